"""Where a pattern matches in a text, and the words around each match.

A match is described by a `SPAN`: character offsets `start` and `end`, and the
positions `first` and `last` of the words it begins and ends in.  All spans of
a text come from one cut of the text at its matches: the pieces between and
the matches themselves are measured once each, and running totals over them
give offsets and word positions.  The totals are summed by doubling steps, so
that n matches cost n log n however many a text has.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from promptsieve.functions.catalogue import WINDOW_WORDS
from promptsieve.functions.dialect import NOT_SPACE, UNEVEN_SPACES, literal

SPAN = "struct<start:int,end:int,first:int,last:int>"


def words(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit(f"{NOT_SPACE}+"), F.lit(0))


def _measures(pieces: str) -> str:
    """SQL: length, words, and whether a word reaches the start or the end."""
    word, opens, closes = (literal(p) for p in (f"{NOT_SPACE}+", f"^{NOT_SPACE}", rf"{NOT_SPACE}\z"))
    return f"""transform({pieces}, x -> named_struct('n', length(x),
        'w', size(regexp_extract_all(x, {word}, 0)), 'opens', rlike(x, {opens}), 'closes', rlike(x, {closes})))"""


def _let(name: str, value: str, body: str) -> str:
    """SQL: `body` with `name` standing for `value`, which is computed once."""
    return f"transform(array({value}), {name} -> {body})[0]"


def match_spans(text: str, regex: str, found: str) -> str:
    """SQL: spans of `found`, the first or all matches of `regex` in `text`."""
    # The last gap has no match behind it.
    pairs = f"""zip_with(slice({_measures(f"split({text}, {regex}, -1)")}, 1, size({found})),
        {_measures(found)}, (gap, hit) -> named_struct('gap', gap, 'hit', hit))"""
    # A piece that goes on with the word before it begins one word less.
    open_before = "coalesce(get(pairs, i - 1).hit.closes, false)"
    open_at_hit = f"if(p.gap.n = 0, {open_before}, p.gap.closes)"
    words_begun = f"""transform(pairs, (p, i) -> named_struct('p', p,
        'open', {open_at_hit},
        'in_gap', p.gap.w - if({open_before} AND p.gap.opens, 1, 0),
        'in_hit', p.hit.w - if({open_at_hit} AND p.hit.opens, 1, 0)))"""
    totals = "transform(steps, x -> named_struct('n', x.p.gap.n + x.p.hit.n, 'w', x.in_gap + x.in_hit))"
    doubling = "transform(sequence(0, cast(ceil(log2(size(steps))) AS int)), e -> cast(pow(2, e) AS int))"
    running = f"""aggregate({doubling}, {totals}, (sums, d) -> transform(sums, (x, i) ->
        if(i < d, x, named_struct('n', x.n + sums[i - d].n, 'w', x.w + sums[i - d].w))))"""
    spans = f"""zip_with(steps, {running}, (x, sum) -> named_struct(
        'start', sum.n - x.p.hit.n, 'end', sum.n,
        'first', sum.w - x.in_hit - if(x.open, 1, 0), 'last', sum.w - 1))"""
    return f"""if(size({found}) > 0, {_let('pairs', pairs, _let('steps', words_begun, spans))},
        cast(array() AS array<{SPAN}>))"""


def window(all_words: Column, span, size: int = WINDOW_WORDS) -> Column:
    """The words of a span with up to `size` words on either side."""
    left = F.greatest(span["first"] - F.lit(size), F.lit(0))
    taken = F.slice(all_words, left + 1, span["last"] + size + 1 - left)
    return F.array_join(taken, " ")


def windows(all_words: Column, spans: Column) -> Column:
    """Distinct windows in order of first appearance.  Matches inside the same
    words share a window, so the words are told apart before any is joined.  A
    place is one number, its first word and its length in words, because numbers
    are told apart by hashing and structs are not."""
    places = F.array_distinct(
        F.transform(
            spans, lambda s: F.shiftleft(s["first"].cast("bigint"), 32) + (s["last"] - s["first"])
        )
    )

    def at(place: Column) -> Column:
        first = F.shiftright(place, 32).cast("int")
        extra = place.bitwiseAND(F.lit(0xFFFFFFFF)).cast("int")
        return window(all_words, {"first": first, "last": first + extra})

    return F.array_distinct(F.transform(places, at))


def collapse_spaces(text: Column) -> Column:
    return F.trim(F.regexp_replace(text, UNEVEN_SPACES, " "))
