"""Format-preserving pseudonyms for personal data, by keyed Feistel rounds.

Card numbers, social security numbers, phone numbers, IPv4 addresses and dates
are found by pattern and then validated.  A valid one is split into two halves,
and eight rounds each add a keyed hash of one half to the other, modulo that
half's range: a permutation of the values of its format.  What comes out is
valid again (the check digit is computed anew, an area stays an area, a date a
date) and is written in the digits of the original, separators kept.  The same
value gives the same pseudonym wherever and however it is written, so documents
stay linked.  Addresses of mailboxes have no such range; theirs are keyed hashes.

All of it is column functions: a text is cut at its matches once, and the pieces
are joined with the pseudonyms between them.

Cards may stand among other digits: of a stretch of digit groups, the runs of
whole groups that pass the Luhn check are cards.  Telephone numbers are those of
ten digits in groups of 3, 3 and 4, with or without a country code before them;
other national forms are not looked for.

Defined cases: a null text stays null.  Numbers that fail their check stay as
they are.  Cards of one stretch of digits count as one in n_replaced.  Dates count from 1900 on for 72,900 days; others stay.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from promptsieve.llm.texts import column, let

ROUNDS = 8

# What is looked for, the longer forms first.
_LETTERS = r"\p{L}\p{M}\p{N}"
MAILBOX = rf"(?<![{_LETTERS}_.%+-])[{_LETTERS}_.%+-]++@[{_LETTERS}-]+(?:\.[{_LETTERS}-]+)*\.\p{{L}}[\p{{L}}\p{{M}}]++"
ADDRESS = r"(?<![\d.])\d{1,3}\.\d{1,3}\.\d{1,3}\.\d{1,3}(?!\.?\d)"
ISO_DATE = r"(?<![\d-])\d{4}-\d{2}-\d{2}(?![\d-])"
DATE = r"(?<![\d./])\d{1,2}[./]\d{1,2}[./]\d{4}(?![\d/]|\.\d)"
SECURITY = r"(?<![\d-])\d{3}-\d{2}-\d{4}(?![\d-])"
PHONE = r"(?<![\w+])(?:\+\d{1,3}[ .-]?)?(?:\(\d{3}\) ?|\d{3}[ .-])\d{3}[ .-]\d{4}(?![\d-])"
# A stretch of 13 digits or more, in which cards are looked for.  It ends where
# another form begins: behind 13 digits a telephone number makes 23, which no
# card has.  A group with a hyphen behind it is part of something else.
_OTHER = f"{ADDRESS}|{ISO_DATE}|{DATE}|{SECURITY}|" + r"\d{3}[ .-]\d{3}[.-]\d{4}(?![\d-])"
CARD = rf"(?<![\d-])\d(?:(?: (?!{_OTHER})|-)?\d){{12}}(?:(?:[ -](?!{_OTHER}|{PHONE}))?\d)*+-?"
FORMS = {"mailbox": MAILBOX, "address": ADDRESS, "iso_date": ISO_DATE, "date": DATE, "security": SECURITY, "phone": PHONE, "card": CARD}
ANY = "|".join(f"(?:{p})" for p in FORMS.values())

FIRST_DAY = "1900-01-01"
DAY_HALF = 270


def keyed(key: str, *parts: Column) -> Column:
    """A number below 2**60 from the key and the parts."""
    text = F.concat_ws("|", F.lit(key), *(p.cast("string") for p in parts), F.lit(key))
    return F.conv(F.substring(F.sha2(text.cast("binary"), 256), 1, 15), 16, 10).cast("long")


def feistel(high: Column, low: Column, high_range: Column, low_range: Column, key: str, kind: Column) -> Column:
    """struct(high, low): the permuted pair of halves, each within its range."""
    start = F.struct(high.cast("long").alias("high"), low.cast("long").alias("low"))

    def step(s: Column, i: Column) -> Column:
        return F.when(
            i % 2 == 0,
            F.struct(F.pmod(s["high"] + keyed(key, kind, i, s["low"]) % high_range, high_range).alias("high"), s["low"].alias("low")),
        ).otherwise(
            F.struct(s["high"].alias("high"), F.pmod(s["low"] + keyed(key, kind, i, s["high"]) % low_range, low_range).alias("low"))
        )

    return F.aggregate(F.sequence(F.lit(0), F.lit(ROUNDS - 1)), start, step)


def _digits(match: Column) -> Column:
    return F.regexp_replace(match, "[^0-9]", "")


def _in_form(match: Column, digits: Column) -> Column:
    """The digits in the places of the match's own digits."""
    before = lambda i: F.length(_digits(F.substring(match, F.lit(1), i)))
    return F.array_join(
        F.transform(
            F.sequence(F.lit(1), F.length(match)),
            lambda i: let(
                F.substring(match, i, F.lit(1)),
                lambda c: F.when(c.rlike("[0-9]"), F.substring(digits, before(i), F.lit(1))).otherwise(c),
            ),
        ),
        "",
    )


def _padded(number: Column, width: Column) -> Column:
    return F.lpad(number.cast("string"), width, F.lit("0"))


def _permuted_digits(digits: Column, key: str, kind: str) -> Column:
    """A digit string permuted among those of its length (18 at most)."""
    n = F.length(digits)
    half = F.floor(n / 2).cast("int")
    ten = lambda k: F.pow(F.lit(10.0), k).cast("long")
    halves = feistel(
        F.substring(digits, F.lit(1), half), F.substring(digits, half + 1, n - half), ten(half), ten(n - half),
        key, F.concat(F.lit(kind), n),
    )
    return let(halves, lambda h: F.concat(_padded(h["high"], half), _padded(h["low"], n - half)))


def _check_digit(payload: Column) -> Column:
    """The digit that makes the number pass the Luhn check."""
    n = F.length(payload)

    def add(total: Column, i: Column) -> Column:
        d = F.substring(payload, i, F.lit(1)).cast("int")
        doubled = F.when(d > 4, d * 2 - 9).otherwise(d * 2)
        return total + F.when((n - i) % 2 == 0, doubled).otherwise(d)

    return F.pmod(-F.aggregate(F.sequence(F.lit(1), n), F.lit(0), add), F.lit(10)).cast("string")


def _luhn(digits: Column) -> Column:
    return _check_digit(F.substring(digits, F.lit(1), F.length(digits) - 1)) == F.right(digits, F.lit(1))


def _cards_in(match: Column) -> Column:
    """Array of struct(start, size): where in a stretch of digits there are cards.

    A card is a run of whole groups with 13 to 19 digits that passes the Luhn
    check.  From the left, the longest run at a group is taken, unless a longer
    one begins within it.
    """

    def longest(groups: Column, i: Column, last: Column) -> Column:
        """Place of the last group of the longest run from group i on, or null."""
        joined = lambda j: F.array_join(F.slice(groups, i + 1, j - i + 1), "")
        ends = F.when(i <= last, F.sequence(i, F.least(i + 18, last)))
        fits = F.filter(ends, lambda j: let(joined(j), lambda d: F.when(F.length(d).between(13, 19), _luhn(d)).otherwise(False)))
        return F.array_max(fits)

    def runs(groups: Column) -> Column:
        last = F.size(groups) - F.when(match.endswith("-"), 3).otherwise(1)
        # Where group i begins, in characters, and how long a run of groups is.
        sizes = F.transform(groups, lambda g: F.length(g))
        run = lambda i: let(
            longest(groups, i, last),
            lambda j: F.struct(
                i.alias("i"), j.alias("j"),
                F.length(F.array_join(F.slice(groups, i + 1, j - i + 1), "")).alias("digits"),
                (F.length(F.array_join(F.slice(groups, i + 1, j - i + 1), " "))).alias("size"),
            ),
        )
        found = F.transform(F.sequence(F.lit(0), F.size(groups) - 1), run)
        none = F.array().cast("array<struct<start:int,size:int>>")
        start = F.struct(F.lit(0).alias("free"), F.lit(1).alias("at"), none.alias("cards"))

        def pick(state: Column, r: Column, all_runs: Column, lengths: Column) -> Column:
            inside = F.slice(all_runs, r["i"] + 2, r["j"] - r["i"])
            taken = r["j"].isNotNull() & (r["i"] >= state["free"]) & ~F.exists(inside, lambda o: F.coalesce(o["digits"] > r["digits"], F.lit(False)))
            return F.struct(
                F.when(taken, r["j"] + 1).otherwise(state["free"]).alias("free"),
                (state["at"] + F.get(lengths, r["i"]) + 1).alias("at"),
                F.when(taken, F.concat(state["cards"], F.array(F.struct(state["at"].alias("start"), r["size"].alias("size")))))
                .otherwise(state["cards"]).alias("cards"),
            )

        return let(found, lambda f: let(sizes, lambda z: F.aggregate(f, start, lambda s, r: pick(s, r, f, z))["cards"]))

    return let(F.split(match, "[ -]"), runs)


def _card(match: Column, key: str) -> Column:
    def permuted(card: Column) -> Column:
        def new(d: Column) -> Column:
            payload = _permuted_digits(F.substring(d, F.lit(1), F.length(d) - 1), key, "card")
            return let(payload, lambda p: F.concat(p, _check_digit(p)))

        return let(_digits(card), lambda d: _in_form(card, new(d)))

    def filled(cards: Column) -> Column:
        """The cards permuted, and before each and behind the last what stays."""

        def piece(c: Column, n: Column) -> Column:
            before = F.when(n == 0, F.lit(1)).otherwise(let(F.get(cards, n - 1), lambda b: b["start"] + b["size"]))
            return F.concat(F.substring(match, before, c["start"] - before), permuted(F.substring(match, c["start"], c["size"])))

        rest = let(F.element_at(cards, -1), lambda c: F.substring(match, c["start"] + c["size"], F.length(match)))
        return F.concat(F.array_join(F.transform(cards, piece), ""), rest)

    return let(_cards_in(match), lambda cards: F.when(F.size(cards) > 0, filled(cards)))


def _security(match: Column, key: str) -> Column:
    area, group, serial = (F.split(match, "-")[i].cast("long") for i in range(3))
    valid = (area > 0) & (area < 900) & (area != 666) & (group > 0) & (serial > 0)
    # Areas 1 to 899 without 666; group and serial as one number.
    index = area - F.when(area > 666, 2).otherwise(1)
    halves = feistel(index, (group - 1) * 9999 + serial - 1, F.lit(898), F.lit(99 * 9999), key, F.lit("security"))
    new = let(
        halves,
        lambda h: F.concat_ws(
            "-",
            _padded(h["high"] + F.when(h["high"] >= 665, 2).otherwise(1), F.lit(3)),
            _padded(F.floor(h["low"] / 9999) + 1, F.lit(2)),
            _padded(h["low"] % 9999 + 1, F.lit(4)),
        ),
    )
    return F.when(valid, new)


def _phone(match: Column, key: str) -> Column:
    """The last ten digits are permuted; the country code stays."""
    return let(
        _digits(match),
        lambda d: _in_form(
            match, F.concat(F.substring(d, F.lit(1), F.length(d) - 10), _permuted_digits(F.right(d, F.lit(10)), key, "phone"))
        ),
    )


def _address(match: Column, key: str) -> Column:
    parts = F.transform(F.split(match, r"\."), lambda p: p.cast("long"))

    def permuted(p: Column) -> Column:
        halves = feistel(p[0] * 256 + p[1], p[2] * 256 + p[3], F.lit(65536), F.lit(65536), key, F.lit("address"))
        return let(
            halves,
            lambda h: F.concat_ws(".", *((x.cast("long")).cast("string") for side in ("high", "low") for x in (F.floor(h[side] / 256), h[side] % 256))),
        )

    return let(parts, lambda p: F.when(F.forall(p, lambda x: x < 256), permuted(p)))


def _new_date(year: Column, month: Column, day: Column, key: str) -> Column:
    """The permuted date, or null if the parts are none or out of range."""
    leap = (year % 4 == 0) & ((year % 100 != 0) | (year % 400 == 0))
    last = F.when(month == 2, F.when(leap, 29).otherwise(28)).when(month.isin(4, 6, 9, 11), 30).otherwise(31)
    valid = (year >= 1900) & (year < 2100) & (month >= 1) & (month <= 12) & (day >= 1) & (day <= last)
    days = F.when(valid, F.datediff(F.make_date(year, month, day), F.lit(FIRST_DAY).cast("date")))
    halves = feistel(F.floor(days / DAY_HALF), days % DAY_HALF, F.lit(DAY_HALF), F.lit(DAY_HALF), key, F.lit("date"))
    return F.when(
        valid & (days < DAY_HALF * DAY_HALF),
        let(halves, lambda h: F.date_add(F.lit(FIRST_DAY).cast("date"), (h["high"] * DAY_HALF + h["low"]).cast("int"))),
    )


def _iso_date(match: Column, key: str) -> Column:
    year, month, day = (F.split(match, "-")[i].cast("int") for i in range(3))
    return F.date_format(_new_date(year, month, day, key), "yyyy-MM-dd")


def _date(match: Column, key: str) -> Column:
    """Day first with dots; with slashes month first, or day first if only that
    makes a date."""
    parts = F.transform(F.split(match, "[./]"), lambda p: p.cast("int"))
    dotted, padded = F.substring(match, F.length(match) - 4, F.lit(1)) == ".", F.length(match) == 10

    def written(p: Column) -> Column:
        day_first = dotted | (p[0] > 12)
        new = _new_date(p[2], F.when(day_first, p[1]).otherwise(p[0]), F.when(day_first, p[0]).otherwise(p[1]), key)
        forms = {
            (True, True, True): "dd.MM.yyyy", (True, True, False): "d.M.yyyy",
            (False, True, True): "dd/MM/yyyy", (False, True, False): "d/M/yyyy",
            (False, False, True): "MM/dd/yyyy", (False, False, False): "M/d/yyyy",
        }
        return let(
            new,
            lambda d: F.coalesce(
                *(
                    F.when((dotted == F.lit(dots)) & (day_first == F.lit(first)) & (padded == F.lit(wide)), F.date_format(d, form))
                    for (dots, first, wide), form in forms.items()
                )
            ),
        )

    return let(parts, written)


def _mailbox(match: Column, key: str) -> Column:
    """A hash in letters for the mailbox and its host; the ending stays."""
    code = F.translate(F.substring(F.sha2(F.concat_ws("|", F.lit(key), F.lower(match), F.lit(key)).cast("binary"), 256), 1, 20), "0123456789", "ghijklmnop")
    return F.concat(F.substring(code, 1, 12), F.lit("@"), F.substring(code, 13, 8), F.lit("."), F.substring_index(match, ".", -1))


_BY_FORM = {
    "mailbox": _mailbox, "address": _address, "iso_date": _iso_date, "date": _date, "security": _security, "phone": _phone, "card": _card,
}


def pseudonym(match: Column, key: str) -> Column:
    """The pseudonym of a match of `ANY`, or null if it is not valid."""
    found = F.when(F.lit(False), F.lit(None).cast("string"))
    for form, make in _BY_FORM.items():
        found = found.when(match.rlike(f"^(?:{FORMS[form]})$"), make(match, key))
    return found


def pseudonymise(docs: DataFrame, key: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: doc_id, text with pseudonyms, and n_replaced."""
    matches = F.coalesce(F.regexp_extract_all(column(text_col), F.lit(ANY), F.lit(0)), F.array().cast("array<string>"))
    found = docs.select(column(id_col).alias("doc_id"), column(text_col).alias("text"), matches.alias("matches"))
    named = found.withColumn(
        "news", F.when(F.size("matches") > 0, F.transform("matches", lambda m: pseudonym(m, key)))
    )
    pieces = F.split("text", ANY, -1)
    filled = F.zip_with("news", "matches", lambda new, old: F.coalesce(new, old))
    joined = F.array_join(F.flatten(F.zip_with(pieces, filled, lambda p, m: F.array(p, F.coalesce(m, F.lit(""))))), "")
    return named.select(
        "doc_id",
        F.when(F.size("matches") > 0, joined).otherwise(F.col("text")).alias("text"),
        F.coalesce(F.size(F.filter("news", lambda n: n.isNotNull())), F.lit(0)).cast("long").alias("n_replaced"),
    )
