"""Rule matching: from prompt text to findings.

Every pattern is a literal regular expression, which Spark compiles once per
task.  Two projections follow one another, so that work is only done where the
first left something to do:

1. `_hits`: the rules that match, with their matches.  The words of a text
   that occur in the catalogue are looked up first, in one pass, and a pattern
   is tried only on texts with one of its words.
2. `_placed`: where those matches are, on texts that have any.

Findings are then read off `_placed`.  Nothing is shuffled and nothing leaves
the JVM.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from promptsieve.functions import catalogue as C
from promptsieve.functions.dialect import (
    array_literal,
    fold,
    folded_words,
    java_regex,
    key_word,
    literal,
    luhn_valid,
    term_regex,
)
from promptsieve.functions.spans import SPAN, match_spans, window, windows, words

FINDING = (
    "struct<rule_no:int,category:string,reason:string,score:int,confidence:string,"
    "source:string,matches:int,evidence:array<string>>"
)
DETECTION = (
    "struct<rule_no:int,pattern_no:int,start:int,end:int,category:string,reason:string,"
    "score:int,confidence:string,source:string,evidence:string>"
)


@dataclass(frozen=True)
class Entry:
    """What one pattern or term rule reports; the fields of a finding."""

    rule_no: int
    pattern_no: int
    category: str
    reason: str
    score: int
    confidence: str
    source: str
    kind: str
    regex: str | None = None


def _entries(rules: C.Catalogue) -> list[tuple[Entry, C.Pattern | None]]:
    """All entries in reporting order: personal data, health information,
    internal policy, client data, usage policy."""
    listed: list[tuple[Entry, C.Pattern | None]] = []

    def add_term_rule(number: int, variants) -> None:
        for category, score, confidence, reason in variants:
            listed.append(
                (Entry(number, 0, category, reason, score, confidence, C.ACCEPTABLE_USE, "term"), None)
            )

    def add_family(number: int, family: tuple[C.Rule, ...]) -> int:
        for rule in family:
            for pattern_no, pattern in enumerate(rule.patterns):
                regex = java_regex(pattern.regex, ignore_case=rule.kind != "card")
                entry = Entry(
                    number, pattern_no, rule.category, rule.reason, rule.score,
                    rule.confidence, rule.source, rule.kind, regex,
                )
                listed.append((entry, pattern))
            number += 1
        return number

    number = add_family(0, rules.personal_data)
    phi = [(C.PHI_CATEGORY, *weight, C.PHI_REASON) for weight in (C.PHI_STRONG, C.PHI_WEAK)]
    add_term_rule(number, phi)
    number = add_family(number + 1, rules.internal_policy)
    add_term_rule(number, (C.CLIENT_STRONG, C.CLIENT_WEAK))
    add_family(number + 1, rules.usage_policy)
    return listed


def _key_words(rules: C.Catalogue) -> list[str]:
    """Every word a pattern or term of the catalogue asks for."""
    terms = (
        rules.phi_terms + rules.client_terms + rules.document_terms
        + rules.data_terms + rules.action_terms
    )
    needs = [w for _, pattern in _entries(rules) if pattern for w in pattern.needs]
    return list(dict.fromkeys(needs + [key_word(t) for t in terms]))


def _overlaps(wanted) -> str:
    return f"arrays_overlap(_keys, {array_literal(wanted)})"


def _gate(pattern: C.Pattern) -> str:
    """SQL: whether a text can match."""
    tests = [_overlaps(pattern.needs)] if pattern.needs else []
    for part in pattern.holds:
        tests.append("_digit" if part == C.DIGIT else f"contains(_folded, {literal(part)})")
    return " OR ".join(tests) or "true"


def _has_term(text: str, terms) -> str:
    found = f"rlike({text}, {literal(term_regex(*terms))})"
    return f"({_overlaps(map(key_word, terms))} AND {found})"


def _named_if_present(text: str, named_terms, gate: str) -> str:
    """SQL: the names whose terms the text has, in order; null unless `gate`."""
    found = [f"if({_has_term(text, terms)}, {literal(name)}, null)" for name, terms in named_terms]
    return f"if({gate}, array_compact(array({', '.join(found)})), null)"


def _phi_terms(text: str, rules: C.Catalogue) -> str:
    """SQL: health-information terms of the text, in catalogue order."""
    if not rules.phi_terms:
        return "cast(null AS array<string>)"
    return _named_if_present(
        text, [(t, (t,)) for t in rules.phi_terms], _has_term(text, rules.phi_terms)
    )


def _client_groups(text: str, rules: C.Catalogue) -> str:
    """SQL: labels of the client-data groups of the text; null without a client."""
    if not rules.client_terms:
        return "cast(null AS array<string>)"
    groups = zip(
        C.CLIENT_GROUP_LABELS,
        (rules.client_terms, rules.document_terms, rules.data_terms, rules.action_terms),
    )
    return _named_if_present(text, groups, _has_term(text, rules.client_terms))


def _hit(entry, regex: str, found: str, given: str = "cast(null AS string)") -> str:
    return (
        f"named_struct('entry', {entry}, 'regex', {regex}, 'found', {found}, 'given', {given})"
    )


def _regex_for(value: str, terms) -> str:
    cases = " ".join(f"WHEN {literal(t)} THEN {literal(term_regex(t))}" for t in terms)
    return f"CASE {value} {cases} END"


def _phi_hit(text: str, entry: int, rules: C.Catalogue) -> str:
    """Evidence is the first match of the first term in catalogue order."""
    strong = f"size(_phi) >= 2 OR arrays_overlap(_phi, {array_literal(rules.phi_strong_terms)})"
    regex = _regex_for("_phi[0]", rules.phi_terms)
    hit = _hit(
        f"if({strong}, {entry}, {entry + 1})", regex, f"array(regexp_substr({text}, {regex}))"
    )
    return f"if(size(_phi) > 0, {hit}, null)"


def _client_hit(text: str, entry: int) -> str:
    """Evidence is round the first group label that is itself a word of the
    text; failing that, the start of the text."""
    strong = f"arrays_overlap(_groups, {array_literal(('sensitive_data', 'sensitive_document'))})"
    labels = ", ".join(
        f"if(array_contains(_groups, {literal(name)}) AND "
        f"rlike({text}, {literal(term_regex(name))}), {literal(name)}, null)"
        for name in C.CLIENT_GROUP_LABELS
    )
    regex = _regex_for(f"coalesce({labels})", C.CLIENT_GROUP_LABELS)
    found = f"regexp_substr({text}, {regex})"
    hit = _hit(
        f"if({strong}, {entry}, {entry + 1})",
        regex,
        f"if({found} IS NULL, null, array({found}))",
        f"if({found} IS NULL, substring({text}, 1, {C.EXCERPT_CHARS}), null)",
    )
    return f"if(size(_groups) >= 2, {hit}, null)"


def _with_hits(df: DataFrame, text_col: str, rules: C.Catalogue, every_match: bool = True) -> DataFrame:
    """Add `_hits`.  Without `every_match`, a rule that needs no look at its
    matches stops at the first one, and its `found` is only a sign."""
    text = f"`{text_col}`"
    hits = []
    for i, (entry, pattern) in enumerate(_entries(rules)):
        if pattern is not None:
            regex = literal(entry.regex)
            if every_match or entry.kind != "regex":
                found = f"if({_gate(pattern)}, regexp_extract_all({text}, {regex}, 0), null)"
            else:
                found = f"if(({_gate(pattern)}) AND rlike({text}, {regex}), array(''), null)"
            hits.append(_hit(i, regex, found))
        elif entry.category == C.PHI_CATEGORY and entry.score == C.PHI_STRONG[0] and rules.phi_terms:
            hits.append(_phi_hit(text, i, rules))
        elif entry.category == C.CLIENT_STRONG[0] and rules.client_terms:
            hits.append(_client_hit(text, i))
    # An empty catalogue gives an empty list, of the same type.
    listed = f"cast(array({', '.join(hits)}) AS array<struct<entry:int,regex:string,found:array<string>,given:string>>)"
    kept = f"filter({listed}, h -> size(h.found) > 0 OR h.given IS NOT NULL)"
    return (
        df.withColumns({"_folded": fold(F.col(text_col)), "_digit": F.col(text_col).rlike(r"\p{Nd}")})
        .withColumn("_found_words", folded_words(F.col("_folded")))
        .withColumn("_keys", F.expr(f"array_intersect(_found_words, {array_literal(_key_words(rules))})"))
        .withColumns(
            {
                "_phi": F.expr(_phi_terms(text, rules)),
                "_groups": F.expr(_client_groups(text, rules)),
            }
        )
        .withColumn("_hits", F.expr(kept))
        .drop("_folded", "_digit", "_found_words", "_keys", "_phi", "_groups")
    )


_FIELDS = ("rule_no", "pattern_no", "category", "reason", "score", "confidence", "source", "kind")


def _table(rules: C.Catalogue, fields: tuple[str, ...] = _FIELDS) -> str:
    """SQL: the entries as a constant array, looked up by a hit's entry number."""
    rows = []
    for entry, _ in _entries(rules):
        values = ((f, getattr(entry, f)) for f in fields)
        pairs = (f"'{f}', {v if isinstance(v, int) else literal(v)}" for f, v in values)
        rows.append(f"named_struct({', '.join(pairs)})")
    return f"array({', '.join(rows)})"


def _with_places(df: DataFrame, text_col: str, rules: C.Catalogue) -> DataFrame:
    """Add `_placed`, the hits with their spans, and the text's `_words`."""
    text, all_words = F.col(text_col), F.col("_words")
    sensitive = term_regex(*rules.contact_terms)
    df = df.withColumn("_words", F.when(F.size("_hits") > 0, words(text)))

    spans = match_spans(f"`{text_col}`", "h.regex", "h.found")
    placed = F.expr(
        f"""transform(_hits, h -> named_struct('rule', {_table(rules)}[h.entry],
        'found', h.found, 'given', h.given, 'spans', if(h.found IS NULL, null, {spans})))"""
    )

    def checked(hit: Column) -> Column:
        kind, spans, found = hit["rule"]["kind"], hit["spans"], hit["found"]
        cards = F.filter(spans, lambda _, i: luhn_valid(F.get(found, i)))
        contacts = F.filter(spans, lambda s: window(all_words, s).rlike(sensitive))
        kept = F.when(kind == "card", cards).when(kind == "contact", contacts).otherwise(spans)
        return F.struct(
            hit["rule"].alias("rule"), hit["given"].alias("given"), kept.alias("spans")
        )

    real = F.filter(F.transform(placed, checked), lambda h: h["given"].isNotNull() | (F.size(h["spans"]) > 0))
    return df.withColumn("_placed", real)


def _plan(df: DataFrame, text: str, rules: C.Catalogue) -> DataFrame:
    return _with_places(_with_hits(df, text, rules), text, rules)


def detect(df: DataFrame, text: str = "prompt", rules: C.Catalogue = C.DEFAULT) -> DataFrame:
    """Add `findings`, one entry per pattern or term rule that fires.

    An entry holds the number of matches and their distinct evidence windows.
    Use `detections` for one row per match.
    """
    all_words = F.col("_words")

    def finding(hit: Column) -> Column:
        rule, given, spans = hit["rule"], hit["given"], hit["spans"]
        evidence = F.when(given.isNotNull(), F.array(given)).otherwise(windows(all_words, spans))
        return F.struct(
            *(rule[f].alias(f) for f in ("rule_no", "category", "reason", "score", "confidence", "source")),
            F.when(given.isNotNull(), 1).otherwise(F.size(spans)).alias("matches"),
            evidence.alias("evidence"),
        )

    findings = F.transform(F.col("_placed"), finding).cast(f"array<{FINDING}>")
    found = F.coalesce(findings, F.array().cast(f"array<{FINDING}>"))
    return _plan(df, text, rules).select(*df.columns, found.alias("findings"))


def verdicts(df: DataFrame, text: str = "prompt", rules: C.Catalogue = C.DEFAULT) -> DataFrame:
    """Add `findings` with category, score and confidence alone: which rules fire.

    What fires is what `detect` finds, but matches are neither listed nor placed,
    except those of rules that look at the words around them.
    """
    numbers = {
        kind: [i for i, (entry, _) in enumerate(_entries(rules)) if entry.kind == kind] for kind in ("card", "contact")
    }

    def of_kind(kind: str) -> str:
        return f"h.entry IN ({', '.join(map(str, numbers[kind]))})" if numbers[kind] else "false"

    hits = _with_hits(df, text, rules, every_match=False)
    needs_words = F.expr(f"exists(_hits, h -> {of_kind('contact')})")
    hits = hits.withColumn("_words", F.when(needs_words, words(F.col(text))))
    spans = match_spans(f"`{text}`", "h.regex", "h.found")
    looked_at = F.expr(
        f"""transform(_hits, h -> named_struct('rule', {_table(rules, ('category', 'score', 'confidence'))}[h.entry],
        'cards', if({of_kind('card')}, h.found, null), 'contacts', if({of_kind('contact')}, {spans}, null)))"""
    )
    sensitive, all_words = term_regex(*rules.contact_terms), F.col("_words")

    def fires(hit: Column) -> Column:
        near = F.exists(hit["contacts"], lambda s: window(all_words, s).rlike(sensitive))
        return F.when(hit["cards"].isNotNull(), F.exists(hit["cards"], luhn_valid)).when(hit["contacts"].isNotNull(), near).otherwise(True)

    fired = F.transform(F.filter(looked_at, fires), lambda h: h["rule"])
    none = F.array().cast("array<struct<category:string,score:int,confidence:string>>")
    return hits.select(*df.columns, F.coalesce(fired, none).alias("findings"))


def detections(df: DataFrame, text: str = "prompt", rules: C.Catalogue = C.DEFAULT) -> DataFrame:
    """One row per match of every rule, in reporting order, with its place and
    evidence; the columns of `df` are kept.  A client-data finding has no place
    in the text unless its evidence has."""
    all_words = F.col("_words")
    nowhere = F.array(F.lit(None).cast(SPAN))

    def listed(hit: Column) -> Column:
        rule, given = hit["rule"], hit["given"]
        spans = F.when(given.isNotNull(), nowhere).otherwise(hit["spans"])

        def detection(span: Column) -> Column:
            return F.struct(
                rule["rule_no"].alias("rule_no"),
                rule["pattern_no"].alias("pattern_no"),
                span["start"].alias("start"),
                span["end"].alias("end"),
                *(rule[f].alias(f) for f in ("category", "reason", "score", "confidence", "source")),
                F.coalesce(given, window(all_words, span)).alias("evidence"),
            )

        return F.transform(spans, detection)

    hits = F.flatten(F.transform(F.col("_placed"), listed)).cast(f"array<{DETECTION}>")
    planned = _plan(df, text, rules).select(*df.columns, hits.alias("_detections"))
    rows = planned.select(*df.columns, F.posexplode_outer("_detections").alias("detection_no", "_d"))
    return rows.where(F.col("detection_no").isNotNull()).select(*df.columns, "detection_no", "_d.*")
