
from __future__ import annotations

import os
import sys
from collections.abc import Callable
from datetime import datetime

HERE = os.path.dirname(os.path.abspath(__file__))
sys.path.insert(0, HERE)

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import oracles
import promptsieve as ps
import workloads as w
from promptsieve.functions import catalogue as C
from promptsieve.functions.redaction import excerpt
from promptsieve.operators.summary import clean_cells
from promptsieve.plans import export
from promptsieve.plans.review import parse_lines
from promptsieve.session import shared_dir
from promptsieve.sources import listing
from promptsieve.sources.lines import numbered_lines
from promptsieve.sources.sinks import stage
from promptsieve.streaming import review as streaming

# The training-data operators come as a part that can be taken out; if it is
# there, whatever it lacks is an error.
if all(os.path.exists(os.path.join(HERE, part)) for part in ("corpus_pipeline.py", "promptsieve/llm/queries.py")):
    import corpus_pipeline
    from promptsieve.llm import queries as llm
else:
    llm = corpus_pipeline = None

ENTRY_DIR = "/root/testdata/sf0.001"
NOW = datetime(2026, 5, 7)
CONFIG = export.ExportConfig("org-1", "CONVERSATION_MESSAGE")


def entry(spark: SparkSession) -> DataFrame:
    """Prompts per risk level."""
    return by_risk_level(spark, ENTRY_DIR)


# --- Decoding and extraction -------------------------------------------------


def role_filter(spark, sf):
    return ps.with_record_facts(w.records(spark, sf)).select("conv_id", "turn", "is_response")


def log_cursor(spark, sf):
    """Pages of up to a hundred purchases past the cursor, as landed listings."""
    after = "2024-01-10T00:00:00Z"
    events = w.table(spark, sf, "events").withColumnRenamed("ts", "end_time")
    past = listing.listed_after(events, "purchase", datetime(2024, 1, 10))
    pages = past.groupBy(F.floor(F.col("event_id") / 100).alias("page_no")).agg(
        F.collect_list(F.struct(F.col("event_id").cast("string").alias("id"))).alias("data"),
        F.date_format(F.max("end_time"), "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("last_end_time"),
    )
    has_more = F.col("page_no") < pages.agg(F.max("page_no")).scalar()
    responses = pages.select(
        "page_no",
        F.to_json(F.struct("data", has_more.alias("has_more"), "last_end_time")).alias("page_json"),
    )
    reached = listing.cursor(listing.read_pages(responses), after)
    now = F.to_timestamp_ntz(F.lit("2024-02-09 00:00:00"))
    return reached.withColumn("window_start", listing.window_start_column(now, 30))


def decode_payload(spark, sf):
    decoded = ps.decode_payload(w.bodies(spark, sf))
    return decoded.where(F.col("record_no").isNotNull())


def _export(spark, sf):
    """(pages, entries, units) from written tables, as in an export."""
    pages = listing.read_pages(w.listing_pages(spark, sf))
    entries = stage(listing.entries(pages), shared_dir(spark, "entries"))
    fetched = listing.fetch_bodies(entries, w.bodies(spark, sf))
    units = stage(export.decoded_units(fetched), shared_dir(spark, "units"))
    return pages, entries, units


def export_warnings(spark, sf):
    _, entries, units = _export(spark, sf)
    return export.in_order(export.warnings(entries, units))


def manifest(spark, sf):
    return export.manifest(CONFIG, *_export(spark, sf), NOW)


def extract_prompts(spark, sf):
    rows = ps.prompt_rows(ps.extract_prompts(ps.with_record_facts(w.records(spark, sf))))
    ids = ("event_id", "conversation_id", "message_id", "user_id", "user_email", "created_at")
    return rows.select("conv_id", "turn", "prompt_no", F.col("own_log_id").alias("source_log_id"), *ids, "content")


def dedup_prompts(spark, sf):
    """Every record listed twice, and messages whose ids are a number and the
    same digits as text, each of them twice."""
    message = F.concat(F.lit('{"role":"'), "role", F.lit('","content":"x","id":'))
    id_text = (F.col("turn") + 1).cast("string")
    number, text = F.concat(message, id_text, F.lit("}")), F.concat(message, F.lit('"'), id_text, F.lit('"}'))
    listed = F.concat(F.lit("["), F.concat_ws(",", w.envelope(), w.envelope(), number, text, number, text), F.lit("]"))
    doubled = w.conversations(spark, sf).select("conv_id", "turn", listed.alias("record_json"))
    rows = ps.prompt_rows(ps.extract_prompts(doubled))
    return rows.select("conv_id", "turn", "prompt_no", "message_id", "content")


def prompt_text(spark, sf):
    """Content of every kind: lists, wrapped values, other objects, numbers, and
    texts forty lists and wrappers deep."""
    turns = w.conversations(spark, sf)
    text, role = F.to_json(F.array("text")), F.col("role")
    bare = F.expr("substring(to_json(array(text)), 2, length(to_json(array(text))) - 2)")
    content = (
        F.when(F.col("turn") % 5 == 0, F.concat(F.lit("["), bare, F.lit(',["'), role, F.lit('",null]]')))
        .when(F.col("turn") % 5 == 1, F.concat(F.lit('{"parts":{"value":'), text, F.lit("}}")))
        .when(F.col("turn") % 5 == 2, F.lit('{"parts_of":{"b":[true,null],"a":1},"kind":"image"}'))
        .when(F.col("turn") % 5 == 3, F.concat(F.lit('[{"text":'), bare, F.lit('},{"value":"tail"},{"n":2}]')))
        .when(F.col("conv_id") % 2 == 0, F.concat(F.lit('[{"text":' * 20), bare, F.lit(',"n":1},null]' * 20)))
        .otherwise(F.lit("17"))
    )
    records = turns.select(
        "conv_id", "turn",
        F.concat(F.lit('{"role":"human","content":'), content, F.lit("}")).alias("record_json"),
    )
    rows = ps.prompt_rows(ps.extract_prompts(records))
    return rows.select("conv_id", "turn", ps.prompt_text().alias("prompt"))


# --- Scanning lines ----------------------------------------------------------


def _parsed_lines(spark, sf):
    lines = numbered_lines(spark, w.write_lines(spark, sf))
    part = F.regexp_extract("file", r"part=(\d+)", 1).cast("bigint")
    return parse_lines(lines), part


def scan_lines(spark, sf):
    parsed, part = _parsed_lines(spark, sf)
    return parsed.select(
        part.alias("part"), "line_number", F.col("record_json").isNotNull().alias("is_json"), "line"
    )


def invalid_lines(spark, sf):
    parsed, part = _parsed_lines(spark, sf)
    broken = parsed.where(F.col("record_json").isNull()).withColumn("part", part)
    return ps.invalid_lines(broken, keep=("part",)).select(
        "part", "line_number", "risk_level", "risk_score", "confidence", "needs_human_review",
        "categories", "matched_evidence", "prompt",
    )


def scan_counters(spark, sf):
    return ps.write_review(numbered_lines(spark, w.write_lines(spark, sf)), shared_dir(spark, "reviewed"))[1]


# --- Rules -------------------------------------------------------------------


def _counts(detected: DataFrame, keys: tuple[str, ...], categories, source: bool = False) -> DataFrame:
    """Matches per row and category, and which policy the category comes from if
    asked.  A row's findings are few, so they are added up inside the row."""
    findings = F.filter("findings", lambda f: f["category"].isin(*categories))
    names = F.array_distinct(F.transform(findings, lambda f: f["category"]))

    def total(name):
        of_name = F.filter(findings, lambda f: f["category"] == name)
        return F.aggregate(of_name, F.lit(0).cast("bigint"), lambda n, f: n + f["matches"])

    def policy(name):
        return F.get(F.filter(findings, lambda f: f["category"] == name), F.lit(0))["source"]

    counted = F.transform(
        names,
        lambda name: F.struct(
            name.alias("category"), total(name).alias("matches"), *([policy(name).alias("source")] if source else [])
        ),
    )
    return detected.select(*keys, F.inline(counted))


def _categories(*families, kinds=("regex",)):
    return [r.category for family in families for r in family if r.kind in kinds]


KEYS = ("conv_id", "turn")


def rule_hits(spark, sf):
    plain = _categories(C.PERSONAL_DATA_RULES, C.INTERNAL_POLICY_RULES, C.USAGE_POLICY_RULES)
    return _counts(ps.detect(w.prompts(spark, sf), rules=C.DEFAULT.only(*plain)), KEYS, plain)


def pii_hits(spark, sf):
    asked = _categories(C.PERSONAL_DATA_RULES)
    return _counts(ps.detect(w.documents(spark, sf), "text", C.DEFAULT.only(*asked)), ("doc_id",), asked)


def policy_hits(spark, sf):
    asked = _categories(C.INTERNAL_POLICY_RULES, C.USAGE_POLICY_RULES)
    return _counts(ps.detect(w.prompts(spark, sf), rules=C.DEFAULT.only(*asked)), KEYS, asked, source=True)


def _places(df: DataFrame, keys, text: str, categories, rules=C.DEFAULT) -> DataFrame:
    return (
        ps.detections(df.select(*keys, text), text, rules.only(*categories))
        .where(F.col("category").isin(*categories))
        .select(*keys, "category", F.col("start").alias("start_at"), F.col("end").alias("end_at"), "evidence")
    )


def card_hits(spark, sf):
    return _places(w.documents(spark, sf), ("doc_id",), "text", ["pii_credit_card"]).drop("category")


def contact_hits(spark, sf):
    return _places(w.prompts(spark, sf), KEYS, "prompt", _categories(C.PERSONAL_DATA_RULES, kinds=("contact",)))


def phi_hits(spark, sf):
    found = ps.detections(w.prompts(spark, sf), rules=C.DEFAULT.only(C.PHI_CATEGORY))
    return found.where(F.col("category") == C.PHI_CATEGORY).select(*KEYS, "score", "confidence", "source")


def client_hits(spark, sf):
    names = (C.CLIENT_STRONG[0], C.CLIENT_WEAK[0])
    found = ps.detections(w.prompts(spark, sf), rules=C.DEFAULT.only(*names))
    return found.where(F.col("category").isin(*names)).select(*KEYS, "category", "score", "evidence")


def evidence_windows(spark, sf):
    """Words round every e-mail address, phone number and labelled secret: a
    catalogue of one's own, with the context test left out."""
    by_name = {r.category: r.patterns[0] for r in C.PERSONAL_DATA_RULES}
    wanted = {
        "email": by_name["pii_email_with_sensitive_context"],
        "phone": by_name["pii_phone_with_sensitive_context"],
        "secret": by_name["credentials_or_secrets"],
    }
    rules = tuple(
        C.Rule(name, 1, "low", name, C.INTERNAL, (pattern,)) for name, pattern in wanted.items()
    )
    own = C.Catalogue(personal_data=rules, internal_policy=(), usage_policy=())
    return _places(w.documents(spark, sf), ("doc_id",), "text", list(wanted), own)


# --- Scores, summaries, tables -----------------------------------------------


def _reviewed(spark, sf):
    return ps.classify(w.prompts(spark, sf), keep=KEYS)


def _levels(spark, sf):
    return ps.risk_levels(w.prompts(spark, sf), keep=KEYS)


def classify(spark, sf):
    return _reviewed(spark, sf).select(
        *KEYS, "risk_level", "risk_score", "confidence", "needs_human_review", "categories",
        "reasons", "prompt",
    )


def flagged(spark, sf):
    return ps.flagged(_levels(spark, sf)).select(*KEYS, "risk_level", "risk_score", "categories")


def redact(spark, sf):
    return w.documents(spark, sf).select("doc_id", excerpt(F.col("text")).alias("excerpt"))


def by_user(spark, sf):
    return ps.by_user(_levels(spark, sf))


def by_category(spark, sf):
    return ps.by_category(ps.flagged(_levels(spark, sf)))


def by_risk_level(spark, sf):
    return ps.by_risk_level(_levels(spark, sf))


def clean(spark, sf):
    """Cells with control characters, without a value, and with lists, structs and maps."""
    dirty = F.concat(F.lit("\x00\x07"), "text", F.lit("\x1b"), "lang", F.lit("\x0c"))
    cell = F.when(F.col("doc_id") % 3 > 0, dirty)
    inner = F.struct(F.col("text").alias("text"), F.array("n_chars", F.lit(None)).alias("sizes"))
    named = F.map_from_arrays(F.array(F.lit("z"), F.lit("é")), F.array("source", "lang"))
    return clean_cells(
        w.table(spark, sf, "documents").select(
            "doc_id", cell.alias("cell"),
            F.when(F.col("doc_id") % 5 > 0, F.struct(F.lit(True).alias("b"), inner.alias("a"))).alias("object"),
            F.array(named, F.map_from_arrays(F.array(F.lit('a"b')), F.array("lang"))).alias("list"),
        )
    )


def export_review(spark, sf):
    """An export and its review in one run: reviewed prompts with the line of
    their record in the export."""
    pages = w.listing_pages(spark, sf)
    run = ps.export_and_review(CONFIG, pages, w.bodies(spark, sf), out_path=shared_dir(spark, "whole_run"), now=NOW)
    return run.review.reviewed.select(
        "line_number", "prompt_no", "conversation_id", "message_id", "user_email", "risk_level", "risk_score", "categories", "prompt"
    )


# --- Streams -----------------------------------------------------------------


def stream_classify(spark, sf):
    """Written lines, arriving as files, through parsing, walk and review."""
    lines, path = w.write_lines(spark, sf), shared_dir(spark, "stream")
    streaming.start_review(streaming.arriving_lines(spark, lines), f"{path}/table", f"{path}/checkpoint").awaitTermination()
    part = F.regexp_extract("file", r"part=(\d+)", 1).cast("bigint").alias("part")
    return spark.read.parquet(f"{path}/table").select(part, "line_number", "prompt_no", "risk_level", "risk_score", "categories")


def stream_by_user(spark, sf):
    lines, path = w.write_lines(spark, sf), shared_dir(spark, "totals")
    streaming.start_user_totals(streaming.arriving_lines(spark, lines), f"{path}/table", f"{path}/checkpoint").awaitTermination()
    return streaming.latest(spark, f"{path}/table")


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "role_filter": role_filter,
        "log_cursor": log_cursor,
        "decode_payload": decode_payload,
        "export_warnings": export_warnings,
        "manifest": manifest,
        "scan_lines": scan_lines,
        "invalid_lines": invalid_lines,
        "scan_counters": scan_counters,
        "extract_prompts": extract_prompts,
        "dedup_prompts": dedup_prompts,
        "prompt_text": prompt_text,
        "rule_hits": rule_hits,
        "pii_hits": pii_hits,
        "card_hits": card_hits,
        "contact_hits": contact_hits,
        "phi_hits": phi_hits,
        "client_hits": client_hits,
        "policy_hits": policy_hits,
        "evidence_windows": evidence_windows,
        "classify": classify,
        "flagged": flagged,
        "redact": redact,
        "by_user": by_user,
        "by_category": by_category,
        "by_risk_level": by_risk_level,
        "clean_cells": clean,
        "export_review": export_review,
        "stream_classify": stream_classify,
        "stream_by_user": stream_by_user,
        **({} if llm is None else {**llm.QUERIES, "pipeline": corpus_pipeline.run}),
    }


def oracle_sql() -> dict[str, str]:
    sql = oracles.build()
    if llm is not None:
        sql |= llm.SQL
    return sql
