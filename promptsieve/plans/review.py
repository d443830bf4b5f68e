"""Review: from lines of raw records to reviewed prompts and summaries."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from promptsieve.functions import catalogue as C
from promptsieve.functions.jsontext import strict_parse
from promptsieve.functions.rows import settle
from promptsieve.operators.prompts import (
    CONTEXT_FIELDS,
    extract_prompts,
    prompt_text,
)
from promptsieve.operators.records import with_record_facts
from promptsieve.operators.review import (
    REVIEW_ORDER,
    REVIEWED_COLUMNS,
    classify,
    flagged,
    invalid_line_values,
)
from promptsieve.operators.summary import (
    by_category,
    by_risk_level,
    by_user,
    in_input_order,
    line_counts,
    observed_counters,
    prompt_counts,
    result_tables,
    summary_lines,
)
from promptsieve.sources.lines import non_blank, numbered_lines
from promptsieve.sources.sinks import stage, write_jsonl, write_table


def parse_lines(lines: DataFrame) -> DataFrame:
    """Non-blank lines with `record_json` (null if the line is not JSON),
    `is_response` and `own_log_id`."""
    kept = non_blank(lines)
    return with_record_facts(kept.withColumn("record_json", strict_parse(F.col("line"))))


def prompts_of_lines(parsed: DataFrame) -> DataFrame:
    """One row per prompt, and one per line that is not JSON (`is_invalid`),
    whose `prompt` is the line itself."""
    place = [c for c in ("file", "line_number") if c in parsed.columns]
    source = parsed.select(
        *place,
        "line",
        "own_log_id",
        F.col("record_json").isNull().alias("is_invalid"),
        F.when(~F.col("is_response"), F.col("record_json")).alias("record_json"),
    )
    return prompts_of_records(extract_prompts(source), place)


def prompts_of_records(walked: DataFrame, place: list[str]) -> DataFrame:
    """`prompts_of_lines` of records that `extract_prompts` has been through.
    `line` is only asked for where `is_invalid`."""
    # An invalid line has no prompts, and keeps its row through the explode.
    rows = walked.select(
        *place, "line", "own_log_id", "is_invalid",
        F.posexplode_outer("prompts").alias("prompt_no", "_p"),
    ).where(F.col("_p").isNotNull() | F.col("is_invalid"))
    text = F.when(F.col("is_invalid"), F.col("line")).otherwise(
        prompt_text("_p.content_kind", "_p.content")
    )
    return settle(
        rows.select(
            *place,
            F.coalesce("prompt_no", F.lit(0)).alias("prompt_no"),
            "is_invalid",
            F.col("own_log_id").alias("source_log_id"),
            *(F.col(f"_p.{f}").alias(f) for f in CONTEXT_FIELDS),
            text.alias("prompt"),
        )
    )


def review_prompts(
    prompts: DataFrame,
    rules: C.Catalogue = C.DEFAULT,
    *,
    redact_prompt: bool = False,
    redact_evidence: bool = False,
    excerpt_chars: int = C.EXCERPT_CHARS,
) -> DataFrame:
    """Classify the rows of `prompts_of_lines`: reviewed columns, then the
    place of the row in the input.  Invalid lines skip the rules."""
    place = tuple(c for c in REVIEW_ORDER if c in prompts.columns and c not in REVIEWED_COLUMNS)
    checked = prompts.select(
        "*", F.when(F.col("is_invalid"), F.col("prompt")).alias("_line")
    ).withColumn("prompt", F.when(~F.col("is_invalid"), F.col("prompt")))
    reviewed = classify(
        checked,
        rules,
        redact_prompt=redact_prompt,
        redact_evidence=redact_evidence,
        excerpt_chars=excerpt_chars,
        keep=(*place, "is_invalid", "_line"),
    )
    fixed = invalid_line_values(F.col("_line"))
    columns = [
        F.when(F.col("is_invalid"), fixed[c]).otherwise(F.col(c)).alias(c) if c in fixed else F.col(c)
        for c in REVIEWED_COLUMNS
    ]
    return settle(reviewed.select(*columns, "findings", *place), "risk_level", "risk_score")


def review_lines(lines: DataFrame, rules: C.Catalogue = C.DEFAULT, **options) -> DataFrame:
    """Lines of raw records in, reviewed prompts out; works on streams too."""
    return review_prompts(prompts_of_lines(parse_lines(lines)), rules, **options)


def write_review(
    lines: DataFrame, path: str, rules: C.Catalogue = C.DEFAULT, **options
) -> tuple[DataFrame, DataFrame]:
    """The reviewed prompts of `lines`, written to `path` by risk level, and one row
    of counters.  Lines and prompts are counted on their way to the table, so the
    input is parsed and matched once."""
    seen, judged = Observation(), Observation()
    parsed = parse_lines(lines).observe(seen, *line_counts())
    reviewed = review_prompts(prompts_of_lines(parsed), rules, **options).observe(judged, *prompt_counts())
    written = stage(reviewed, path, partition_by=("risk_level",))
    return written, observed_counters(lines.sparkSession, seen, judged)


@dataclass(frozen=True)
class Review:
    reviewed: DataFrame
    flagged: DataFrame
    by_user: DataFrame
    by_category: DataFrame
    by_risk_level: DataFrame
    counters: DataFrame


def run_review(
    spark: SparkSession,
    in_path: str | list[str],
    out_path: str,
    rules: C.Catalogue = C.DEFAULT,
    *,
    redact_prompt: bool = False,
    redact_evidence: bool = False,
    excerpt_chars: int = C.EXCERPT_CHARS,
) -> Review:
    """Review the raw records at `in_path` and write all outputs to `out_path`.

    The input is read twice, to number its lines and to review them; every prompt
    is matched against the rules once.  The reviewed prompts are written partitioned
    by risk level and the other outputs are read off that table, so that the flagged
    ones are found by partition.  Written prompts are in the order of the input.
    """
    reviewed, counters = write_review(
        numbered_lines(spark, in_path),
        f"{out_path}/reviewed_table",
        rules,
        redact_prompt=redact_prompt,
        redact_evidence=redact_evidence,
        excerpt_chars=excerpt_chars,
    )
    return write_outputs(reviewed, counters, out_path, [in_path] if isinstance(in_path, str) else in_path)


def write_outputs(reviewed: DataFrame, counters: DataFrame, out_path: str, in_paths: list[str]) -> Review:
    """Everything a review writes, read off the table of reviewed prompts."""
    findings = flagged(reviewed)
    review = Review(
        reviewed,
        findings,
        by_user(reviewed),
        by_category(findings),
        by_risk_level(reviewed),
        counters,
    )
    place = [c for c in ("file", "prompt_no") if c in reviewed.columns]
    for name, rows in (("reviewed_prompts", reviewed), ("findings", findings)):
        ordered = in_input_order(rows).select(*REVIEWED_COLUMNS, *place)
        write_jsonl(ordered, f"{out_path}/compliance_{name}")
    totals = counters.select(F.lit(", ".join(in_paths)).alias("input_path"), *counters.columns)
    summaries = summary_lines(totals, review.by_user, review.by_category, review.by_risk_level)
    write_jsonl(summaries, f"{out_path}/compliance_summary", keep_nulls=False)
    for name, table in result_tables(reviewed).items():
        write_table(table, f"{out_path}/tables/{name}")
    return review
