"""Summaries and counters of reviewed prompts, and their tabular form."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from promptsieve.functions.catalogue import INVALID_LINE, LEVELS
from promptsieve.functions.redaction import clean_cell
from promptsieve.operators.review import REVIEW_ORDER, REVIEWED_COLUMNS, flagged

# Fixed values.
UNKNOWN_USER = "<unknown>"
USER_COLUMNS = ("user_email", "total_prompts", "flagged_prompts", "max_risk_score", *LEVELS)
CATEGORY_COLUMNS = ("category", "count", "max_risk_score", "users_affected")
LEVEL_COLUMNS = ("risk_level", "count")
COUNTERS = ("records_seen", "assistant_records_skipped", "prompt_records_seen", "flagged_prompts")


def user_key() -> Column:
    """Who a prompt is counted under: e-mail, else id, else unknown."""
    return F.coalesce(
        F.nullif(F.col("user_email"), F.lit("")), F.nullif(F.col("user_id"), F.lit("")),
        F.lit(UNKNOWN_USER),
    )


def _has_level(level: str) -> Column:
    return F.col("risk_level") == level


def by_user(reviewed: DataFrame, *, ordered: bool = True) -> DataFrame:
    """Prompts per user and level.  Counts are summed up before the shuffle, so
    a user with most of the prompts weighs no more than any other."""
    counts = reviewed.groupBy(user_key().alias("user_email")).agg(
        F.count("*").alias("total_prompts"),
        F.count_if(~_has_level("none")).alias("flagged_prompts"),
        F.max("risk_score").alias("max_risk_score"),
        *(F.count_if(_has_level(level)).alias(level) for level in LEVELS),
    )
    return counts.orderBy(F.desc("max_risk_score"), "user_email") if ordered else counts


def split_categories(joined: Column) -> Column:
    parts = F.transform(F.split(joined, ";"), lambda p: F.trim(p))
    return F.filter(parts, lambda p: p != "")


def by_category(findings: DataFrame, *, ordered: bool = True) -> DataFrame:
    """Flagged prompts and users per category, with the highest prompt score.

    Users are first reduced to one row per category and user, so no task holds
    the set of all users of a category.
    """
    exploded = findings.select(
        F.explode(F.array_distinct(split_categories(F.col("categories")))).alias("category"),
        "risk_score",
        user_key().alias("user"),
    )
    per_user = exploded.groupBy("category", "user").agg(
        F.count("*").alias("n"), F.max("risk_score").alias("top")
    )
    counts = per_user.groupBy("category").agg(
        F.sum("n").alias("count"),
        F.max("top").alias("max_risk_score"),
        F.count("*").alias("users_affected"),
    )
    return counts.orderBy(F.desc("count"), "category") if ordered else counts


def by_risk_level(reviewed: DataFrame) -> DataFrame:
    """Prompts per level: five rows, most severe first, zeros included."""
    totals = reviewed.agg(*(F.count_if(_has_level(level)).alias(level) for level in LEVELS))
    rows = F.array(
        *(
            F.struct(F.lit(level).alias("risk_level"), F.col(level).alias("count"))
            for level in LEVELS
        )
    )
    return totals.select(F.inline(rows))


def merge_rows(*one_row_frames: DataFrame) -> DataFrame:
    """One row with the columns of several one-row frames."""
    stacked = one_row_frames[0]
    for frame in one_row_frames[1:]:
        stacked = stacked.unionByName(frame, allowMissingColumns=True)
    return stacked.agg(*(F.max(c).alias(c) for c in stacked.columns))


def line_counts() -> list[Column]:
    """Totals over parsed lines."""
    return [F.count(F.lit(1)).alias("records_seen"), F.count_if("is_response").alias("assistant_records_skipped")]


def prompt_counts() -> list[Column]:
    """Totals over reviewed prompts; lines that are not JSON count as flagged only."""
    return [
        F.count_if(F.col("categories") != INVALID_LINE[0]).alias("prompt_records_seen"),
        F.count_if(~_has_level("none")).alias("flagged_prompts"),
    ]


def observed_counters(spark: SparkSession, *observed: Observation) -> DataFrame:
    """One row of totals out of finished observations of `line_counts` and
    `prompt_counts`.  Observed where no shuffle follows, as in a review, a total
    counts every partition once, however often its task is run."""
    totals = {name: n for one in observed for name, n in one.get.items()}
    return spark.range(1).select(*(F.lit(totals.get(c) or 0).cast("bigint").alias(c) for c in COUNTERS))


def scan_counters(scanned: DataFrame, reviewed: DataFrame) -> DataFrame:
    """One row of totals.  `scanned` has a row per input line, with
    `is_response`; lines that are not JSON count as flagged, not as prompts."""
    return merge_rows(scanned.agg(*line_counts()), reviewed.agg(*prompt_counts()))


def in_input_order(reviewed: DataFrame) -> DataFrame:
    """Sorted by place in the input, as far as the rows have one.  Written files
    in the order of their names then hold the rows in that order; rows are dealt
    by ranges of places, so that a long file is sorted by many tasks."""
    return reviewed.orderBy(*(c for c in REVIEW_ORDER if c in reviewed.columns))


def summary_lines(
    counters: DataFrame, users: DataFrame, categories: DataFrame, levels: DataFrame
) -> DataFrame:
    """The counters and all summaries as rows of one table, told apart by
    `section`; columns of other sections are null.  A row per user, not one value
    with all users, as their number has no bound."""
    parts = {"counters": counters, "by_user": users, "by_category": categories, "by_risk_level": levels}
    named = [part.select(F.lit(name).alias("section"), *part.columns) for name, part in parts.items()]
    stacked = named[0]
    for part in named[1:]:
        stacked = stacked.unionByName(part, allowMissingColumns=True)
    return stacked


def result_tables(reviewed: DataFrame) -> dict[str, DataFrame]:
    """The five result tables, in fixed column order, as clean text cells; prompts
    in the order of the input."""
    findings = flagged(reviewed)
    tables = {
        "reviewed_prompts": in_input_order(reviewed).select(*REVIEWED_COLUMNS),
        "flagged_prompts": in_input_order(findings).select(*REVIEWED_COLUMNS),
        "summary_by_user": by_user(reviewed).select(*USER_COLUMNS),
        "summary_by_category": by_category(findings).select(*CATEGORY_COLUMNS),
        "summary_by_risk_level": by_risk_level(reviewed).select(*LEVEL_COLUMNS),
    }
    return {name: clean_cells(table) for name, table in tables.items()}


def clean_cells(table: DataFrame) -> DataFrame:
    return table.select(*(clean_cell(F.col(f"`{f.name}`"), f.dataType).alias(f.name) for f in table.schema))
