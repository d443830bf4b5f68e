"""Export and review in one run: bodies are decoded and walked once for both."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import datetime, timezone

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from promptsieve.functions import catalogue as C
from promptsieve.operators.summary import scan_counters
from promptsieve.plans import export
from promptsieve.plans.export import Export, ExportConfig
from promptsieve.plans.review import Review, prompts_of_records, review_prompts, write_outputs
from promptsieve.sources.sinks import stage

# Place of a record in the listing; `page_no` tells one page from another.
PLACE = ("page_no", "entry_no", "record_no")
# A row's number within its task are the lower bits of its id.
TASK_BITS = 33


@dataclass(frozen=True)
class WholeRun:
    export: Export
    review: Review


def line_numbers(records: DataFrame, path: str) -> DataFrame:
    """PLACE and `line_number` of records: their 1-based rank by place, as a table.

    Only places are sorted, by ranges, so that a log with most of the records is
    numbered by many tasks.  A running total over one row per task says where
    each begins.
    """
    placed = records.select(*PLACE).repartitionByRange(*PLACE).sortWithinPartitions(*PLACE)
    ids = stage(placed.withColumn("row_id", F.monotonically_increasing_id()), path)
    task = F.shiftright("row_id", TASK_BITS).alias("task")
    before = Window.orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    starts = ids.groupBy(task).agg(F.count("*").alias("n")).select("task", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start"))
    # Two numbers a task of the sort.
    found = ids.withColumn("task", task).join(F.broadcast(starts), "task")
    in_task = F.col("row_id") - F.shiftleft("task", TASK_BITS)
    return found.select(*PLACE, (F.col("start") + in_task + 1).alias("line_number"))


def reviewable(records: DataFrame, numbers: DataFrame) -> DataFrame:
    """The prompts of exported records as `review_prompts` takes them, with the
    line of their record in the export."""
    walked = records.select(
        *PLACE, "own_log_id", "prompts", F.lit(None).cast("string").alias("line"), F.lit(False).alias("is_invalid")
    )
    return prompts_of_records(walked, list(PLACE)).join(numbers, [*PLACE])


def export_and_review(
    config: ExportConfig,
    responses: DataFrame,
    bodies: DataFrame,
    *,
    out_path: str,
    now: datetime | None = None,
    rules: C.Catalogue = C.DEFAULT,
    redact_prompt: bool = False,
    redact_evidence: bool = False,
    excerpt_chars: int = C.EXCERPT_CHARS,
) -> WholeRun:
    """What `export_logs` writes, to `out_path/export`, and what `run_review` makes
    of its raw records, to `out_path/review`.

    The written raw records are not read again: prompts come from the units that
    the export has walked.  Raw records are in the order of the listing, and
    `line_number` counts through all their files in the order of their names.
    """
    now = now or datetime.now(timezone.utc)
    exported, reviewed_path = f"{out_path}/export", f"{out_path}/review"
    pages, entries, units = export.staged_units(config, responses, bodies, exported, now)
    records = export.kept_records(units)
    outputs = export.write_outputs(config, pages, entries, units, records.orderBy(*PLACE), exported, now)
    numbers = line_numbers(records, f"{exported}/numbers")
    options = {"redact_prompt": redact_prompt, "redact_evidence": redact_evidence, "excerpt_chars": excerpt_chars}
    reviewed = stage(
        review_prompts(reviewable(records, numbers), rules, **options), f"{reviewed_path}/reviewed_table", partition_by=("risk_level",)
    )
    # Model responses are not exported, so that a review skips none.
    counters = scan_counters(numbers.withColumn("is_response", F.lit(False)), reviewed)
    return WholeRun(outputs, write_outputs(reviewed, counters, reviewed_path, [f"{exported}/raw"]))
