"""Review as files of raw records arrive.

Files are read in splits, as in batch.  What a batch of the stream yields is
committed under its number: a batch that is run again after a crash replaces its
own rows and no others, and readers see a batch's rows all at once.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from promptsieve.functions import catalogue as C
from promptsieve.operators.summary import by_user
from promptsieve.plans.review import review_lines
from promptsieve.sources.lines import PLACE, with_numbers


def arriving_lines(spark: SparkSession, path: str) -> DataFrame:
    """Lines of the text files that land in a folder, as (file, block, line).  A
    file is read when it is complete, and wholly in one batch."""
    return spark.readStream.format("text").load(path).selectExpr(*PLACE)


def commit(rows: DataFrame, out_path: str, batch: int) -> None:
    """Put the rows of a batch in its own partition of the table."""
    numbered = rows.withColumn("batch_id", F.lit(batch).cast("long"))
    numbered.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("batch_id").parquet(out_path)


def latest(spark: SparkSession, out_path: str) -> DataFrame:
    """The rows that the last committed batch has put in a table.  Partitions of
    earlier batches are not read."""
    table = spark.read.parquet(out_path)
    return table.where(F.col("batch_id") == table.agg(F.max("batch_id")).scalar()).drop("batch_id")


def start_review(
    lines: DataFrame,
    out_path: str,
    checkpoint: str,
    rules: C.Catalogue = C.DEFAULT,
    *,
    redact_prompt: bool = False,
    excerpt_chars: int = C.EXCERPT_CHARS,
    available_now: bool = True,
) -> StreamingQuery:
    """Review arriving lines of raw records into a parquet table, which has the
    `batch_id` beside the reviewed prompts.  Lines are numbered within a batch,
    which holds whole files; no state is kept."""

    def review(batch: DataFrame, number: int) -> None:
        reviewed = review_lines(with_numbers(batch), rules, redact_prompt=redact_prompt, excerpt_chars=excerpt_chars)
        commit(reviewed, out_path, number)

    writer = lines.writeStream.foreachBatch(review).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if available_now else writer).start()


def start_user_totals(
    lines: DataFrame,
    out_path: str,
    checkpoint: str,
    rules: C.Catalogue = C.DEFAULT,
    *,
    available_now: bool = True,
) -> StreamingQuery:
    """Review arriving lines of raw records into totals per user.  State is one
    row of counts per user; `latest` reads the totals so far."""
    # Totals need no places, so nothing is numbered.
    totals = by_user(review_lines(lines.select("line"), rules), ordered=False)
    writer = (
        totals.writeStream.outputMode("complete")
        .foreachBatch(lambda rows, number: commit(rows, out_path, number)).option("checkpointLocation", checkpoint)
    )
    return (writer.trigger(availableNow=True) if available_now else writer).start()
