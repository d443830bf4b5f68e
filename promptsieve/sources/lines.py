"""Text lines with their numbers, read in parallel."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from promptsieve.functions.dialect import strip

# A line of a file as it is read, with the split it comes from.
PLACE = ("_metadata.file_path AS file", "_metadata.file_block_start AS block", "value AS line")


def numbered_lines(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Every physical line of the text files as (file, line_number, line).

    Numbers are 1-based per file and count blank lines.
    """
    return with_numbers(spark.read.text(path).selectExpr(*PLACE))


def with_numbers(read: DataFrame) -> DataFrame:
    """Lines of whole files, as read (file, block, line), with their numbers.

    Files are read in splits; a first pass counts the lines of each split, and
    the running total of those counts is where a split's numbering starts.  Only
    the counts are joined to the lines.
    """
    lines = read.withColumn("row_id", F.monotonically_increasing_id())
    before = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        lines.groupBy("file", "block")
        .agg(F.count("*").alias("n"), F.min("row_id").alias("first_id"))
        .select(
            F.xxhash64("file", "block").alias("split"),
            (F.coalesce(F.sum("n").over(before), F.lit(0)) - F.col("first_id") + 1).alias("shift"),
        )
    )
    # Two numbers a split: 800,000 splits, as 100 TB have, are some 20 MB.
    placed = lines.withColumn("split", F.xxhash64("file", "block")).join(F.broadcast(offsets), "split")
    return placed.select("file", (F.col("row_id") + F.col("shift")).alias("line_number"), "line")


def non_blank(lines: DataFrame) -> DataFrame:
    return lines.withColumn("line", strip(F.col("line"))).where(F.col("line") != "")
