"""Exact deduplication that splits off heavy hitters.

Texts are compared by the SHA-256 of their normal form, in which each run of
white space is one space.  A Misra-Gries summary (the mergeable frequent-items
sketch behind `approx_top_k`) names the digests that could be frequent.  Their
rows are counted exactly, and the verified winners, at most `TRACKED` rows, are
sent to every task, so that copies in large groups are settled where they are
read.  The other digests meet by an ordinary shuffle: by the summary's error
bound none of them has more than a few of every `TRACKED` rows.

Defined cases: a null text is an empty one.  A null id comes after all others.
Of rows with the same id and equal texts one stays, the first as read.  Other
columns of the input are ignored by `decisions` and carried by `keep_first`.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from promptsieve.llm.texts import collapsed, column
from promptsieve.session import shared_dir
from promptsieve.sources.sinks import stage

# Counters of the summary, and so the most digests that are broadcast.
TRACKED = 8192
# Summaries are merged in so many groups before they meet in one task.
MERGE_GROUPS = 64


def digest(text: Column) -> Column:
    return F.unhex(F.sha2(collapsed(text).cast("binary"), 256))


def frequent_digests(rows: DataFrame, tracked: int = TRACKED) -> DataFrame:
    """(digest, first, size) of the digests that the summary names and that an
    exact count finds more than once; `first` is the least `place`."""
    short = rows.select(F.xxhash64("digest").alias("h"))
    merged = (
        short.groupBy(F.pmod(F.spark_partition_id(), F.lit(MERGE_GROUPS)))
        .agg(F.expr(f"approx_top_k_accumulate(h, {tracked})").alias("sketch"))
        # A group of its own, as an empty partition has no sketch to merge.
        .groupBy(F.lit(True).alias("all"))
        .agg(F.expr(f"approx_top_k_combine(sketch, {tracked})").alias("sketch"))
    )
    named = merged.select(
        F.explode(F.expr(f"approx_top_k_estimate(sketch, {tracked})")).alias("item")
    )
    suspects = named.where(F.col("item.count") > 1).select(F.col("item.item").alias("h"))
    counted = (
        rows.withColumn("h", F.xxhash64("digest"))
        .join(F.broadcast(suspects), "h", "left_semi")
        .groupBy("digest")
        .agg(F.min("place").alias("first"), F.count("*").alias("size"))
    )
    # Two digests with one short hash may both pass, hence the limit.
    return counted.where(F.col("size") > 1).orderBy(F.desc("size"), "digest").limit(tracked)


def decisions(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: the id, keep_id, group_size, kept and text_sha256."""
    spark = docs.sparkSession
    rows = docs.select(column(id_col).alias("id"), digest(column(text_col)).alias("digest"))
    place = F.struct(F.col("id").isNull().alias("last"), "id", F.monotonically_increasing_id().alias("row"))
    rows = stage(rows.select("id", "digest", place.alias("place")), shared_dir(spark, "digests"))
    winners = stage(frequent_digests(rows), shared_dir(spark, "winners"))

    # At most TRACKED rows of some hundred bytes.
    settled = rows.join(F.broadcast(winners), "digest")
    rest = rows.join(F.broadcast(winners), "digest", "left_anti")
    same = Window.partitionBy("digest")
    rest = rest.withColumn("first", F.min("place").over(same)).withColumn("size", F.count("*").over(same))
    out = settled.unionByName(rest.select(settled.columns))
    return out.select(
        F.col("id").alias(id_col),
        F.col("first.id").alias("keep_id"),
        F.col("size").alias("group_size"),
        (F.col("place") == F.col("first")).alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"),
    )


def keep_first(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of `docs` that stay, with all their columns.

    Rows of frequent texts other than the winner go where they are read; what
    is left is grouped by digest with a partial choice before the shuffle, so a
    row that is repeated very often is no hot group either.
    """
    spark = docs.sparkSession
    order = F.struct(column(id_col).isNull().alias("last"), column(id_col).alias("id"))
    keyed = docs.select(
        F.struct(*(column(c) for c in docs.columns)).alias("document"),
        digest(column(text_col)).alias("digest"),
        order.alias("place"),
        column(text_col).alias("text"),
    )
    winners = stage(frequent_digests(keyed.select("digest", "place")), shared_dir(spark, "winners"))
    known = F.broadcast(winners.select("digest", "first"))
    passed = keyed.join(known, "digest", "left").where(
        F.col("first").isNull() | (F.col("place") == F.col("first"))
    )
    best = F.min_by("document", F.struct(F.col("place"), F.col("text")))
    return passed.groupBy("digest").agg(best.alias("document")).select("document.*")
