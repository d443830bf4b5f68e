"""How document filters interact: what each removes in every order they can take.

Each document is reduced to a mask of the filters it fails, and documents to
counts per part and mask.  A mask leaves at the first filter of an order that it
holds.  Orders have ranks in lexicographic order (their Lehmer codes), and all
orders that begin alike are one interval of ranks, so the orders in which a mask
leaves at a given step are a few intervals.  A mask's counts are added where an
interval begins and taken off where it ends; the running sum over ranks is what
each order removes at that step, and everything else follows from it.

Filters: A, fewer than 200 words; B, under half of the words distinct; C, over 2
of 100 characters A-Z; D, holds one of `#$%&*|`; E, equal to the text of a
smaller id anywhere in the table.

Defined cases: a null text is empty, and all empty texts are equal.  A null
source is the part "".  Repeated rows of one id and text are documents of their
own, and none of them makes another fail E; a null id comes after all others
there.  Several labels of one id count as good or toxic if one of them does; a
document of no label or a null id is neither.  An empty table gives no rows.
Texts of any length are split in slices; only distinct words are held.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from itertools import permutations
from math import factorial

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from promptsieve.llm.texts import column, in_arrow
from promptsieve.session import shared_dir
from promptsieve.sources.sinks import stage

FILTERS = "ABCDE"
LEAST_WORDS = 200
# Bytes of a text that are split into words at once.
SLICE = 1 << 20

_UPPER = bytes(range(65, 91))
_INSIDE = bytes(range(0x80, 0xC0))
_SIGNS = re.compile(rb"[#$%&*|]")
_SPACE = re.compile(rb"[\x20\x09-\x0D]")


# --- Filters of one text -----------------------------------------------------------


def failed(text: bytes) -> int:
    """The filters A to D that a text fails, as bits."""
    words, distinct, start = 0, set(), 0
    while start < len(text):
        gap = _SPACE.search(text, start + SLICE)
        end = gap.start() if gap else len(text)
        found = text[start:end].split()
        words += len(found)
        distinct.update(found)
        start = end
    upper = len(text) - len(text.translate(None, _UPPER))
    points = len(text.translate(None, _INSIDE))
    return (words < LEAST_WORDS) | (100 * len(distinct) < 50 * words) << 1 | (100 * upper > 2 * points) << 2 | (_SIGNS.search(text) is not None) << 3


def _masked(docs: DataFrame) -> DataFrame:
    """Per row: id, part, mask of A to D and digest of the text."""

    def job(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [t or b"" for t in batch.column(2).cast(pa.binary()).to_pylist()]
            masks, digests = [failed(t) for t in texts], [hashlib.sha256(t).digest() for t in texts]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(masks, pa.int32()), pa.array(digests, pa.binary())], names=["id", "part", "mask", "digest"]
            )

    return in_arrow(docs, job, "id long, part string, mask int, digest binary")


def mask_counts(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """(part, mask) with counts: documents, good and toxic ones."""
    spark = docs.sparkSession
    plain = docs.select(
        column(id_col).cast("long").alias("id"), F.coalesce(column(source_col).cast("string"), F.lit("")).alias("part"), column(text_col).cast("string").alias("text")
    )
    # Repeated rows become a count before anything is joined.
    rows = stage(_masked(plain).groupBy("id", "part", "mask", "digest").agg(F.count("*").alias("n")), shared_dir(spark, "masks"))
    labelled = labels.where(F.col("doc_id").isNotNull()).groupBy(F.col("doc_id").cast("long").alias("id")).agg(
        F.max(F.expr("cast(quality <=> 1 as int)")).alias("good"), F.max(F.expr("cast(toxic <=> 1 as int)")).alias("toxic")
    )
    joined = rows.join(labelled, "id", "left").select(
        "id", "part", "mask", "digest", "n", (F.col("n") * F.coalesce("good", F.lit(0))).alias("good"), (F.col("n") * F.coalesce("toxic", F.lit(0))).alias("toxic")
    )
    # Of equal texts, what has the smallest id passes E.  Texts share their mask,
    # so a digest needs a row per part only: all its counts, and those at its
    # smallest id there.
    counts = F.struct("n", "good", "toxic")
    key = F.struct(F.col("id").isNull().alias("last"), "id")
    by_id = joined.groupBy("digest", "part", "mask", "id").agg(*(F.sum(c).alias(c) for c in ("n", "good", "toxic")))
    by_part = by_id.groupBy("digest", "part", "mask").agg(
        *(F.sum(c).alias(c) for c in ("n", "good", "toxic")), F.min(F.struct(key.alias("key"), counts.alias("counts"))).alias("first")
    )
    first = F.min("first.key").over(Window.partitionBy("digest"))
    known = by_part.withColumn("is_first", F.col("first.key") == first)
    passing = [F.when(F.col("is_first"), F.col(f"first.counts.{c}")).otherwise(0).alias(f"{c}_passing") for c in ("n", "good", "toxic")]
    known = known.select("part", "mask", "n", "good", "toxic", *passing)
    split = F.array(
        F.struct(F.col("mask").alias("mask"), *(F.col(f"{c}_passing").alias(c) for c in ("n", "good", "toxic"))),
        F.struct(
            F.col("mask").bitwiseOR(16).alias("mask"), *((F.col(c) - F.col(f"{c}_passing")).alias(c) for c in ("n", "good", "toxic"))
        ),
    )
    each = known.select("part", F.explode(split).alias("x")).select("part", "x.*")
    return each.groupBy("part", "mask").agg(*(F.sum(c).alias(c) for c in ("n", "good", "toxic")))


# --- Orders ------------------------------------------------------------------------


def intervals(mask: int, filters: int = len(FILTERS)) -> list[tuple[int, int, int]]:
    """(step, first rank, rank after the last) of the orders in which a mask
    leaves at that step.

    Orders that share their first `step` filters are consecutive.  The mask
    leaves at the last of these if it holds that one and none before.
    """
    found: list[tuple[int, int, int]] = []

    def extend(step: int, rank: int, left: tuple[int, ...]) -> None:
        width = factorial(len(left) - 1) if left else 0
        for digit, f in enumerate(left):  # the digits of the Lehmer code
            start = rank + digit * width
            if mask >> f & 1:
                if found and found[-1][0] == step + 1 and found[-1][2] == start:
                    start = found.pop()[1]
                found.append((step + 1, start, rank + (digit + 1) * width))
            else:
                extend(step + 1, start, left[:digit] + left[digit + 1 :])

    extend(0, 0, tuple(range(filters)))
    return found


def _constants(spark: SparkSession) -> tuple[DataFrame, DataFrame]:
    """(mask, step, rank, sign) where intervals begin and end, and (rank,
    filter_order): tables that depend on the number of filters alone."""
    ends = [
        (mask, step, rank, sign)
        for mask in range(1, 1 << len(FILTERS))
        for step, low, high in intervals(mask)
        for rank, sign in ((low, 1), (high, -1))
        if rank < factorial(len(FILTERS))
    ]
    orders = [(rank, "".join(order)) for rank, order in enumerate(permutations(FILTERS))]
    return spark.createDataFrame(ends, "mask int, step int, rank int, sign int"), spark.createDataFrame(orders, "rank int, filter_order string")


def audit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """One row per part, filter_order and step with all counts."""
    spark = docs.sparkSession
    counts = stage(mask_counts(docs, labels, id_col, text_col, source_col), shared_dir(spark, "mask-counts"))
    ends, orders = _constants(spark)
    # At most 31 masks of a part meet at a place, so places are few per part.
    moved = (
        counts.join(F.broadcast(ends), "mask")
        .groupBy("part", "step", "rank")
        .agg(*(F.sum(F.col(c) * F.col("sign")).alias(c) for c in ("n", "good", "toxic")))
    )

    # What holds for a part and filter whatever the order.
    def fails(f: int):
        return F.sum(F.when(F.col("mask").bitwiseAND(1 << f) != 0, F.col("n")).otherwise(0))

    def alone(f: int):
        return F.sum(F.when(F.col("mask") == 1 << f, F.col("n")).otherwise(0))

    parts = counts.groupBy("part").agg(
        F.sum("n").alias("total"),
        F.array(*(fails(f) for f in range(len(FILTERS)))).alias("fails"),
        F.array(*(alone(f) for f in range(len(FILTERS)))).alias("alone"),
    )
    steps = F.explode(F.sequence(F.lit(1), F.lit(len(FILTERS)))).alias("step")
    # A row per part, order and step: 600 a part.
    ranks = F.explode(F.sequence(F.lit(0), F.lit(factorial(len(FILTERS)) - 1))).alias("rank")
    places = parts.select("*", steps).select("part", "total", "fails", "alone", "step", ranks).join(F.broadcast(orders), "rank")
    running = Window.partitionBy("part", "step").orderBy("rank")
    summed = places.join(moved, ["part", "step", "rank"], "left").withColumns(
        {name: F.coalesce(F.sum(c).over(running), F.lit(0)) for name, c in (("removed", "n"), ("good_lost", "good"), ("toxic_lost", "toxic"))}
    )
    named = summed.withColumn("filter", F.instr(F.lit(FILTERS), F.col("filter_order").substr(F.col("step"), F.lit(1))) - 1)
    by_order = Window.partitionBy("part", "rank").orderBy("step")
    by_filter = Window.partitionBy("part", "filter")
    return named.select(
        "part", "filter_order", "step",
        (F.col("total") - F.sum("removed").over(by_order)).alias("kept"),
        "removed",
        (F.get("fails", F.col("filter")) - F.col("removed")).alias("redundant"),
        F.get("alone", F.col("filter")).alias("unique_fails"),
        "good_lost", "toxic_lost",
        F.sum("removed").over(by_filter).alias("shapley"),
    )
