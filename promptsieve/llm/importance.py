"""Importance resampling towards a target distribution, drawn by distributed quickselect.

Words are runs of letters, digits and anything beyond ASCII, with A-Z in lower
case; features are runs of up to `n` consecutive words, each in one of `buckets`
by the crc32 of its bytes.  Bucket counts of all documents and of all target
texts give every bucket a gain in thousandths, and a document weighs the sum of
the gains its features look up in that array.  Gumbel noise, fixed by the seed
and the id, makes the highest scores a draw without replacement by weight.

The draw is a quickselect over the composite key (score falling, id rising, a
hash of the text, a number of the row): a few random pivots of the range that is
left, and one pass that counts the rows before, at and between them, narrow the
range until the k-th key is known.  Only the rows up to that key are sorted and
ranked.  No job sees more than `PIVOTS` keys or `buckets` counts in one place.

Defined cases: null and empty texts have no features and weight 0.  A null id
counts as the empty string in the noise and comes after all ids in ties.
Repeated rows are rows of their own; of fully equal ones at the border any is
drawn, which gives the same result.  Empty tables give no rows; an empty target
counts as one with no features.  Texts of any length are read in slices.
"""

from __future__ import annotations

import hashlib
import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from promptsieve.llm.texts import column, in_arrow
from promptsieve.session import shared_dir
from promptsieve.sources.sinks import stage

BUCKETS = 10_000
LEAST_WORDS = 20
PERCENT = 10
SEED = 2024
# Keys that split the range in each round.
PIVOTS = 15
# Bytes of a text whose words are held at once.
SLICE = 1 << 20

# ASCII bytes in lower case, and a space for those no word has.
_FOLDED = bytes(b + 32 if 65 <= b <= 90 else b if b >= 128 or chr(b).isalnum() else 32 for b in range(256))


def words_of(text: bytes | None) -> Iterator[list[bytes]]:
    """The words of a text in order, in lists of a bounded size."""
    if not text:
        return
    folded, start = text.translate(_FOLDED), 0
    while start < len(folded):
        gap = folded.find(b" ", start + SLICE)
        end = gap if gap >= 0 else len(folded)
        yield folded[start:end].split()
        start = end


def buckets_of(text: bytes | None, n: int, buckets: int) -> Iterator[np.ndarray]:
    """The buckets of a text's features, with repeats, in bounded arrays."""
    carried: list[bytes] = []
    for words in words_of(text):
        words = carried + words
        for width in range(1, n + 1):
            # Runs that lie in the carried words have been seen.
            first = max(0, len(carried) - width + 1)
            runs = words[first:] if width == 1 else [b" ".join(words[i : i + width]) for i in range(first, len(words) - width + 1)]
            yield np.fromiter(map(zlib.crc32, runs), dtype=np.int64, count=len(runs)) % buckets
        carried = words[len(words) - n + 1 :] if n > 1 else []


def bucket_counts(texts: DataFrame, n: int, buckets: int) -> np.ndarray:
    """How many features of all texts are in each bucket."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, dtype=np.int64)
        for batch in batches:
            for text in batch.column(0).cast(pa.binary()).to_pylist():
                for found in buckets_of(text, n, buckets):
                    total += np.bincount(found, minlength=buckets)
        held = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(held, pa.int32()), pa.array(total[held], pa.int64())], names=["bucket", "n"])

    counted = in_arrow(texts, count, "bucket int, n long").groupBy("bucket").agg(F.sum("n").alias("n"))
    total = np.zeros(buckets, dtype=np.int64)
    for row in counted.collect():  # a row per bucket
        total[row.bucket] = row.n
    return total


def gains(documents: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Per bucket the log ratio of target to documents, smoothed by one, in
    thousandths, rounded down."""
    size, s, t = len(documents), documents.astype(float), target.astype(float)
    every, wanted = float(documents.sum()), float(target.sum())
    ratio = (t + 1) * (every + size) / ((s + 1) * (wanted + size))
    return np.array([math.floor(1000 * math.log(r)) for r in ratio], dtype=np.int64)


def noise(seed: int, doc_id: int | None) -> int:
    """Gumbel noise in thousandths, by the seed and the id alone."""
    key = f"{seed}:{'' if doc_id is None else doc_id}"
    h = int(hashlib.sha256(key.encode()).hexdigest()[:8], 16)
    return math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))


def weighed(docs: DataFrame, gain: np.ndarray, n: int, seed: int) -> DataFrame:
    """Per row: doc_id, n_words, n_features, weight, score and a hash of the text."""
    shared = docs.sparkSession.sparkContext.broadcast(gain)

    def job(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        gain = shared.value
        for batch in batches:
            words, features, weights, hashes = [], [], [], []
            for text in batch.column(1).cast(pa.binary()).to_pylist():
                count = total = 0
                for found in buckets_of(text, n, len(gain)):
                    count += len(found)
                    total += int(gain[found].sum())
                # Of w words there are w + (w - 1) + ... runs, so n runs tell w.
                words.append(count if n == 1 else sum(map(len, words_of(text))))
                features.append(count)
                weights.append(total)
                hashes.append(-1 if text is None else xxhash.xxh3_64_intdigest(text) >> 1)
            ids = batch.column(0).to_pylist()
            scores = [w + noise(seed, i) for w, i in zip(weights, ids)]
            columns = [words, features, weights, scores, hashes]
            yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(c, pa.int64()) for c in columns)], names=["doc_id", "n_words", "n_features", "weight", "score", "hash"])

    return in_arrow(docs, job, "doc_id long, n_words long, n_features long, weight long, score long, hash long")


# --- The draw --------------------------------------------------------------------------

# What makes the key of a row, as numbers that all rise.
KEY = ("down", "last", "id", "hash", "row")


def _before(key: tuple[int, ...], closed: bool = False) -> Column:
    """Whether a row's key is before `key` (or at it, if closed)."""
    met = F.lit(closed)
    for name, value in reversed(list(zip(KEY, key))):
        met = (F.col(name) < F.lit(value)) | ((F.col(name) == F.lit(value)) & met)
    # Said first on its own, so that the scan can skip by score.
    return (F.col(KEY[0]) <= F.lit(key[0])) & met


def kth_key(keys: DataFrame, k: int, pivots: int = PIVOTS) -> tuple[int, ...]:
    """The k-th smallest key of a written table of keys, k from 1."""
    low = high = None  # what is left lies after `low` and up to `high`
    done, turn = 0, 0
    while True:
        left = keys
        if low is not None:
            left = left.where(~_before(low, closed=True) & (F.col(KEY[0]) >= F.lit(low[0])))
        if high is not None:
            left = left.where(_before(high))
        drawn = left.orderBy(F.xxhash64(*KEY, F.lit(turn))).limit(pivots).select(*KEY).collect()
        at = sorted({tuple(row) for row in drawn})
        # Rows by how many pivots are at or before them, and whether the last of
        # these is at them.
        reached, passed = (sum((~_before(p, closed)).cast("int") for p in at) for closed in (False, True))
        counted = left.groupBy(reached.alias("reached"), (reached != passed).alias("is_pivot")).count()
        found = {(row.reached, row.is_pivot): row["count"] for row in counted.collect()}
        for i, pivot in enumerate([*at, None]):
            between = found.get((i, False), 0)
            if k <= done + between:
                low, high = (at[i - 1] if i else low), (pivot or high)
                break
            done += between
            if pivot is not None:
                done += found.get((i + 1, True), 0)
                if k <= done:
                    return pivot
        turn += 1


def _ranked(winners: DataFrame) -> DataFrame:
    """The drawn rows with their place in the order of keys, from 1."""
    spark = winners.sparkSession

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part, at = TaskContext.get().partitionId(), 0
        for batch in batches:
            rows = len(batch)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array([part] * rows, pa.int32()), pa.array(range(at + 1, at + rows + 1), pa.int64())],
                names=["doc_id", "n_features", "weight", "score", "part", "at"],
            )
            at += rows

    ordered = winners.repartitionByRange(*KEY).sortWithinPartitions(*KEY).select("doc_id", "n_features", "weight", "score")
    numbered = stage(
        in_arrow(ordered, number, "doc_id long, n_features long, weight long, score long, part int, at long"), shared_dir(spark, "winners")
    )
    # One row per partition of the sort.
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = numbered.groupBy("part").agg(F.count("*").alias("rows")).select("part", F.coalesce(F.sum("rows").over(before), F.lit(0)).alias("offset"))
    return numbered.join(parts, "part").select("doc_id", "n_features", "weight", "score", (F.col("offset") + F.col("at")).alias("rank"))


def resample(
    docs: DataFrame, target: DataFrame, percent: int = PERCENT, least_words: int = LEAST_WORDS, n: int = 1, buckets: int = BUCKETS, seed: int = SEED,
    id_col: str = "doc_id", text_col: str = "text", target_col: str = "text",
) -> DataFrame:
    """Per row of `docs`: doc_id, n_features, weight, score, and the rank if it
    is among the drawn `percent` of the rows with at least `least_words` words."""
    spark = docs.sparkSession
    plain = docs.select(column(id_col).cast("long").alias("doc_id"), column(text_col).cast("string").alias("text"))
    gain = gains(bucket_counts(plain.select("text"), n, buckets), bucket_counts(target.select(column(target_col).cast("string").alias("text")), n, buckets))
    keys = {"down": -F.col("score"), "last": F.col("doc_id").isNull().cast("int"), "id": F.coalesce("doc_id", F.lit(0)), "row": F.monotonically_increasing_id()}
    scored = stage(weighed(plain, gain, n, seed).withColumns(keys), shared_dir(spark, "scored"))
    may = F.col("n_words") >= least_words
    plain_result = ("doc_id", "n_features", "weight", "score")
    k = percent * scored.where(may).count() // 100
    if k == 0:
        return scored.select(*plain_result, F.lit(None).cast("long").alias("rank"))
    key = kth_key(scored.where(may), k)
    drawn = may & _before(key, closed=True)
    return _ranked(scored.where(drawn)).unionByName(scored.where(~drawn).select(*plain_result, F.lit(None).cast("long").alias("rank")))
