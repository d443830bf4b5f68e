"""Exact top-k inner products with a bit-sliced index.

Vectors become integers, floor(256 x) of each component.  The index holds blocks
of rows: per dimension the components, shifted to a few bits, as bit slices, one
bitmap per bit.  A block of queries is scored against a block of rows with bitmap
arithmetic alone: a query's component is a sum of powers of two, so its product
with a sliced dimension is a sum of slices at shifted places, and carry-save
adders sum the bitmaps of each place until a binary number per row is left, in
slices again.  The k-th best of those sums is found from the most significant
slice downward.  The bits that were shifted away can add no more than a bound
that depends on the query alone; rows within it of the k-th best are the boundary
rows, and their integer products are computed exactly.

The queries are those rows of the table whose id is divisible by `every`.  Each
block of them meets each block of rows once, and only k rows per query and block
leave a task.  A task holds a shelf of blocks of rows while blocks of queries pass
by, so the number of tasks grows with the shelves, not with the pairs of blocks;
the few queries go to every shelf, and nothing is broadcast.

Defined cases: rows whose id or vector is null, or whose vector holds a null or
a number that is not finite, take no part.  Shorter vectors count as filled up
with zeros.  Rows that share an id are rows of their own, as candidates and as
queries: the best of all queries of one id are ranked together, and none of them
meets a row of that id.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from promptsieve.llm.texts import column, importable, in_arrow
from promptsieve.session import shared_dir
from promptsieve.sources.sinks import stage

SCALE = 256.0
BLOCK_ROWS = 8192
BLOCK_QUERIES = 256
# Queries whose bitmaps are summed together, so that they stay in the cache.
TOGETHER = 64
SLICES = 6
# So many blocks of rows are on a shelf at most, and so many tasks are wanted: where
# there are fewer blocks, each is held by several tasks, which share the queries.
SHELF = 16
TASKS = 48

_INDEX = "block int, rows int, ids binary, values binary, low binary, shift int, slices binary"


# --- Bitmap arithmetic -------------------------------------------------------------


def bitmaps(bits: np.ndarray) -> np.ndarray:
    """Rows of 0 and 1 as rows of 64-bit words."""
    padded = np.zeros((*bits.shape[:-1], -(-bits.shape[-1] // 64) * 64), dtype=np.uint8)
    padded[..., : bits.shape[-1]] = bits
    return np.packbits(padded, axis=-1, bitorder="little").view(np.uint64)


def unpacked(words: np.ndarray, rows: int) -> np.ndarray:
    return np.unpackbits(np.ascontiguousarray(words).view(np.uint8), bitorder="little", count=rows)


class Adder:
    """Sums bitmaps by place value.  A place keeps at most two bitmaps: the third
    that comes makes a full adder, one bitmap stays and one is carried."""

    def __init__(self):
        self.places: list[list[np.ndarray]] = []

    def add(self, place: int, bitmap: np.ndarray) -> None:
        while True:
            while place >= len(self.places):
                self.places.append([])
            held = self.places[place]
            if len(held) < 2:
                held.append(bitmap)
                return
            a, b = held
            either = a ^ b
            carry = (a & b) | (bitmap & either)
            self.places[place] = [either ^ bitmap]
            place, bitmap = place + 1, carry

    def total(self) -> list[np.ndarray | None]:
        """The sum's slices, least significant first."""
        slices, carry, place = [], None, 0
        while place < len(self.places) or carry is not None:
            parts = [p for p in (*(self.places[place] if place < len(self.places) else ()), carry) if p is not None]
            carry, place = None, place + 1
            if len(parts) == 3:
                either = parts[0] ^ parts[1]
                slices.append(either ^ parts[2])
                carry = (parts[0] & parts[1]) | (parts[2] & either)
            elif len(parts) == 2:
                slices.append(parts[0] ^ parts[1])
                carry = parts[0] & parts[1]
            else:
                slices.append(parts[0] if parts else None)
        return slices


def kth_largest(slices: list[np.ndarray], valid: np.ndarray, k: int) -> np.ndarray:
    """Per query the k-th largest sum among its valid rows (0 if fewer)."""
    tied, above = valid.copy(), np.zeros(len(valid), dtype=np.int64)
    found = np.zeros(len(valid), dtype=np.int64)
    for bit in range(len(slices) - 1, -1, -1):
        ones = tied & slices[bit]
        n = above + np.bitwise_count(ones).sum(axis=1, dtype=np.int64)
        goes_up = n >= k
        found += goes_up.astype(np.int64) << bit
        above = np.where(goes_up, above, n)
        tied = np.where(goes_up[:, None], ones, tied & ~slices[bit])
    return np.where(np.bitwise_count(valid).sum(axis=1) >= k, found, 0)


def at_least(slices: list[np.ndarray], valid: np.ndarray, threshold: np.ndarray) -> np.ndarray:
    """Per query the bitmap of valid rows whose sum reaches its threshold."""
    over, tied = np.zeros_like(valid), valid.copy()
    for bit in range(len(slices) - 1, -1, -1):
        wanted = ((threshold >> bit) & 1 == 1)[:, None]
        over = np.where(wanted, over, over | (tied & slices[bit]))
        tied = np.where(wanted, tied & slices[bit], tied & ~slices[bit])
    return np.where((threshold >> len(slices) > 0)[:, None], 0, over | tied)


def narrow(values: np.ndarray) -> np.ndarray:
    """The values in the smallest integers that hold them all."""
    low, high = values.min(initial=0), values.max(initial=0)
    return values.astype(next(t for t in ("<i2", "<i4", "<i8") if np.iinfo(t).min <= low and high <= np.iinfo(t).max))


def widened(data: bytes, rows: int, width: int) -> np.ndarray:
    """Rows of what `narrow` made, as it made them."""
    return np.frombuffer(data, dtype=f"<i{len(data) // (rows * width)}").reshape(rows, width)


# --- Blocks ------------------------------------------------------------------------


def index_block(ids: np.ndarray, values: np.ndarray) -> tuple:
    """(low, shift, slices) of rows of integer components."""
    low = values.min(axis=0) if len(values) else np.zeros(values.shape[1], dtype=np.int64)
    raised = values - low
    shift = max(0, int(raised.max(initial=0)).bit_length() - SLICES)
    short = (raised >> shift).T
    bits = np.stack([(short >> b) & 1 for b in range(SLICES)], axis=1).astype(np.uint8)
    return low, shift, bitmaps(bits)


def search_block(query_ids, queries, ids, values, low, shift, slices, k: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(query id, row ids, scores) of each query's best k rows of a block, whose
    ids rise.  All rows with the query's own id are left out."""
    n = len(ids)
    everyone = bitmaps(np.ones((1, n), dtype=np.uint8))
    for begin in range(0, len(queries), TOGETHER):
        some, some_ids = queries[begin : begin + TOGETHER], query_ids[begin : begin + TOGETHER]
        valid = np.repeat(everyone, len(some), axis=0)
        for row, q in enumerate(some_ids):
            low_own, high_own = np.searchsorted(ids, [q, q + 1])
            if low_own < high_own:
                valid[row] = bitmaps((ids != q).astype(np.uint8)[None])[0]
        adder, size = Adder(), np.abs(some)
        negative = (np.where(some < 0, -1, 0)).astype(np.int64).view(np.uint64)
        bits = int(size.max(initial=0)).bit_length()
        for d in range(some.shape[1]):
            # A negative weight takes the slice's complement instead.
            flipped = [slices[d, b][None, :] ^ negative[:, d, None] for b in range(SLICES)]
            for j in range(bits):
                chosen = (-((size[:, d] >> j) & 1)).view(np.uint64)[:, None]
                if chosen.any():
                    for b in range(SLICES):
                        adder.add(j + b, flipped[b] & chosen)
        nothing = np.zeros_like(valid)
        sums = [s if s is not None else nothing for s in adder.total()] or [nothing]
        # What the shifted bits of all components can add, in units of the sums.
        slack = -(-(size.sum(axis=1) * ((1 << shift) - 1)) >> shift) if shift else np.zeros(len(some), dtype=np.int64)
        threshold = np.maximum(0, kth_largest(sums, valid, k) - slack)
        boundary = at_least(sums, valid, threshold)
        for row, q in enumerate(some_ids):
            at = np.flatnonzero(unpacked(boundary[row], n))
            score = values[at].astype(np.int64) @ some[row]
            best = np.lexsort((ids[at], -score))[:k]
            yield int(q), ids[at][best], score[best]


# --- The search --------------------------------------------------------------------


def top_k(rows: DataFrame, k: int = 5, every: int = 50, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """Per query and rank: query_id, rank, vec_id and score."""
    spark = rows.sparkSession
    importable(spark)
    whole = rows.select(column(id_col).cast("long").alias("id"), column(vector_col).cast("array<double>").alias("vector")).where(
        F.col("id").isNotNull() & F.col("vector").isNotNull()
        & F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    )
    values = whole.select("id", F.transform("vector", lambda x: F.floor(x * SCALE)).alias("v"))
    n, width = values.agg(F.count("*"), F.coalesce(F.max(F.size("v")), F.lit(0))).first()
    blocks = max(1, -(-n // BLOCK_ROWS))

    def build(key: tuple, group: pd.DataFrame) -> pd.DataFrame:
        filled = np.zeros((len(group), width), dtype=np.int64)
        for row, v in enumerate(group.v):
            filled[row, : len(v)] = v
        order = np.lexsort((*filled.T[::-1], group.id.to_numpy()))
        ids, filled = group.id.to_numpy()[order], filled[order]
        low, shift, slices = index_block(ids, filled)
        return pd.DataFrame({
            "block": [key[0]], "rows": [len(ids)], "ids": [ids.astype("<i8").tobytes()], "values": [narrow(filled).tobytes()],
            "low": [low.astype("<i8").tobytes()], "shift": [shift], "slices": [slices.tobytes()],
        })

    # By row, so that an id that many rows have is no group of its own.
    keyed = values.withColumn("block", F.pmod(F.xxhash64("id", F.monotonically_increasing_id()), F.lit(blocks)).cast("int"))
    index = stage(keyed.groupBy("block").applyInPandas(build, _INDEX), shared_dir(spark, "bit-slices"))

    def queries_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for ids, v in zip(*(batch.column(i).to_pylist() for i in range(2))):
                ids = np.frombuffer(ids, dtype="<i8")
                v = widened(v, len(ids), width)
                asked = np.flatnonzero(ids % every == 0)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(ids[asked]), pa.array([narrow(v[i]).tobytes() for i in asked], pa.binary())], names=["id", "value"]
                )

    asked = stage(in_arrow(index.select("ids", "values"), queries_of, "id long, value binary", rows=4), shared_dir(spark, "queries"))
    query_blocks = max(1, -(-asked.count() // BLOCK_QUERIES))
    gathered = asked.withColumn(
        "query_block", F.pmod(F.xxhash64("id", F.monotonically_increasing_id()), F.lit(query_blocks)).cast("int")
    ).groupBy("query_block").agg(
        F.array_sort(F.collect_list(F.struct("id", "value"))).alias("queries")
    )
    wanted = max(TASKS, 2 * spark.sparkContext.defaultParallelism)
    shelves = -(-blocks // min(SHELF, -(-blocks // wanted)))
    parts = min(query_blocks, max(1, wanted // shelves))
    places = shelves * parts
    # Place shelf * parts + part holds a shelf and meets the query blocks of a part.
    first = F.col("block") % shelves * parts
    shelved = index.withColumn("place", F.explode(F.sequence(first, first + (parts - 1))))
    passing = gathered.withColumn("place", F.explode(F.sequence(F.col("query_block") % parts, F.lit(places - 1), F.lit(parts))))
    met = (
        shelved.unionByName(passing, allowMissingColumns=True)
        .repartitionById(places, F.col("place"))
        .sortWithinPartitions("place", F.col("queries").isNotNull())
    )

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place, shelf = None, []
        for batch in batches:
            for row in batch.to_pylist():
                if row["place"] != place:
                    place, shelf = row["place"], []
                if row["queries"] is None:
                    ids, low = np.frombuffer(row["ids"], dtype="<i8"), np.frombuffer(row["low"], dtype="<i8")
                    slices = np.frombuffer(row["slices"], dtype=np.uint64).reshape(width, SLICES, -1)
                    shelf.append((ids, widened(row["values"], len(ids), width), low, row["shift"], slices))
                    continue
                query_ids = np.array([q["id"] for q in row["queries"]], dtype=np.int64)
                weights = np.concatenate([widened(q["value"], 1, width) for q in row["queries"]]).astype(np.int64)
                for block in shelf:
                    found = list(search_block(query_ids, weights, *block, k))
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(np.repeat([f[0] for f in found], [len(f[1]) for f in found]).astype(np.int64)),
                            pa.array(np.concatenate([f[1] for f in found] or [np.zeros(0, dtype=np.int64)]).astype(np.int64)),
                            pa.array(np.concatenate([f[2] for f in found] or [np.zeros(0, dtype=np.int64)]).astype(np.int64)),
                        ],
                        names=["query_id", "vec_id", "score"],
                    )

    best = in_arrow(met, search, "query_id long, vec_id long, score long", rows=1)
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return best.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
