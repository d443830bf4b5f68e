"""Token ids in Huffman-coded files, and back.

Writing: the ids of every document, end id included, are staged once; their
global counts, one row per id, give a length-limited code (package-merge) in
canonical form, which is stored as (id, bits).  Documents in ascending id order
are then coded in blocks of whole documents.  A block stands alone: it holds its
documents' ids and lengths, the bits, and the bit offset of every
`CHECKPOINT`-th token, so that reading can start at any of them.

Blocks are rows of a table, so the files live in any store that Spark reaches.
Input that is in order already, as most tables are written, is coded where it is
read; other input is dealt once by ranges of the document id.

Reading: all stretches between checkpoints of a block are decoded side by side,
one table look-up per token.

Defined cases: a null text is empty and still gets the end id; a null document
id comes before all others; repeated ids keep all their rows; an empty table
gives an empty one.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from promptsieve.llm.texts import column, in_arrow
from promptsieve.llm.units import vocabulary_size, words
from promptsieve.session import shared_dir

BLOCK_IDS = 1 << 18
# The more texts, the fewer distinct words; bytes bound a batch as well.
TEXTS_PER_BATCH = 2048
CHECKPOINT = 256
RANGE_BYTES = 64 << 20

_STAGED = "part int, seq long, doc_id long, falls boolean, n_ids long, ids binary"
_BLOCK = (
    "part int, seq long, n_ids long, doc_ids array<long>, lengths array<long>, "
    "bits binary, checkpoints array<long>"
)


def read_tokenizer(path: str) -> str:
    """The tokenizer file as text, which is what tasks are sent."""
    with open(path, encoding="utf-8") as file:
        return file.read()


# --- The code ------------------------------------------------------------------


def code_lengths(counts: np.ndarray, limit: int) -> np.ndarray:
    """Bits per symbol of the best prefix code with at most `limit` bits each,
    0 for symbols without a count (package-merge)."""
    used = np.flatnonzero(counts)
    lengths = np.zeros(len(counts), dtype=np.int64)
    if len(used) < 2:
        lengths[used] = 1
        return lengths
    if len(used) > 1 << limit:
        raise ValueError(f"{len(used)} symbols do not fit in {limit} bits")
    order = used[np.argsort(counts[used], kind="stable")]
    leaves = counts[order].astype(np.int64)
    merged, is_leaf = leaves, [np.ones(len(leaves), dtype=bool)]
    for _ in range(limit - 1):
        even = merged[: len(merged) // 2 * 2]
        both = np.concatenate([leaves, even[::2] + even[1::2]])
        place = np.argsort(both, kind="stable")
        merged = both[place]
        is_leaf.append(place < len(leaves))
    wanted = 2 * len(leaves) - 2
    for level in reversed(is_leaf):
        chosen = int(level[:wanted].sum())
        lengths[order[:chosen]] += 1
        wanted = 2 * (wanted - chosen)
    return lengths


def canonical(lengths: np.ndarray) -> np.ndarray:
    """The codes that follow from the lengths alone."""
    codes = np.zeros(len(lengths), dtype=np.uint64)
    order = np.lexsort((np.arange(len(lengths)), lengths))
    order = order[lengths[order] > 0]
    sorted_lengths = lengths[order].astype(np.int64)
    if len(order):
        longest = int(sorted_lengths[-1])
        steps = np.int64(1) << (longest - sorted_lengths)
        codes[order] = ((np.cumsum(steps) - steps) >> (longest - sorted_lengths)).astype(np.uint64)
    return codes


def bit_limit(symbols: int) -> int:
    return max(12, int(symbols - 1).bit_length() + 1)


def pack(ids: np.ndarray, codes: np.ndarray, lengths: np.ndarray) -> tuple[bytes, np.ndarray]:
    """The ids' codes one after another, and the bit offset of each id."""
    bits = lengths[ids]
    ends = np.cumsum(bits)
    starts = ends - bits
    spread = codes[ids] << (64 - bits - (starts & 31)).astype(np.uint64)
    word = starts >> 5
    n = int(ends[-1] >> 5) + 2 if len(ids) else 1
    # The summed parts share no bits and stay below 2**32, so doubles are exact.
    high = np.bincount(word, weights=(spread >> np.uint64(32)).astype(np.float64), minlength=n)
    low = np.bincount(word + 1, weights=(spread & np.uint64(0xFFFFFFFF)).astype(np.float64), minlength=n)
    return (high + low).astype(np.uint64).astype(">u4").tobytes(), starts


def decoding_table(lengths: np.ndarray) -> tuple[np.ndarray, int]:
    """For every window of `limit` bits: the id it begins with and its bits."""
    limit = max(1, int(lengths.max(initial=0)))
    codes, table = canonical(lengths), np.zeros(1 << limit, dtype=np.uint64)
    order = np.lexsort((np.arange(len(lengths)), lengths))
    order = order[lengths[order] > 0]
    repeats = np.int64(1) << (limit - lengths[order])
    entries = (order.astype(np.uint64) << np.uint64(6)) | lengths[order].astype(np.uint64)
    filled = np.repeat(entries, repeats)
    table[: len(filled)] = filled
    assert not len(order) or codes[order[0]] == 0
    return table, limit


def unpack(bits: bytes, checkpoints: np.ndarray, n: int, table: np.ndarray, limit: int) -> np.ndarray:
    """`n` ids, all stretches between checkpoints in step with each other."""
    raw = np.frombuffer(bits + bytes(8), dtype=np.uint8).astype(np.uint64)
    windows = np.zeros(len(raw) - 7, dtype=np.uint64)
    for i in range(5):  # 40 bits from every byte on
        windows |= raw[i : i + len(windows)] << np.uint64(32 - 8 * i)
    at = checkpoints.astype(np.uint64)
    last = n - (len(at) - 1) * CHECKPOINT  # ids of the last stretch
    out = np.empty((CHECKPOINT, len(at)), dtype=np.uint32)
    mask, shift = np.uint64((1 << limit) - 1), np.uint64(40 - limit)
    six, three, seven, sixty_three = (np.uint64(x) for x in (6, 3, 7, 63))
    for step in range(CHECKPOINT if len(at) > 1 else last):
        if step == last:
            at = at[:-1]
        found = table[(windows[at >> three] >> (shift - (at & seven))) & mask]
        out[step, : len(at)] = found >> six
        at = at + (found & sixty_three)
    return out.T.reshape(-1)[:n] if len(checkpoints) > 1 else out[:n, 0]


# --- Writing ---------------------------------------------------------------------


def _tokenised(docs: DataFrame, id_col: str, text_col: str, tokenizer_json: str, end_id: int, width: str) -> DataFrame:
    shared, size = docs.sparkSession.sparkContext.broadcast(tokenizer_json), np.dtype(width).itemsize

    def job(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, part, seq, before = words(shared.value), TaskContext.get().partitionId(), 0, None
        for batch in batches:
            doc_ids = batch.column(0).to_pylist()
            flat, ends = known.encode_all(batch.column(1))
            raw = np.insert(flat.astype(width), ends, end_id).tobytes()
            bounds = [0, *(ends + np.arange(1, len(ends) + 1)).tolist()]
            keys = [(-1, 0) if d is None else (0, d) for d in doc_ids]
            falls = [a is not None and a > b for a, b in zip([before, *keys], keys)]
            before = keys[-1] if keys else before
            n = len(doc_ids)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([part] * n, pa.int32()), pa.array(range(seq, seq + n), pa.int64()),
                    pa.array(doc_ids, pa.int64()), pa.array(falls, pa.bool_()),
                    pa.array(np.diff(bounds), pa.int64()),
                    pa.array([raw[a * size : b * size] for a, b in zip(bounds, bounds[1:])], pa.binary()),
                ],
                names=["part", "seq", "doc_id", "falls", "n_ids", "ids"],
            )
            seq += n

    return in_arrow(docs.select(column(id_col).cast("long"), column(text_col)), job, _STAGED, rows=TEXTS_PER_BATCH)


def _counts(staged: DataFrame, width: str, size: int) -> np.ndarray:
    """How often each id occurs; the result has a row per id of the vocabulary."""

    def job(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size, dtype=np.int64)
        for batch in batches:
            joined = b"".join(batch.column(0).to_pylist())
            total += np.bincount(np.frombuffer(joined, dtype=width), minlength=size)
        found = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(found, pa.int32()), pa.array(total[found], pa.int64())], names=["id", "n"])

    rows = in_arrow(staged.select("ids"), job, "id int, n long").groupBy("id").agg(F.sum("n").alias("n")).collect()
    counts = np.zeros(size, dtype=np.int64)
    counts[[r.id for r in rows]] = [r.n for r in rows]
    return counts


def _in_order(staged: DataFrame) -> bool:
    """Whether the parts hold ascending ids and their ranges do not overlap."""
    parts = staged.groupBy("part").agg(
        F.min(F.coalesce("doc_id", F.lit(-(1 << 63)))).alias("low"),
        F.max(F.coalesce("doc_id", F.lit(-(1 << 63)))).alias("high"),
        F.max("falls").alias("falls"),
    )
    before = F.lag("high").over(Window.orderBy("low", "high"))  # a row per part
    tested = parts.select((F.col("falls") | F.coalesce(before > F.col("low"), F.lit(False))).alias("bad"))
    return not tested.agg(F.max("bad")).first()[0]


def _dealt_by_range(staged: DataFrame, width: str) -> DataFrame:
    """Staged rows in ascending order inside parts that are ranges of the id."""
    ids = staged.agg(F.sum("n_ids")).first()[0] or 0
    ranges = int(ids) * np.dtype(width).itemsize // RANGE_BYTES + 1
    bounds = staged.agg(F.percentile_approx("doc_id", [(i + 1) / ranges for i in range(ranges)], 10_000)).first()[0] or []
    bounds = sorted(set(bounds))
    limits = F.array(*(F.lit(int(b)) for b in bounds)) if bounds else F.array().cast("array<bigint>")
    part = F.coalesce(F.size(F.filter(limits, lambda b: b < F.col("doc_id"))), F.lit(0))
    return (
        staged.withColumn("was", F.struct("part", "seq")).withColumn("part", part)
        .repartition(len(bounds) + 1, "part")
        .sortWithinPartitions("part", F.asc_nulls_first("doc_id"), "was")
        .withColumn("seq", F.monotonically_increasing_id())
        .select("part", "seq", "doc_id", "n_ids", "ids")
    )


def _blocks(ordered: DataFrame, lengths: np.ndarray, width: str) -> DataFrame:
    shared = ordered.sparkSession.sparkContext.broadcast(lengths.astype(np.uint8))

    def job(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = shared.value.astype(np.int64)
        codes = canonical(bits)
        part = following = None
        open_: list[tuple] = []
        held = first = 0

        def block() -> pa.RecordBatch:
            ids = np.frombuffer(b"".join(x[1] for x in open_), dtype=width)
            packed, starts = pack(ids, codes, bits)
            row = [part, first, len(ids), [x[0] for x in open_], [x[2] for x in open_], packed, starts[::CHECKPOINT].tolist()]
            kinds = [pa.int32(), pa.int64(), pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.binary(), pa.list_(pa.int64())]
            names = ["part", "seq", "n_ids", "doc_ids", "lengths", "bits", "checkpoints"]
            return pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip(row, kinds)], names=names)

        for batch in batches:
            for p, s, doc_id, n, ids in zip(*(batch.column(i).to_pylist() for i in range(5))):
                if open_ and (p != part or s != following or held + n > BLOCK_IDS):
                    yield block()
                    open_, held = [], 0
                if not open_:
                    part, first = p, s
                open_.append((doc_id, ids, n))
                held, following = held + n, s + 1
        if open_:
            yield block()

    return in_arrow(ordered.select("part", "seq", "doc_id", "n_ids", "ids"), job, _BLOCK)


def write(docs: DataFrame, path: str, tokenizer_path: str, end_id: int, id_col: str = "doc_id", text_col: str = "text") -> None:
    """Write the files of `docs` under `path`: `code` and `blocks`."""
    spark, tokenizer_json = docs.sparkSession, read_tokenizer(tokenizer_path)
    size = max(vocabulary_size(tokenizer_json), end_id + 1)
    width = "<u2" if size <= 1 << 16 else "<u4"
    work = shared_dir(spark, "token-ids")
    _tokenised(docs, id_col, text_col, tokenizer_json, end_id, width).write.option("compression", "zstd").parquet(work)
    staged = spark.read.schema(_STAGED).parquet(work)
    counts = _counts(staged, width, size)
    lengths = code_lengths(counts, bit_limit(max(2, int(np.count_nonzero(counts)))))
    used = np.flatnonzero(lengths)
    code = spark.createDataFrame([(int(i), int(lengths[i])) for i in used], "id int, bits int")
    code.coalesce(1).write.parquet(f"{path}/code")
    ordered = staged if _in_order(staged) else _dealt_by_range(staged, width)
    _blocks(ordered, lengths, width).write.option("compression", "uncompressed").parquet(f"{path}/blocks")


# --- Reading ---------------------------------------------------------------------


def _code(spark: SparkSession, path: str) -> np.ndarray:
    rows = spark.read.schema("id int, bits int").parquet(f"{path}/code").collect()  # a row per id of the vocabulary
    lengths = np.zeros(max((r.id for r in rows), default=0) + 1, dtype=np.int64)
    for r in rows:
        lengths[r.id] = r.bits
    return lengths


def read(spark: SparkSession, path: str, value: Callable[[bytes], object] = bytes, kind: str = "binary") -> DataFrame:
    """(part, seq, doc_id, begin, n_tokens, value): per document where it begins
    in its block, and a value of its ids as little-endian unsigned 32-bit
    integers, which are themselves the value if no other is asked for."""
    shared = spark.sparkContext.broadcast(_code(spark, path))
    arrow_kind = {"binary": pa.binary(), "long": pa.int64()}[kind]

    def job(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table, limit = decoding_table(shared.value)
        for batch in batches:
            columns = [batch.column(i) for i in range(7)]
            for i in range(batch.num_rows):
                part, seq, n, doc_ids, lengths, bits, checkpoints = (c[i].as_py() for c in columns)
                ids = unpack(bits, np.array(checkpoints, dtype=np.int64), n, table, limit).astype("<u4")
                ends = np.cumsum(lengths)
                begins = ends - lengths
                k = len(doc_ids)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([part] * k, pa.int32()), pa.array([seq] * k, pa.int64()), pa.array(doc_ids, pa.int64()),
                        pa.array(begins, pa.int64()), pa.array(lengths, pa.int64()),
                        pa.array([value(ids[a:b].tobytes()) for a, b in zip(begins, ends)], arrow_kind),
                    ],
                    names=["part", "seq", "doc_id", "begin", "n_tokens", "value"],
                )

    blocks = spark.read.schema(_BLOCK).parquet(f"{path}/blocks")
    # A block has some hundred thousand ids.
    return in_arrow(blocks, job, f"part int, seq long, doc_id long, begin long, n_tokens long, value {kind}", rows=8)


def block_starts(spark: SparkSession, path: str) -> DataFrame:
    """(part, seq, start): ids before each block.  Totals are summed per part,
    and then over the parts, of which there is one per task that wrote."""
    blocks = spark.read.schema(_BLOCK).parquet(f"{path}/blocks").select(
        "part", "seq", "n_ids", F.get("doc_ids", F.lit(0)).alias("first"), F.try_element_at("doc_ids", F.lit(-1)).alias("last")
    )
    inside = Window.partitionBy("part").orderBy("seq").rowsBetween(Window.unboundedPreceding, -1)
    per_part = blocks.groupBy("part").agg(F.sum("n_ids").alias("total"), F.min_by("first", "seq").alias("first"), F.max("last").alias("last"))
    # As the parts were found to be in order: one that ends with the id another
    # begins with comes first, though both begin with it.
    across = Window.orderBy(F.asc_nulls_first("first"), F.asc_nulls_first("last"), "part").rowsBetween(Window.unboundedPreceding, -1)
    bases = per_part.select("part", F.coalesce(F.sum("total").over(across), F.lit(0)).alias("base"))
    return blocks.withColumn("inside", F.coalesce(F.sum("n_ids").over(inside), F.lit(0))).join(bases, "part").select(
        "part", "seq", (F.col("base") + F.col("inside")).alias("start")
    )


def digests(spark: SparkSession, path: str) -> DataFrame:
    """Per document, from the files: doc_id, start, n_tokens and ids_crc32."""
    return read(spark, path, zlib.crc32, "long").join(block_starts(spark, path), ["part", "seq"]).select(
        "doc_id", (F.col("start") + F.col("begin")).alias("start"), "n_tokens", F.col("value").alias("ids_crc32")
    )
