"""Removal of byte strings that occur more than once, by distributed prefix doubling.

A position counts as repeated if the `length` bytes from there on also begin at
another position, in any text or the same; every byte such a string covers goes.
Prefix doubling over all positions would shuffle each byte of the corpus many
times over, so positions are decided in bulk first, exactly, and only those that
bulk cannot decide are sorted:

1. Every window of `length` bytes has an anchor, the least of its grams of half
   that length by a hash.  Positions with one anchor form a run; equal windows
   have equal anchors at equal offsets.  An anchor gram held once decides a run:
   nothing there is repeated.  A run whose whole surroundings (all its windows
   together) occur twice is decided too: all of it is repeated.
2. What is left, runs that share a gram and differ somewhere, is cut into blocks
   of `BLOCK` positions.  The bytes all windows of a block share decide it if
   they occur once; the bytes they span, if these occur twice.
3. The positions of the blocks that are left are ranked by prefix doubling: Spark
   sorts the pairs of a position's rank and of what the bytes after it hold, at
   offsets that grow (a quarter, half, all of `length`), gives each pair that
   occurs twice the next rank in that order, and drops positions whose pair is
   unique.  Those that get past `length` are repeated.

One representative of equal runs, and of equal blocks, goes to the next step, so
that thousands of copies cost one.  Texts are known by 128 bits of hash, runs,
blocks and pairs by 64 within 64.

Defined cases: a null text is empty.  Texts shorter than `length` lose nothing.
Rows with one text are all repeated, if long enough.  A null or repeated doc_id
changes nothing.  Very long texts are hashed in chunks; runs end at their borders.
An empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from promptsieve.llm.texts import column, in_arrow
from promptsieve.session import shared_dir
from promptsieve.sources.sinks import stage

LENGTH = 400
BLOCK = 16
# Windows whose hashes are held at once.
CHUNK = 1 << 16
# Lists of places are broadcast up to so many bytes, and joined by a shuffle beyond.
BROADCAST_BYTES = 64 << 20
TEXTS_PER_BATCH = 256

_POSITION_BITS = 17
_POSITION = np.uint64((1 << _POSITION_BITS) - 1)
_BASE = 0x9E3779B97F4A7C15
_ODD = np.random.default_rng(400).integers(0, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


# --- Runs of one text --------------------------------------------------------------


class Runs:
    """Finds the runs of positions that share an anchor."""

    def __init__(self, length: int):
        if not 8 <= length < CHUNK:
            raise ValueError(f"length has to be from 8 to {CHUNK - 1}")
        self.length, self.gram = length, length // 2
        most = CHUNK + length
        self.up = np.cumprod(np.concatenate([np.ones(1, dtype=np.uint64), np.full(most, _BASE, dtype=np.uint64)]))
        self.down = np.cumprod(np.concatenate([np.ones(1, dtype=np.uint64), np.full(most, pow(_BASE, -1, 1 << 64), dtype=np.uint64)]))

    def of_chunk(self, text: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(first position of each run, its anchor, hash of the anchor's gram)."""
        summed = np.concatenate([np.zeros(1, dtype=np.uint64), np.cumsum(_ODD[text] * self.up[: len(text)])])
        grams = (summed[self.gram :] - summed[: -self.gram]) * self.down[: len(text) - self.gram + 1]
        mixed = (grams ^ (grams >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
        mixed ^= mixed >> np.uint64(29)
        # With the position in the low bits, the first of equal grams is the least.
        least = (mixed & ~_POSITION) | np.arange(len(mixed), dtype=np.uint64)
        width, wanted = 1, self.length - self.gram + 1
        while width < wanted:
            by = min(width, wanted - width)
            least = np.minimum(least[:-by], least[by:])
            width += by
        anchors = (least & _POSITION).astype(np.int64)
        first = np.concatenate([[0], np.flatnonzero(anchors[1:] != anchors[:-1]) + 1])
        return first, anchors[first], grams[anchors[first]]

    def of_text(self, text: bytes) -> tuple[np.ndarray, ...]:
        """(first, last, offset of the anchor from the first, gram, surroundings)."""
        parts = [[np.zeros(0, dtype=np.int64)], [np.zeros(0, dtype=np.int64)], [np.zeros(0, dtype=np.int64)], [np.zeros(0, dtype=np.uint64)]]
        windows = len(text) - self.length + 1
        for at in range(0, windows, CHUNK):
            piece = text[at : min(at + CHUNK, windows) + self.length - 1]
            first, anchor, gram = self.of_chunk(np.frombuffer(piece, dtype=np.uint8))
            last = np.append(first[1:], len(piece) - self.length + 1) - 1
            for part, found in zip(parts, (first + at, last + at, anchor - first, gram)):
                part.append(found)
        first, last, offset, gram = map(np.concatenate, parts)
        around = [xxhash.xxh3_64_intdigest(text[a : b + self.length]) for a, b in zip(first.tolist(), last.tolist())]
        return first, last, offset, gram, np.array(around, dtype=np.uint64)


def blocks_of(text: bytes, first: int, last: int, offset: int, length: int) -> Iterator[tuple[int, int, int, int]]:
    """(first, last, hash of the shared bytes, hash of the spanned bytes) of the
    blocks of a run.  Blocks lie at fixed offsets from the anchor, so those of
    equal windows correspond even where a run cuts them short."""
    anchor, width = first + offset, min(BLOCK, length // 2)
    for number in range((anchor - last) // width, offset // width + 1):
        end, start = anchor - width * number, anchor - width * (number + 1) + 1
        a, b = max(first, start), min(last, end)
        shared = xxhash.xxh3_64_intdigest(text[end : start + length], seed=number)
        yield a, b, shared, xxhash.xxh3_64_intdigest(text[a : b + length])


def merged(places: list[tuple[int, int]], length: int) -> list[tuple[int, int]]:
    """(first, last) positions of the maximal stretches of bytes that the windows
    at the given positions cover."""
    stretches: list[tuple[int, int]] = []
    for first, last in sorted(places):
        if stretches and first <= stretches[-1][1] + length:
            stretches[-1] = stretches[-1][0], max(last, stretches[-1][1])
        else:
            stretches.append((first, last))
    return stretches


def kept_of(text: bytes, stretches: list[tuple[int, int]], length: int) -> tuple[int, str]:
    """(bytes removed, sha256 of the rest)."""
    digest, removed, at, view = hashlib.sha256(), 0, 0, memoryview(text)
    for first, last in stretches:
        digest.update(view[at:first])
        at = last + length
        removed += at - first
    digest.update(view[at:])
    return removed, digest.hexdigest()


# --- Steps -------------------------------------------------------------------------


def _signed(values) -> pa.Array:
    return pa.array(np.asarray(values, dtype=np.uint64).view(np.int64), pa.int64())


def _texts(plain: DataFrame, length: int) -> DataFrame:
    """The distinct long texts with text_no, how many rows hold them, the key of
    one of these, and their runs."""

    def job(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        runs = Runs(length)
        for batch in batches:
            found = [runs.of_text(text) for text in batch.column(3).to_pylist()]
            at = pa.array(np.concatenate([[0], np.cumsum([len(f[0]) for f in found])]), pa.int32())
            flat = [np.concatenate([f[i] for f in found]) if found else np.zeros(0) for i in range(5)]
            lists = [pa.ListArray.from_arrays(at, pa.array(flat[i], pa.int32())) for i in range(3)]
            lists += [pa.ListArray.from_arrays(at, _signed(flat[i])) for i in (3, 4)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), batch.column(2), *lists], names=["t1", "t2", "id", "first", "last", "offset", "gram", "around"]
            )

    spark = plain.sparkSession
    long = plain.where(F.octet_length("bytes") >= length).select("t1", "t2", "id", "bytes")
    lists = ("first", "last", "offset", "gram", "around")
    schema = "t1 long, t2 long, id long, first array<int>, last array<int>, offset array<int>, gram array<long>, around array<long>"
    rows = stage(in_arrow(long, job, schema, rows=TEXTS_PER_BATCH), shared_dir(spark, "runs"))
    many = stage(rows.groupBy("t1", "t2").agg(F.count("*").alias("rows"), F.min("id").alias("id")).where(F.col("rows") > 1), shared_dir(spark, "copies"))
    keys = many.select("t1", "t2")
    small = F.broadcast(keys) if many.count() * 64 <= BROADCAST_BYTES else keys
    one = rows.join(small, ["t1", "t2"], "left_semi").groupBy("t1", "t2").agg(*(F.first(c).alias(c) for c in lists)).join(many, ["t1", "t2"])
    single = rows.join(small, ["t1", "t2"], "left_anti").withColumn("rows", F.lit(1).cast("long"))
    columns = ("t1", "t2", "id", "rows", *lists)
    texts = single.select(*columns).unionByName(one.select(*columns))
    return stage(texts.withColumn("text_no", F.monotonically_increasing_id()), shared_dir(spark, "texts"))


def _kinds(items: DataFrame, kind: list[str], whole: str, kept: tuple[str, ...]) -> tuple[DataFrame, DataFrame]:
    """(repeated items, representatives of undecided ones).

    Equal windows are in items of one `kind`.  A kind held once is unique.  Items
    whose `whole` is held twice are repeated; of kinds with several `whole`s one
    item of each goes on, since it may share windows with the others.
    """
    spark = items.sparkSession
    # Written, so that the join below can split a kind that many items have.
    held = stage(items.groupBy(*kind).agg(F.sum("n").alias("held")).where(F.col("held") > 1).select(*kind), shared_dir(spark, "held"))
    live = stage(items.join(held, kind), shared_dir(spark, "live"))
    wholes = stage(live.groupBy(*kind, whole).agg(F.sum("n").alias("n"), F.min(F.struct(*kept)).alias("one")), shared_dir(spark, "wholes"))
    twice = wholes.where(F.col("n") > 1).select(*kind, whole)
    repeated = live.join(twice, [*kind, whole], "left_semi").select(*kept)
    mixed = wholes.groupBy(*kind).agg(F.count("*").alias("wholes")).where(F.col("wholes") > 1).select(*kind)
    return repeated, wholes.join(mixed, kind, "left_semi").select(*kind, F.least("n", F.lit(2)).cast("int").alias("n"), "one.*")


def _with_lists(plain: DataFrame, lists: DataFrame, how: str, keys: list[str]) -> DataFrame:
    """Documents joined with one row of lists per text: by broadcast if these are
    known to be small, else by a shuffle."""
    size = lists.agg(F.sum(F.lit(64) + F.size("list") * 48)).first()[0] or 0
    return plain.join(F.broadcast(lists) if size <= BROADCAST_BYTES else lists, keys, how)


def _reading(plain: DataFrame, texts: DataFrame, items: DataFrame, job, schema: str) -> DataFrame:
    """`job` over the bytes of each text that has items, with these as a list."""
    spark = plain.sparkSession
    lists = items.groupBy("text_no").agg(F.collect_list(F.struct(*(c for c in items.columns if c != "text_no"))).alias("list"))
    lists = stage(lists.join(texts.select("text_no", "t1", "t2", "id"), "text_no"), shared_dir(spark, "lists"))
    named = lists.select("t1", "t2", F.col("id").alias("wanted"), "text_no", "list")
    read = _with_lists(plain, named, "inner", ["t1", "t2"]).where(F.col("id").eqNullSafe(F.col("wanted")))
    # Rows that repeat id and text give the same again, which changes no decision:
    # what a repeated text holds counts as held twice in any case.
    return in_arrow(read.select("text_no", "bytes", "list"), job, schema, rows=TEXTS_PER_BATCH)


def _blocks(plain: DataFrame, texts: DataFrame, runs: DataFrame, length: int) -> DataFrame:
    def job(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for text_no, text, items in zip(*(batch.column(i).to_pylist() for i in range(3))):
                for run in items:
                    for a, b, shared, spanned in blocks_of(text, run["first"], run["last"], run["offset"], length):
                        rows.append((text_no, a, b, run["k1"], shared, spanned, run["n"]))
            cols = list(zip(*rows)) or [()] * 7
            yield pa.RecordBatch.from_arrays(
                [pa.array(cols[0], pa.int64()), pa.array(cols[1], pa.int32()), pa.array(cols[2], pa.int32()), pa.array(cols[3], pa.int64()), _signed(cols[4]), _signed(cols[5]), pa.array(cols[6], pa.int32())],
                names=["text_no", "first", "last", "k1", "k2", "spanned", "n"],
            )

    return _reading(plain, texts, runs, job, "text_no long, first int, last int, k1 long, k2 long, spanned long, n int")


def _positions(plain: DataFrame, texts: DataFrame, blocks: DataFrame, length: int) -> DataFrame:
    """A row per position of the blocks, with what the bytes hold up to a quarter,
    from there to half, and from there to all of `length`."""
    ends = (0, length // 4, length // 2, length)

    def job(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for text_no, text, items in zip(*(batch.column(i).to_pylist() for i in range(3))):
                for block in items:
                    for at in range(block["first"], block["last"] + 1):
                        keys = [xxhash.xxh3_64_intdigest(text[at + a : at + b]) for a, b in zip(ends, ends[1:])]
                        rows.append((text_no, at, block["k1"], block["k2"], block["n"], *keys))
            cols = list(zip(*rows)) or [()] * 8
            yield pa.RecordBatch.from_arrays(
                [pa.array(cols[0], pa.int64()), pa.array(cols[1], pa.int32()), pa.array(cols[2], pa.int64()), pa.array(cols[3], pa.int64()), pa.array(cols[4], pa.int32()), *map(_signed, cols[5:])],
                names=["text_no", "first", "k1", "k2", "n", "next0", "next1", "next2"],
            )

    return _reading(plain, texts, blocks, job, "text_no long, first int, k1 long, k2 long, n int, next0 long, next1 long, next2 long")


def _doubled(rows: DataFrame, rank: list[str], following: str) -> DataFrame:
    """The rows whose pair of rank and following bytes occurs twice, ranked anew
    by the sorted order of such pairs."""
    spark, pair = rows.sparkSession, [*rank, following]
    pairs = rows.groupBy(*pair).agg(F.sum("n").alias("held")).where(F.col("held") > 1).select(*pair)
    ordered = pairs.repartitionByRange(*pair).sortWithinPartitions(*pair)
    # Rises through each sorted partition and from one to the next.
    ranks = stage(ordered.withColumn("next_rank", F.monotonically_increasing_id()), shared_dir(spark, "ranks"))
    joined = rows.join(ranks, pair).drop(*pair).withColumnRenamed("next_rank", "rank")
    return stage(joined, shared_dir(spark, "ranked"))


def _merged(lists: DataFrame, length: int) -> DataFrame:
    """Lists of places, merged to the stretches they cover."""

    def job(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [merged([(p["first"], p["last"]) for p in places], length) for places in batch.column(1).to_pylist()]
            lists = pa.array([[{"first": a, "last": b} for a, b in f] for f in found], pa.list_(pa.struct([("first", pa.int32()), ("last", pa.int32())])))
            yield pa.RecordBatch.from_arrays([batch.column(0), lists], names=["text_no", "list"])

    return in_arrow(lists, job, "text_no long, list array<struct<first:int,last:int>>")


def repeated_places(plain: DataFrame, texts: DataFrame, length: int) -> DataFrame:
    """(text_no, first, last): all positions whose `length` bytes occur elsewhere,
    but for those of texts that several rows hold."""
    runs = texts.select("text_no", F.least("rows", F.lit(2)).cast("int").alias("n"), F.inline(F.arrays_zip("first", "last", "offset", "gram", "around")))
    runs = runs.select("text_no", "n", "first", "last", "offset", F.col("gram").alias("k1"), "around")
    places = ["text_no", "first", "last"]
    by_run, open_runs = _kinds(runs, ["k1"], "around", (*places, "offset"))
    blocks = stage(_blocks(plain, texts, open_runs, length), shared_dir(plain.sparkSession, "blocks"))
    by_block, open_blocks = _kinds(blocks, ["k1", "k2"], "spanned", tuple(places))
    rows = stage(_positions(plain, texts, open_blocks, length), shared_dir(plain.sparkSession, "positions"))
    rows = _doubled(rows, ["k1", "k2"], "next0")
    rows = _doubled(rows, ["rank"], "next1")
    rows = _doubled(rows, ["rank"], "next2")
    by_position = rows.select("text_no", "first", F.col("first").alias("last"))
    single = texts.where(F.col("rows") == 1).select("text_no")
    found = by_run.select(*places).unionByName(by_block.select(*places)).unionByName(by_position)
    return found.join(single, "text_no", "left_semi")


def remove_repeats(
    docs: DataFrame, length: int = LENGTH, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Per row: doc_id, n_bytes, n_removed, n_spans, kept_sha256."""
    spark = docs.sparkSession
    text = F.coalesce(column(text_col).cast("string"), F.lit(""))
    keyed = docs.select(column(id_col).cast("long").alias("id"), text.alias("text"))
    plain = keyed.select("id", F.xxhash64("text").alias("t1"), F.xxhash64(F.lit(length), "text").alias("t2"), F.col("text").cast("binary").alias("bytes"))
    texts = _texts(plain, length)
    found = repeated_places(plain, texts, length)
    lists = found.groupBy("text_no").agg(F.collect_list(F.struct("first", "last")).alias("list"))
    whole = texts.where(F.col("rows") > 1).select("t1", "t2", F.array().cast("array<struct<first:int,last:int>>").alias("list"), F.lit(True).alias("all"))
    marked = _merged(lists, length).join(texts.select("text_no", "t1", "t2"), "text_no").select("t1", "t2", "list", F.lit(False).alias("all"))
    marked = stage(marked.unionByName(whole), shared_dir(spark, "marked"))

    def job(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, counts, results = [], [], []
            for text, places, whole in zip(*(batch.column(i).to_pylist() for i in range(1, 4))):
                stretches = [(0, len(text) - length)] if whole else [(p["first"], p["last"]) for p in places or ()]
                sizes.append(len(text))
                counts.append(len(stretches))
                results.append(kept_of(text, stretches, length))
            removed, digests = zip(*results) if results else ((), ())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(sizes, pa.int64()), pa.array(removed, pa.int64()), pa.array(counts, pa.int64()), pa.array(digests, pa.string())],
                names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"],
            )

    read = _with_lists(plain, marked, "left", ["t1", "t2"]).select("id", "bytes", "list", "all")
    return in_arrow(read, job, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string", rows=TEXTS_PER_BATCH)
