"""Near-duplicates by a Jaccard join on word n-grams with adaptive prefixes.

A document's set holds its distinct n-word shingles; a shorter document has its
whole sequence as the only one, and one without words an empty set that is
linked with nothing.  Two sets are linked when `den * intersection >= num *
union`.  The join is exact, and no two documents are compared that need not be:

* Equal sets are one class from the start.
* Shingles have one order for all documents: by how many documents hold them, as
  a table of hashed counts over all documents says, and then by hash.  If two
  sets are linked, any prefixes of theirs that leave out no more than the
  overlap allows, less `l - 1`, share `l` shingles.  Each document picks the `l`
  for which the expected number of candidates costs least: common shingles in
  the prefix make it longer and ask for more matches.  A pair must share as many
  prefix shingles as the lower of its two `l`.
* Only sets whose sizes allow a link can meet, by buckets of the size.
* First, for some turns, each class of a posting list is compared with one
  leader per bucket only, and verified links make components.  Then the pairs
  that are left are those of different components: near copies that leaders have
  linked do not meet in all pairs, and no link between components is lost.
* Sets that meet at a shingle are a candidate only if their sizes, the places of
  the shingle in both and their parities leave room for a link.  Of what comes
  before the shingle, only entries that some other prefix holds too can be shared:
  prefixes that both reach the shingle hold all that comes before it.  Across
  components only the first `l` shared shingles of a pair have to meet, and fewer than
  `l` come before those, so that a set's later entries meet almost nothing.  A leader
  leads only some of the lists it shares, so that there all of them count.  Parities say
  for each of `PARITIES` bins whether an odd number of a set's shingles fall in it;
  two sets differ in at least as many shingles as they have unequal parities.  Both
  are exact, and part of the join's condition, so that texts just below the
  threshold do not become rows.

Verification reads the texts of the candidates again; sets are never stored.
Shingles and sets are known by 64-bit hashes of whole words in order.

Defined cases: null texts and texts of white space have n_shingles 0 and their
own id as component; a null id is in no minimum, and a component of null ids
only has a null component_id.  Repeated rows are kept, each with its result.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from promptsieve.llm.texts import column, in_arrow
from promptsieve.session import shared_dir
from promptsieve.sources.sinks import stage

# Most matches that are asked for, and how a match more thins out candidates.
MOST_MATCHES = 4
THINNING = 8.0
# What verifying a candidate costs, in posting entries read.
VERIFY_COST = 20.0
# The table of counts has a place for every so many shingles, between these.
SHINGLES_PER_PLACE = 16
PLACES = (1 << 16, 1 << 24)
CHUNKS = 64
# How often classes are compared with leaders before all pairs that are left.
LEADER_TURNS = 3
# Keys that are broadcast at most; more are joined by a shuffle.
BROADCAST_KEYS = 1_000_000
# Bins of a set's parities, a multiple of 64.
PARITIES = 512
# Rows of a batch, by what a row holds: a text, or two sets.
TEXTS_PER_BATCH, PAIRS_PER_BATCH = 128, 32

_MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)
_FINAL = np.uint64(0xBF58476D1CE4E5B9)


# --- Sets --------------------------------------------------------------------------


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(31))) * _FINAL
    return h ^ (h >> np.uint64(29))


def shingle_set(text: bytes | None, n: int) -> np.ndarray:
    """The sorted hashes of a text's distinct shingles."""
    # Bytes are lower-cased and split as ASCII, which is what is asked for.
    words = text.lower().split() if text else []
    if not words:
        return np.zeros(0, dtype=np.uint64)
    hashed = np.fromiter(map(xxhash.xxh3_64_intdigest, words), dtype=np.uint64, count=len(words))
    width = min(n, len(words))
    total = np.full(len(words) - width + 1, width, dtype=np.uint64)
    for i in range(width):
        total = total * _MULTIPLIER + hashed[i : i + len(total)]
    return np.unique(_mixed(total))


def _set_key(shingles: np.ndarray) -> int:
    return xxhash.xxh3_64_intdigest(shingles.tobytes()) - (1 << 63)


def parities(shingles: np.ndarray) -> np.ndarray:
    """Whether an odd number of shingles fall in each bin, as 64-bit words."""
    odd = np.bincount((shingles & np.uint64(PARITIES - 1)).astype(np.int64), minlength=PARITIES) & 1
    return np.packbits(odd.astype(np.uint8)).view(np.int64)


PARITY_WORDS = tuple(f"p{i}" for i in range(PARITIES // 64))


def least_overlap(size: int, num: int, den: int) -> int:
    """What a set of this size shares at least with any set it is linked with."""
    return -(-num * size // den)


# --- The order of shingles -----------------------------------------------------------


def count_table(docs: DataFrame, n: int) -> np.ndarray:
    """How many documents hold the shingles of each place of a hashed table, up
    to 65,535.  Tasks add up what they read; chunks of places are then added."""
    spark = docs.sparkSession
    # An estimate of the words is enough to choose the size.
    words = (docs.agg(F.sum(F.length("text"))).first()[0] or 0) / 6
    places = 1 << int(np.clip(math.ceil(math.log2(words / SHINGLES_PER_PLACE + 1)), *(int(math.log2(p)) for p in PLACES)))
    shift, width = np.uint64(64 - int(math.log2(places))), places // CHUNKS

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(places, dtype=np.uint16)
        for batch in batches:
            sets = [shingle_set(t, n) for t in batch.column(0).cast(pa.binary()).to_pylist()]
            place, times = np.unique(np.concatenate([np.zeros(0, dtype=np.uint64), *sets]) >> shift, return_counts=True)
            place = place.astype(np.int64)
            total[place] = np.minimum(total[place] + times, 65535)
        pack = zstandard.ZstdCompressor(level=1).compress
        yield pa.RecordBatch.from_arrays(
            [pa.array(range(CHUNKS), pa.int32()), pa.array([pack(total[c * width : (c + 1) * width].tobytes()) for c in range(CHUNKS)], pa.binary())],
            names=["chunk", "counts"],
        )

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals: dict[int, np.ndarray] = {}
        for batch in batches:
            for chunk, counts in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                more = np.frombuffer(zstandard.ZstdDecompressor().decompress(counts), dtype=np.uint16).astype(np.int64)
                totals[chunk] = totals.get(chunk, 0) + more
        kept = {c: np.minimum(t, 65535).astype(np.uint16).tobytes() for c, t in totals.items()}
        yield pa.RecordBatch.from_arrays([pa.array(list(kept), pa.int32()), pa.array(list(kept.values()), pa.binary())], names=["chunk", "counts"])

    schema = "chunk int, counts binary"
    parts = in_arrow(docs.select("text"), count, schema, rows=TEXTS_PER_BATCH).repartition(CHUNKS, "chunk")
    table = np.zeros(places, dtype=np.uint16)
    for row in in_arrow(parts, add, schema, rows=64).collect():  # 2 bytes a place
        table[row.chunk * width : (row.chunk + 1) * width] = np.frombuffer(row.counts, dtype=np.uint16)
    return table


def chosen_prefix(shingles: np.ndarray, counts: np.ndarray, noise: float, num: int, den: int) -> tuple[int, np.ndarray]:
    """(matches asked for, the prefix that warrants them)."""
    size = len(shingles)
    base = size - least_overlap(size, num, den)
    order = np.lexsort((shingles, counts))
    others = np.cumsum(np.maximum(counts[order[: base + MOST_MATCHES]] - noise - 1, 0.0))
    most = min(MOST_MATCHES, size - base)
    expected = others[base]
    costs = [others[base + matches - 1] + VERIFY_COST * expected / THINNING ** (matches - 1) for matches in range(1, most + 1)]
    matches = 1 + int(np.argmin(costs))
    return matches, shingles[order[: base + matches]]


def _sets(docs: DataFrame, table: np.ndarray, n: int, num: int, den: int) -> DataFrame:
    """Per row: id, text_key, size, set_key, matches, prefix and parities."""
    shared = docs.sparkSession.sparkContext.broadcast(table)
    shift, noise = np.uint64(64 - int(math.log2(len(table)))), float(np.median(table))

    def job(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = shared.value
        for batch in batches:
            sizes, keys, matches, prefixes, odd = [], [], [], [], []
            for text in batch.column(2).cast(pa.binary()).to_pylist():
                shingles = shingle_set(text, n)
                sizes.append(len(shingles))
                keys.append(_set_key(shingles))
                odd.append(parities(shingles))
                found, prefix = chosen_prefix(shingles, counts[shingles >> shift].astype(np.float64), noise, num, den) if len(shingles) else (0, shingles)
                matches.append(found)
                prefixes.append(prefix.view(np.int64))
            offsets = np.concatenate([[0], np.cumsum([len(p) for p in prefixes])]).astype(np.int32)
            flat = np.concatenate([np.zeros(0, dtype=np.int64), *prefixes])
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0), batch.column(1), pa.array(sizes, pa.int64()), pa.array(keys, pa.int64()), pa.array(matches, pa.int32()),
                    pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat)),
                    *(pa.array([words[i] for words in odd], pa.int64()) for i in range(len(PARITY_WORDS))),
                ],
                names=["id", "text_key", "size", "set_key", "matches", "prefix", *PARITY_WORDS],
            )

    return in_arrow(
        docs.select("id", "text_key", "text"), job,
        "id long, text_key long, size long, set_key long, matches int, prefix array<long>, " + ", ".join(f"{p} long" for p in PARITY_WORDS),
        rows=TEXTS_PER_BATCH,
    )


# --- Links -------------------------------------------------------------------------


def verified(docs: DataFrame, classes: DataFrame, pairs: DataFrame, n: int, num: int, den: int) -> DataFrame:
    """The candidate pairs (a, b) with `linked`."""
    spark = docs.sparkSession
    keys = pairs.select(F.col("a").alias("set_key")).union(pairs.select("b")).distinct()
    needed = stage(classes.join(keys, "set_key").select("set_key", "place"), shared_dir(spark, "needed"))
    wanted = needed.select(F.col("place.text_key").alias("text_key"), F.col("place.id").alias("wanted_id"))
    if wanted.count() <= BROADCAST_KEYS:
        wanted = F.broadcast(wanted)
    read = docs.alias("d").join(
        wanted.alias("w"), (F.col("d.text_key") == F.col("w.text_key")) & F.col("d.id").eqNullSafe(F.col("w.wanted_id")), "left_semi"
    )

    def shingle(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = [shingle_set(t, n) for t in batch.column(0).cast(pa.binary()).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [pa.array([_set_key(s) for s in sets], pa.int64()), pa.array([s.tobytes() for s in sets], pa.binary())], names=["set_key", "shingles"]
            )

    # Of rows with one text and no id several may come.
    sets = in_arrow(read.select("text"), shingle, "set_key long, shingles binary", rows=TEXTS_PER_BATCH).groupBy("set_key").agg(F.first("shingles").alias("shingles"))
    sets = stage(sets, shared_dir(spark, "sets"))
    met = pairs.join(sets.select(F.col("set_key").alias("a"), F.col("shingles").alias("a_set")), "a").join(
        sets.select(F.col("set_key").alias("b"), F.col("shingles").alias("b_set")), "b"
    )

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            linked = []
            for one, other in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist()):
                one, other = np.frombuffer(one, dtype=np.uint64), np.frombuffer(other, dtype=np.uint64)
                if len(one) > len(other):
                    one, other = other, one
                at = np.searchsorted(other, one)
                shared = int((other[np.minimum(at, len(other) - 1)] == one).sum())
                linked.append(den * shared >= num * (len(one) + len(other) - shared))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(linked, pa.bool_())], names=["a", "b", "linked"])

    return in_arrow(met.select("a", "b", "a_set", "b_set"), compare, "a long, b long, linked boolean", rows=PAIRS_PER_BATCH)


def components(links: DataFrame) -> DataFrame:
    """(node, root) for the ends of links (a, b): smallest labels spread along
    links, and labels of labels shorten the way, until nothing changes."""
    spark = links.sparkSession
    both = stage(links.select("a", "b").union(links.select("b", "a")).distinct(), shared_dir(spark, "links"))
    labels = stage(both.groupBy(F.col("a").alias("node")).agg(F.least(F.min("b"), F.col("node")).alias("root")), shared_dir(spark, "labels"))
    while True:
        near = both.join(labels.select(F.col("node").alias("b"), "root"), "b").groupBy(F.col("a").alias("node")).agg(F.min("root").alias("seen"))
        spread = labels.join(near, "node").select("node", "root", F.least("root", "seen").alias("found"))
        spread = stage(spread, shared_dir(spark, "spread"))
        onward = spread.select(F.col("node").alias("found"), F.col("found").alias("onward"))
        moved = spread.join(onward, "found").select("node", "root", F.least("found", "onward").alias("new"))
        moved = stage(moved, shared_dir(spark, "labels"))
        labels = moved.select("node", F.col("new").alias("root"))
        if moved.where(F.col("root") != F.col("new")).isEmpty():
            return labels


def _labelled(postings: DataFrame, labels: DataFrame) -> DataFrame:
    """Postings with the component of their class."""
    rooted = postings.drop("root").join(labels.withColumnRenamed("node", "set_key"), "set_key", "left")
    return stage(rooted.withColumn("root", F.coalesce("root", "set_key")), shared_dir(postings.sparkSession, "labelled"))


# What is known of a class wherever it is met.
ENTRY = ("set_key", "root", "size", "pos", "live", "matches", *PARITY_WORDS)


def _may_link(x: str, y: str, num: int, den: int, first_only: bool = False) -> Column:
    """Whether sets that meet at a shingle can be linked by their sizes, by what
    comes before and after it in their order, and by their parities.  A linked
    pair passes at each shingle it shares; with `first_only` at the first ones, as
    many as have to match: no more than that less one are shared before them."""
    x_size, y_size = F.col(f"{x}.size"), F.col(f"{y}.size")
    sizes = den * F.least(x_size, y_size) >= num * F.greatest(x_size, y_size)
    before = F.least(f"{x}.live", f"{y}.live", *([F.col(f"{e}.matches") - 1 for e in (x, y)] if first_only else []))
    most = before + F.least(x_size - F.col(f"{x}.pos"), y_size - F.col(f"{y}.pos"))
    unequal = sum(F.bit_count(F.col(f"{x}.{p}").bitwiseXOR(F.col(f"{y}.{p}"))) for p in PARITY_WORDS)
    return sizes & ((num + den) * most >= num * (x_size + y_size)) & ((num + den) * unequal <= (den - num) * (x_size + y_size))


def _pairs_with_leaders(postings: DataFrame, turn: int, num: int, den: int) -> DataFrame:
    """Candidates (a, b), a below b: each class with the leader of its lists, if
    that is of another component.  Every turn has other leaders; a component
    leads the more lists the larger it is."""
    rank = F.struct(F.xxhash64("set_key", F.lit(turn)).alias("rank"), *ENTRY)
    leaders = postings.groupBy("shingle", "bucket").agg(F.min(rank).alias("y"), F.min("root").alias("low"), F.max("root").alias("high"))
    leaders = leaders.where(F.col("low") != F.col("high")).select("shingle", "bucket", "y")
    each = postings.select("shingle", "bucket", F.struct(*ENTRY).alias("x"))
    met = each.join(leaders, ["shingle", "bucket"]).where((F.col("x.root") != F.col("y.root")) & _may_link("x", "y", num, den))
    x, y = F.col("x.set_key"), F.col("y.set_key")
    counted = met.groupBy(F.least(x, y).alias("a"), F.greatest(x, y).alias("b")).agg(F.count("*").alias("n"), F.min("x.matches").alias("matches"))
    # Whether the leader asks for fewer is not looked up: what is left out here
    # is met again among the pairs of different components.
    return counted.where(F.col("n") >= F.col("matches")).select("a", "b")


def _pairs_across(labelled: DataFrame, num: int, den: int) -> DataFrame:
    """Candidates (a, b) in different components, a below b."""
    mixed = labelled.groupBy("shingle").agg(F.min("root").alias("low"), F.max("root").alias("high")).where(F.col("low") != F.col("high"))
    left = labelled.join(mixed.select("shingle"), "shingle", "left_semi")
    entry = F.struct(*ENTRY)
    one = left.select("shingle", "bucket", entry.alias("x"))
    near = F.explode(F.array(F.struct("bucket", F.lit(True).alias("same")), F.struct((F.col("bucket") + 1).alias("bucket"), F.lit(False).alias("same"))))
    other = left.select("shingle", near.alias("at"), entry.alias("y")).select("shingle", "at.bucket", "at.same", "y")
    met = one.join(other, ["shingle", "bucket"]).where(
        (F.col("x.root") != F.col("y.root")) & (~F.col("same") | (F.col("x.set_key") < F.col("y.set_key"))) & _may_link("x", "y", num, den, first_only=True)
    )
    x, y = F.col("x.set_key"), F.col("y.set_key")
    counted = met.groupBy(F.least(x, y).alias("a"), F.greatest(x, y).alias("b")).agg(
        F.count("*").alias("n"), F.first(F.least("x.matches", "y.matches")).alias("matches")
    )
    return counted.where(F.col("n") >= F.col("matches")).select("a", "b")


def near_duplicates(
    docs: DataFrame, n: int = 5, num: int = 80, den: int = 100, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Per row: doc_id, n_shingles and component_id."""
    rows, labels, smallest = _linked(docs, n, num, den, id_col, text_col)
    rooted = rows.select("id", "size", "set_key").join(labels.withColumnRenamed("node", "set_key"), "set_key", "left")
    named = rooted.withColumn("root", F.coalesce("root", "set_key")).join(smallest, "root", "left")
    return named.select(
        F.col("id").alias("doc_id"), F.col("size").alias("n_shingles"), F.when(F.col("size") > 0, F.col("smallest")).otherwise(F.col("id")).alias("component_id")
    )


def _linked(docs: DataFrame, n: int, num: int, den: int, id_col: str, text_col: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(rows with their sets, labels of linked classes, smallest id per root)."""
    spark = docs.sparkSession
    plain = docs.select(column(id_col).cast("long").alias("id"), column(text_col).alias("text"), F.xxhash64(column(text_col)).alias("text_key"))
    rows = stage(_sets(plain, count_table(plain, n), n, num, den), shared_dir(spark, "rows"))
    place = F.struct(F.col("id").isNull().alias("last"), "id", "text_key")
    classes = stage(
        rows.where(F.col("size") > 0).groupBy("set_key").agg(
            F.min(place).alias("place"), F.first("size").alias("size"), F.first("matches").alias("matches"), F.first("prefix").alias("prefix"),
            *(F.first(p).alias(p) for p in PARITY_WORDS),
        ),
        shared_dir(spark, "classes"),
    )
    bucket = F.floor(F.log(F.col("size").cast("double")) / math.log(den / num) + 1e-9).cast("int") if num < den else F.col("size").cast("int")
    entries = classes.select("set_key", F.posexplode("prefix").alias("pos", "shingle"))
    # Most shingles are in one prefix only and go before anything is joined.
    common = entries.groupBy("shingle").agg(F.count("*").alias("holders")).where(F.col("holders") > 1).select("shingle")
    facts = classes.select("set_key", F.col("set_key").alias("root"), "size", "matches", bucket.alias("bucket"), *PARITY_WORDS)
    left = entries.join(common, "shingle", "left_semi").join(facts, "set_key")
    # How many entries before this one are left in its own prefix.
    live = F.row_number().over(Window.partitionBy("set_key").orderBy("pos")) - 1
    postings = stage(left.withColumn("live", live), shared_dir(spark, "postings"))

    compared = links = labels = None
    labelled = postings
    for turn in range(LEADER_TURNS + 1):
        pairs = _pairs_with_leaders(labelled, turn, num, den) if turn < LEADER_TURNS else _pairs_across(labelled, num, den)
        if compared is not None:
            pairs = pairs.join(compared, ["a", "b"], "left_anti")
        pairs = stage(pairs, shared_dir(spark, "pairs"))
        found = stage(verified(plain, classes, pairs, n, num, den), shared_dir(spark, "verified"))
        more = found.where("linked").select("a", "b")
        links = more if links is None else links.union(more)
        compared = found.select("a", "b") if compared is None else compared.union(found.select("a", "b"))
        if labels is None or not more.isEmpty():
            labels = components(links)
            if turn < LEADER_TURNS:
                labelled = _labelled(postings, labels)
    roots = classes.join(labels.withColumnRenamed("node", "set_key"), "set_key", "left")
    smallest = roots.groupBy(F.coalesce("root", "set_key").alias("root")).agg(F.min("place.id").alias("smallest"))
    return rows, labels, smallest


def keep_one(docs: DataFrame, n: int = 5, num: int = 80, den: int = 100, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of `docs` with the smallest id of their group, all columns.

    Rows without words have no group and stay.  Of several rows with the kept id
    and equal sets one stays.
    """
    spark = docs.sparkSession
    rows, labels, smallest = _linked(docs, n, num, den, id_col, text_col)
    named = (
        rows.where(F.col("size") > 0).select("id", "text_key", "set_key")
        .join(labels.withColumnRenamed("node", "set_key"), "set_key", "left")
        .withColumn("root", F.coalesce("root", "set_key"))
        .join(smallest, "root", "left")
    )
    rows_of = named.groupBy("root", "id", "text_key").agg(F.count("*").alias("times"))
    firsts = rows_of.groupBy("root").agg(F.min(F.struct(F.col("id").isNull().alias("last"), "id", "text_key")).alias("first"))
    met = rows_of.join(firsts, "root").withColumn(
        "stays", (F.col("first.text_key") == F.col("text_key")) & F.col("first.id").eqNullSafe(F.col("id"))
    )
    # Rows that go, and rows that stay but repeat each other.
    marks = stage(
        met.where(~F.col("stays") | (F.col("times") > 1)).select(F.col("id").alias("marked_id"), F.col("text_key").alias("marked_key"), "stays"),
        shared_dir(spark, "marks"),
    )
    if marks.count() <= BROADCAST_KEYS:
        marks = F.broadcast(marks)
    keyed = docs.select(
        F.struct(*(column(c) for c in docs.columns)).alias("document"), column(id_col).cast("long").alias("id"), F.xxhash64(column(text_col)).alias("key")
    )
    marked = keyed.join(marks, (F.col("key") == F.col("marked_key")) & F.col("id").eqNullSafe(F.col("marked_id")), "left")
    repeated = marked.where("stays").groupBy("id", "key").agg(F.first("document").alias("document"))
    return marked.where(F.col("stays").isNull()).select("document.*").unionByName(repeated.select("document.*"))
