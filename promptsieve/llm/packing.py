"""Best-fit packing of token sequences by bin completion.

Documents are tokenised and, only where they are longer than a sequence, cut.
What has to be solved depends on the pieces' lengths alone, and there are no more
lengths than a sequence has tokens, so the plan is made on their histogram: a
table of fixed size however large the corpus is.  Best fit is the incumbent.  The
longest piece left is completed by each filling that is not dominated and wastes
no more than would still beat the incumbent, and the search goes back over earlier
fillings.  A lower bound on the sequences needed ends it, mostly at once; else it
ends after `STEPS`, with the best plan so far.

The plan gives each length ranges of ranks with their sequences.  A piece's rank
among those of its length is its number in the task that made it plus what the
tasks before it made, so that not even a corpus of equal lengths is counted in
one task.

Defined cases: a null text is empty and still gets the end id.  Repeated rows
are packed each.  Texts of any length are cut into pieces.  Pieces of equal length
are interchangeable; which of them goes where follows the input's partitions.
Other columns are not read.  An empty table needs no sequence.
"""

from __future__ import annotations

import zlib
from bisect import bisect_right
from collections import Counter
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from promptsieve.llm.texts import column, in_arrow
from promptsieve.llm.token_files import read_tokenizer
from promptsieve.llm.units import words
from promptsieve.session import shared_dir
from promptsieve.sources.sinks import stage

CAPACITY = 2048
# Nodes of the search for one filling; after that its best so far is used.
NODES = 4000
# Steps of the search for a plan.
STEPS = 40_000

_PIECE = "part int, nth long, doc_id long, piece int, start long, length long, ids_crc32 long"


# --- The plan ----------------------------------------------------------------------


class _Lengths:
    """Counts of the lengths that are left, and which they are, in order."""

    def __init__(self, counts: dict[int, int]):
        self.counts = {k: int(n) for k, n in counts.items() if n}
        self.order = sorted(self.counts)

    def take(self, length: int, n: int) -> None:
        self.counts[length] -= n
        if not self.counts[length]:
            del self.counts[length]
            self.order.remove(length)

    def longest_up_to(self, room: int) -> int:
        """Place in the order of the longest length of at most `room`, or -1."""
        return bisect_right(self.order, room) - 1


def best_fit(left: _Lengths, room: int) -> list[int]:
    """The longest piece that fits, again and again."""
    filling, used = [], Counter()
    place = left.longest_up_to(room)
    while place >= 0:
        length = left.order[place]
        n = min(room // length, left.counts[length] - used[length])
        filling += [length] * n
        used[length] += n
        room -= n * length
        place = min(place - 1, left.longest_up_to(room))
    return filling


def complete(left: _Lengths, room: int, nodes: int = NODES) -> list[int]:
    """The filling of `room` that wastes least, longest pieces first.

    Fillings are enumerated by falling lengths; the search ends with one that
    wastes nothing, or after `nodes`.
    """
    best = best_fit(left, room)
    waste = room - sum(best)

    def descend(place: int, free: int, chosen: list[int]) -> None:
        nonlocal best, waste, nodes
        if free < waste:
            best, waste = chosen, free
        place = min(place, left.longest_up_to(free))
        while place >= 0 and waste and nodes > 0:
            length = left.order[place]
            for n in range(min(free // length, left.counts[length]), 0, -1):
                nodes -= 1
                descend(place - 1, free - n * length, chosen + [length] * n)
                if not waste or nodes <= 0:
                    return
            place -= 1

    descend(len(left.order) - 1, room, [])
    return best


def _packed(counts: dict[int, int], capacity: int, fill) -> list[tuple[list[int], int]]:
    """(filling, how often) for all pieces, the longest one left first."""
    left, packed = _Lengths(counts), []
    while left.order:
        longest = left.order[-1]
        left.take(longest, 1)
        pattern = [longest, *fill(left, capacity - longest)]
        needs = Counter(pattern)
        for length in pattern[1:]:
            left.take(length, 1)
        more = min(left.counts.get(length, 0) // n for length, n in needs.items())
        for length, n in needs.items() if more else ():
            left.take(length, n * more)
        packed.append((pattern, 1 + more))
    return packed


def lower_bound(counts: dict[int, int], capacity: int) -> int:
    """Sequences that any packing needs.  For each length k: pieces over
    capacity - k stay without one of k or more; those over half a sequence need
    one each, and what of the shorter ones does not fit beside them needs more."""
    lengths = np.array(sorted(k for k, n in counts.items() if n), dtype=np.int64)
    if not len(lengths):
        return 0
    numbers = np.array([counts[int(k)] for k in lengths], dtype=np.int64)
    n_before = np.concatenate([[0], np.cumsum(numbers)])
    sum_before = np.concatenate([[0], np.cumsum(numbers * lengths)])
    least = np.concatenate([[0], lengths[lengths <= capacity // 2]])
    half = np.searchsorted(lengths, capacity // 2, side="right")
    alone = np.searchsorted(lengths, capacity - least, side="right")
    small = np.searchsorted(lengths, least)
    beside = n_before[alone] - n_before[half]
    room = beside * capacity - (sum_before[alone] - sum_before[half])
    over = np.maximum(sum_before[half] - sum_before[small] - room, 0)
    return int((n_before[-1] - n_before[alone] + beside + -(-over // capacity)).max())


def _dominated(left: _Lengths, filling: Counter, free: int) -> bool:
    """Whether a longer piece that is left would fit in place of none, one or two
    of the filling's pieces.  Exchanged, any packing stays one."""

    def spare(shortest: int, longest: int) -> bool:
        place = left.longest_up_to(longest)
        while place >= 0 and left.order[place] >= shortest:
            if left.counts[left.order[place]] > filling[left.order[place]]:
                return True
            place -= 1
        return False

    if spare(1, free):
        return True
    held = sorted(filling)
    if free and any(spare(x + 1, x + free) for x in held):
        return True
    pairs = ((x, y) for i, x in enumerate(held) for y in held[i:] if x < y or filling[x] > 1)
    return any(spare(x + y, x + y + free) for x, y in pairs)


def fillings(left: _Lengths, room: int, waste: int) -> Iterator[list[int] | None]:
    """Undominated fillings of `room` that leave at most `waste` of it, and None
    for every step without one, so that the caller can count them.

    Lengths fall along a filling; a branch ends where all shorter pieces together
    would leave too much.
    """
    order = left.order
    below = [0]  # what the pieces up to a place come to
    for length in order:
        below.append(below[-1] + length * left.counts[length])
    stack = [(left.longest_up_to(room), room, ())]
    while stack:
        place, free, chosen = stack.pop()
        place = min(place, left.longest_up_to(free))
        if place < 0:
            filling = Counter(dict(chosen))
            found = free <= waste and not _dominated(left, filling, free)
            yield list(filling.elements()) if found else None
            continue
        yield None
        if free - below[place + 1] > waste:
            continue
        length = order[place]
        for n in range(min(free // length, left.counts[length]) + 1):  # the most of it is taken first
            stack.append((place - 1, free - n * length, (*chosen, (length, n)) if n else chosen))


def search(counts: dict[int, int], capacity: int, incumbent: list[tuple[list[int], int]], steps: int) -> list[tuple[list[int], int]]:
    """The best plan found by bin completion within `steps`, or the incumbent.

    A sequence is filled round the longest piece left, with the least wasteful
    filling first and then with every other undominated one; a filling is used as
    often as the lengths left allow, and then once.  To beat the incumbent, all
    sequences together may waste no more than what one sequence less has over the
    pieces' sum: that bounds each filling.  A set of lengths left that was met
    before is not gone through again: what was spent on it is the same.
    """
    total = sum(k * n for k, n in counts.items())
    best, used_by_best = incumbent, sum(n for _, n in incumbent)
    bound, seen = lower_bound(counts, capacity), set()

    def branches(now: dict[int, int], used: int) -> Iterator[tuple[list[int], int] | None]:
        wasted = used * capacity - (total - sum(k * n for k, n in now.items()))
        left = _Lengths(now)
        longest = left.order[-1]
        left.take(longest, 1)
        room = capacity - longest
        first = sorted(complete(left, room))
        allowed = (used_by_best - 1) * capacity - total - wasted
        for filling in chain([first], fillings(left, room, allowed)):
            if filling is None or (filling is not first and sorted(filling) == first):
                yield None
                continue
            if room - sum(filling) > (used_by_best - 1) * capacity - total - wasted:
                yield None
                continue
            pattern = [longest, *sorted(filling, reverse=True)]
            needs = Counter(pattern)
            times = min(now[length] // n for length, n in needs.items())
            yield pattern, times
            if times > 1:
                yield pattern, 1

    stack = [(dict(counts), 0, branches(counts, 0))]
    path: list[tuple[list[int], int]] = []
    while stack and steps > 0 and used_by_best > bound:
        now, used, options = stack[-1]
        steps -= 1
        choice = next(options, False)
        if choice is False:
            stack.pop()
            if path:
                path.pop()
            continue
        if choice is None:
            continue
        pattern, times = choice
        needs = Counter(pattern)
        then = {k: n - times * needs[k] for k, n in now.items() if n > times * needs[k]}
        if not then:
            if used + times < used_by_best:
                best, used_by_best = [*path, choice], used + times
            continue
        key = frozenset(then.items())
        if key in seen or used + times + lower_bound(then, capacity) >= used_by_best:
            continue
        seen.add(key)
        path.append(choice)
        stack.append((then, used + times, branches(then, used + times)))
    return best


def plan(counts: dict[int, int], capacity: int = CAPACITY, nodes: int = NODES, steps: int = STEPS) -> list[tuple[list[int], int]]:
    """Fillings and their numbers.  Best fit is the first incumbent, completion
    without second thoughts the next, and the search goes on from the better one;
    it ends at once where the lower bound is met."""
    counts = {int(k): int(n) for k, n in counts.items() if n}
    bound = lower_bound(counts, capacity)
    number = lambda p: sum(n for _, n in p)
    best = _packed(counts, capacity, best_fit)
    if number(best) > bound:
        best = min(_packed(counts, capacity, lambda left, room: complete(left, room, nodes)), best, key=number)
    return search(counts, capacity, best, steps) if number(best) > bound else best


def ranges(planned: list[tuple[list[int], int]]) -> np.ndarray:
    """Columns length, first rank, pieces per sequence, first sequence, place
    of the first piece; in order of length and rank."""
    rows, ranks, sequence = [], Counter(), 0
    for pattern, times in planned:
        place = 0
        for length in sorted(set(pattern), reverse=True):
            per = pattern.count(length)
            rows.append((length, ranks[length], per, sequence, place))
            ranks[length] += per * times
            place += per * length
        sequence += times
    return np.array(sorted(rows), dtype=np.int64).reshape(-1, 5)


# --- The pieces --------------------------------------------------------------------


def pieces(docs: DataFrame, tokenizer_path: str, end_id: int, capacity: int = CAPACITY, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Every document's pieces, numbered per task and length."""
    shared = docs.sparkSession.sparkContext.broadcast(read_tokenizer(tokenizer_path))
    end = np.array([end_id], dtype="<u4").tobytes()

    def job(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, part, numbers = words(shared.value), TaskContext.get().partitionId(), Counter()
        for batch in batches:
            rows: list[tuple] = []
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).cast(pa.binary()).to_pylist()):
                ids = known.encode(text) + end
                total = len(ids) // 4
                for n, start in enumerate(range(0, total, capacity)):
                    length = min(capacity, total - start)
                    rows.append((numbers[length], doc_id, n, start, length, zlib.crc32(ids[4 * start : 4 * (start + length)])))
                    numbers[length] += 1
            if rows:
                nth, doc_ids, places, starts, lengths, crcs = zip(*rows)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([part] * len(rows), pa.int32()), pa.array(nth, pa.int64()), pa.array(doc_ids, pa.int64()),
                        pa.array(places, pa.int32()), pa.array(starts, pa.int64()), pa.array(lengths, pa.int64()), pa.array(crcs, pa.int64()),
                    ],
                    names=["part", "nth", "doc_id", "piece", "start", "length", "ids_crc32"],
                )

    return in_arrow(docs.select(column(id_col).cast("long"), column(text_col)), job, _PIECE)


def pack(
    docs: DataFrame, tokenizer_path: str, end_id: int, capacity: int = CAPACITY, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset."""
    spark = docs.sparkSession
    cut = stage(pieces(docs, tokenizer_path, end_id, capacity, id_col, text_col), shared_dir(spark, "pieces"))
    per_part = stage(cut.groupBy("part", "length").agg(F.count("*").alias("n")), shared_dir(spark, "lengths"))
    histogram = per_part.groupBy("length").agg(F.sum("n").alias("n")).collect()  # at most `capacity` rows
    places = ranges(plan({r.length: r.n for r in histogram}, capacity))
    shared = spark.sparkContext.broadcast(places)

    before = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = per_part.select("part", "length", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("earlier"))
    ranked = cut.join(offsets, ["part", "length"]).select(
        "doc_id", "piece", "start", "length", "ids_crc32", (F.col("nth") + F.col("earlier")).alias("rank")
    )

    def job(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = shared.value
        bound = int(table[:, 1].max(initial=0)) + 1
        keys = table[:, 0].astype(np.float64) if not len(table) else table[:, 0] * bound + table[:, 1]
        for batch in batches:
            if not batch.num_rows:
                continue
            length, rank = (batch.column(i).to_numpy() for i in (3, 5))
            row = table[np.searchsorted(keys, length * bound + np.minimum(rank, bound - 1), side="right") - 1]
            bin_, slot = np.divmod(rank - row[:, 1], row[:, 2])
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:5], pa.array(row[:, 3] + bin_), pa.array(row[:, 4] + slot * length)],
                names=["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"],
            )

    schema = "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long"
    return in_arrow(ranked, job, schema, rows=10_000)
