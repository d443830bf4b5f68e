"""Packings: every piece once, nothing over, and as few sequences as can be."""

import random
import zlib
from collections import Counter, defaultdict

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from promptsieve.llm import packing
from promptsieve.llm.queries import WORD_TOKENIZER, vocabulary

PATH = vocabulary(WORD_TOKENIZER)
TOKENIZER = Tokenizer.from_file(PATH)


@settings(max_examples=80, deadline=None)
@given(st.dictionaries(st.integers(1, 100), st.integers(1, 40), max_size=25))
def test_plan_places_every_piece(counts):
    plan, placed = packing.plan(counts, 100), Counter()
    for pattern, times in plan:
        assert sum(pattern) <= 100
        for length in pattern:
            placed[length] += times
    assert placed == Counter(counts)
    best_fit = sum(n for _, n in packing._packed(counts, 100, packing.best_fit))
    used = sum(n for _, n in plan)
    assert -(-sum(k * n for k, n in counts.items()) // 100) <= used <= best_fit
    table = packing.ranges(plan)
    for length, n in counts.items():
        mine = table[table[:, 0] == length]
        assert mine[0, 1] == 0 and mine[-1, 1] < n


def test_completion_beats_best_fit():
    counts = {60: 1, 50: 1, 30: 1, 25: 2, 10: 1}
    assert sum(n for _, n in packing.plan(counts, 100)) == 2
    assert packing.complete(packing._Lengths({50: 1, 30: 2, 25: 1}), 60) == [30, 30]
    # Short pieces only, and a room they cannot fill.
    assert sum(packing.complete(packing._Lengths({2: 5000}), 2047)) == 2046


def fewest(lengths, capacity):
    """By going through all subsets: the fewest sequences, and the least in the last."""
    best = [(0, capacity)] + [(len(lengths) + 1, 0)] * ((1 << len(lengths)) - 1)
    for held, (used, last) in enumerate(best):
        for i, length in enumerate(lengths):
            if not held >> i & 1:
                after = (used, last + length) if last + length <= capacity else (used + 1, length)
                best[held | 1 << i] = min(best[held | 1 << i], after)
    return best[-1][0]


def number(planned):
    return sum(n for _, n in planned)


def test_search_goes_back_over_earlier_fillings():
    counts = Counter([55, 50, 44, 38, 36, 27, 17, 15, 13])
    assert number(packing.plan(counts, 100)) == 3
    assert number(packing._packed(counts, 100, packing.best_fit)) == 4


def test_search_finds_the_fewest():
    rng = random.Random(5)
    for n in range(300):
        lengths = [rng.randint(5, 70) for _ in range(rng.randint(1, 11))]
        if n % 3 == 0:
            lengths = [rng.choice(lengths[:3]) for _ in lengths]
        best, bound = fewest(lengths, 100), packing.lower_bound(Counter(lengths), 100)
        assert bound <= best == number(packing.plan(Counter(lengths), 100)), lengths


def test_fillings_left_out_are_dominated():
    """A longer piece left over that fits in place of one or two, or beside all."""
    found = [sorted(f) for f in packing.fillings(packing._Lengths({50: 1, 30: 2, 10: 1, 9: 1}), 60, 60) if f]
    assert [10, 50] in found and [30, 30] in found
    assert [9, 50] not in found and [50] not in found and [10, 30] not in found
    with_one_for_all = packing._Lengths({60: 1, 50: 1, 30: 2, 10: 1, 9: 1})
    assert [f for f in packing.fillings(with_one_for_all, 60, 60) if f] == [[60]]
    exact = [f for f in packing.fillings(packing._Lengths({50: 1, 30: 2, 9: 1}), 60, 0) if f]
    assert exact == [[30, 30]]


def test_search_is_bounded_and_keeps_the_incumbent():
    rng = random.Random(3)
    counts = Counter(rng.randint(200, 1100) for _ in range(400))
    best_fit = number(packing._packed(counts, 2048, packing.best_fit))
    assert packing.lower_bound(counts, 2048) <= number(packing.plan(counts, steps=2000)) <= best_fit
    assert packing.plan({}) == [] and packing.lower_bound({}, 100) == 0


def check(df, capacity):
    rows = packing.pack(df, PATH, 0, capacity).collect()
    want = Counter()
    for r in df.select("doc_id", "text").collect():
        ids = [*TOKENIZER.encode(r.text or "", add_special_tokens=False).ids, 0]
        for n, start in enumerate(range(0, len(ids), capacity)):
            part = ids[start : start + capacity]
            want[r.doc_id, n, start, len(part), zlib.crc32(np.array(part, dtype="<u4").tobytes())] += 1
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in rows) == want
    sequences = defaultdict(list)
    for r in rows:
        sequences[r.sequence_id].append((r.offset, r.length))
    for held in sequences.values():
        at = 0
        for offset, length in sorted(held):
            assert offset == at
            at += length
        assert at <= capacity
    return len(sequences), -(-sum(r.length for r in rows) // capacity)


def test_documents(documents):
    used, bound = check(documents, 2048)
    assert used <= bound + 2


def test_odd_rows(odd):
    check(odd, 2048)
    check(odd, 7)


def test_one_length_only(spark):
    df = spark.createDataFrame([(i, "one two") for i in range(500)], "doc_id long, text string").repartition(9)
    used, bound = check(df, 7)
    assert used == 250


def test_empty_table(odd):
    assert packing.pack(odd.limit(0), PATH, 0).collect() == []
