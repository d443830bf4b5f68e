"""Top-k search against all inner products."""

import math
import re

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from promptsieve.llm import topk


def brute(rows, k=5, every=50):
    kept = []
    for vec_id, v in rows:
        if vec_id is None or v is None or any(x is None or not math.isfinite(x) for x in v):
            continue
        kept.append((vec_id, [math.floor(256 * float(np.float32(x))) for x in v]))
    width = max((len(v) for _, v in kept), default=0)
    ints = [(i, np.array([*v, *[0] * (width - len(v))], dtype=np.int64)) for i, v in kept]
    out = []
    for q in sorted({i for i, _ in ints if i % every == 0}):
        scored = sorted((-int(w @ v), i) for asked, w in ints if asked == q for i, v in ints if i != q)[:k]
        out += [(q, n, i, -s) for n, (s, i) in enumerate(scored, 1)]
    return out


def found(df, **options):
    return sorted(map(tuple, topk.top_k(df, **options).collect()))


def test_embeddings(spark):
    df = spark.read.parquet("/root/testdata/sf0.001/embeddings.parquet")
    assert found(df) == brute([(r.vec_id, r.embedding) for r in df.collect()])


def test_many_blocks_and_equal_vectors(spark, monkeypatch):
    monkeypatch.setattr(topk, "BLOCK_ROWS", 100)
    monkeypatch.setattr(topk, "BLOCK_QUERIES", 16)
    rng = np.random.default_rng(1)
    rows = [(i, [0.5, -0.25, 0.125, 0.0] if i % 3 == 0 else rng.normal(size=4).tolist()) for i in range(600)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    assert found(df, every=10) == brute(rows, every=10)


def test_odd_rows(spark):
    rows = [
        (0, [1.0, 2.0]), (0, [1.0, 2.0]), (0, [3.0, 0.0]), (50, [0.5]), (100, []), (150, None), (1, None), (2, [float("nan"), 1.0]),
        (3, [float("inf"), 1.0]), (4, [None, 1.0]), (None, [1.0, 1.0]), (5, [-1.0, -1.0, 1.0]), (6, [0.1, 0.1]), (7, [0.1, 0.1]), (-50, [2.0, 2.0]),
    ]
    df = spark.createDataFrame([(*r, 1, 2, "x") for r in rows], "vec_id long, embedding array<float>, rank int, score long, block string")
    assert found(df) == brute(rows)
    assert found(df.limit(0)) == []


@settings(max_examples=40, deadline=None)
@given(st.lists(st.lists(st.integers(-300, 300), min_size=3, max_size=3), min_size=1, max_size=150), st.integers(1, 6))
def test_bitmap_search(vectors, k):
    values, ids = np.array(vectors, dtype=np.int64), np.arange(len(vectors))
    low, shift, slices = topk.index_block(ids, values)
    for q, got_ids, scores in topk.search_block(ids[:70], values[:70], ids, values, low, shift, slices, k):
        want = sorted((-int(values[q] @ v), i) for i, v in enumerate(values) if i != q)[:k]
        assert [(-s, i) for s, i in zip(scores, got_ids)] == want


@pytest.mark.parametrize("n", [1, 2, 3, 17])
def test_adder(n):
    rng = np.random.default_rng(n)
    bits = rng.integers(0, 2, size=(n, 128)).astype(np.uint8)
    places = rng.integers(0, 5, size=n)
    adder = topk.Adder()
    for row, place in zip(topk.bitmaps(bits), places):
        adder.add(int(place), row)
    total = sum(topk.unpacked(s, 128).astype(int) << i for i, s in enumerate(adder.total()) if s is not None)
    assert (total == (bits * (1 << places)[:, None]).sum(axis=0)).all()


def test_repeated_ids_stay(spark):
    rows = [(0, [1.0, 0.0]), (1, [0.5, 0.0]), (1, [0.25, 0.5]), (2, [0.1, 0.0]), (0, [0.0, 1.0])]
    rows += [(3, [0.2, 0.1])] * 300
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").repartition(4)
    assert found(df) == brute(rows)
    assert [r[2] for r in brute(rows[:4])] == [1, 1, 2]


def test_tasks_do_not_grow_with_pairs_of_blocks(spark, monkeypatch):
    monkeypatch.setattr(topk, "BLOCK_ROWS", 10)
    monkeypatch.setattr(topk, "BLOCK_QUERIES", 2)
    rng = np.random.default_rng(2)
    rows = [(i, rng.integers(-3, 4, size=3).astype(float).tolist()) for i in range(600)]
    best = topk.top_k(spark.createDataFrame(rows, "vec_id long, embedding array<float>"), every=5)
    plan = best._jdf.queryExecution().executedPlan().toString()
    tasks = [int(n) for n in re.findall(r"(\d+)\), REPARTITION", plan)]
    assert "Broadcast" not in plan and tasks and max(tasks) <= 60, tasks
    assert sorted(map(tuple, best.collect())) == brute(rows, every=5)


def test_large_numbers(spark, monkeypatch):
    monkeypatch.setattr(topk, "BLOCK_ROWS", 30)
    rng = np.random.default_rng(3)
    rows = [(i, (rng.normal(size=2) * 10.0 ** (i % 8)).clip(-5e6, 5e6).astype(np.float32).tolist()) for i in range(120)]
    rows[7] = (7, [1.2e7, 0.0])
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    assert found(df, every=3) == brute(rows, every=3)
