"""Mixing against targets that are reshared step by step."""

import re

import pytest
from pyspark.sql import functions as F

from promptsieve.llm import mixing


def words(text):
    return len(re.findall(r"[^\x20\x09-\x0D]+", text or ""))


def brute_targets(sizes, share=1.5, cap=2.0, weights=(5.0, 2.0, 1.0)):
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    left, open_, target = share * sum(sizes.values()), set(names), {}
    while open_:
        total = sum(weight[s] for s in open_)
        over = {s for s in open_ if left * weight[s] / total > cap * sizes[s]}
        if not over:
            return target | {s: left * weight[s] / total for s in open_}
        for s in over:
            target[s] = cap * sizes[s]
        left -= sum(target[s] for s in over)
        open_ -= over
    return target


def check(df):
    sizes, largest = {}, {}
    for r in df.select("source", "text").collect():
        sizes[r.source] = sizes.get(r.source, 0) + words(r.text)
        largest[r.source] = max(largest.get(r.source, 0), words(r.text))
    want = brute_targets(sizes)
    per_entry = mixing.copies(df).collect()
    taken = dict.fromkeys(sizes, 0)
    for r in per_entry:
        assert r.source_size == sizes[r.source] and r.target == pytest.approx(want[r.source])
        assert 0 <= r.extra <= r.rows and r.base + (r.extra > 0) <= 2
        taken[r.source] += r.size * (r.base * r.rows + r.extra)
    for s in sizes:
        assert abs(taken[s] - want[s]) <= largest[s] / 2 + 1e-6
    rows = mixing.taken(df).collect()
    assert len(rows) == df.count() and all(r.taken <= 2 * r["size"] for r in rows)
    assert sum(r.taken for r in rows) == sum(taken.values())
    return sorted(map(tuple, rows), key=repr)


def test_odd_rows(odd):
    check(odd)


def test_reruns_agree_whatever_the_partitions(documents):
    assert check(documents) == check(documents.repartition(5, F.xxhash64("text")))


def test_large_and_hot_source(spark):
    """Three levels of the tree, with a third of all rows the same."""
    rows = [(i, " ".join("w" * (1 + i % 17)), "big") for i in range(3000)] + [(1, "a b c", "hot")] * 1500 + [(-1, None, "none")]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    first = sorted(map(tuple, mixing.taken(df, block=8).collect()), key=repr)
    assert first == sorted(map(tuple, mixing.taken(df.repartition(3), block=8).collect()), key=repr)
    totals = {}
    for r in first:
        totals[r[2]] = totals.get(r[2], 0) + r[4]
    aims = {r[2]: r[3] for r in first}
    assert all(abs(totals[k] - aims[k]) <= 17 for k in totals)


def test_mixed_rows_follow_the_decisions(odd):
    mix = mixing.mixed(odd)
    assert mix.columns == odd.columns
    assert sum(words(r.text) for r in mix.collect()) == sum(r.taken for r in mixing.taken(odd).collect())


def test_empty_table(odd):
    assert mixing.taken(odd.limit(0)).collect() == []
    assert mixing.mixed(odd.limit(0)).collect() == []
