"""Importance resampling against plain loops."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import pytest

from promptsieve.llm import importance


def features_of(text, n):
    lowered = (text or "").translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"))
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lowered)
    return words, [" ".join(words[i : i + w]) for w in range(1, n + 1) for i in range(len(words) - w + 1)]


def brute(rows, target, n=1, buckets=10_000, percent=10, least=20, seed=2024):
    def place(feature):
        return zlib.crc32(feature.encode()) % buckets

    s = Counter(place(f) for _, text in rows for f in features_of(text, n)[1])
    t = Counter(place(f) for text in target for f in features_of(text, n)[1])
    every, wanted = float(sum(s.values())), float(sum(t.values()))

    def gain(b):
        return math.floor(1000 * math.log((t[b] + 1) * (every + buckets) / ((s[b] + 1) * (wanted + buckets))))

    scored = []
    for doc_id, text in rows:
        words, found = features_of(text, n)
        weight = sum(gain(place(f)) for f in found)
        h = int(hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
        scored.append((doc_id, len(words), len(found), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))))
    may = sorted((-score, doc_id is None, doc_id or 0) for doc_id, words, _, _, score in scored if words >= least)
    ranks = {}
    for rank, key in enumerate(may[: percent * len(may) // 100], 1):
        ranks.setdefault(key, []).append(rank)
    out = []
    for doc_id, words, count, weight, score in scored:
        left = ranks.get((-score, doc_id is None, doc_id or 0)) if words >= least else None
        out.append((doc_id, count, weight, score, left.pop(0) if left else None))
    return sorted(out, key=repr)


def found(docs, target, **options):
    return sorted((tuple(r) for r in importance.resample(docs, target, **options).collect()), key=repr)


def test_documents(spark, documents):
    target = spark.read.parquet("/root/testdata/sf0.001/benchmark.parquet")
    want = brute([(r.doc_id, r.text) for r in documents.collect()], [r.text for r in target.collect()])
    assert found(documents, target) == want
    assert sum(r[-1] is not None for r in want) > 10


@pytest.mark.parametrize("n, buckets", [(1, 16), (2, 50), (3, 1000)])
def test_ties_repeats_and_longer_runs(spark, n, buckets):
    rng = random.Random(n)
    rows = [(rng.choice([None, *range(40)]), " ".join(rng.choices("a B c d É 1-2 x_y".split(), k=rng.randrange(12)))) for _ in range(150)]
    rows += [(7, "same words here again")] * 100
    target = ["a b c", None, "", "same here"]
    docs = spark.createDataFrame([(*r, 1, 2, "x") for r in rows], "doc_id long, text string, score long, rank int, row string").repartition(7)
    options = {"n": n, "buckets": buckets, "least_words": 3, "percent": 37}
    got = found(docs, spark.createDataFrame([(t,) for t in target], "text string"), **options)
    want = brute(rows, target, n, buckets, 37, 3)
    # Which of several rows of one id and score is drawn depends on their texts.
    assert [r[:4] for r in got] == [r[:4] for r in want]
    assert sorted((r[4], r[3]) for r in got if r[4]) == sorted((r[4], r[3]) for r in want if r[4])


def test_odd_and_empty_tables(spark, odd):
    target = spark.createDataFrame([("one two",)], "text string")
    rows = [(r.doc_id, r.text) for r in odd.collect()]
    assert found(odd, target, least_words=0, percent=50)[0][:4] == brute(rows, ["one two"], least=0, percent=50)[0][:4]
    assert found(odd.limit(0), target) == []
    assert len(found(odd, target.limit(0))) == len(rows)


def test_long_text_is_read_in_slices(monkeypatch):
    text = ("Wörd " * 50 + "x" * 5000 + " tail-end ") * 20
    whole = [list(b) for b in importance.buckets_of(text.encode(), 2, 1000)]
    monkeypatch.setattr(importance, "SLICE", 64)
    sliced = [list(b) for b in importance.buckets_of(text.encode(), 2, 1000)]
    assert len(sliced) > len(whole)
    assert Counter(x for b in sliced for x in b) == Counter(x for b in whole for x in b)


def test_quickselect(spark):
    rng = random.Random(3)
    rows = [(rng.randrange(-5, 5), 0, rng.randrange(50), 0, i) for i in range(700)]
    keys = spark.createDataFrame(rows, "down long, last int, id long, hash long, row long")
    rows.sort()
    for k in (1, 2, 333, 699, 700):
        assert importance.kth_key(keys, k, pivots=3) == rows[k - 1]
