"""The join against every pair of documents compared."""

import random
from collections import Counter, defaultdict

import numpy as np
import pytest

from promptsieve.llm import ngram_join


def brute(rows, n, num, den):
    sets = []
    for _, text in rows:
        words = (text or "").encode().lower().split()
        k = min(n, len(words))
        sets.append({tuple(words[i : i + k]) for i in range(len(words) - k + 1)} if words else set())
    parent = list(range(len(rows)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    holders, shared = defaultdict(list), Counter()
    for i, s in enumerate(sets):
        for shingle in s:
            holders[shingle].append(i)
    for held in holders.values():
        for b in range(len(held)):
            for a in range(b):
                shared[held[a], held[b]] += 1
    for (a, b), both in shared.items():
        if den * both >= num * (len(sets[a]) + len(sets[b]) - both):
            parent[root(a)] = root(b)
    smallest = {}
    for i, (doc_id, _) in enumerate(rows):
        if doc_id is not None:
            smallest[root(i)] = min(doc_id, smallest.get(root(i), doc_id))
    return sorted(((d, len(s), smallest.get(root(i)) if s else d) for i, ((d, _), s) in enumerate(zip(rows, sets))), key=repr)


def found(df, n, num, den):
    rows = ngram_join.near_duplicates(df, n, num, den).collect()
    return sorted(((r.doc_id, r.n_shingles, r.component_id) for r in rows), key=repr)


def near_copies(seed, groups, size, per_group, edits):
    """Groups of texts that differ in some words, chained and shuffled."""
    rng, rows = random.Random(seed), []
    vocabulary = [f"w{i}" for i in range(400)]
    passage = [rng.choice(vocabulary) for _ in range(60)]
    for g in range(groups):
        words = [rng.choice(vocabulary) for _ in range(rng.randint(5, size))]
        if g % 3 == 0:
            words += passage
        for _ in range(rng.randint(1, per_group)):
            rows.append(" ".join(words))
            for _ in range(rng.randint(0, edits)):
                words[rng.randrange(len(words))] = rng.choice(vocabulary)
    rng.shuffle(rows)
    return list(enumerate(rows))


@pytest.mark.parametrize("n, num", [(3, 90), (5, 80)])
def test_near_copies(spark, n, num):
    rows = near_copies(n, 60, 200, 8, 4)
    df = spark.createDataFrame(rows, "doc_id long, text string")
    want = brute(rows, n, num, 100)
    assert found(df, n, num, 100) == want
    assert len({c for _, _, c in want}) < len(rows)
    kept = [r.doc_id for r in ngram_join.keep_one(df, n, num, 100).collect()]
    assert sorted(kept) == sorted({c for _, _, c in want})


def test_large_group_without_all_pairs(spark):
    """A thousand near copies of one text."""
    rng = random.Random(1)
    base = [f"u{i}" for i in range(300)]
    rows = []
    for i in range(1000):
        words = list(base)
        words[rng.randrange(300)] = f"new{i}"
        rows.append((i, " ".join(words)))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert {r.component_id for r in ngram_join.near_duplicates(df, 3, 90, 100).collect()} == {0}


def test_odd_rows(odd):
    rows = [(r.doc_id, r.text) for r in odd.collect()]
    assert found(odd, 3, 90, 100) == brute(rows, 3, 90, 100)
    kept = ngram_join.keep_one(odd, 3, 90, 100)
    assert kept.columns == odd.columns
    wordless = sum(not (r.text or "").split() for r in odd.collect())
    groups = {c for d, n, c in brute(rows, 3, 90, 100) if n}
    assert kept.count() == wordless + len(groups)


def test_empty_table(odd):
    assert found(odd.limit(0), 3, 90, 100) == []
    assert ngram_join.keep_one(odd.limit(0)).collect() == []


def test_texts_just_below_the_threshold_are_not_compared(spark, monkeypatch):
    """A few hundred edits of one text, no two of them linked: their pairs are
    ruled out where they meet, and none is verified."""
    rng = random.Random(8)
    words = [f"w{i}" for i in range(300)]
    rows = []
    for i in range(250):
        edited = list(words)
        for at in rng.sample(range(0, 300, 4), 6):
            edited[at] = f"e{i}x{at}"
        rows.append((i, " ".join(edited)))
    verified, counts = ngram_join.verified, []

    def counting(docs, classes, pairs, *options):
        counts.append(pairs.count())
        return verified(docs, classes, pairs, *options)

    monkeypatch.setattr(ngram_join, "verified", counting)
    found = ngram_join.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), n=3, num=90, den=100).collect()
    assert all(r.component_id == r.doc_id for r in found) and len(found) == 250
    assert sum(counts) < 250


def test_parities_bound_the_difference():
    rng = np.random.default_rng(2)
    for _ in range(50):
        both = rng.integers(0, 1 << 62, 200, dtype=np.uint64)
        one, other = (np.unique(np.concatenate([both, rng.integers(0, 1 << 62, rng.integers(0, 60), dtype=np.uint64)])) for _ in range(2))
        unequal = np.unpackbits((ngram_join.parities(one) ^ ngram_join.parities(other)).view(np.uint8)).sum()
        assert unequal <= len(np.setxor1d(one, other))
