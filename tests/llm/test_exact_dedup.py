"""Exact deduplication against a plain dictionary."""

import hashlib
import re
from collections import defaultdict

from promptsieve.llm import exact_dedup


def brute(rows):
    groups = defaultdict(list)
    for doc_id, text in rows:
        normal = re.sub(r"[\x20\x09-\x0D]+", " ", text or "")
        groups[hashlib.sha256(normal.encode()).hexdigest()].append(doc_id)
    out = []
    for sha, ids in groups.items():
        keep = min((i for i in ids if i is not None), default=None)
        first = True
        for i in ids:
            kept = i == keep and first
            first = first and not kept
            out.append((i, keep, len(ids), kept, sha))
    return sorted(out, key=repr)


def decided(df):
    rows = exact_dedup.decisions(df).collect()
    return sorted(((r.doc_id, r.keep_id, r.group_size, r.kept, r.text_sha256) for r in rows), key=repr)


def pairs(df):
    return [(r.doc_id, r.text) for r in df.select("doc_id", "text").collect()]


def test_odd_rows(odd):
    assert decided(odd) == brute(pairs(odd))


def test_documents(documents):
    assert decided(documents) == brute(pairs(documents))


def test_one_text_holds_a_third_of_all_rows(spark):
    rows = [(i, "same  text" if i % 3 == 0 else f"text {i // 2}") for i in range(3000)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(7)
    assert decided(df) == brute(rows)
    kept = exact_dedup.keep_first(df).collect()
    assert sorted(r.doc_id for r in kept) == sorted(r[0] for r in brute(rows) if r[3])


def test_keep_first_carries_all_columns(odd):
    kept = exact_dedup.keep_first(odd)
    assert kept.columns == odd.columns
    want = [r for r in brute(pairs(odd)) if r[3]]
    assert sorted(r.doc_id for r in kept.collect()) == sorted(r[0] for r in want)


def test_empty_table(odd):
    assert exact_dedup.decisions(odd.limit(0)).collect() == []
    assert exact_dedup.keep_first(odd.limit(0)).collect() == []
