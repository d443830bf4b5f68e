"""Removal of repeated strings against all windows."""

import hashlib
import random
from collections import Counter

import pytest

from promptsieve.llm import repeats


def brute(rows, length):
    texts = [(i, (t or "").encode()) for i, t in rows]
    held = Counter(b[i : i + length] for _, b in texts for i in range(len(b) - length + 1))
    out = []
    for doc_id, b in texts:
        gone = [False] * len(b)
        for i in range(len(b) - length + 1):
            if held[b[i : i + length]] > 1:
                gone[i : i + length] = [True] * length
        spans = sum(g and (i == 0 or not gone[i - 1]) for i, g in enumerate(gone))
        rest = bytes(x for x, g in zip(b, gone) if not g)
        out.append((doc_id, len(b), sum(gone), spans, hashlib.sha256(rest).hexdigest()))
    return sorted(out, key=repr)


def found(df, length):
    return sorted((tuple(r) for r in repeats.remove_repeats(df, length).collect()), key=repr)


def test_documents(spark, documents):
    want = brute([(r.doc_id, r.text) for r in documents.collect()], 400)
    assert found(documents, 400) == want
    assert sum(r[2] > 0 for r in want) > 5


def passages(seed, length):
    """Texts that share passages, whole, cut, shifted and edited."""
    rng = random.Random(seed)
    words = [rng.choice("ab é-") * rng.randrange(1, 4) for _ in range(40)]
    shared = ["".join(rng.choices(words, k=length)) for _ in range(4)]
    rows = []
    for i in range(60):
        own = "".join(rng.choices("abcdefgh ", k=rng.randrange(3 * length)))
        piece = rng.choice(shared)
        start = rng.randrange(len(piece))
        piece = piece[start : start + rng.randrange(4 * length)]
        if i % 3 == 0:
            at = rng.randrange(len(piece) + 1)
            piece = piece[:at] + "#" + piece[at + 1 :]
        rows.append((i, own[: len(own) // 2] + piece + own[len(own) // 2 :]))
    rows += [(i, rows[i % 7][1]) for i in range(60, 70)] + [(3, rows[3][1])] * 2
    rows += [(70, "a" * 10 * length), (71, "ab" * 4 * length), (72, "a" * length), (73, None), (None, "".join(shared)), (74, "")]
    return rows


@pytest.mark.parametrize("length", [8, 33, 100])
def test_shared_passages(spark, monkeypatch, length):
    monkeypatch.setattr(repeats, "CHUNK", 256)
    rows = passages(length, length)
    df = spark.createDataFrame([(*r, "x", 1, 2) for r in rows], "doc_id long, text string, first string, list int, n long").repartition(5)
    assert found(df, length) == brute(rows, length)


def test_lists_joined_by_a_shuffle(spark, monkeypatch):
    monkeypatch.setattr(repeats, "BROADCAST_BYTES", -1)
    rows = passages(5, 20)
    assert found(spark.createDataFrame(rows, "doc_id long, text string"), 20) == brute(rows, 20)


def test_odd_and_empty_tables(spark, odd):
    rows = [(r.doc_id, r.text) for r in odd.collect()]
    assert found(odd, 400) == brute(rows, 400)
    assert found(odd.limit(0), 400) == []


def test_long_text():
    """Runs of a text of a megabyte cover each window once."""
    rng = random.Random(1)
    text = bytes(rng.choices(b"abcdefghij ", k=1_000_000))
    first, last, offset, gram, around = repeats.Runs(400).of_text(text)
    assert first[0] == 0 and last[-1] == len(text) - 400 and (first[1:] == last[:-1] + 1).all()
    assert (offset <= 200 + last - first).all() and len(gram) == len(around) < 15_000
