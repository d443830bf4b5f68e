"""The filter audit against every order played through."""

import random
import re
from itertools import permutations

from promptsieve.llm import interaction


def fails(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    return [
        len(words) < 200, 100 * len(set(words)) < 50 * len(words), 100 * len(re.findall("[A-Z]", text)) > 2 * len(text),
        any(c in text for c in "#$%&*|"),
    ]


def brute(docs, labels):
    """Rows by playing all orders through, one document at a time."""
    texts = {}
    for doc_id, text, _ in docs:
        texts.setdefault(text or "", []).append((doc_id is None, doc_id or 0))
    parts = {}
    for doc_id, text, source in docs:
        mask = [*fails(text or ""), (doc_id is None, doc_id or 0) > min(texts[text or ""])]
        good, toxic = (any(i == doc_id and i is not None and v[at] == 1 for i, *v in labels) for at in (0, 1))
        parts.setdefault(source or "", []).append((mask, good, toxic))
    rows = []
    for part, items in parts.items():
        of_part, lost = [], dict.fromkeys("ABCDE", 0)
        for order in permutations("ABCDE"):
            left = list(items)
            for step, letter in enumerate(order, 1):
                f = "ABCDE".index(letter)
                gone = [x for x in left if x[0][f]]
                left = [x for x in left if not x[0][f]]
                failing = sum(x[0][f] for x in items)
                alone = sum(x[0][f] and sum(x[0]) == 1 for x in items)
                lost[letter] += len(gone)
                of_part.append([part, "".join(order), step, len(left), len(gone), failing - len(gone), alone, sum(x[1] for x in gone), sum(x[2] for x in gone)])
        rows += [(*r, lost[r[1][r[2] - 1]]) for r in of_part]
    return sorted(rows)


COLUMNS = ["part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"]


def found(docs, labels):
    return sorted(tuple(r) for r in interaction.audit(docs, labels).select(COLUMNS).collect())


def test_made_up_documents(spark):
    rng = random.Random(4)
    texts = [" ".join(rng.choices(["a", "Bc", "d$", "é", *map(str, range(k))], k=n)) for k in (5, 400) for n in (3, 150, 201, 260) for _ in range(3)]
    texts += [None, "", " \t ", "A" * 300, "x\x0by " * 100]
    docs = [(rng.choice([None, *range(30)]), rng.choice(texts), rng.choice([None, "", "s1", "s2"])) for _ in range(200)]
    docs += [(1, texts[0], "s1")] * 50
    labels = [(rng.choice([None, *range(25)]), rng.choice([None, 0, 1]), rng.choice([0, 1])) for _ in range(40)]
    df = spark.createDataFrame([(*d, 1, 2, "x") for d in docs], "doc_id long, text string, source string, mask int, n long, part string").repartition(6)
    assert found(df, spark.createDataFrame(labels, "doc_id long, quality int, toxic int")) == brute(docs, labels)


def test_odd_and_empty_tables(spark, odd):
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert found(odd, labels) == brute([(r.doc_id, r.text, r.source) for r in odd.collect()], [])
    assert found(odd.limit(0), labels) == []


def test_slices_of_long_texts(monkeypatch):
    texts = [b"one two\tthree " * 70, b"word" * 5000, b" " * 3000, b"a b " * 40 + b"C" * 700]
    whole = [interaction.failed(t) for t in texts]
    monkeypatch.setattr(interaction, "SLICE", 16)
    assert [interaction.failed(t) for t in texts] == whole


def test_intervals_cover_every_order():
    orders = list(permutations(range(5)))
    for mask in range(32):
        held = {}
        for step, low, high in interaction.intervals(mask):
            for rank in range(low, high):
                assert held.setdefault(rank, step) == step
        want = {rank: next(i for i, f in enumerate(order, 1) if mask >> f & 1) for rank, order in enumerate(orders) if mask}
        assert held == want
