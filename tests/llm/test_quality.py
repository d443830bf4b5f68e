"""The quality model by held-out figures and defined cases."""

import zlib

import numpy as np

from promptsieve.llm import quality


def test_held_out_labels(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    model = quality.train(quality.sample(docs, labels))
    rows = {r.doc_id: r for r in quality.score(docs, model).collect()}
    assert len(rows) == docs.count()
    for r in rows.values():
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0)
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3)
    held = [(rows[x.doc_id], x.quality) for x in labels.collect() if rows[x.doc_id].held_out]
    assert np.mean([r.predicted == q for r, q in held]) > 0.93
    kept = quality.keep(docs, model)
    assert kept.columns == docs.columns
    assert {r.doc_id for r in kept.collect()} == {d for d, r in rows.items() if r.predicted}


def test_interactions_are_learned():
    """A label that no single measure tells: the exclusive or of two."""
    rng = np.random.default_rng(0)
    rows = rng.random((4000, 4))
    labels = ((rows[:, 1] > 0.5) ^ (rows[:, 2] > 0.5)).astype(float)
    model = quality.fit(rows, labels)
    assert ((model.score(rows) > 0.5) == labels).mean() > 0.9


def test_sample_is_bounded_and_never_held_out(spark, documents):
    labels = spark.read.parquet("/root/testdata/sf0.001/labels.parquet")
    all_ids = {r.doc_id for r in quality.sample(documents, labels).collect()}
    few = {r.doc_id for r in quality.sample(documents, labels, rows=20).collect()}
    assert few < all_ids and 5 < len(few) < 40
    assert all(zlib.crc32(str(i).encode()) % 5 for i in all_ids)


def test_odd_rows(spark, odd):
    labels = spark.createDataFrame([(i, i % 2, 0) for i in range(1, 20)] + [(3, 0, 0), (4, None, 0), (None, 1, 0)], "doc_id long, quality int, toxic int")
    model = quality.train(quality.sample(odd, labels))
    assert quality.score(odd, model).count() == odd.count()
    assert quality.score(odd.limit(0), model).collect() == []
    assert quality.keep(odd, model).columns == odd.columns
    nothing = quality.train(quality.sample(odd.limit(0), labels))
    assert {r.score for r in quality.score(odd, nothing).collect()} == {0.5}
