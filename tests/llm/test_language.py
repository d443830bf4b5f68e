"""Language identification by held-out accuracy and defined cases."""

import zlib

import numpy as np

from promptsieve.llm import language


def test_held_out_accuracy(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    truth = {r.doc_id: r.lang for r in docs.select("doc_id", "lang").collect()}
    rows = language.identify(docs, language.train(docs)).collect()
    assert len(rows) == len(truth)
    for r in rows:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) and 0 <= r.score <= 1
    held = [r for r in rows if r.held_out]
    assert np.mean([r.lang_pred == truth[r.doc_id] for r in held]) > 0.97
    assert np.mean([r.rejected for r in rows]) < 0.1


def test_nothing_but_training_rows_is_learned(documents):
    """Other languages on held-out rows change nothing."""
    from pyspark.sql import functions as F

    changed = documents.withColumn("lang", F.when(language.held_out(), F.lit("xx")).otherwise(F.col("lang")))
    assert set(language.train(changed)[0]) == set(language.train(documents)[0])


def test_odd_rows(odd, documents):
    model = language.train(documents)
    rows = language.identify(odd, model).collect()
    assert len(rows) == odd.count()
    texts = [r.text for r in odd.collect()]
    assert sum(r.lang_pred == "und" for r in rows) == sum(not (t or "").strip() for t in texts)
    assert all(r.score == 0 for r in rows if r.lang_pred == "und")
    language.identify(odd, language.train(odd)).collect()


def test_empty_table_and_no_languages(odd):
    assert language.identify(odd.limit(0), language.train(odd.limit(0))).collect() == []
    rows = language.identify(odd, language.train(odd.limit(0))).collect()
    assert {r.lang_pred for r in rows} == {"und"}


def test_numerals_are_no_letters(spark, documents):
    rows = [(1, "² ½ Ⅷ 123 !"), (2, "x"), (3, "é"), (4, None), (5, "")]
    df = spark.createDataFrame([(i, t, None) for i, t in rows], "doc_id long, text string, lang string")
    got = {r.doc_id: r.lang_pred for r in language.identify(df, language.train(documents)).collect()}
    assert got[1] == got[4] == got[5] == "und"
