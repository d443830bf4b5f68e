"""The pipeline: each stage takes effect and passes on what documents hold."""

import corpus_pipeline
from promptsieve.llm import queries

SF = "/root/testdata/sf0.001"


def test_stages(spark, documents, tmp_path):
    docs, counts = documents, [documents.count()]
    for name, apply in corpus_pipeline.STAGES[:-1]:
        out = apply(spark, docs, SF)
        assert out.columns == documents.columns
        out.write.parquet(f"{tmp_path}/{name}")
        docs = spark.read.parquet(f"{tmp_path}/{name}")
        counts.append(docs.count())
    assert counts[0] > counts[1] > counts[2] >= counts[3] > 0 and counts[4] > 0
    ids = {r.doc_id for r in docs.collect()}
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, SF).collect()
    assert {r.doc_id for r in packed} == ids
    assert len({(r.sequence_id, r.offset) for r in packed}) == len(packed)


def test_stages_on_odd_rows(spark, odd):
    """Documents' own columns, with nulls, blank texts and repeated rows."""
    docs = odd.select("doc_id", "text", "lang", "source", "n_chars")
    for _, apply in corpus_pipeline.STAGES[1:4]:
        docs = apply(spark, docs, SF)
    assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars"]


def test_every_operator_is_registered():
    numbers = sorted(int(name[2:].split("_")[0]) for name in queries.QUERIES)
    assert numbers == list(range(1, 14))
