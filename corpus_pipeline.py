"""A training corpus out of raw documents, in five stages.

Every stage reads what its predecessor has written and works on all of it:
documents that the quality classifier rejects go, of equal texts one stays, of
each group of near-duplicates one stays, the sources are mixed to their target
weights, and the mix is packed into training sequences.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from promptsieve.llm import exact_dedup, mixing, ngram_join, packing, quality
from promptsieve.llm.queries import WORD_TOKENIZER, vocabulary
from promptsieve.llm.texts import table
from promptsieve.session import shared_dir
from promptsieve.sources.sinks import stage


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that a model of the labelled ones scores at least 0.3."""
    labelled = quality.sample(docs, table(spark, sf_dir, "labels"))
    return quality.keep(docs, quality.train(labelled))


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of texts that are equal but for white space, the one with the least id."""
    return exact_dedup.keep_first(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents linked by a similarity of 0.8 on five-word shingles, the one
    with the least id."""
    return ngram_join.keep_one(docs, n=5, num=80, den=100)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as their source's target asks for."""
    return mixing.mixed(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents with their sequence and place."""
    return packing.pack(docs, vocabulary(WORD_TOKENIZER), end_id=0)


STAGES = [
    ("quality_classifier", keep_quality),
    ("exact_dedup", drop_copies),
    ("ngram_jaccard_join", drop_near_copies),
    ("mix_sources", mix_sources),
    ("best_fit_packing", pack_sequences),
]

# A learned score, random rounding and a packing are no SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, apply in STAGES[:-1]:
        docs = stage(apply(spark, docs, sf_dir), shared_dir(spark, name))
    return STAGES[-1][1](spark, docs, sf_dir)
