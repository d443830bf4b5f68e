"""Batches of whole texts."""

import pyarrow as pa
from pyspark.sql import functions as F

from promptsieve.llm import texts

BOUND, ROWS = "spark.sql.execution.arrow.maxBytesPerBatch", "spark.sql.execution.arrow.maxRecordsPerBatch"


def sizes(df, rows):
    def job(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([batch.num_rows])], names=["n"])

    return texts.in_arrow(df, job, "n long", rows=rows)


def test_batches_of_a_frame_do_not_depend_on_later_calls(spark):
    rows = spark.conf.get(ROWS)
    df = spark.range(0, 3000, 1, 1).select(F.lit("some text").alias("t"))
    made = sizes(df, 512)
    sizes(df, 1).limit(1).collect()
    assert [r.n for r in made.collect()] == [512] * 5 + [440]
    assert spark.conf.get(ROWS) == rows


def test_long_texts_come_in_small_batches(spark):
    df = spark.range(0, 40, 1, 1).select(F.repeat(F.lit("x"), 1_000_000).alias("t"))
    assert max(r.n for r in sizes(df, 512).collect()) <= 6


def test_a_smaller_bound_of_the_session_stays(spark):
    before = spark.conf.get(BOUND)
    spark.conf.set(BOUND, "1000000b")
    try:
        sizes(spark.range(1), 5).collect()
        assert spark.conf.get(BOUND) == "1000000b"
    finally:
        spark.conf.set(BOUND, before)
