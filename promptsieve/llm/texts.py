"""Helpers the operators of this subpackage share: white space, sizes, row
identity and Arrow batches of whole texts."""

from __future__ import annotations

import os
import re
from collections.abc import Callable, Iterator
from pathlib import Path

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# The white space that separates words.
SPACE = r"[\x20\x09-\x0D]+"
WORD = r"[^\x20\x09-\x0D]+"

# So many whole texts are worked on at once in Python.
ROWS_PER_BATCH = 512
# And so many bytes are sent there at once, or one row.
BYTES_PER_BATCH = 4 << 20
_UNITS = {"": 1, "b": 1, "k": 1 << 10, "m": 1 << 20, "g": 1 << 30}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def column(name: str) -> Column:
    """A column by its literal name, whatever characters that holds."""
    return F.col("`" + name.replace("`", "``") + "`")


def importable(spark: SparkSession) -> None:
    """Let Python workers import this package from where the driver has it; a
    cluster that installs it or ships it has no such folder and ignores it."""
    root, places = str(Path(__file__).resolve().parents[2]), spark.sparkContext.environment
    known = [p for p in places.get("PYTHONPATH", "").split(os.pathsep) if p]
    if root not in known:
        places["PYTHONPATH"] = os.pathsep.join([*known, root])


def in_arrow(
    df: DataFrame, job: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema: str, rows: int = ROWS_PER_BATCH
) -> DataFrame:
    """`mapInArrow` whose job is given at most `rows` rows at a time.

    What Spark sends at once is bounded by bytes, by one bound for every operator,
    since a plan takes the session's setting when it runs; a smaller one of the
    session's own stays.  The worker cuts that into slices, which share its memory.
    """
    conf, bound = df.sparkSession.conf, "spark.sql.execution.arrow.maxBytesPerBatch"
    said = re.fullmatch(r"(\d+)([bkmg]?)b?", conf.get(bound).lower())
    if not said or not 0 < int(said[1]) * _UNITS[said[2]] <= BYTES_PER_BATCH:
        conf.set(bound, f"{BYTES_PER_BATCH}b")
    importable(df.sparkSession)

    def sliced(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return job(batch.slice(at, rows) for batch in batches for at in range(0, max(1, batch.num_rows), rows))

    return df.mapInArrow(sliced, schema)


def collapsed(text: Column) -> Column:
    """The text with every run of white space as one space; null is empty."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), SPACE, " ")


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """`use(value)` with the value computed once."""
    return F.transform(F.array(value), use)[0]


def uniform(*parts: Column) -> Column:
    """A number in [0, 1) that depends on the parts alone."""
    return F.shiftrightunsigned(F.xxhash64(*parts), 11).cast("double") / F.lit(float(1 << 53))
