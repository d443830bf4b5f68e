"""Row-level helpers that shape plans rather than values."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def settle(df: DataFrame, *columns: str) -> DataFrame:
    """The same rows, with some columns (or all) computed at this point of the plan.

    Spark moves a filter below the projections that define its columns, and
    copies their expressions into it.  Behind a long chain of costly columns
    the copies grow with every step and are evaluated once more each.  A filter
    on the output of a generator stays above it, so each row passes through one
    here.  Columns that are not named stay outside and can still be pruned.
    """
    held = columns or df.columns
    others = [F.col(f"`{c}`") for c in df.columns if c not in held]
    settled = df.select(*others, F.inline(F.array(F.struct(*(F.col(f"`{c}`") for c in held)))))
    return settled.select(*(F.col(f"`{c}`") for c in df.columns))


def spread(df: DataFrame) -> DataFrame:
    """The same rows over all cores, if the input comes in fewer splits.

    Matching rules costs far more than moving the text, so a small input is
    dealt out first.  An input with a split for every core is left alone.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df
