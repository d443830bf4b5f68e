"""Written results: JSON Lines, tables for analysis and tables for people."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from promptsieve.functions.jsontext import json_string
from promptsieve.operators.prompts import CONTEXT_FIELDS


def stage(df: DataFrame, path: str, *, partition_by: tuple[str, ...] = ()) -> DataFrame:
    """Write `df` as a parquet table and go on from what was written, so that
    several results can be derived from it without computing it again."""
    df.write.mode("overwrite").partitionBy(*partition_by).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path).select(*df.columns)


def write_jsonl(df: DataFrame, path: str, *, keep_nulls: bool = True) -> None:
    df.write.mode("overwrite").option("ignoreNullFields", str(not keep_nulls).lower()).json(path)


def write_raw_records(records: DataFrame, path: str) -> None:
    """Records as the compact JSON they hold, one per line."""
    records.select("record_json").write.mode("overwrite").text(path)


def write_table(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("header", "true").option("escape", '"').csv(path)


def prompt_lines(prompts: DataFrame) -> DataFrame:
    """Prompts as the JSON objects they are exported as, one text per row.
    Content and raw are put in as the JSON they are, in their own order of keys."""
    head = F.to_json(
        F.struct(F.col("log_id").alias("source_log_id"), *CONTEXT_FIELDS, F.lit("user").alias("role")), {"ignoreNullFields": "false"}
    )
    content = F.expr(f"if(content_kind = 'STRING', {json_string('content')}, content)")
    line = F.concat(F.expr("substring(_head, 1, length(_head) - 1)"), F.lit(',"content":'), content, F.lit(',"raw":'), F.col("raw"), F.lit("}"))
    return prompts.withColumn("_head", head).select(line.alias("value"))
