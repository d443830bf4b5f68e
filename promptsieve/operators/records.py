"""From log bodies to records: decoding, and telling model responses apart."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from promptsieve.functions.dialect import strip
from promptsieve.functions.jsontext import elements, last_key_wins, present, read_json, strict_parse, truthy
from promptsieve.functions.rows import settle

# Fixed values.
RESPONSE_ROLES = ("assistant", "model")
UNPARSED_FIELD = "_unparsed_log_line"
# Every character sequence that ends a line inside a log body.
LINE_ENDS = r"\r\n|[\n\r\x0B\f\x1C-\x1E\x{85}\x{2028}\x{2029}]"

ROLE_FIELDS = (
    "role: variant, sender_role: variant, senderRole: variant, "
    "author: struct<role: variant, type: variant>, sender: struct<role: variant, type: variant>"
)
_RECORD_SCHEMA = (
    f"struct<{ROLE_FIELDS}, message: struct<{ROLE_FIELDS}>, "
    "source_log_id: variant, log_id: variant, id: variant>"
)


def role_sql(node: str) -> str:
    """SQL: lower-case role of an object parsed with `ROLE_FIELDS`.

    The direct fields come first; author and sender are asked only if those
    leave nothing at all (an empty last field is something).
    """
    return f"""lower(try_variant_get(CASE
        WHEN {truthy(f'{node}.role')} THEN {node}.role
        WHEN {truthy(f'{node}.sender_role')} THEN {node}.sender_role
        WHEN {present(f'{node}.senderRole')} IS NOT NULL THEN {node}.senderRole
        WHEN {truthy(f'{node}.author.role')} THEN {node}.author.role
        WHEN {present(f'{node}.author.type')} IS NOT NULL THEN {node}.author.type
        WHEN {truthy(f'{node}.sender.role')} THEN {node}.sender.role
        ELSE {node}.sender.type END, '$', 'string'))"""


def with_record_facts(records: DataFrame, json: str = "record_json") -> DataFrame:
    """Add `is_response` and `own_log_id` to a frame of records."""
    last_key_wins(records.sparkSession)
    head = f"if(startswith({json}, '{{'), {read_json(json, _RECORD_SCHEMA)}, null)"
    listed = ", ".join(f"'{r}'" for r in RESPONSE_ROLES)
    role = f"if(_head.message IS NOT NULL, {role_sql('_head.message')}, {role_sql('_head')})"
    own_id = f"""try_variant_get(CASE
        WHEN {truthy('_head.source_log_id')} THEN _head.source_log_id
        WHEN {truthy('_head.log_id')} THEN _head.log_id
        ELSE _head.id END, '$', 'string')"""
    return settle(
        records.withColumn("_head", F.expr(head))
        .withColumns(
            {
                "is_response": F.expr(f"coalesce({role} IN ({listed}), false)"),
                "own_log_id": F.expr(own_id),
            }
        )
        .drop("_head")
    )


def unparsed_record(line: Column, log_id: Column, line_number: Column) -> Column:
    """The record that stands in for a line which is not JSON."""
    return F.to_json(
        F.struct(
            line.alias(UNPARSED_FIELD),
            log_id.alias("source_log_id"),
            line_number.alias("line_number"),
        )
    )


def decode_payload(bodies: DataFrame, *, keep: tuple[str, ...] = ()) -> DataFrame:
    """One row per record of each log body.

    `bodies` has log_id and body, plus the `keep` columns that are carried
    along.  A body is one JSON value, a JSON array of records, or JSON Lines.
    The result has log_id, record_no (0-based), line_number (JSON Lines only),
    record_json and parse_ok.  Empty bodies give one row with a null
    record_no, so that they can be reported; `records_of` drops it.
    """
    last_key_wins(bodies.sparkSession)
    body = strip(F.col("body"))
    whole = bodies.select(*keep, "log_id", body.alias("_body")).withColumn(
        "_whole", F.when(F.col("_body") != "", strict_parse(F.col("_body")))
    )
    unit = F.struct(
        F.lit(None).cast("bigint").alias("line_number"),
        F.col("_whole").alias("text"),
        F.lit(True).alias("ok"),
    )
    array_units = F.transform(
        elements("_whole"),
        lambda text: F.struct(
            F.lit(None).cast("bigint").alias("line_number"), text.alias("text"), F.lit(True).alias("ok")
        ),
    )
    lines = F.filter(
        F.transform(
            F.split(F.col("_body"), LINE_ENDS, -1),
            lambda line, i: F.struct(
                (i + 1).cast("bigint").alias("line_number"),
                strip(line).alias("text"),
                F.lit(False).alias("ok"),
            ),
        ),
        lambda line: line["text"] != "",
    )
    units = (
        F.when(F.coalesce(F.col("_body"), F.lit("")) == "", F.array().cast(_UNITS))
        .when(F.col("_whole").isNull(), lines)
        .when(F.col("_whole").startswith("["), array_units)
        .otherwise(F.array(unit))
    )
    rows = whole.select(*keep, "log_id", F.posexplode_outer(units).alias("record_no", "_unit"))
    line = F.col("_unit.text")
    parsed = F.when(F.col("_unit.ok"), line).otherwise(strict_parse(line))
    return (
        rows.withColumn("_parsed", parsed)
        .select(
            *keep,
            "log_id",
            F.col("record_no").cast("bigint").alias("record_no"),
            F.col("_unit.line_number").alias("line_number"),
            F.when(F.col("record_no").isNull(), F.lit(None).cast("string"))
            .otherwise(
                F.coalesce(
                    F.col("_parsed"),
                    unparsed_record(line, F.col("log_id"), F.col("_unit.line_number")),
                )
            )
            .alias("record_json"),
            F.when(F.col("record_no").isNotNull(), F.col("_parsed").isNotNull()).alias("parse_ok"),
        )
    )


_UNITS = "array<struct<line_number:bigint,text:string,ok:boolean>>"


def records_of(decoded: DataFrame) -> DataFrame:
    return decoded.where(F.col("record_no").isNotNull())
