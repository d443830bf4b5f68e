"""Landed log listings: pages, their entries, the cursor and the log bodies."""

from __future__ import annotations

from datetime import datetime, timedelta, timezone

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from promptsieve.functions.jsontext import is_container, is_truthy, last_key_wins, plain, read_json, tag, tagged, tagged_struct
from promptsieve.functions.rows import settle

# Entries of so many bytes are sent to every task.  Beyond that, hashes of their
# ids are, up to so many rows, so that only bodies that are listed are shuffled.
BROADCAST_BYTES = 64 << 20
BROADCAST_HASHES = 8_000_000

# What is reported of a bad listing.
DATA_NOT_A_LIST = "log list response field 'data' must be a list"
NO_CURSOR = "log page had has_more=true but no last_end_time"
NON_OBJECT = "Skipped non-object log listing entry"
WITHOUT_ID = "Skipped log listing entry without an id"

_PAGE = tagged_struct("data", "has_more", "last_end_time")


def isoformat_utc(moment: datetime) -> str:
    """UTC to the second, marked Z.  A time without a zone is taken as UTC."""
    if moment.tzinfo is None:
        moment = moment.replace(tzinfo=timezone.utc)
    return moment.astimezone(timezone.utc).strftime("%Y-%m-%dT%H:%M:%SZ")


def window_start(now: datetime, days: int, after: str | None = None) -> str:
    return after or isoformat_utc(now - timedelta(days=days))


def window_start_column(now: Column, days: int) -> Column:
    """`window_start` of a timestamp column; the session time zone must be UTC."""
    start = now - F.make_dt_interval(F.lit(days))
    return F.date_format(start, "yyyy-MM-dd'T'HH:mm:ss'Z'")


def listed_after(listing: DataFrame, event_type: str, after) -> DataFrame:
    """Flat listing rows of one event type past the cursor, as the listing
    service selects them.  Both tests reach the file scan."""
    return listing.where((F.col("event_type") == event_type) & (F.col("end_time") > F.lit(after)))


def read_pages(responses: DataFrame) -> DataFrame:
    """Landed listing responses (page_no, page_json) as (page_no, data,
    has_more, last_end_time); `data` holds each entry as tagged JSON text."""
    last_key_wins(responses.sparkSession)
    parsed = responses.select("page_no", F.expr(read_json(tagged("page_json"), _PAGE)).alias("p"))
    data, more, end = (f"p.{tag(k)}" for k in ("data", "has_more", "last_end_time"))
    entries = f"""CASE WHEN NOT coalesce({is_truthy(data)}, false) THEN null
        WHEN startswith({data}, '[') THEN {read_json(data, 'array<string>')}
        ELSE raise_error("{DATA_NOT_A_LIST}") END"""
    end_time = f"if({is_truthy(end)} AND NOT {is_container(end)}, {plain(end)}, null)"
    has_more = f"coalesce({is_truthy(more)}, false)"
    checked = f"""CASE WHEN {has_more} AND {end_time} IS NULL
        THEN cast(raise_error('{NO_CURSOR}') AS boolean) ELSE {has_more} END"""
    return parsed.select(
        "page_no",
        F.expr(entries).alias("data"),
        F.expr(checked).alias("has_more"),
        F.expr(end_time).alias("last_end_time"),
    )


def entries(pages: DataFrame) -> DataFrame:
    """One row per listing entry: page_no, entry_no, log_id and, for an entry
    that cannot be used, `problem`."""
    rows = pages.select("page_no", F.posexplode_outer("data").alias("entry_no", "e"))
    is_object = "startswith(e, '{')"
    entry_id = f"{read_json('e', tagged_struct('id'))}.{tag('id')}"
    log_id = f"if({is_object} AND {is_truthy(entry_id)}, {plain(entry_id)}, null)"
    problem = f"""CASE WHEN NOT {is_object} THEN '{NON_OBJECT}'
        WHEN log_id IS NULL THEN '{WITHOUT_ID}' END"""
    return settle(
        rows.where(F.col("entry_no").isNotNull())
        .withColumn("log_id", F.expr(log_id))
        .select(
            "page_no",
            F.col("entry_no").cast("bigint").alias("entry_no"),
            "log_id",
            F.expr(problem).alias("problem"),
        )
    )


def cursor(pages: DataFrame, after: str) -> DataFrame:
    """One row: where the listing began, how far it got and its page count.
    Every page but the last must say that more follow."""
    last = F.max("page_no")
    stops = F.min(F.when(~F.col("has_more"), F.col("page_no")))
    reached = F.max_by("last_end_time", F.when(F.col("last_end_time").isNotNull(), F.col("page_no")))
    complete = F.when(
        stops < last, F.raise_error(F.lit("listing has pages after its last one"))
    ).otherwise(F.coalesce(reached, F.lit(after)))
    return pages.agg(
        F.lit(after).alias("after"),
        complete.cast("string").alias("completed_through"),
        F.count("*").alias("pages_fetched"),
    )


def fetch_bodies(
    listed: DataFrame, bodies: DataFrame, *, broadcast_bytes: int = BROADCAST_BYTES, broadcast_hashes: int = BROADCAST_HASHES
) -> DataFrame:
    """The body of each usable entry, once per listing of it, and whether it has
    `landed`: a body that has not is null, which is not an empty body.

    `bodies` (log_id, body) is much the larger side.  It is not shuffled if the
    entries are small enough to be sent to it, and only as far as it is listed
    if their hashes are.
    """
    usable = listed.where(F.col("problem").isNull()).select("page_no", "entry_no", "log_id")
    weight = F.coalesce(F.sum(F.octet_length("log_id") + 48), F.lit(0))
    size, entries_no = usable.agg(weight, F.count("*")).first()
    wanted = bodies.select("log_id", "body")
    side = F.broadcast(usable) if size <= broadcast_bytes else usable
    if size > broadcast_bytes and entries_no <= broadcast_hashes:
        hashes = usable.select(F.xxhash64("log_id").alias("hash")).distinct()
        wanted = wanted.withColumn("hash", F.xxhash64("log_id")).join(F.broadcast(hashes), "hash", "left_semi")
    found = wanted.join(side, "log_id").select("page_no", "entry_no", "log_id", "body", F.lit(True).alias("landed"))
    # Only the ids of the bodies are read for this.
    landed = bodies.select("log_id").join(side, "log_id", "left_semi")
    absent = usable.join(landed, "log_id", "left_anti")
    return found.unionByName(
        absent.select("page_no", "entry_no", "log_id", F.lit(None).cast("string").alias("body"), F.lit(False).alias("landed"))
    )


def requested(responses: DataFrame, event_type: str, after: str) -> DataFrame:
    """Landed listing responses of one event type past the cursor.  Where they
    are kept with `event_type` and `end_time` columns, the scan is filtered by
    them; a response without them is taken as what the service sent for it."""
    if "event_type" in responses.columns:
        responses = responses.where(F.col("event_type") == event_type)
    if "end_time" in responses.columns:
        kind = responses.schema["end_time"].dataType
        responses = responses.where(F.col("end_time") > F.lit(after).cast(kind))
    return responses
