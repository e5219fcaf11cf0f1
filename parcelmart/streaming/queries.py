"""Streaming jobs run over the driver's event table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from parcelmart.sources.scratch import fresh_folder
from parcelmart.streaming.deltas import current_rows, read_log, summed_rows
from parcelmart.streaming.jobs import (
    HOURLY_SCHEMA,
    file_stream,
    hourly_counts,
    newest_in_batch,
    run_to_log,
)

EVENTS = (
    "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double,"
    " props string"
)
CHANGES = "user_id bigint, ts timestamp_ntz, event_id bigint, event_type string"


def _events(spark: SparkSession, sf_dir: str) -> DataFrame:
    # A pattern, so that both a single file and a folder of files are read.
    return file_stream(spark, f"{sf_dir.rstrip('/')}/events.parque[t]", EVENTS)


def events_per_hour_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events per hour and type, as sums of the micro-batches' counts."""
    folder = fresh_folder(spark, "events-per-hour")
    events = _events(spark, sf_dir).select("ts", "event_type")
    run_to_log(events, f"{folder}/log", f"{folder}/checkpoint", hourly_counts("ts", "event_type"))
    log = read_log(spark, f"{folder}/log", HOURLY_SCHEMA)
    return summed_rows(log, ["hour", "kind"], ["rows"])


def latest_event_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Newest event per user, kept up to date by upserts."""
    folder = fresh_folder(spark, "latest-event")
    keys, order = ["user_id"], ["ts", "event_id"]
    columns = ["user_id", "ts", "event_id", "event_type"]
    run_to_log(
        _events(spark, sf_dir).select(*columns),
        f"{folder}/log",
        f"{folder}/checkpoint",
        newest_in_batch(keys, order, columns),
    )
    return current_rows(read_log(spark, f"{folder}/log", CHANGES), keys, order)


QUERIES = {
    query.__name__: query for query in (events_per_hour_stream, latest_event_stream)
}
