"""Streams drained over several batches, replayed and compacted."""

from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from parcelmart.streaming.deltas import batch_writer, compact, current_rows, read_log, summed_rows
from parcelmart.streaming.jobs import (
    HOURLY_SCHEMA,
    file_stream,
    hourly_counts,
    newest_in_batch,
    run_to_log,
)

SCHEMA = "id bigint, parcel_id bigint, date timestamp_ntz, kind string"
START = datetime(2024, 1, 1)


def add_file(spark, path, first, count):
    rows = [
        (i, i % 7, START + timedelta(minutes=7 * i), "a" if i % 3 else "b")
        for i in range(first, first + count)
    ]
    spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(path)


@pytest.fixture()
def folders(tmp_path):
    return {name: str(tmp_path / name) for name in ("in", "log", "state", "compacted")}


def counted(spark, folders, compacted=None):
    log = read_log(spark, folders["log"], HOURLY_SCHEMA, compacted)
    return sorted(summed_rows(log, ["hour", "kind"], ["rows"]).collect())


def test_hourly_counts_of_files_in_reverse_order_equal_the_batch_result(spark, folders):
    """Newest rows first, one file per batch: nothing is too late to count."""
    sums = lambda log: summed_rows(log, ["hour", "kind"], ["rows"])
    for n, first in enumerate((800, 400, 0)):
        add_file(spark, folders["in"], first, 40)
        stream = file_stream(spark, folders["in"], SCHEMA, files_per_batch=1)
        run_to_log(stream, folders["log"], folders["state"], hourly_counts("date", "kind"))
        if n == 1:
            assert compact(spark, folders["log"], HOURLY_SCHEMA, folders["compacted"], sums) == 1
    expected = sorted(
        spark.read.schema(SCHEMA)
        .parquet(folders["in"])
        .groupBy(F.date_trunc("hour", "date").cast("timestamp_ntz").alias("hour"), "kind")
        .agg(F.count("*").alias("rows"))
        .collect()
    )
    assert counted(spark, folders) == expected
    # The fold and the batch after it, then a fold of that fold.
    assert counted(spark, folders, folders["compacted"]) == expected
    assert compact(spark, folders["log"], HOURLY_SCHEMA, folders["compacted"], sums) == 2
    assert counted(spark, folders, folders["compacted"]) == expected


def test_a_stream_without_input_is_an_empty_log(spark, folders):
    spark.createDataFrame([], SCHEMA).write.parquet(folders["in"])
    stream = file_stream(spark, folders["in"] + "/none*", SCHEMA)
    run_to_log(stream, folders["log"], folders["state"], hourly_counts("date", "kind"))
    assert counted(spark, folders) == []
    assert compact(spark, folders["log"], HOURLY_SCHEMA, folders["compacted"], lambda log: log) is None
    assert counted(spark, folders, folders["compacted"]) == []


def test_latest_scan_survives_replay_and_compaction(spark, folders):
    keys, order = ["parcel_id"], ["date", "id"]
    columns = ["parcel_id", "date", "id", "kind"]
    schema = "parcel_id bigint, date timestamp_ntz, id bigint, kind string"
    reduce = newest_in_batch(keys, order, columns)
    for first in (0, 30):
        add_file(spark, folders["in"], first, 30)
        stream = file_stream(spark, folders["in"], SCHEMA, files_per_batch=1)
        run_to_log(stream.select(*columns), folders["log"], folders["state"], reduce)
    log = read_log(spark, folders["log"], schema)
    before = sorted(current_rows(log, keys, order).collect())
    assert [row["id"] for row in before] == [56, 57, 58, 59, 53, 54, 55]
    # The same batch written again replaces its folder.
    batch = spark.read.schema(SCHEMA).parquet(folders["in"]).where("id >= 30")
    newest = log.agg(F.max("batch")).first()[0]
    batch_writer(folders["log"], reduce)(batch, newest)
    again = current_rows(read_log(spark, folders["log"], schema), keys, order)
    assert sorted(again.collect()) == before
    assert compact(spark, folders["log"], schema, folders["compacted"], lambda x: current_rows(x, keys, order)) == newest
    folded = read_log(spark, folders["compacted"], schema)
    assert folded.count() == 7
    assert sorted(folded.drop("batch").collect()) == before
