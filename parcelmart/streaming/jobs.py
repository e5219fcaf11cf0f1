"""Streaming jobs.

The batch marts recompute these tables on a schedule; here they are updated
as rows arrive.  ``availableNow`` drains what is there and stops, so the same
job also runs on a schedule.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from parcelmart.functions.timeparts import epoch_seconds, utc_of
from parcelmart.operators.joins import latest_per_key
from parcelmart.streaming.deltas import batch_writer

HOURLY_SCHEMA = "hour timestamp_ntz, kind string, rows bigint"


def file_stream(spark: SparkSession, path: str, schema: str, files_per_batch: int = 64) -> DataFrame:
    """New parquet files as a stream with a declared schema."""
    return (
        spark.readStream.schema(schema)
        .option("maxFilesPerTrigger", files_per_batch)
        .parquet(path)
    )


def hourly_counts(time: str, kind: str):
    """Reduce a micro-batch to its rows per UTC hour and kind.

    The counts are partial: readers sum the batches.  No state is kept and no
    row is late, whatever the order files arrive in.
    """

    def reduce(batch: DataFrame) -> DataFrame:
        # By seconds, so the session's time zone has no part in it.
        hour = utc_of(F.floor(epoch_seconds(F.col(time)) / 3600) * 3600)
        return batch.groupBy(hour.alias("hour"), F.col(kind).alias("kind")).agg(
            F.count("*").alias("rows")
        )

    return reduce


def run_to_log(rows: DataFrame, path: str, checkpoint: str, reduce=None) -> StreamingQuery:
    """Drain a stream into a batch log; returns the finished query."""
    writer = batch_writer(path, reduce) if reduce else batch_writer(path)
    query = (
        rows.writeStream.outputMode("append")
        .foreachBatch(writer)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return query


def newest_in_batch(keys: Sequence[str], order: Sequence[str], columns: Sequence[str]):
    """Reduce a micro-batch of changes to its newest row per key."""

    def reduce(batch: DataFrame) -> DataFrame:
        carry = [name for name in columns if name not in keys and name not in order]
        return latest_per_key(batch, keys, order, carry).select(*columns)

    return reduce
