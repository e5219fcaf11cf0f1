"""Result tables kept as a log of small batch folders.

Every micro-batch overwrites the folder of its own batch id, so a batch that
is replayed after a failure replaces its earlier attempt instead of adding to
it.  Readers fold the batches: the newest row per key, or sums per key.
``compact`` folds old batches into one when the log grows long, and readers take
the folded rows and the batches after them.  No batch rewrites the whole table.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from parcelmart.operators.joins import latest_per_key

BATCH = "batch"

Fold = Callable[[DataFrame], DataFrame]


def batch_writer(path: str, reduce: Fold = lambda batch: batch) -> Callable[[DataFrame, int], None]:
    """A ``foreachBatch`` function that stores each reduced micro-batch."""

    def write(batch: DataFrame, batch_id: int) -> None:
        reduce(batch).write.mode("overwrite").parquet(f"{path}/{BATCH}={batch_id}")

    return write


def _exists(spark: SparkSession, path: str) -> bool:
    found = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return found.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(found)


def read_log(spark: SparkSession, path: str, schema: str, compacted: str | None = None) -> DataFrame:
    """All batches with their id as the ``batch`` column.

    With a folder that ``compact`` has written, its newest fold stands for the
    batches up to its own id.  A stream that has had no input has no folder
    yet, which is an empty log.
    """
    schema = f"{schema}, {BATCH} bigint"
    empty = spark.createDataFrame([], schema)
    log = spark.read.schema(schema).parquet(path) if _exists(spark, path) else empty
    if compacted is None or not _exists(spark, compacted):
        return log
    folds = spark.read.schema(schema).parquet(compacted)
    upto = folds.agg(F.max(BATCH)).first()[0]
    if upto is None:
        return log
    return folds.where(F.col(BATCH) == upto).unionByName(log.where(F.col(BATCH) > upto))


def current_rows(log: DataFrame, keys: Sequence[str], order: Sequence[str] = (BATCH,)) -> DataFrame:
    """Newest row per key, by default the one of the latest batch."""
    carry = [name for name in log.columns if name not in keys and name not in order]
    return latest_per_key(log, keys, order, carry).select(*log.columns).drop(BATCH)


def summed_rows(log: DataFrame, keys: Sequence[str], values: Sequence[str]) -> DataFrame:
    """Sums of the batches' partial values per key."""
    return log.groupBy(*keys).agg(*(F.sum(name).alias(name) for name in values))


def compact(
    spark: SparkSession, path: str, schema: str, target: str, fold: Fold
) -> int | None:
    """Fold the log into one batch folder under ``target``, by ``current_rows`` or ``summed_rows``.

    An earlier fold there is taken in.  The folder takes the id of the newest
    batch read, which is returned; an empty log writes nothing and returns None.
    """
    log = read_log(spark, path, schema, target)
    newest = log.agg(F.max(BATCH)).first()[0]
    if newest is None:
        return None
    folder = f"{target}/{BATCH}={newest}"
    if not _exists(spark, f"{folder}/_SUCCESS"):
        fold(log.where(F.col(BATCH) <= newest)).write.mode("overwrite").parquet(folder)
    return newest
