"""Shared folders for checkpoints and intermediate tables."""

from __future__ import annotations

import tempfile
import uuid
from functools import cache

from pyspark.sql import DataFrame, SparkSession

SETTING = "spark.checkpoint.dir"


@cache
def _local_folder() -> str:
    return tempfile.mkdtemp(prefix="parcelmart-")


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors share, as the cluster names it.

    Only where the setting is absent and Spark runs in one local process (as
    in tests) is a temporary folder used.
    """
    folder = spark.conf.get(SETTING, None) or spark.sparkContext.getConf().get(SETTING)
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError(f"set {SETTING} to a folder all executors can reach")
    return _local_folder()


def fresh_folder(spark: SparkSession, name: str) -> str:
    """A new, unused folder below the shared one, deleted when the session's JVM ends."""
    folder = f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(path)
    return folder


def written(df: DataFrame, name: str) -> DataFrame:
    """A result stored once in the shared folder, and read from there."""
    folder = fresh_folder(df.sparkSession, name)
    df.write.parquet(folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder)
