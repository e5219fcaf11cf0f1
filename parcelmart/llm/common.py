"""Helpers the training-data operators share."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from parcelmart.sources.scratch import fresh_folder

# ASCII white space separates words in every operator that counts words.
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_path(spark: SparkSession, name: str) -> str:
    """A new folder all executors share, deleted when the session's JVM ends."""
    folder = fresh_folder(spark, name)
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(path)
    return folder


REMOVE_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def shuffles_removed(spark: SparkSession) -> Iterator[None]:
    """Shuffle files of queries that run inside go when the query has ended, not when the driver collects garbage."""
    before = spark.conf.get(REMOVE_SHUFFLES, "false")
    spark.conf.set(REMOVE_SHUFFLES, "true")
    try:
        yield
    finally:
        spark.conf.set(REMOVE_SHUFFLES, before)


def stage(df: DataFrame, name: str, partition_by: str | None = None) -> DataFrame:
    """Write a DataFrame to the shared folder and read it back: the lineage ends here, and its shuffles are of no more use."""
    spark = df.sparkSession
    folder = shared_path(spark, name)
    writer = df.write.option("compression", "zstd")
    with shuffles_removed(spark):
        (writer.partitionBy(partition_by) if partition_by else writer).parquet(folder)
    return spark.read.schema(df.schema).parquet(folder)


def written_place(df: DataFrame) -> Column:
    """What puts the rows of written Parquet into the order in which a job's tasks wrote them.

    Readers deal files out by size, so this is number and piece of the part file (else its path) and
    the row in it. Rows that are not read from Parquet count in the order of their partitions.
    """
    try:
        meta = df.metadataColumn("_metadata")
        df.select(meta["file_name"], meta["row_index"])
    except AnalysisException:
        return F.struct(F.monotonically_increasing_id().alias("row"))
    number = lambda pattern: F.regexp_extract(meta["file_name"], pattern, 1).try_cast("long")
    part = number(r"^part-(\d+)")
    other = F.when(part.isNull(), meta["file_path"])
    return F.struct(part.alias("part"), number(r"-c(\d+)\.").alias("piece"), other.alias("file"), meta["row_index"].alias("row"))


def without(df: DataFrame, *names: str) -> DataFrame:
    """The input without columns whose names (in any case) an operator will add."""
    taken = {name.lower() for name in names}
    return df.select(*(F.col(quoted(c)) for c in df.columns if c.lower() not in taken))


def packed(df: DataFrame, name: str):
    """All columns as one struct, so that no name of theirs can clash with an operator's own."""
    return F.struct(*(F.col(quoted(c)) for c in df.columns)).alias(name)


def quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def doc_key(doc_id: Column | str) -> Column:
    """crc32 of the id as text (a null id counts as an empty text)."""
    column = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    return F.crc32(F.coalesce(column.cast("string"), F.lit("")).cast("binary"))


def parallelism(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def ranked(rows: DataFrame, group: str, order: list[str], unkept: tuple[str, ...] = ()) -> DataFrame:
    """Rows with `rank` (from 0, within their group) and `total` (rows of the group), without columns only the order needs.

    A group is not held in one task: rows are range-sorted by group and order, written, and
    numbered by the counts of the parts before theirs. `group` must not be null; rows that tie in
    `order` keep any order among themselves.
    """
    keys = [group, *order, "_tie"]
    spread = rows.withColumn("_tie", F.monotonically_increasing_id())
    spread = spread.repartitionByRange(parallelism(rows.sparkSession), *keys).sortWithinPartitions(*keys).drop("_tie", *unkept)
    row = F.monotonically_increasing_id().bitwiseAND((1 << 33) - 1)
    placed = stage(spread.withColumns({"_part": F.spark_partition_id(), "_row": row}), "ranked")
    counts = placed.groupBy(group, "_part").agg(F.min("_row").alias("_first"), F.count("*").alias("_n"))
    whole = W.partitionBy(group)
    before = F.coalesce(F.sum("_n").over(whole.orderBy("_part").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    shifts = counts.select(group, "_part", (before - F.col("_first")).alias("_shift"), F.sum("_n").over(whole).alias("total"))
    numbered = placed.join(shifts, [group, "_part"])
    return numbered.withColumn("rank", F.col("_row") + F.col("_shift")).select(*(c for c in rows.columns if c not in unkept), "rank", "total")
