"""Publishing marts.

Every refresh is a version of its own; readers find the newest whole one. A
refresh that fails changes nothing for them, and a reader that began before the
switch goes on with the version it found, which stays for ``keep`` refreshes.
"""

from __future__ import annotations

import json
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from parcelmart.functions.clock import ts_lit
from parcelmart.sources.versions import Versions

KEEP = 3


def stamped(df: DataFrame, now: datetime) -> DataFrame:
    """Add the refresh stamp."""
    return df.withColumn("refreshed_at", ts_lit(now))


def write_files(df: DataFrame, root: str, name: str, fmt: str = "parquet", keep: int = KEEP) -> str:
    """Publish a new version of the mart's folder, which is returned; read it with ``published``."""
    path = f"{root.rstrip('/')}/{name}"
    versions = Versions(df.sparkSession, path, keep)
    number = versions.current()[0] + 1
    folder = versions.new_folder(number)
    df.write.format(fmt).save(f"{path}/{folder}")
    versions.commit(number, {"folder": folder, "format": fmt, "schema": df.schema.json()})
    return path


def published(spark: SparkSession, path: str, version: int | None = None) -> DataFrame:
    """The mart's newest version (or a given one that is still held), resolved now and once."""
    versions = Versions(spark, path)
    number, found = versions.current()
    if version not in (None, number):
        found = versions.describe(version)
    if not found:
        raise FileNotFoundError(f"nothing is published at {path}")
    schema = StructType.fromJson(json.loads(found["schema"]))
    return spark.read.format(found["format"]).schema(schema).load(f"{path.rstrip('/')}/{found['folder']}")


def write_table(df: DataFrame, name: str, namespace: str, fmt: str = "parquet", keep: int = KEEP) -> str:
    """Publish a new version of the mart as a catalog table behind a view; the namespace picks database and schema.

    The view is what readers name; replacing it is one change of the catalog.
    """
    spark, view = df.sparkSession, f"{namespace}.{name}"
    numbers = table_versions(spark, name, namespace)
    number = (numbers[-1] if numbers else 0) + 1
    try:
        df.write.format(fmt).saveAsTable(_versioned(view, number))
        spark.sql(f"CREATE OR REPLACE VIEW {view} AS SELECT * FROM {_versioned(view, number)}")
    except Exception:
        # A failed refresh does not count among those kept.
        spark.sql(f"DROP TABLE IF EXISTS {_versioned(view, number)}")
        raise
    for old in [*numbers, number][:-keep]:
        spark.sql(f"DROP TABLE IF EXISTS {_versioned(view, old)}")
    return view


def _versioned(view: str, number: int) -> str:
    return f"{view}__v{number:012d}"


def table_versions(spark: SparkSession, name: str, namespace: str) -> list[int]:
    """Numbers of the mart's tables."""
    prefix = f"{name}__v".lower()
    rows = spark.sql(f"SHOW TABLES IN {namespace} LIKE '{prefix}*'").collect()
    found = [row["tableName"][len(prefix) :] for row in rows]
    return sorted(int(number) for number in found if number.isdigit())
