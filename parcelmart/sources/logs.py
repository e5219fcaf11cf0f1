"""Logs stored so that a mart reads the days and buckets it needs.

A log is a catalog table partitioned by the day (or week, month) of its time and bucketed by the key it is
joined on: days before those that matter are not opened, and a join on the key moves the other side only.
"""

from __future__ import annotations

from collections.abc import Mapping
from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parcelmart.sources.schemas import schema_of
from parcelmart.sources.tables import Tables

LOG_DAY = "log_day"


def store_log(rows: DataFrame, table: str, time: str, key: str, buckets: int, grain: str = "day") -> None:
    """Write a log's rows to a new catalog table; a day (or ``grain``: week, month) and bucket are one file."""
    (
        rows.withColumn(LOG_DAY, first_day(F.col(time), grain))
        .repartition(LOG_DAY, F.pmod(F.hash(key), F.lit(buckets)))
        .write.partitionBy(LOG_DAY)
        .bucketBy(buckets, key)
        .sortBy(key)
        .format("parquet")
        .saveAsTable(table)
    )


def first_day(moment: Column, grain: str) -> Column:
    day = F.to_date(moment)
    return day if grain == "day" else F.trunc(day, grain)


class StoredLogs(Tables):
    """Another source whose logs are read from their stored tables."""

    def __init__(self, tables: Tables, stored: Mapping[str, str], grain: str = "day") -> None:
        super().__init__(tables.spark)
        self.tables, self.stored, self.grain = tables, dict(stored), grain

    def begin_refresh(self) -> None:
        self.tables.begin_refresh()

    def load(self, name: str, wanted: frozenset[str]) -> DataFrame:
        if name in self.stored:
            return self.spark.read.table(self.stored[name]).drop(LOG_DAY)
        return self.tables.load(name, wanted)

    def log(self, name: str, *columns: str, since: date | Column | None = None) -> DataFrame:
        if name not in self.stored or since is None:
            return self(name, *columns)
        first = first_day(F.lit(since) if isinstance(since, date) else since, self.grain)
        return self.spark.read.table(self.stored[name]).where(F.col(LOG_DAY) >= first).selectExpr(*columns)


def stored_logs(
    tables: Tables, namespace: str, logs: Mapping[str, tuple[str, str]], buckets: int, grain: str = "day"
) -> StoredLogs:
    """Store the named logs (time column, key column) of a source and serve them with its tables."""
    names = {}
    for name, (time, key) in logs.items():
        names[name] = f"{namespace}.{name}"
        columns = [field.split(" ")[0] for field in schema_of(name).replace(", ", ",").split(",")]
        store_log(tables(name, *columns), names[name], time, key, buckets, grain)
    return StoredLogs(tables, names, grain)
