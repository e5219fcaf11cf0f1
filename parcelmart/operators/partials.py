"""Rolling windows from partial results per day.

A window of months is not counted anew at each refresh: every day keeps its
counts per group, a change batch adds what it changes to the days it concerns,
and a window is the sum of its days. A row that changes is taken out with what it
counted before and put in with what it counts now, so an order cancelled later
leaves the day it was created on. Only what can be taken out again may be kept
this way: counts and sums of exact numbers, no extremes, averages as two sums.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from parcelmart.operators.changes import BucketedState
from parcelmart.sources.parts import PartStore

DAY = "day"


def contributions(
    changes: DataFrame, day: Column, groups: Mapping[str, Column], measures: Mapping[str, Column], counted: Column | None = None
) -> DataFrame:
    """What changed rows (with ``sign``) add to the days' measures; rows for which ``counted`` is not true count nothing.

    A measure is a row's exact number, such as ``lit(1)`` for a count.
    """
    rows = changes if counted is None else changes.where(counted)
    return (
        rows.select(day.alias(DAY), *[column.alias(name) for name, column in groups.items()], *[(column * F.col("sign")).alias(name) for name, column in measures.items()])
        .where(F.col(DAY).isNotNull())
        .groupBy(DAY, *groups)
        .agg(*[F.sum(name).alias(name) for name in measures])
        .where(_any_nonzero(measures))
    )


def _any_nonzero(measures: Iterable[str]) -> Column:
    tests = [F.coalesce(F.col(name), F.lit(0)) != 0 for name in measures]
    found = tests[0]
    for test in tests[1:]:
        found = found | test
    return found


class DailyPartials:
    """Counts per day and group, one part of a store per day."""

    def __init__(self, spark: SparkSession, root: str, groups: str, measures: str, keep: int = 3) -> None:
        """``groups`` and ``measures`` are DDL, such as ``"buyer_id long"`` and ``"orders long"``."""
        named = [StructType.fromDDL(ddl) for ddl in (groups, measures)]
        self.groups, self.measures = ([field.name for field in part.fields] for part in named)
        self.store = PartStore(spark, root, StructType.fromDDL(f"{DAY} date, {groups}, {measures}"), keep)

    def source(self) -> int:
        """The version of the table up to which changes are counted; 0 before the first."""
        return self.store.settings().get("source", 0)

    def add(self, changed: DataFrame, source: int) -> list[str]:
        """Add what changed (day, groups, measures) up to a version of the table; returns the days rewritten.

        Days and version are switched together, so a refresh that fails is repeated from where it began.
        """
        since = self.store.versions.current()[0]
        days = sorted(str(row[0]) for row in changed.select(DAY).distinct().collect())  # one value per changed day
        columns = [F.col(field.name).cast(field.dataType) for field in self.store.schema.fields]
        both = self.store.read(days).unionByName(changed.select(*columns))
        summed = both.groupBy(DAY, *self.groups).agg(*[F.sum(name).alias(name) for name in self.measures])
        # Few files per day: each day's groups are already few rows.
        self.store.replace(summed.where(_any_nonzero(self.measures)).repartition(DAY), DAY, days, since, {"source": source})
        return days

    def refresh(self, table: BucketedState, day: Column, groups: Mapping[str, Column], measures: Mapping[str, Column], counted: Column | None = None) -> list[str]:
        """Count what changed in a replicated table since the last refresh; returns the days rewritten."""
        now = table.store.versions.current()[0]
        if now == self.source():
            return []
        return self.add(contributions(table.changes_since(self.source(), now), day, groups, measures, counted), now)

    def days(self, first: date | None = None, last: date | None = None) -> DataFrame:
        """The partials of the days from ``first`` to ``last``, both included; other days' files are not opened."""
        held = self.store.parts()
        wanted = [day for day in held if (first is None or day >= first.isoformat()) and (last is None or day <= last.isoformat())]
        return self.store.read(wanted)

    def window(self, first: date | None = None, last: date | None = None, by: Sequence[str] | None = None) -> DataFrame:
        """Measures of a window summed by some of the groups (all by default); ``day`` may be one of them."""
        return (
            self.days(first, last)
            .groupBy(*(self.groups if by is None else by))
            .agg(*[F.sum(name).alias(name) for name in self.measures])
            .where(_any_nonzero(self.measures))
        )
