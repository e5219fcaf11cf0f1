"""Joins on a range of time, as equi-joins on time bins."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parcelmart.functions.timeparts import epoch_seconds


def _bin(time: Column, seconds: int) -> Column:
    return F.floor(epoch_seconds(time) / seconds)


def within(
    left: DataFrame,
    right: DataFrame,
    keys: Sequence[str],
    left_time: str,
    right_time: str,
    seconds: int,
    before: int = 0,
) -> DataFrame:
    """Pairs of equal keys where ``right_time`` is in [left_time - before, left_time + seconds].

    Bins are as wide as the whole range: a right row goes to its own bin, a left row to the
    one or two bins its range meets. Keys and bin are the join's key, so no pair is formed that is
    more than two bins apart, and a key with very many rows is dealt out by its bins.
    Rows with a NULL key or time pair with nothing. Column names must differ but for the keys.
    """
    width = max(seconds + before, 1)
    start = F.col(left_time) - F.make_dt_interval(secs=F.lit(before))
    end = F.col(left_time) + F.make_dt_interval(secs=F.lit(seconds))
    bins = F.array_distinct(F.array(_bin(start, width), _bin(end, width)))
    spread = _known(left, [*keys, left_time]).withColumn("_bin", F.explode(bins))
    placed = _known(right, [*keys, right_time]).withColumn("_bin", _bin(F.col(right_time), width))
    return spread.join(placed, [*keys, "_bin"]).where(F.col(right_time).between(start, end)).drop("_bin")


def _known(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    for name in columns:
        df = df.where(F.col(name).isNotNull())
    return df
