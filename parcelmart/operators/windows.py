"""Window operators that stay balanced when one key is very large."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def previous_row(
    df: DataFrame,
    keys: Sequence[str],
    order: str,
    tie_breaks: Sequence[str],
    carry: Sequence[str],
    name: str = "previous",
    width: int = 16,
) -> DataFrame:
    """Add the preceding row of the same key as a struct of ``carry`` columns.

    A plain ``lag`` sorts a whole key in one task.  Here a key is cut into
    slices of ``width`` consecutive ``order`` values: the lag runs inside each
    slice, and the first row of a slice takes the last row of the slice
    before it, found among the last rows of all slices.

    Both uses of the slices read the same packed rows, so Spark shuffles (and
    computes) the input once and reuses it.  Rows without a key are left out.
    """
    known = df
    for key in keys:
        known = known.where(F.col(key).isNotNull())
    sort_columns = dict.fromkeys([*keys, order, *tie_breaks])
    packed = known.select(
        *sort_columns,
        F.floor(F.col(order) / width).alias("_slice"),
        F.struct(*df.columns).alias("_row"),
    )
    inside = Window.partitionBy(*keys, "_slice").orderBy(order, *tie_breaks)
    across = Window.partitionBy(*keys).orderBy("_slice")
    is_end = F.lead(F.lit(False), 1, True).over(inside)
    ends = (
        packed.withColumn("_is_end", is_end)
        .where("_is_end")
        .select(*keys, "_slice", F.lag("_row").over(across).alias("_far"))
        .where(F.col("_far").isNotNull())
    )
    before = F.coalesce(F.col("_near"), F.col("_far"))
    picked = F.struct(*[before[column].alias(column) for column in carry])
    return (
        packed.withColumn("_near", F.lag("_row").over(inside))
        .join(ends, [*keys, "_slice"], "left")
        .select("_row.*", F.when(before.isNotNull(), picked).alias(name))
    )
