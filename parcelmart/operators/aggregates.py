"""Aggregations the marts share."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def count_where(condition: Column, weight: Column | None = None) -> Column:
    """Rows (or summed weights) for which the condition is true; never NULL."""
    if weight is None:
        return F.count_if(condition)
    return F.sum(F.when(condition, weight).otherwise(0))


def count_distinct_where(condition: Column, value: Column) -> Column:
    return F.count_distinct(F.when(condition, value))


def category_columns(
    categories: Iterable[str], merged: Mapping[str, str] | None = None
) -> dict[str, list[str]]:
    """Output column to the categories it counts, in the given order."""
    columns: dict[str, list[str]] = {}
    for category in categories:
        target = (merged or {}).get(category, category)
        columns.setdefault(target.lower(), []).append(category)
    return columns


def pivot_counts(
    category: Column, columns: Mapping[str, Sequence[str]], weight: Column | None = None
) -> list[Column]:
    """One count per known category, all from a single pass."""
    return [
        count_where(category.isin(*names), weight).alias(name)
        for name, names in columns.items()
    ]


def ratio(part: Column, whole: Column, scale: int = 1) -> Column:
    """``part / whole * scale``; NULL for an empty whole."""
    result = F.try_divide(part.cast("double"), whole.cast("double"))
    return result if scale == 1 else result * scale


def concat_distinct(
    df: DataFrame,
    keys: Sequence[str],
    values: Sequence[str],
    separator: str,
    smallest: Sequence[str] = (),
) -> DataFrame:
    """Distinct values of each key as one ordered text per value column.

    All value columns are stacked and their duplicates removed by one hash
    aggregation first, so only the values that appear in the output reach the
    concatenation.  ``smallest`` columns are reduced to their minimum on the
    way.
    """

    def text(name: str) -> Column:
        listed = F.expr(
            f"listagg(IF(_name = '{name}', _value, NULL), '{separator}')"
            " WITHIN GROUP (ORDER BY _value)"
        )
        return listed.alias(name)

    stacked = ", ".join(f"'{name}', {name}" for name in values)
    minima = [F.min(name).alias(name) for name in smallest]
    distinct = (
        df.select(
            *keys, *smallest, F.expr(f"stack({len(values)}, {stacked}) AS (_name, _value)")
        )
        .groupBy(*keys, "_name", "_value")
        .agg(F.count("*").alias("_rows"), *minima)
    )
    return distinct.groupBy(*keys).agg(*[text(name) for name in values], *minima)


def with_total(counts: DataFrame, entity: str, group: str, measure: str, label: str) -> DataFrame:
    """Per-group counts of each entity plus one row for all its groups.

    ``counts`` holds one row per (entity, group); the total is summed from it,
    so the base rows are read once.  Rows with a NULL group (no match in the
    group's dimension) belong to the total only.
    """
    total = (
        counts.groupBy(entity)
        .agg(F.sum(measure).alias(measure))
        .select(F.lit(label).alias(group), entity, measure)
    )
    return total.unionByName(
        counts.where(F.col(group).isNotNull()).select(group, entity, measure)
    )
