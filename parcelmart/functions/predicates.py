"""Reusable business predicates."""

from __future__ import annotations

from collections.abc import Iterable
from datetime import date

from pyspark.sql import Column
from pyspark.sql import functions as F


def on_or_between(value: Column, first: date, last: date) -> Column:
    return value.between(F.lit(first), F.lit(last))


def billable(
    cancelled_at: Column,
    deadline: Column,
    category: Column | None = None,
    categories: Iterable[str] | None = None,
) -> Column:
    """Not cancelled, or cancelled strictly after the deadline.

    ``cancelled_at`` is NULL for attempts without a cancellation.  With
    ``categories`` only late cancellations of those kinds are billed.
    """
    late = cancelled_at > deadline
    if categories is not None:
        late = late & category.isin(*categories)
    return cancelled_at.isNull() | late


def same_text(left: Column, right: Column | str) -> Column:
    """Equality that ignores letter case."""
    right = F.lit(right) if isinstance(right, str) else right
    return F.lower(left) == F.lower(right)


def like_any_case(value: Column, pattern: str) -> Column:
    return F.lower(value).like(pattern.lower())


def json_path_set(text: Column, path: str) -> Column:
    """The path exists and is not JSON null; bad JSON counts as absent."""
    return F.get_json_object(text, path).isNotNull()
