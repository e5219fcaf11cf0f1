"""Text helpers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def plain_plate(value: Column) -> Column:
    """Number plate in capitals without blanks and dashes."""
    return F.translate(F.upper(F.trim(value)), "- ", "")


def comparable_plate(value: Column) -> Column:
    """Plate with zero and the letter O folded together."""
    return F.translate(plain_plate(value), "0", "O")


def compare_text(left: Column, right: Column) -> Column:
    """-1, 0 or 1 by order; NULL if either side is NULL."""
    return F.when(left == right, 0).when(left < right, -1).when(left > right, 1)


def joined(separator: str, *parts: Column) -> Column:
    """Concatenation that is NULL as soon as one part is."""
    pieces = [parts[0]]
    for part in parts[1:]:
        pieces += [F.lit(separator), part]
    return F.concat(*pieces)


def admin_link(base: str, kind: str, key: Column) -> Column:
    return F.concat(F.lit(f"{base}{kind}/"), key.cast("string"))
