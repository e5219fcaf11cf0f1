"""JSON text taken apart once: parsed to a variant, its wanted paths as typed columns."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def parsed(text: Column | str) -> Column:
    """The text as a variant; malformed text is NULL."""
    return F.try_parse_json(text)


def path_columns(variant: Column | str, paths: Mapping[str, tuple[str, str]]) -> dict[str, Column]:
    """One column per name: its path in the variant as the given type; NULL where absent or of another kind."""
    value = F.col(variant) if isinstance(variant, str) else variant
    return {name: F.try_variant_get(value, path, kind) for name, (path, kind) in paths.items()}


def taken_apart(df: DataFrame, text: str, paths: Mapping[str, tuple[str, str]], keep: str | None = None) -> DataFrame:
    """Replace a JSON column by the wanted paths' columns, parsing each text once; ``keep`` names the variant if it stays."""
    name = keep or "_variant"
    out = df.withColumn(name, parsed(text)).drop(text).withColumns(path_columns(name, paths))
    return out if keep else out.drop(name)


def found_paths(df: DataFrame, text: str) -> str | None:
    """Which paths the texts have, of which types, as one schema; None without any text that parses."""
    return df.agg(F.schema_of_variant_agg(parsed(text))).first()[0]
