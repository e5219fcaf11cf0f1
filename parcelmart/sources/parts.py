"""Tables kept in parts (hash buckets, days) of which a change rewrites only those it touches."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from parcelmart.sources.versions import Conflict, Versions

PART = "_part"


class PartStore:
    """Parquet folders, one per part, and a version that says which folder holds which part.

    A folder is written by one version and never changed. The driver holds one
    name per part: choose parts so that their number is bounded.
    """

    def __init__(self, spark: SparkSession, root: str, schema: StructType | str, keep: int = 3) -> None:
        self.spark, self.root = spark, root.rstrip("/")
        self.schema = StructType.fromDDL(schema) if isinstance(schema, str) else schema
        self.versions = Versions(spark, root, keep)

    def settings(self) -> dict:
        return self.versions.current()[1].get("settings", {})

    def parts(self) -> dict[str, str]:
        return self.versions.current()[1].get("parts", {})

    def read(self, wanted: Iterable[str] | None = None) -> DataFrame:
        """The given parts (all by default) as of now; parts that do not exist are empty."""
        return self.read_version(self.parts(), wanted)

    def read_version(self, parts: dict[str, str], wanted: Iterable[str] | None = None) -> DataFrame:
        """The same as of another version's ``parts``."""
        names = parts if wanted is None else [name for name in wanted if name in parts]
        paths = sorted(f"{self.root}/{parts[name]}/{PART}={name}" for name in names)
        if not paths:
            return self.spark.createDataFrame([], self.schema)
        return self.spark.read.schema(self.schema).parquet(*paths)

    def replace(self, rows: DataFrame, part: str, touched: Iterable[str], since: int, settings: dict | None = None) -> int:
        """Rewrite the touched parts with ``rows``, whose column ``part`` names each row's; returns the version.

        ``since`` is the version that ``rows`` was made from: Conflict if it is no longer the current one.
        A touched part without rows is gone; other parts stay as they are.
        """
        number, current = self.versions.current()
        if number != since:
            raise Conflict(f"{self.root} has changed since version {since}")
        folder = self.versions.new_folder(number + 1)
        columns = [F.col(field.name) for field in self.schema.fields]
        rows.select(*columns, F.col(part).cast("string").alias(PART)).write.partitionBy(PART).parquet(f"{self.root}/{folder}")
        written = [name.split("=", 1)[1] for name in self.versions.files.names(folder) if name.startswith(f"{PART}=")]
        touched = set(touched)
        if not touched.issuperset(written):
            raise ValueError(f"rows of parts that are not rewritten: {sorted(set(written) - touched)[:5]}")
        parts = {name: place for name, place in current.get("parts", {}).items() if name not in touched}
        merged = {"parts": parts | dict.fromkeys(written, folder), "settings": current.get("settings", {}) | (settings or {})}
        self.versions.commit(number + 1, merged)
        return number + 1
