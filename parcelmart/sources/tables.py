"""Table sources.

A source is a callable ``tables(name, *columns) -> DataFrame``.  Marts name the
columns they need (``"id as order_id"``), which keeps join keys unambiguous and
every scan narrow.
"""

from __future__ import annotations

from abc import ABC, abstractmethod
from collections.abc import Mapping
from dataclasses import dataclass
from datetime import date, datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from parcelmart.sources.schemas import database_of, schema_of


class Tables(ABC):
    """Common interface of all sources."""

    def __init__(self, spark: SparkSession) -> None:
        self.spark = spark

    def begin_refresh(self) -> None:
        """Called before a refresh: what was fitted to the data is fitted anew."""

    @abstractmethod
    def load(self, name: str, wanted: frozenset[str]) -> DataFrame:
        """The table with at least the wanted columns."""

    def __call__(self, name: str, *columns: str) -> DataFrame:
        wanted = frozenset(column.split(" as ")[0].split(".")[0].strip() for column in columns)
        df = self.load(name, wanted)
        return df.selectExpr(*columns) if columns else df

    def log(self, name: str, *columns: str, since: date | Column | None = None) -> DataFrame:
        """Rows of a log of which those before the day ``since`` (a moment of another table, or a date) do not matter.

        A source that stores its logs by day does not open earlier days.
        """
        return self(name, *columns)


class ParquetTables(Tables):
    """One parquet folder per table, read with the declared schema."""

    def __init__(self, spark: SparkSession, root: str) -> None:
        super().__init__(spark)
        self.root = root.rstrip("/")

    def load(self, name: str, wanted: frozenset[str]) -> DataFrame:
        return self.spark.read.schema(schema_of(name)).parquet(f"{self.root}/{name}")


class CatalogTables(Tables):
    """Catalog tables; the two databases may live in different schemas."""

    def __init__(self, spark: SparkSession, namespaces: Mapping[str, str]) -> None:
        super().__init__(spark)
        self.namespaces = dict(namespaces)

    def load(self, name: str, wanted: frozenset[str]) -> DataFrame:
        return self.spark.read.table(f"{self.namespaces[database_of(name)]}.{name}")


@dataclass(frozen=True)
class Split:
    """How to cut a table into parallel range reads."""

    column: str
    lower: int | date | datetime
    upper: int | date | datetime
    partitions: int = 4

    def options(self) -> dict[str, str]:
        return {
            "partitionColumn": self.column,
            "lowerBound": str(self.lower),
            "upperBound": str(self.upper),
            "numPartitions": str(self.partitions),
        }


@dataclass(frozen=True)
class Strides:
    """Range reads of equal width between the bounds that the table has at each refresh."""

    column: str
    partitions: int = 4


@dataclass(frozen=True)
class Shares:
    """Range reads of about equally many rows, fitted to the table at each refresh.

    A value with more rows than a share is dealt out by the integer column ``spread``.
    """

    column: str
    partitions: int = 4
    spread: str | None = None


@dataclass(frozen=True)
class Cuts:
    """Where shares of a column begin: the smallest value of each, NULL first; repeats mark values of several shares."""

    column: str
    starts: tuple
    spread: str | None = None

    def predicates(self) -> list[str]:
        """SQL conditions of which every row fulfils exactly one, rows with NULL too."""
        counts: dict = {}
        for value in self.starts:
            counts[value] = counts.get(value, 0) + 1
        values = sorted((value for value in counts if value is not None))
        # One condition or more for NULL; it goes with the first share if no share begins with it.
        found = self._dealt(f"{self.column} IS NULL", counts[None]) if None in counts else []
        if not values:
            return found + [f"{self.column} IS NOT NULL"] if found else ["1 = 1"]
        below = f"{self.column} < {sql_literal(values[0])}"
        found.append(below if None in counts else f"({below} OR {self.column} IS NULL)")
        for value, following in zip(values, [*values[1:], None], strict=True):
            begin, end = sql_literal(value), "" if following is None else f" AND {self.column} < {sql_literal(following)}"
            if counts[value] > 1:
                # Its rows fill all shares it begins but the last, and may reach into both beside them.
                found += self._dealt(f"{self.column} = {begin}", counts[value])
                found.append(f"{self.column} > {begin}{end}")
            else:
                found.append(f"{self.column} >= {begin}{end}")
        return found

    def _dealt(self, condition: str, parts: int) -> list[str]:
        if self.spread is None or parts < 2:
            return [condition]
        rest = f"ABS(MOD({self.spread}, {parts}))"
        others = ", ".join(map(str, range(1, parts)))
        first = f"{condition} AND ({rest} NOT IN ({others}) OR {self.spread} IS NULL)"
        return [first, *[f"{condition} AND {rest} = {n}" for n in range(1, parts)]]


def sql_literal(value) -> str:
    if isinstance(value, datetime):
        return f"TIMESTAMP '{value.isoformat(' ')}'"
    if isinstance(value, date):
        return f"DATE '{value.isoformat()}'"
    if isinstance(value, str):
        return "'" + value.replace("'", "''") + "'"
    return str(value)


def fitted_cuts(df: DataFrame, column: str, partitions: int, spread: str | None = None) -> Cuts:
    """Shares of a DataFrame's rows by one aggregation; of numbers, dates or timestamps."""
    ranks = [n / partitions for n in range(partitions)]
    row = df.agg(
        F.percentile_approx(column, ranks, 100 * partitions).alias("starts"),
        F.count(column).alias("known"),
        F.count("*").alias("rows"),
    ).first()
    share = max(row["rows"], 1) / partitions
    nulls = round((row["rows"] - row["known"]) / share)
    # The known values' quantiles, as many as their part of the rows makes shares.
    starts = row["starts"] or []
    kept = max(partitions - nulls, 1)
    chosen = [starts[n * partitions // kept] for n in range(kept)] if starts else []
    return Cuts(column, (*[None] * nulls, *chosen), spread)


class JdbcTables(Tables):
    """Tables of a row store, read in parallel ranges.

    Filters and column lists are pushed to the server; joins and aggregation
    run in Spark.  ``connection`` holds url, user, password and driver with
    ``{database}`` left open in the url; nothing about a deployment is fixed
    here.
    """

    def __init__(
        self,
        spark: SparkSession,
        connection: Mapping[str, str],
        databases: Mapping[str, str],
        splits: Mapping[str, Split | Strides | Shares] | None = None,
        fetch_size: int = 2000,
    ) -> None:
        super().__init__(spark)
        self._fitted: dict[str, Split | Cuts | None] = {}
        self.connection = dict(connection)
        self.databases = dict(databases)
        self.splits = dict(splits or {})
        self.fetch_size = fetch_size

    def options(self, relation: str, database: str, split: Split | None = None) -> dict[str, str]:
        url = self.connection["url"].format(database=self.databases[database])
        options = {
            **self.connection,
            "url": url,
            "dbtable": relation,
            "fetchsize": str(self.fetch_size),
            # The server's datetimes carry no zone.
            "preferTimestampNTZ": "true",
        }
        return options | (split.options() if split else {})

    def relation(self, name: str) -> str:
        """The table, or for one with points a query that takes them apart on the server."""
        fields = declared(name).fields
        if not any(isinstance(field.dataType, StructType) for field in fields):
            return name
        parts = [
            f"ST_X({f.name}) AS {f.name}_x, ST_Y({f.name}) AS {f.name}_y"
            if isinstance(f.dataType, StructType)
            else f.name
            for f in fields
        ]
        return f"(SELECT {', '.join(parts)} FROM {name}) AS source"

    def begin_refresh(self) -> None:
        self._fitted.clear()

    def fitted(self, name: str) -> Split | Cuts | None:
        """How to read a table: fitted to what it holds once per refresh, by a query of the server's."""
        split = self.splits.get(name)
        if not isinstance(split, (Strides, Shares)):
            return split
        if name not in self._fitted:
            fit = self._cuts if isinstance(split, Shares) else self._bounds
            self._fitted[name] = fit(name, split)
        return self._fitted[name]

    def _bounds(self, name: str, split: Strides) -> Split | None:
        row = self.query(f"SELECT MIN({split.column}) AS low, MAX({split.column}) AS high FROM {name}", database_of(name)).first()
        return None if row["low"] is None else Split(split.column, row["low"], row["high"], split.partitions)

    def _cuts(self, name: str, split: Shares) -> Cuts | None:
        """The server numbers its rows by value into equal shares; one row of each comes back."""
        dealt = f"SELECT {split.column} AS v, NTILE({split.partitions}) OVER (ORDER BY {split.column}) AS share FROM {name}"
        found = f"SELECT share, MIN(v) AS low, COUNT(*) - COUNT(v) AS unknown FROM ({dealt}) AS dealt GROUP BY share"
        rows = sorted(self.query(found, database_of(name)).collect())  # at most one per share
        starts = tuple(None if row["unknown"] else row["low"] for row in rows)
        return Cuts(split.column, starts, split.spread) if rows else None

    def load(self, name: str, wanted: frozenset[str]) -> DataFrame:
        relation, database, split = self.relation(name), database_of(name), self.fitted(name)
        if isinstance(split, Cuts):
            return typed(self.in_shares(relation, database, split.predicates()), name)
        return typed(self.spark.read.format("jdbc").options(**self.options(relation, database, split)).load(), name)

    def in_shares(self, relation: str, database: str, predicates: list[str]) -> DataFrame:
        """A relation with one task per condition."""
        options = self.options(relation, database)
        return self.spark.read.jdbc(options["url"], relation, predicates=predicates, properties=options)

    def query(self, sql: str, database: str, split: Split | None = None) -> DataFrame:
        """A query of the server's own dialect as a DataFrame."""
        options = self.options(f"({sql}) as source", database, split)
        return self.spark.read.format("jdbc").options(**options).load()


def declared(name: str) -> StructType:
    return StructType.fromDDL(schema_of(name))


def typed(df: DataFrame, name: str) -> DataFrame:
    """A server's columns as the table declares them; points come as two columns."""

    def column(field):
        if isinstance(field.dataType, StructType):
            both = F.col(f"{field.name}_x").isNotNull() & F.col(f"{field.name}_y").isNotNull()
            point = F.struct(F.col(f"{field.name}_x").alias("x"), F.col(f"{field.name}_y").alias("y"))
            return F.when(both, point).cast(field.dataType).alias(field.name)
        return F.col(field.name).cast(field.dataType).alias(field.name)

    return df.select(*(column(field) for field in declared(name).fields))


def bounds(df: DataFrame, column: str) -> tuple | None:
    """Smallest and largest value of a column; None for an empty input."""
    row = df.agg(F.min(column).alias("low"), F.max(column).alias("high")).first()
    return None if row["low"] is None else (row["low"], row["high"])


def split_by_bounds(df: DataFrame, column: str, partitions: int = 4) -> Split | None:
    """Range split fitted to the data; None when there is nothing to read."""
    found = bounds(df, column)
    return Split(column, found[0], found[1], partitions) if found else None


def interval_bounds(tables: Tables) -> DataFrame:
    """Interval ids with both ends resolved, from the two lookup tables.

    Two joins over large lookups, which a refresh runs once (``with_intervals``).
    """
    spans = tables("intervals", "id", "start_timestamp_id", "stop_timestamp_id")
    start = tables("timestamps", "id as start_timestamp_id", "date as start_ts")
    stop = tables("timestamps", "id as stop_timestamp_id", "date as stop_ts")
    return (
        spans.join(start, "start_timestamp_id")
        .join(stop, "stop_timestamp_id")
        .select("id", "start_ts", "stop_ts")
    )


class WithIntervals(Tables):
    """Another source whose ``interval_bounds`` are read from a stored result."""

    def __init__(self, tables: Tables, path: str) -> None:
        super().__init__(tables.spark)
        self.tables, self.path = tables, path

    def begin_refresh(self) -> None:
        self.tables.begin_refresh()

    def log(self, name: str, *columns: str, since: date | Column | None = None) -> DataFrame:
        return self.tables.log(name, *columns, since=since)

    def load(self, name: str, wanted: frozenset[str]) -> DataFrame:
        if name == "interval_bounds":
            return self.spark.read.schema(schema_of(name)).parquet(self.path)
        return self.tables.load(name, wanted)


def with_intervals(tables: Tables, path: str) -> Tables:
    """Resolve the intervals once, store them, and serve them with the source's tables."""
    interval_bounds(tables).write.mode("overwrite").parquet(path)
    return WithIntervals(tables, path)
