"""Replication of operational tables from a change log."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from parcelmart.operators.joins import latest_per_key
from parcelmart.sources.parts import PartStore
from parcelmart.sources.scratch import written


@dataclass(frozen=True)
class Replicated:
    """One table to replicate: its key and the columns that order changes."""

    table: str
    keys: tuple[str, ...] = ("id",)
    order: tuple[str, ...] = ("changed_at", "change_id")


def parse_manifest(groups: Iterable[str], **settings) -> list[Replicated]:
    """Expand job entries; one entry may name several tables joined by ``:``."""
    tables = [name.strip() for group in groups for name in group.split(":")]
    return [Replicated(name, **settings) for name in dict.fromkeys(tables) if name]


def newest_changes(
    changes: DataFrame, keys: Sequence[str], order: Sequence[str], deleted: Column
) -> DataFrame:
    """Final state of every key in a change log, without deleted keys.

    The result depends on the set of changes only, not on their arrival
    order, and applying a batch twice changes nothing.
    """
    carry = [name for name in changes.columns if name not in keys and name not in order]
    # A change without a mark deletes nothing.
    flagged = changes.withColumn("_deleted", F.coalesce(deleted, F.lit(False)))
    newest = latest_per_key(flagged, keys, order, [*carry, "_deleted"])
    return newest.where(~F.col("_deleted")).select(*changes.columns)


def apply_changes(
    current: DataFrame,
    changes: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
) -> DataFrame:
    """Merge a change batch into the current state.

    Deleted rows stay as tombstones, so a late change that is older than the
    delete cannot bring the row back.  Readers filter them with ``live_rows``.
    """
    merged = current.unionByName(changes.select(*current.columns))
    carry = [name for name in current.columns if name not in keys and name not in order]
    return latest_per_key(merged, keys, order, carry).select(*current.columns)


def live_rows(state: DataFrame, deleted: str) -> DataFrame:
    return state.where(~F.coalesce(F.col(deleted), F.lit(False)))


def replicate(
    manifest: Iterable[Replicated],
    state: Callable[[str], DataFrame | None],
    changes: Callable[[str], DataFrame],
    store: Callable[[str, DataFrame], None],
) -> None:
    """Take one change batch of every table in: read its state, merge, store the new state.

    ``state`` returns None for a table not replicated yet. Batches may come in
    any order and twice: the state depends on the set of changes only.
    """
    for entry in manifest:
        batch = changes(entry.table)
        current = state(entry.table)
        if current is None:
            current = batch.where(F.lit(False))
        store(entry.table, apply_changes(current, batch, entry.keys, entry.order))


@dataclass(frozen=True)
class Merge:
    """What one merge did: the version it made and the buckets it rewrote."""

    version: int
    rewritten: list[int]


class BucketedState:
    """A replicated table in hash buckets of its key; a change batch rewrites the buckets it has keys in.

    Deleted rows stay as tombstones, so a late change cannot bring a row back,
    until no change that old may come: ``oldest`` of a merge says from which value of
    the first order column on changes still come. What is older was either applied
    before or is not to be applied, so it is left out, and tombstones of rewritten
    buckets that are older go. Batches may come in any order and twice.
    """

    def __init__(
        self,
        spark: SparkSession,
        root: str,
        schema: StructType | str,
        keys: Sequence[str],
        order: Sequence[str],
        deleted: str,
        buckets: int = 256,
        keep: int = 3,
    ) -> None:
        self.store = PartStore(spark, root, schema, keep)
        self.keys, self.order, self.deleted = list(keys), list(order), deleted
        # A table keeps the number of buckets it began with.
        self.buckets = self.store.settings().get("buckets", buckets)
        self.columns = [field.name for field in self.store.schema.fields]

    def bucket(self) -> Column:
        key = [F.coalesce(F.col(name).cast("string"), F.lit("")) for name in self.keys]
        return F.pmod(F.crc32(F.concat_ws("\x1f", *key).cast("binary")), F.lit(self.buckets)).cast("int")

    def all_rows(self) -> DataFrame:
        """Rows and tombstones."""
        return self.store.read()

    def live(self) -> DataFrame:
        return live_rows(self.all_rows(), self.deleted)

    def merge(self, batch: DataFrame, oldest=None) -> Merge:
        """Take a change batch in; buckets without a key in it are neither read nor written."""
        since = self.store.versions.current()[0]
        limit = self._limit(batch.sparkSession, oldest)
        flagged = batch.select(*self.columns).withColumn(self.deleted, F.coalesce(F.col(self.deleted), F.lit(False)))
        if limit is not None:
            flagged = flagged.where(F.col(self.order[0]) >= self._ordered(limit))
        carry = [name for name in self.columns if name not in self.keys and name not in self.order]
        # A key with very many changes is one row before its bucket meets in a task.
        newest = latest_per_key(flagged, self.keys, self.order, carry).withColumn("_bucket", self.bucket())
        arrived = written(newest, "change-batch")
        touched = sorted(row[0] for row in arrived.select("_bucket").distinct().collect())  # at most all buckets
        if not touched:
            return Merge(since, [])
        old = self.store.read(str(bucket) for bucket in touched).withColumn("_bucket", self.bucket())
        both = old.unionByName(arrived).repartition("_bucket")
        merged = latest_per_key(both, ["_bucket", *self.keys], self.order, carry)
        settings = {"buckets": self.buckets}
        if limit is not None:
            merged = merged.where(~F.col(self.deleted) | (F.col(self.order[0]) >= self._ordered(limit)))
            settings["oldest"] = limit
        return Merge(self.store.replace(merged, "_bucket", map(str, touched), since, settings), touched)

    def _ordered(self, value) -> Column:
        return F.lit(value).cast(self.store.schema[self.order[0]].dataType)

    def _limit(self, spark: SparkSession, oldest) -> str | None:
        """The later of the given limit and the one the table already has, as text."""
        limits = [self._ordered(value) for value in (self.store.settings().get("oldest"), oldest) if value is not None]
        if not limits:
            return None
        latest = F.array_max(F.array(*limits)).cast("string")
        return spark.range(1).select(latest).first()[0]

    def changes_since(self, version: int, until: int | None = None) -> DataFrame:
        """Live rows that changed after a version (0: before the first), from the buckets that did.

        Columns are the table's and ``sign``: -1 with a row as it was then, 1 with it as it is now.
        """
        now = self.store.parts() if until is None else self.store.versions.describe(until)["parts"]
        then = self.store.versions.describe(version)["parts"] if version else {}
        differ = [part for part in sorted({*now, *then}) if now.get(part) != then.get(part)]
        sides = [
            live_rows(self.store.read_version(parts, differ), self.deleted).withColumn("sign", F.lit(sign))
            for parts, sign in ((then, -1), (now, 1))
        ]
        row = F.struct(*[name for name in self.columns if name not in self.keys])
        both = sides[0].unionByName(sides[1]).groupBy(*self.keys).agg(
            F.max(F.when(F.col("sign") < 0, row)).alias("_then"), F.max(F.when(F.col("sign") > 0, row)).alias("_now")
        )
        changed = both.where(~F.col("_then").eqNullSafe(F.col("_now")))
        signed = F.array(F.struct(F.lit(-1).alias("sign"), F.col("_then").alias("row")), F.struct(F.lit(1).alias("sign"), F.col("_now").alias("row")))
        rows = changed.select(*self.keys, F.explode(signed).alias("_at")).where(F.col("_at.row").isNotNull())
        unpacked = [F.col(name) if name in self.keys else F.col(f"_at.row.{name}").alias(name) for name in self.columns]
        return rows.select(*unpacked, F.col("_at.sign").alias("sign"))


def replicate_buckets(
    manifest: Iterable[Replicated],
    state: Callable[[Replicated], BucketedState],
    changes: Callable[[str], DataFrame],
    oldest=None,
) -> dict[str, Merge]:
    """Take one change batch of every table in, rewriting only the buckets it touches."""
    return {entry.table: state(entry).merge(changes(entry.table), oldest) for entry in manifest}
