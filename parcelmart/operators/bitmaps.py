"""Exact distinct counts that can be united: sets of ids as bitmaps.

An id is a bit in a bitmap of 32,768, so a set is some rows of 4 KB, built before
the shuffle, and the sets of days, zones or shops unite by OR. A plain
``count_distinct`` shuffles every id of every group, and its results cannot be
put together. For ids handed out one after the other (surrogate keys); ids
spread thinly over a wide range fill many bitmaps with few bits each.
NULL ids are in no set; negative ids count like others.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BUCKET, BITS = "id_bucket", "id_bits"


def id_sets(df: DataFrame, keys: Sequence[str | Column], ids: str) -> DataFrame:
    """The set of ids of every key: (keys, id_bucket, id_bits)."""
    rows = df.where(F.col(ids).isNotNull())
    return rows.groupBy(*keys, F.bitmap_bucket_number(ids).alias(BUCKET)).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position(ids)).alias(BITS)
    )


def united(sets: DataFrame, keys: Sequence[str | Column]) -> DataFrame:
    """Sets of coarser keys: the union of all sets that fall together."""
    return sets.groupBy(*keys, BUCKET).agg(F.bitmap_or_agg(BITS).alias(BITS))


def sizes(sets: DataFrame, keys: Sequence[str], name: str) -> DataFrame:
    """How many ids the set of every key has; sets must be united by exactly these keys."""
    return sets.groupBy(*keys).agg(F.sum(F.bitmap_count(BITS)).alias(name))


def distinct_counts(sets: DataFrame, keys: Sequence[str], name: str) -> DataFrame:
    """Distinct ids per key from sets of finer keys."""
    return sizes(united(sets, keys), keys, name)


def shared_by(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The ids that a set of the left and a set of the right side share, for every pair of them that shares any.

    ``keys`` name both sides' keys. Bitmaps meet by bucket, so no id is joined.
    """
    pairs = left.join(right.withColumnRenamed(BITS, "_bits"), BUCKET)
    both = F.explode(F.array(BITS, "_bits")).alias(BITS)
    common = pairs.select(*keys, BUCKET, both).groupBy(*keys, BUCKET).agg(F.bitmap_and_agg(BITS).alias(BITS))
    return common.where(F.bitmap_count(BITS) > 0)
