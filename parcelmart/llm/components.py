"""Connected components of an edge table by alternating star contractions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parcelmart.llm.common import stage


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of `edges` (u, v); root is the component's smallest node.

    Each round hangs the larger neighbours of a node on its smallest neighbour,
    then the smaller ones; the number of rounds grows with the logarithm of the
    longest chain. Rounds are cut by tables in the shared folder, so a lost
    executor repeats one round at most. Self loops and repeated edges do no
    harm; no edges give no rows.
    """
    pairs = edges.select(F.greatest("u", "v").alias("a"), F.least("u", "v").alias("b")).where("a <> b").distinct()
    pairs = stage(pairs, "edges")
    known = _checksum(pairs)
    while known[0]:
        both = pairs.union(pairs.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.min("b").alias("low")).select("a", F.least("a", "low").alias("low"))
        large = both.where("b > a").join(low, "a").select(F.col("b").alias("a"), F.col("low").alias("b")).distinct()
        low = large.groupBy("a").agg(F.min("b").alias("low"))
        small = large.join(low, "a").where("b <> low").select(F.col("b").alias("a"), F.col("low").alias("b"))
        pairs = stage(small.union(low).distinct(), "edges")
        found = _checksum(pairs)
        if found == known:
            break
        known = found
    roots = pairs.select(F.col("b").alias("node"), F.col("b").alias("root"))
    return pairs.select(F.col("a").alias("node"), F.col("b").alias("root")).union(roots).distinct()


def _checksum(pairs: DataFrame) -> tuple:
    return tuple(pairs.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(20,0)"))).first())
