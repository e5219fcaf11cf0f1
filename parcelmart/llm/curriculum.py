"""Mix sources to target weights along a time-varying curriculum.

Sources in code point order (null last) take the weights in turn. The mix
holds `share` times all words; a source's target is its weighted part, at most
`cap` times its own size, and what that leaves over is shared again by weight
until no source is above. Within a source the documents follow a fixed hash
order. Its demand runs over them once for each whole copy and then over a
prefix, so the words taken miss the target by at most half of one document.

Each source also has a schedule w(t) = 1 + tilt * (1 - 2t) over training time
t in [0, 1]. Its integral G(t) = t + tilt * (t - t^2) times the target is the
cumulative demand; a document copy whose middle word lies at part u of that
demand gets the training position t = G^-1(u).

Defined results: a null or empty text has size 0 and is taken 0 words; a null
source is a source of its own; repeated rows are separate documents; a source
of size 0 has target 0 and none of its rows is copied; an empty table gives an
empty result. Words are counted in whole texts of any length. Input columns named like a result
column are replaced, others kept.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from parcelmart.llm.common import WORD, quoted, without

WEIGHTS = (5, 2, 1)
# Heavier sources lead, lighter ones come late.
TILTS = (0.5, 0.0, -0.5)
ADDED = ("size", "source_size", "target", "copies", "taken", "positions")


def targets(sizes: DataFrame, weights=WEIGHTS, tilts=TILTS, share=1.5, cap=2.0) -> DataFrame:
    """One row per source: source, source_size, target, tilt. `sizes` has (source, source_size).

    The shares solve sum(min(level * weight, cap * size)) = share * sum(size): with
    sources ordered by cap * size / weight, the level is the first one that
    stays below its own source's limit. The windows without a partition run
    over one row per source, not over documents.
    """
    turn = F.row_number().over(W.orderBy(F.col("source").asc_nulls_last())) - 1
    pick = lambda values: F.element_at(F.array(*(F.lit(float(v)) for v in values)), (turn % len(values) + 1).cast("int"))
    weighted = sizes.withColumns({"weight": pick(weights), "tilt": pick(tilts)})
    by_limit = W.orderBy(F.col("limit"), F.col("source").asc_nulls_last())
    before = by_limit.rowsBetween(W.unboundedPreceding, -1)
    after = by_limit.rowsBetween(0, W.unboundedFollowing)
    everything = W.rowsBetween(W.unboundedPreceding, W.unboundedFollowing)
    levels = (
        weighted.withColumn("limit", F.col("source_size") * cap / F.col("weight"))
        .withColumn("demand", F.sum("source_size").over(everything) * share)
        .withColumn("filled", F.coalesce(F.sum(F.col("source_size") * cap).over(before), F.lit(0.0)))
        .withColumn("open", F.sum("weight").over(after))
        .withColumn("level", (F.col("demand") - F.col("filled")) / F.col("open"))
    )
    level = F.min(F.when(F.col("level") <= F.col("limit"), F.struct("limit", "level"))).over(everything)["level"]
    full = F.col("source_size") * cap
    return levels.withColumn("chosen", level).select(
        "source",
        "source_size",
        F.coalesce(F.least(F.col("chosen") * F.col("weight"), full), full).alias("target"),
        "tilt",
    )


def position(part, tilt):
    """The time at which a schedule has met `part` of its demand."""
    root = F.sqrt((1 + tilt) * (1 + tilt) - 4 * tilt * part)
    return F.when(tilt == 0, part).otherwise(((1 + tilt) - root) / (2 * tilt))


def mix(docs: DataFrame, weights=WEIGHTS, tilts=TILTS, share=1.5, cap=2.0) -> DataFrame:
    """Every row of `docs` with the columns of ADDED; `positions` has one entry per copy taken.

    Prefix sums go over (source, first three hex digits of the order hash),
    so a source with a third of all rows is cut into 4096 parts; the parts'
    sums are added up per source.
    """
    kept = without(docs, *ADDED)
    order = F.md5(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary"))
    base = kept.select(
        # Under names of our own, which none of the others here can clash with.
        *(F.col(quoted(c)).alias(f"_input{i}") for i, c in enumerate(kept.columns)),
        F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long").alias("size"),
        F.col("doc_id").alias("_id"),
        F.col("source").alias("_source"),
        order.alias("_order"),
        F.substring(order, 1, 3).alias("_part"),
        F.xxhash64("text").alias("_tie"),
    )
    parts = base.groupBy(F.col("_source").alias("source"), "_part").agg(F.sum("size").alias("part_size"))
    in_source = W.partitionBy("source")
    parts = parts.withColumns(
        {
            "before": F.coalesce(F.sum("part_size").over(in_source.orderBy("_part").rowsBetween(W.unboundedPreceding, -1)), F.lit(0)),
            "source_size": F.sum("part_size").over(in_source),
        }
    )
    sizes = parts.groupBy("source").agg(F.max("source_size").alias("source_size"))
    goals = targets(sizes, weights, tilts, share, cap)
    parts = parts.drop("source_size").alias("p").join(goals.alias("g"), F.col("p.source").eqNullSafe(F.col("g.source")))
    parts = parts.select(F.col("p.source").alias("p_source"), F.col("_part").alias("p_part"), "before", "source_size", "target", "tilt")
    inside = W.partitionBy("_source", "_part").orderBy("_order", "_id", "size", "_tie").rowsBetween(W.unboundedPreceding, -1)
    summed = base.withColumn("_inside", F.coalesce(F.sum("size").over(inside), F.lit(0)))
    joined = summed.join(parts, F.col("_source").eqNullSafe(F.col("p_source")) & (F.col("_part") == F.col("p_part")))
    whole = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0)
    rest = F.col("target") - F.col("_whole") * F.col("source_size")
    start = F.col("before") + F.col("_inside")
    extra = F.when((rest > 0) & (F.col("_start") + F.col("size") / 2 <= rest), 1).otherwise(0)
    middle = lambda k: F.col("_start") + k * F.col("source_size") + F.col("size") / 2
    placed = F.transform(
        F.sequence(F.lit(0), F.col("copies") - 1),
        lambda k: position(F.least(middle(k) / F.col("target"), F.lit(1.0)), F.col("tilt")),
    )
    return (
        joined.withColumn("_whole", whole)
        .withColumn("_start", start)
        .withColumn("copies", (F.col("_whole") + extra).cast("int"))
        .withColumn("taken", F.col("size") * F.col("copies"))
        .withColumn("positions", F.when(F.col("copies") > 0, placed).otherwise(F.array().cast("array<double>")))
        .select(*(F.col(f"_input{i}").alias(c) for i, c in enumerate(kept.columns)), *ADDED)
    )


def training_order(mixed: DataFrame, idle: bool = False) -> DataFrame:
    """One row per copy taken, range-sorted by its `mix_position`; with `idle`, documents that are not taken come last."""
    rows = F.explode_outer("positions") if idle else F.explode("positions")
    copies = mixed.withColumn("mix_position", rows).drop("positions")
    keys = (F.col("mix_position").asc_nulls_last(), "source", "doc_id")
    return copies.repartitionByRange(*keys).sortWithinPartitions(*keys)
