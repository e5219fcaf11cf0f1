"""A Merkle manifest of documents: content-addressed records, proofs by descent from the root.

`build` makes every row a leaf, gathers the leaves of each source (ascending by
doc_id) in runs of 16 up to the source's root, and the sources' roots (null
first, then by bytes) to the root of all. Every inner node is a record:
its digest, and its children's digests in a row, whose hash it is.

`proofs` starts at the root with the requested leaves and goes down the records
by their ranks' base-16 digits: requests below one node go together, a node's
digest finds its children, the digit selects one of them and the others are kept
as a path segment. The path is read backwards for a proof, from the leaf to the root.

No task holds a source: ranks come from a range sort and prefix counts, a run
has 16 nodes at most, and every join is by digest or by (source, run). Levels are
written to the shared folder one by one.

Defined results: leaves are hashed from doc_id, source, lang, n_chars and text, each `-`
if null, so null and empty differ; a null doc_id comes first; rows that tie in
doc_id are ordered by digest, rows equal in all five columns take the places beside
each other; texts are hashed whole at any length; an empty table has no records, no root
and no proofs; columns other than the five are not looked at, whatever their names.
"""

from __future__ import annotations

import string
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parcelmart.llm.common import ranked, stage

FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
# Children of a node, and the bits of a rank that choose one of them.
ARITY, DIGIT_BITS = 16, 4
HEX = 64
SEGMENT = "struct<left: string, right: string>"


def hashed(*parts: Column) -> Column:
    """Lower-case hexadecimal SHA-256 of the parts in a row."""
    return F.sha2(F.concat(*parts), 256)


def leaf_digest(fields: dict[str, Column]) -> Column:
    def framed(column: Column) -> Column:
        value = column.cast("string")
        return F.coalesce(F.concat(F.octet_length(value).cast("string"), F.lit(":"), value), F.lit("-"))

    return hashed(*(framed(fields[name]) for name in FIELDS))


@dataclass(frozen=True)
class Manifest:
    """`records` (digest, children), `leaves` (source_key, rank, total, doc_id, leaf and what was carried),
    `sources` (source_key, digest, leaves, rank, total) and the root, None without documents."""

    records: DataFrame
    leaves: DataFrame
    sources: DataFrame
    root: str | None


def build(docs: DataFrame, carry: dict[str, Column] | None = None) -> Manifest:
    """The manifest of all rows; `carry` adds columns computed from a row to its leaf."""
    fields = {name: F.col(name) for name in FIELDS}
    # Not null, and in the sources' order: null, then bytewise.
    key = F.coalesce(F.concat(F.lit("="), F.col("source").cast("string")), F.lit("")).alias("source_key")
    extra = [column.alias(name) for name, column in (carry or {}).items()]
    rows = docs.select(key, F.col("doc_id").cast("long").alias("doc_id"), leaf_digest(fields).alias("leaf"), *extra)
    leaves = stage(ranked(rows, "source_key", ["doc_id", "leaf"]), "merkle-leaves")
    inner, tops = _levels(leaves.select(F.col("source_key").alias("owner"), "rank", "total", F.col("leaf").alias("digest")))
    listed = tops.select(F.lit("").alias("all"), F.col("owner").alias("source_key"), "digest", F.col("total").alias("leaves"))
    sources = stage(ranked(listed, "all", ["source_key"]), "merkle-sources")
    upper, root = _levels(sources.select(F.col("all").alias("owner"), "rank", "total", "digest"))
    # Equal runs are one record.
    records = reduce(DataFrame.union, [*inner, *upper]).groupBy("digest").agg(F.min("children").alias("children"))
    first = root.select("digest").first()
    return Manifest(stage(records, "merkle-records"), leaves, sources.drop("all"), first and first["digest"])


def _depth(total: Column | str) -> Column:
    """Levels above the leaves: the smallest d with 16^d >= total."""
    count = F.col(total) if isinstance(total, str) else total
    return sum(((count > ARITY**k).cast("int") for k in range(15)), F.lit(0))


def _height(nodes: DataFrame) -> int:
    return int(nodes.agg(F.max(_depth("total"))).first()[0] or 0)


def _levels(nodes: DataFrame) -> tuple[list[DataFrame], DataFrame]:
    """Records (digest, children) of all levels over (owner, rank, total, digest), and the top node of each owner."""
    tops, records = [nodes.where(_depth("total") == 0)], []
    for level in range(1, _height(nodes) + 1):
        run = F.array_sort(F.collect_list(F.struct("rank", "digest")))
        children = F.array_join(F.transform(run, lambda node: node["digest"]), "").alias("children")
        runs = nodes.where(_depth("total") >= level).groupBy("owner", "total", F.shiftright("rank", DIGIT_BITS).alias("rank"))
        nodes = stage(runs.agg(children).withColumn("digest", hashed(F.col("children"))), f"merkle-level-{level}")
        records.append(nodes.select("digest", "children"))
        tops.append(nodes.where(_depth("total") == level).select("owner", "rank", "total", "digest"))
    records = records or [nodes.where(F.lit(False)).select("digest", F.col("digest").alias("children"))]
    return records, reduce(DataFrame.unionByName, tops)


def proofs(manifest: Manifest, requests: DataFrame | None = None) -> DataFrame:
    """Requested rows of `manifest.leaves` (all by default) with `subroot` and `path`.

    `path` holds a (left, right) pair of sibling digests per level, from the leaf up to the root.
    """
    requests = manifest.leaves if requests is None else requests
    spark = requests.sparkSession
    start = spark.createDataFrame([("", manifest.root)] if manifest.root else [], "owner string, digest string")
    start = start.withColumns({"path": F.array().cast(f"array<{SEGMENT}>"), "subroot": F.lit(None).cast("string")})
    asked = manifest.sources.join(requests.select("source_key").distinct(), "source_key", "left_semi")
    asked = asked.select(F.lit("").alias("owner"), "rank", "total", "source_key", "digest", "leaves")
    above = stage(descend(manifest.records, start, asked), "merkle-source-paths")
    start = above.select(F.col("source_key").alias("owner"), "digest", "path", F.col("digest").alias("subroot"))
    found = descend(manifest.records, start, requests.withColumnRenamed("source_key", "owner"))
    return found.withColumnRenamed("owner", "source_key").withColumn("path", F.reverse("path"))


def descend(records: DataFrame, start: DataFrame, requests: DataFrame) -> DataFrame:
    """Requests (owner, rank, total, ...) with the path from `start` (owner, digest, path, subroot) down to them.

    Requests of one run share their way until the last step.
    """
    runs = requests.where(_depth("total") > 0).groupBy("owner", "total", F.shiftright("rank", DIGIT_BITS).alias("run")).count()
    runs = stage(runs.drop("count"), "merkle-runs")
    sizes = runs.select("owner", _depth("total").alias("depth")).distinct()
    start = stage(start.join(sizes, "owner", "left"), "merkle-start")
    nodes = None
    for level in range(int(start.agg(F.max("depth")).first()[0] or 0), 0, -1):
        entering = start.where(F.col("depth") == level).withColumn("node", F.lit(0).cast("long")).drop("depth")
        nodes = entering if nodes is None else nodes.unionByName(entering)
        if level > 1:
            shift = DIGIT_BITS * (level - 2)
            steps = runs.where(_depth("total") >= level).select("owner", F.shiftright("run", shift).alias("child")).distinct()
            steps = steps.withColumn("node", F.shiftright("child", DIGIT_BITS))
            below = nodes.join(records, "digest").join(steps, ["owner", "node"])
            chosen, segment = _selected("child")
            path = F.concat("path", F.array(segment)).alias("path")
            nodes = stage(below.select("owner", chosen.alias("digest"), path, "subroot", F.col("child").alias("node")), f"merkle-walk-{level}")
    lone = requests.where(_depth("total") == 0).join(start.select("owner", "path", "subroot"), "owner")
    if nodes is None:
        return lone
    reached = nodes.join(records, "digest").select("owner", F.col("node").alias("run"), "children", "path", "subroot")
    found = requests.where(_depth("total") > 0).withColumn("run", F.shiftright("rank", DIGIT_BITS)).join(reached, ["owner", "run"])
    _, segment = _selected("rank")
    found = found.withColumn("path", F.concat("path", F.array(segment)))
    return found.select(*lone.columns).unionByName(lone)


def _selected(place: str) -> tuple[Column, Column]:
    """The child that the last digit of `place` selects, and the others."""
    at = F.col(place).bitwiseAND(ARITY - 1).cast("int") * HEX
    children = F.col("children")
    left, right = children.substr(F.lit(1), at), children.substr(at + HEX + 1, F.lit(ARITY * HEX))
    return children.substr(at + 1, F.lit(HEX)), F.struct(left.alias("left"), right.alias("right"))


def siblings(path: Column | str) -> Column:
    """All sibling digests of a path in a row."""
    return F.array_join(F.transform(path, lambda level: F.concat(level["left"], level["right"])), "")


def folded(leaf: Column, path: Column | str) -> Column:
    """The root that a leaf and its siblings give."""
    return F.aggregate(path, leaf, lambda digest, level: hashed(level["left"], digest, level["right"]))


def tampered_leaf() -> Column:
    """The leaf of a fifth of the rows (by crc32 of the id) with A-Z lower-cased; null for the others and without an id."""
    lower = F.translate(F.col("text"), string.ascii_uppercase, string.ascii_lowercase)
    changed = leaf_digest({**{name: F.col(name) for name in FIELDS}, "text": lower})
    return F.when(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0, changed)


def verified(docs: DataFrame) -> DataFrame:
    """Every row's leaf, proof, and the root folded from its leaf after tampering."""
    manifest = build(docs, {"tampered": tampered_leaf()})
    root = F.lit(manifest.root).cast("string")
    proven = proofs(manifest).withColumn("folded_root", folded(F.coalesce("tampered", "leaf"), "path"))
    return proven.select(
        "doc_id",
        "leaf",
        "subroot",
        root.alias("root"),
        F.sha2(siblings("path"), 256).alias("proof_sha256"),
        "folded_root",
        (F.col("folded_root") == root).alias("verified"),
    )
