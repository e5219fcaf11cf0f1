"""Hard negatives of anchors by exact integer scores, tile by tile.

Scores are inner products of integer vectors. Anchors and candidates are cut into
tiles that a task can hold, every tile of anchors meets every tile of candidates
once, and the scores of both are one matrix product by Strassen's recursion: operands
are padded with zeros to even sizes and split into quarters, seven products stand for eight, and
all sums are exact int64.

First the anchors meet their own label's tiles: a heap per anchor keeps its best positives.
Then they meet all tiles: for each positive's score a heap keeps the best candidates
of other labels in the window of scores that goes with it. Heaps of an anchor from different
tiles merge by rank, so a tile never gives more than they hold. A hot label is many
tiles like any other; nothing is dropped to bound a tile.

Defined results: rows with a null id, label or vector, or with a null or non-finite component,
take no part; missing components of shorter vectors count as zero, so an empty vector
scores 0; components and scores are 64-bit (components beyond saturate, sums wrap as
Spark's integers do); every row counts on its own, so repeated rows are candidates,
positives and anchors side by side; ties go to the smaller vec_id; an anchor without positives
or a window without negatives gives no rows, nor does an empty table; other columns
are not looked at.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from parcelmart.llm.common import parallelism, stage

# Numbers in a tile of candidates (16 MB), in a tile of anchors, and of scores held at once.
TILE_CELLS, ANCHOR_CELLS, SCORE_CELLS = 1 << 21, 1 << 19, 1 << 20
# A tile worth a task of its own, in rows.
SMALL_TILE = 4096
# Side below which a product is not split.
LEAF = 32
SALTS = 32


def usable(embeddings: DataFrame) -> Column:
    finite = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    return F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.col("embedding").isNotNull() & finite


def quantised(embeddings: DataFrame, scale: int = 256) -> DataFrame:
    """(vec_id, label, vector) of the usable rows, components as floor(scale * x)."""
    vector = F.transform("embedding", lambda x: F.floor(x.cast("double") * scale))
    return embeddings.where(usable(embeddings)).select(F.col("vec_id").cast("long"), F.col("label").cast("long"), vector.alias("vector"))


def strassen(a: np.ndarray, b: np.ndarray, leaf: int = LEAF) -> np.ndarray:
    """The product of two int64 matrices, modulo 2^64 like int64 itself."""
    depth = 0
    while min(*a.shape, b.shape[1]) >> depth > leaf:
        depth += 1
    # Sums of quarters double at every level; below 2^53 doubles are exact.
    largest = [int(np.abs(x).max(initial=0)) if x.size and x.min() > np.iinfo(np.int64).min else 1 << 63 for x in (a, b)]
    exact = largest[0] * largest[1] * max(a.shape[1], 1) << depth < 1 << 53
    return _product(a, b, leaf, exact)


def _product(a: np.ndarray, b: np.ndarray, leaf: int, exact: bool) -> np.ndarray:
    (m, k), n = a.shape, b.shape[1]
    if min(m, k, n) <= leaf:
        return (a.astype(np.float64) @ b.astype(np.float64)).astype(np.int64) if exact else a @ b
    a, b = (np.pad(x, ((0, x.shape[0] % 2), (0, x.shape[1] % 2))) if x.shape[0] % 2 or x.shape[1] % 2 else x for x in (a, b))
    h, i, j = a.shape[0] // 2, a.shape[1] // 2, b.shape[1] // 2
    a11, a12, a21, a22 = a[:h, :i], a[:h, i:], a[h:, :i], a[h:, i:]
    b11, b12, b21, b22 = b[:i, :j], b[:i, j:], b[i:, :j], b[i:, j:]
    p1 = _product(a11 + a22, b11 + b22, leaf, exact)
    p2 = _product(a21 + a22, b11, leaf, exact)
    p3 = _product(a11, b12 - b22, leaf, exact)
    p4 = _product(a22, b21 - b11, leaf, exact)
    p5 = _product(a11 + a12, b22, leaf, exact)
    p6 = _product(a21 - a11, b11 + b12, leaf, exact)
    p7 = _product(a12 - a22, b21 + b22, leaf, exact)
    out = np.empty((2 * h, 2 * j), np.int64)
    out[:h, :j], out[:h, j:] = p1 + p4 - p5 + p7, p3 + p5
    out[h:, :j], out[h:, j:] = p2 + p4, p1 - p2 + p3 + p6
    return out[:m, :n]


def matrix(vectors: pa.ChunkedArray, width: int) -> np.ndarray:
    """Lists as rows, filled up with zeros."""
    column = vectors.combine_chunks()
    sizes = np.diff(column.offsets.to_numpy())
    out = np.zeros((len(column), width), np.int64)
    out[np.arange(width) < sizes[:, None]] = column.flatten().to_numpy()
    return out


def best(scores: np.ndarray, k: int) -> np.ndarray:
    """Places of the k largest scores, the largest first; equal ones in their order."""
    if len(scores) > 4 * k:
        least = np.partition(scores, len(scores) - k)[len(scores) - k]
        places = np.flatnonzero(scores >= least)
    else:
        places = np.arange(len(scores))
    # ~x falls as x rises and cannot overflow.
    return places[np.argsort(~scores[places], kind="stable")][:k]


@dataclass(frozen=True)
class Found:
    """What heaps give out: anchors' rows, which heap, candidates' places, scores."""

    anchor: list[np.ndarray]
    slot: list[np.ndarray]
    place: list[np.ndarray]
    score: list[np.ndarray]

    def add(self, anchor: int, slot: int, places: np.ndarray, scores: np.ndarray) -> None:
        for held, value in ((self.anchor, anchor), (self.slot, slot)):
            held.append(np.full(len(places), value, np.int64))
        self.place.append(places)
        self.score.append(scores)

    def table(self, candidates: pa.Table) -> pa.Table:
        join = lambda parts: np.concatenate([np.zeros(0, np.int64), *parts])
        rows = candidates.select(["vec_id", "row"]).take(pa.array(join(self.place)))
        return pa.table({"anchor": join(self.anchor), "slot": join(self.slot), "score": join(self.score), "vec_id": rows["vec_id"], "row": rows["row"]})


HEAPS = "anchor long, slot long, score long, vec_id long, row long"
Heap = Callable[[int, np.ndarray], list[tuple[int, np.ndarray]]]


def _meet(anchors: pa.Table, candidates: pa.Table, heaps: Callable[[pa.Table, pa.Table], Heap]) -> pa.Table:
    """All scores of two tiles, a block at a time; `heaps(anchors, block)` says what an anchor keeps of a block: (heap, places)."""
    candidates = candidates.sort_by([("vec_id", "ascending"), ("row", "ascending")])
    found = Found([], [], [], [])
    sizes = [_width(t) for t in (anchors, candidates)]
    left, right = (matrix(t["vector"], max(sizes)) for t in (anchors, candidates))
    step = min(max(len(right), 1), 8192)
    high = max(SCORE_CELLS // step, 1)
    rows = anchors["row"].to_numpy()
    for at in range(0, len(right) if len(left) else 0, step):
        block = candidates.slice(at, step)
        keep = heaps(anchors, block)
        columns = np.ascontiguousarray(right[at : at + step].T)
        for top in range(0, len(left), high):
            scores = strassen(left[top : top + high], columns)
            for i in range(len(scores)):
                for slot, places in keep(top + i, scores[i]):
                    found.add(rows[top + i], slot, places + at, scores[i][places])
    return found.table(candidates)


def _grid(anchors: DataFrame, candidates: DataFrame, keys: tuple[str, ...], heaps: Callable[[pa.Table, pa.Table], Heap]) -> DataFrame:
    """Every tile of anchors meets the tiles of candidates with its keys."""
    # Both sides come from one table: one gets columns of its own.
    left, right = anchors.toDF(*anchors.columns).groupBy(*keys), candidates.groupBy(*keys)
    return left.cogroup(right).applyInArrow(lambda a, c: _meet(a, c, heaps), HEAPS)


def _width(tile: pa.Table) -> int:
    column = tile["vector"].combine_chunks()
    return int(np.diff(column.offsets.to_numpy()).max(initial=0)) if len(column) else 0


def _merged(heaps: DataFrame, size: int) -> DataFrame:
    """The heads of all heaps of an anchor and slot as one heap, with `rank` from 1."""
    order = W.partitionBy("anchor", "slot").orderBy(F.desc("score"), "vec_id", "row")
    return heaps.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= size)


def _tiles(rows: Column | str, cells: int, width: int) -> Column:
    """Tiles that so many rows need."""
    return F.ceil((F.col(rows) if isinstance(rows, str) else rows) / F.lit(max(cells // max(width, 1), 1)))


def _dealt(count: Column | str) -> Column:
    return F.pmod(F.xxhash64("row"), F.col(count) if isinstance(count, str) else count)


def _all(count: Column | str) -> Column:
    return F.explode(F.sequence(F.lit(0).cast("long"), (F.col(count) if isinstance(count, str) else count) - 1))


def positives(rows: DataFrame, width: int, keep: int) -> DataFrame:
    """The best `keep` other rows of an anchor's label: (anchor, rank, score, vec_id)."""
    labels = rows.groupBy("label").agg(F.count("*").alias("rows"), F.count_if("is_anchor").alias("anchors")).where("anchors > 0")
    labels = labels.select("label", _tiles("rows", TILE_CELLS, width).alias("tiles"), _tiles("anchors", ANCHOR_CELLS, width).alias("groups"))
    # A hot label's rows do not meet its counts in one task.
    labels = stage(labels, "labels").withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    salted = rows.withColumn("salt", F.pmod(F.col("row"), F.lit(SALTS)).cast("int")).join(labels, ["label", "salt"])
    anchors = salted.where("is_anchor").select("label", _dealt("groups").alias("group"), _all("tiles").alias("tile"), "row", "vec_id", "vector")
    candidates = salted.select("label", _dealt("tiles").alias("tile"), _all("groups").alias("group"), "row", "vec_id", "vector")

    def heaps(anchors: pa.Table, block: pa.Table) -> Heap:
        mine, others = anchors["row"].to_numpy(), block["row"].to_numpy()

        def kept(i: int, scores: np.ndarray) -> list[tuple[int, np.ndarray]]:
            places = best(scores, keep + 1)
            return [(0, places[others[places] != mine[i]][:keep])]

        return kept

    keys = ("label", "group", "tile")
    return _merged(_grid(anchors, candidates, keys, heaps), keep).select("anchor", "rank", "score", "vec_id")


def negatives(rows: DataFrame, wanted: DataFrame, width: int, keep: int, low: int, high: int) -> DataFrame:
    """For each (anchor, rank, score) wanted, the best rows of other labels with low * score <= 100 * s <= high * score."""
    spark = rows.sparkSession
    windows = wanted.groupBy("anchor").agg(F.array_sort(F.collect_list(F.struct("rank", "score"))).alias("windows"))
    asked = stage(rows.where("is_anchor").join(windows, rows["row"] == windows["anchor"]).select("row", "label", "vector", "windows"), "asked")
    total, count = rows.count(), asked.count()
    tiles = max(-(-total // max(TILE_CELLS // max(width, 1), 1)), min(parallelism(spark), -(-total // SMALL_TILE)), 1)
    groups = max(-(-count // max(ANCHOR_CELLS // max(width, 1), 1)), 1)
    tiles, groups = F.lit(tiles).cast("long"), F.lit(groups).cast("long")
    anchors = asked.select(_dealt(groups).alias("group"), _all(tiles).alias("tile"), "row", "label", "vector", "windows")
    candidates = rows.select(_dealt(tiles).alias("tile"), _all(groups).alias("group"), "row", "vec_id", "label", "vector")

    def heaps(anchors: pa.Table, block: pa.Table) -> Heap:
        mine, others = anchors["label"].to_numpy(), block["label"].to_numpy()
        asked = anchors["windows"].to_pylist()

        def kept(i: int, scores: np.ndarray) -> list[tuple[int, np.ndarray]]:
            bounds = [(w["rank"], -(-low * w["score"] // 100), high * w["score"] // 100) for w in asked[i]]
            bounds = [(slot, least, most) for slot, least, most in bounds if least <= most]
            if not bounds:
                return []
            inside = (scores >= min(b[1] for b in bounds)) & (scores <= max(b[2] for b in bounds)) & (others != mine[i])
            places = np.flatnonzero(inside)
            falling = ~scores[places]
            order = np.argsort(falling, kind="stable")
            places, falling = places[order], falling[order]
            out = []
            for slot, least, most in bounds:
                begin = int(np.searchsorted(falling, ~most))
                end = int(np.searchsorted(falling, ~least, "right"))
                out.append((slot, places[begin : min(end, begin + keep)]))
            return out

        return kept

    keys = ("group", "tile")
    return _merged(_grid(anchors, candidates, keys, heaps), keep).select("anchor", "slot", "rank", "score", "vec_id")


def mine(vectors: DataFrame, anchors: Column, n_positives: int = 5, n_negatives: int = 10, low: int = 30, high: int = 90) -> DataFrame:
    """Hard negatives of the rows that `anchors` marks among (vec_id, label, vector).

    For each anchor and each of its best positives the best candidates of other
    labels whose score is between `low` and `high` per cent of the positive's.
    """
    marked = vectors.select(F.monotonically_increasing_id().alias("row"), "vec_id", "label", "vector", anchors.alias("is_anchor"))
    rows = stage(marked, "vectors")
    width = int(rows.agg(F.max(F.size("vector"))).first()[0] or 0)
    chosen = stage(positives(rows, width, n_positives), "positives")
    found = negatives(rows, chosen.select("anchor", "rank", "score"), width, n_negatives, low, high)
    with_id = chosen.join(rows.where("is_anchor").select(F.col("row").alias("anchor"), F.col("vec_id").alias("anchor_id")), "anchor")
    pairs = with_id.select("anchor", F.col("rank").alias("slot"), "anchor_id", F.col("vec_id").alias("positive_id"), F.col("score").alias("positive_score"))
    return found.join(pairs, ["anchor", "slot"]).select(
        "anchor_id", "positive_id", "rank", F.col("vec_id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score")
    )
