"""SimHash near-duplicates by anchor-point covering.

A 64-bit fingerprint is cut into three blocks of 22, 21 and 21 bits. Two
fingerprints that differ in at most d bits differ in at most d // 3 bits of some
block. In each block (padded to 23 bits) the code words of the perfect binary
Golay code are the anchors: every 23-bit word lies within the covering radius
3 of exactly one. A fingerprint goes to every anchor within 3 + d // 3 of its block
(about five for d = 4). Of two near fingerprints each is therefore at the
other's own anchor, where all pairs with one member at home are compared.

Only distinct fingerprints are compared, so exact copies cost nothing. An
anchor's comparison returns a forest that links what it has found connected, not
all pairs. Anchors with more than `block_rows` members are dealt out as pairs
of blocks, so that no task holds an unbounded group.

Defined results: a null or empty text, or one of white space only, has the
fingerprint zero, which links like any other; texts of fewer than `k` words
have one shingle, the whole sequence; repeated rows are documents of one group;
a null doc_id counts as larger than any other, and a group of such rows alone has a
null component; an empty table gives an empty result. Texts are read whole at any length;
of other columns none is looked at, and `one_of_each` returns them as they are, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from parcelmart.llm.common import packed, parallelism, stage, without
from parcelmart.llm.components import components

SHINGLE_WORDS = 4
MAX_BITS = 4
SEED = 42
# Generator polynomial, length and covering radius of the Golay code.
GOLAY = 0b110001110101
LENGTH = 23
RADIUS = 3
BLOCKS = ((0, 22), (22, 21), (43, 21))
# Members of one anchor that are compared in one piece.
BLOCK_ROWS = 200_000
# Cells of a comparison matrix held at once.
CELLS = 1 << 22


def fingerprint(text: str | None, k: int = SHINGLE_WORDS) -> bytes:
    """Eight bytes: a bit is set where over half of the shingle hashes have it."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return bytes(8)
    joined = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words])
    starts = np.concatenate(([0], ends[:-1]))
    k = min(k, len(words))
    digest = xxhash.xxh64_digest
    total = len(words) - k + 1
    counts = np.zeros(64, np.int64)
    for at in range(0, total, 1 << 15):
        upto = min(total, at + (1 << 15))
        spans = zip(starts[at:upto].tolist(), (ends[at + k - 1 : upto + k - 1] - 1).tolist(), strict=True)
        hashes = b"".join([digest(joined[a:b], SEED) for a, b in spans])
        bits = np.unpackbits(np.frombuffer(hashes, np.uint8)).reshape(-1, 64)
        counts += bits.sum(axis=0, dtype=np.int64)
    return np.packbits(counts * 2 > total).tobytes()


def with_fingerprints(docs: DataFrame, k: int = SHINGLE_WORDS) -> DataFrame:
    """`docs` with the column `fp`, the fingerprint as a signed long."""
    fields = [f for f in without(docs, "fp").schema.fields]
    schema = T.StructType([*fields, T.StructField("fp", T.LongType())])
    at = [f.name for f in fields].index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = b"".join(fingerprint(text, k) for text in batch.column(at).to_pylist())
            fps = np.frombuffer(found, ">i8").astype(np.int64)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(fps)], names=[*batch.schema.names, "fp"])

    return without(docs, "fp").mapInArrow(run, schema)


@cache
def _tables(reach: int):
    """Remainders of the low 12 and high 11 bits; error patterns within reach by remainder."""
    remainder = np.zeros(LENGTH, np.int64)
    for bit in range(LENGTH):
        value = 1 << bit
        for top in range(LENGTH - 1, 10, -1):
            if value >> top & 1:
                value ^= GOLAY << (top - 11)
        remainder[bit] = value

    def folded(bits):
        out = np.zeros(1 << len(bits), np.int64)
        for k, bit in enumerate(bits):
            out[1 << k : 2 << k] = out[: 1 << k] ^ remainder[bit]
        return out

    low, high = folded(range(12)), folded(range(12, LENGTH))
    patterns = [sum(1 << b for b in bits) for w in range(reach + 1) for bits in combinations(range(LENGTH), w)]
    patterns = np.array(patterns, np.int64)
    owner = low[patterns & 4095] ^ high[patterns >> 12]
    order = np.argsort(owner, kind="stable")
    bounds = np.searchsorted(owner[order], np.arange(2049))
    return low, high, patterns[order], bounds


def anchors(fps: np.ndarray, max_bits: int = MAX_BITS) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row number, key (block and code word) and whether it is the own anchor, for each anchor in reach."""
    low, high, patterns, bounds = _tables(RADIUS + max_bits // len(BLOCKS))
    rows, keys, homes = [], [], []
    for number, (shift, width) in enumerate(BLOCKS):
        word = ((fps >> np.uint64(shift)) & np.uint64((1 << width) - 1)).astype(np.int64)
        owner = low[word & 4095] ^ high[word >> 12]
        count = bounds[owner + 1] - bounds[owner]
        row = np.repeat(np.arange(len(fps)), count)
        step = np.arange(len(row)) - np.repeat(np.cumsum(count) - count, count)
        code = word[row] ^ patterns[bounds[owner][row] + step]
        rows.append(row)
        keys.append(number << 12 | code >> 11)
        # Patterns are sorted by weight, and the first is the only one within the radius.
        homes.append(step == 0)
    return np.concatenate(rows), np.concatenate(keys), np.concatenate(homes)


def links(fps: np.ndarray, home: np.ndarray, max_bits: int = MAX_BITS) -> list[tuple[np.ndarray, np.ndarray]]:
    """Edges that connect exactly what pairs within max_bits, one member at home, connect."""
    n, own = len(fps), np.flatnonzero(home)
    most, found, linked, pairs = 8 * n + 64, [], np.zeros(n, bool), 0
    for at in range(0, len(own), step := max(1, CELLS // max(n, 1))):
        part = own[at : at + step]
        close = np.bitwise_count(fps[part][:, None] ^ fps[None, :]) <= max_bits
        close[np.arange(len(part)), part] = False
        linked |= close.any(axis=0)
        linked[part] |= close.any(axis=1)
        if pairs <= most:
            a, b = np.nonzero(close)
            pairs += len(a)
            found.append((fps[part[a]], fps[b]))
    return found if pairs <= most else _forest(fps[linked], max_bits)


def _forest(fps: np.ndarray, max_bits: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """A star per group of connected fingerprints; a fingerprint is looked for once it is reached no more."""
    found, rest = [], fps
    while len(rest):
        seed, front, rest = rest[0], rest[:1], rest[1:]
        while len(front) and len(rest):
            near = np.zeros(len(rest), bool)
            part, front = front[:256], front[256:]
            for at in range(0, len(rest), step := max(1, CELLS // len(part))):
                near[at : at + step] = (np.bitwise_count(rest[at : at + step, None] ^ part[None, :]) <= max_bits).any(axis=1)
            reached, rest = rest[near], rest[~near]
            front = np.concatenate((front, reached))
            found.append((np.full(len(reached), seed), reached))
    return found


def near_links(distinct: DataFrame, max_bits: int = MAX_BITS, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """Edges (u, v) that connect the fingerprints `fp` (each once) within max_bits of each other."""
    spark = distinct.sparkSession
    reach = "key int, home boolean, fp long"

    def replicate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 1 << 16):
                fps = batch.column("fp").slice(at, 1 << 16).to_numpy().view(np.uint64)
                row, key, home = anchors(fps, max_bits)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(key.astype(np.int32)), pa.array(home), pa.array(fps.view(np.int64)[row])],
                    names=["key", "home", "fp"],
                )

    placed = distinct.select("fp").mapInArrow(replicate, reach)
    full = stage(placed.groupBy("key").count().where(F.col("count") > block_rows), "full-anchors")
    parts = [F.lit(0).alias("i"), F.lit(0).alias("j")]
    if full.head(1):
        # A row of a full anchor goes to the pairs of blocks that its own block is in.
        blocks = F.coalesce(F.ceil(F.col("count") / block_rows), F.lit(1)).cast("int")
        placed = placed.join(full, "key", "left").withColumn("blocks", blocks)
        placed = placed.withColumn("own", F.pmod(F.xxhash64("fp"), F.col("blocks")).cast("int"))
        placed = placed.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        parts = [F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j")]
    keys = ("key", "i", "j")
    dealt = placed.select("key", *parts, "home", "fp").repartition(parallelism(spark), *keys).sortWithinPartitions(*keys)

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for fps, home in _groups(batches):
            for u, v in links(fps, home, max_bits):
                for at in range(0, len(u), 1 << 16):
                    sides = (pa.array(x[at : at + (1 << 16)].view(np.int64)) for x in (u, v))
                    yield pa.RecordBatch.from_arrays(list(sides), names=["u", "v"])

    return dealt.mapInArrow(compare, "u long, v long")


def _groups(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(fingerprints, home) of each run of equal keys, across batches."""
    key, held = None, []
    for batch in batches:
        keys = np.stack([batch.column(c).to_numpy() for c in ("key", "i", "j")])
        fps = batch.column("fp").to_numpy().view(np.uint64)
        home = batch.column("home").to_numpy(zero_copy_only=False)
        cuts = [0, *(np.flatnonzero((keys[:, 1:] != keys[:, :-1]).any(axis=0)) + 1).tolist(), len(fps)]
        for a, b in zip(cuts, cuts[1:], strict=False):
            if a == b:
                continue
            own = tuple(keys[:, a])
            if own != key and held:
                yield tuple(np.concatenate(x) for x in zip(*held, strict=True))
                held = []
            key = own
            held.append((fps[a:b], home[a:b]))
    if held:
        yield tuple(np.concatenate(x) for x in zip(*held, strict=True))


def near_duplicates(docs: DataFrame, k: int = SHINGLE_WORDS, max_bits: int = MAX_BITS, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """Per row: doc_id, text_hash, fp, root (the group's smallest fingerprint) and component_id."""
    slim = docs.select("doc_id", F.xxhash64("text").alias("text_hash"), "text")
    marked = stage(with_fingerprints(slim, k).drop("text"), "fingerprints")
    distinct = stage(marked.groupBy("fp").agg(F.min("doc_id").alias("first")), "distinct-fingerprints")
    grouped = components(stage(near_links(distinct, max_bits, block_rows), "links"))
    rooted = distinct.join(grouped.withColumnRenamed("node", "fp"), "fp", "left")
    rooted = rooted.withColumn("root", F.coalesce("root", "fp"))
    smallest = rooted.groupBy("root").agg(F.min("first").alias("component_id"))
    by_print = rooted.select("fp", "root").join(smallest, "root")
    return marked.join(by_print, "fp").select("doc_id", "text_hash", "fp", "root", "component_id")


def one_of_each(docs: DataFrame, k: int = SHINGLE_WORDS, max_bits: int = MAX_BITS) -> DataFrame:
    """The row with the smallest doc_id of each group (ties: the smallest text hash), all columns kept."""
    first = F.min(F.struct(F.col("doc_id").isNull().alias("absent"), "doc_id", "text_hash")).alias("first")
    chosen = near_duplicates(docs, k, max_bits).groupBy("root").agg(first).select("first.doc_id", "first.text_hash").distinct()
    rows = docs.select(packed(docs, "row"), F.col("doc_id").alias("own_id"), F.xxhash64("text").alias("own_hash"))
    same = F.col("own_id").eqNullSafe(F.col("doc_id")) & (F.col("own_hash") == F.col("text_hash"))
    return rows.join(chosen, same, "left_semi").dropDuplicates(["own_id", "own_hash"]).select("row.*")
