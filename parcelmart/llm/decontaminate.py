"""Benchmark decontamination by SimHash windows of each item's size.

Words are runs of letters, digits and underscores in lower case. An item of n words
has n - 4 shingles of five words (an item of fewer than five words: one shingle of
all its words). Over every document a window of as many shingles slides for each
size of item; a document shorter than an item is one window. A window is
fingerprinted if a shingle of any item lies in it (one without any has similarity 0
to all items). A fingerprint bit is set where over half of the shingle hashes, each
weighing as often as it occurs, have it.

Items of one size are indexed by the `radius` + 1 blocks of their fingerprints: a
window within the radius of an item agrees with it in one block at least, so looking up
all blocks finds every item within the radius. Those candidates are verified exactly:
sum of the smaller over sum of the larger shingle counts, `threshold` or more.
At similarity 0.8 fingerprints differ in about 10 of 64 bits; the radius is 20.

Defined results: a null or empty text or item matches nothing; repeated rows match
alike, each for itself; per row and item the window with the highest similarity, then the
lowest distance, then the first, is reported; an empty table or benchmark gives no match. Texts are
searched whole at any length; other columns are not looked at, and clean documents keep them
as they are, whatever their names.

The benchmark is a stated query set: it goes to the tasks in blocks of at
most ITEM_BLOCK items, with one pass over the documents per block.
"""

from __future__ import annotations

import re
from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

K = 5
THRESHOLD = 0.8
RADIUS = 20
ITEM_BLOCK = 50_000
KNOWN_WORDS = 500_000

_WORDS = re.compile(r"\w+")
_FACTOR = 0x9E3779B97F4A7C15
_MASK = (1 << 64) - 1


def words(text: str | None) -> list[str]:
    return _WORDS.findall((text or "").lower())


class WordHashes:
    """64-bit hashes of words; those seen are kept, up to KNOWN_WORDS."""

    def __init__(self):
        self.known: dict[str, int] = {}

    def __call__(self, tokens: list[str]) -> np.ndarray:
        known = self.known
        if len(known) > KNOWN_WORDS:
            known.clear()
        for token in tokens:
            if token not in known:
                known[token] = xxhash.xxh64_intdigest(token.encode("utf-8", "surrogatepass"))
        return np.array([known[token] for token in tokens], np.uint64)


def shingles(hashes: np.ndarray, k: int) -> np.ndarray:
    """One mixed 64-bit hash for every k words in a row."""
    n = len(hashes) - k + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    out = np.zeros(n, np.uint64)
    for j in range(k):
        out += hashes[j : n + j] * np.uint64(pow(_FACTOR, k - j, 1 << 64))
    out ^= out >> np.uint64(31)
    out *= np.uint64(0xBF58476D1CE4E5B9)
    out ^= out >> np.uint64(29)
    out *= np.uint64(0x94D049BB133111EB)
    return out ^ (out >> np.uint64(32))


def window_prints(grams: np.ndarray, size: int, starts: np.ndarray) -> np.ndarray:
    """Fingerprints of the windows of `size` shingles at the starts (ascending), by prefix sums of bits."""
    low, high = int(starts[0]), int(starts[-1]) + size
    bits = np.unpackbits(grams[low:high].astype(">u8").view(np.uint8)).reshape(-1, 64)
    sums = np.zeros((len(bits) + 1, 64), np.int32)
    np.cumsum(bits, axis=0, out=sums[1:])
    at = starts - low
    return np.packbits((sums[at + size] - sums[at]) * 2 > size, axis=1).view(">u8").astype(np.uint64).ravel()


class BlockIndex:
    """Fingerprints by the values of radius + 1 blocks."""

    def __init__(self, prints: np.ndarray, radius: int):
        self.prints, self.radius = prints, radius
        cuts = [64 * i // (radius + 1) for i in range(radius + 2)]
        self.blocks = [(np.uint64(a), np.uint64((1 << (b - a)) - 1)) for a, b in zip(cuts, cuts[1:], strict=False)]
        self.orders, self.bounds = [], []
        for shift, mask in self.blocks:
            value = (prints >> shift) & mask
            order = np.argsort(value, kind="stable")
            self.orders.append(order)
            self.bounds.append(np.searchsorted(value[order], np.arange(int(mask) + 2)))

    def near(self, queries: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(query, item, distance) for every pair within the radius."""
        found = []
        for (shift, mask), order, bounds in zip(self.blocks, self.orders, self.bounds, strict=True):
            value = ((queries >> shift) & mask).astype(np.int64)
            count = bounds[value + 1] - bounds[value]
            query = np.repeat(np.arange(len(queries)), count)
            step = np.arange(len(query)) - np.repeat(np.cumsum(count) - count, count)
            found.append(query * len(self.prints) + order[bounds[value][query] + step])
        pairs = np.unique(np.concatenate(found))
        query, item = np.divmod(pairs, max(1, len(self.prints)))
        distance = np.bitwise_count(queries[query] ^ self.prints[item])
        near = distance <= self.radius
        return query[near], item[near], distance[near]


class Benchmark:
    """Items, by shingle length and number of shingles."""

    def __init__(self, items: list[tuple[int | None, str | None]], radius: int = RADIUS, threshold: float = THRESHOLD):
        self.threshold = threshold
        self.ids = [item_id for item_id, _ in items]
        hashes = WordHashes()
        by_size, grams_of = defaultdict(list), {}
        for number, (_, text) in enumerate(items):
            tokens = words(text)
            if tokens:
                k = min(K, len(tokens))
                grams_of[number] = shingles(hashes(tokens), k)
                by_size[k, len(grams_of[number])].append(number)
        self.counts = {number: Counter(grams.tolist()) for number, grams in grams_of.items()}
        self.sizes = {}
        for (k, size), numbers in by_size.items():
            prints = np.concatenate([window_prints(grams_of[n], size, np.zeros(1, np.int64)) for n in numbers])
            known = np.unique(np.concatenate([grams_of[n] for n in numbers]))
            self.sizes.setdefault(k, []).append((size, known, np.array(numbers), BlockIndex(prints, radius)))
        self.known = {k: np.unique(np.concatenate([entry[1] for entry in entries])) for k, entries in self.sizes.items()}

    def matches(self, hashes: np.ndarray) -> list[tuple[int, float, int, int, int]]:
        """(item number, similarity, first word, words, distance) of the best window of each matching item."""
        best: dict[int, tuple] = {}
        for k, entries in self.sizes.items():
            grams = shingles(hashes, k)
            if not len(grams):
                continue
            at = np.flatnonzero(_among(grams, self.known[k]))
            if not len(at):
                continue
            for size, known, numbers, index in entries:
                hits = at[_among(grams[at], known)]
                if not len(hits):
                    continue
                span = min(size, len(grams))
                last = len(grams) - span
                edges = np.zeros(last + 2, np.int32)
                np.add.at(edges, np.maximum(hits - span + 1, 0), 1)
                np.add.at(edges, np.minimum(hits, last) + 1, -1)
                starts = np.flatnonzero(np.cumsum(edges[:-1]) > 0)
                for part in np.split(starts, np.flatnonzero(np.diff(starts) > span) + 1):
                    for piece in range(0, len(part), 1 << 14):
                        chosen = part[piece : piece + (1 << 14)]
                        query, item, distance = index.near(window_prints(grams, span, chosen))
                        for q, i, d in zip(query.tolist(), item.tolist(), distance.tolist(), strict=True):
                            number, start = int(numbers[i]), int(chosen[q])
                            sim = similarity(Counter(grams[start : start + span].tolist()), self.counts[number])
                            if sim >= self.threshold:
                                rank = (-sim, d, start, span + k - 1)
                                best[number] = min(best.get(number, rank), rank)
        return [(number, -rank[0], rank[2], rank[3], rank[1]) for number, rank in sorted(best.items())]


def similarity(a: Counter, b: Counter) -> float:
    """Weighted Jaccard similarity of two bags of shingles."""
    common = (a & b).total()
    return common / (a.total() + b.total() - common)


def _among(values: np.ndarray, known: np.ndarray) -> np.ndarray:
    place = np.minimum(np.searchsorted(known, values), len(known) - 1)
    return known[place] == values


def item_blocks(benchmark: DataFrame, radius: int = RADIUS, threshold: float = THRESHOLD) -> Iterator[Benchmark]:
    """The benchmark (item_id, text) in indexed blocks of about ITEM_BLOCK items at most."""
    items = benchmark.select(F.col("item_id").cast("long"), "text")
    parts = -(-items.count() // ITEM_BLOCK)
    for part in range(parts):
        rows = items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(parts)) == part)
        yield Benchmark(sorted(((r.item_id, r.text) for r in rows.collect()), key=str), radius, threshold)


MATCHES = "doc_id long, item_id long, similarity double, first_word long, words long, distance int"
_NAMES = [column.split()[0] for column in MATCHES.split(", ")]
_TYPES = [pa.int64(), pa.int64(), pa.float64(), pa.int64(), pa.int64(), pa.int32()]


def contaminated(docs: DataFrame, benchmark: DataFrame, radius: int = RADIUS, threshold: float = THRESHOLD) -> DataFrame:
    """One row of MATCHES for every row of docs (doc_id, text) and item with a window like it."""
    slim = docs.select(F.col("doc_id").cast("long"), "text")
    out = docs.sparkSession.createDataFrame([], MATCHES)
    for block in item_blocks(benchmark, radius, threshold):

        def run(batches: Iterator[pa.RecordBatch], block=block) -> Iterator[pa.RecordBatch]:
            hashes = WordHashes()
            for batch in batches:
                rows = []
                for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist(), strict=True):
                    rows += [(doc_id, block.ids[number], *rest) for number, *rest in block.matches(hashes(words(text)))]
                columns = list(zip(*rows, strict=True)) or [[]] * 6
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, _TYPES, strict=True)], names=_NAMES)

        out = out.union(slim.mapInArrow(run, MATCHES))
    return out


def clean_documents(docs: DataFrame, benchmark: DataFrame, radius: int = RADIUS, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of `docs` in which no window is like an item, columns as given."""
    at = docs.columns.index("text")
    for block in item_blocks(benchmark, radius, threshold):

        def run(batches: Iterator[pa.RecordBatch], block=block) -> Iterator[pa.RecordBatch]:
            hashes = WordHashes()
            for batch in batches:
                clean = [not block.matches(hashes(words(text))) for text in batch.column(at).to_pylist()]
                yield batch.filter(pa.array(clean, pa.bool_()))

        docs = docs.mapInArrow(run, docs.schema)
    return docs
