"""Packing documents into sequences of a fixed length by best-two-fit, on the lengths' counts.

Each sequence is filled greedily, the longest piece that fits first; then its
smallest piece gives way to two pieces not yet packed that fill the gap more
tightly, if there are such. Pieces of one length are alike, so `plan` works on how
often each length occurs and repeats a filling for as long as those counts would lead
to it again: what it reads is one count per length, whatever the number of documents.

A piece finds its place by its number among the pieces of its length: `plan` says
which numbers go to which sequences. Numbers come from counts per task and their
prefix sums, so no length, however frequent, meets in one task.

What reaches the driver and every task is bounded by the capacity C alone: C counts,
and runs of numbers. A filling that is no longer possible has fewer pieces left of
some length than it takes of it, at most C / length times for each length, so there
are about C ln C fillings, of at most sqrt(2 C) different lengths each.

Defined results: a null or empty text is the end id alone; a text whose ids with the
end id exceed the capacity is cut into whole pieces of that size after a first one that may be
shorter; repeated rows and null ids are packed like others; an empty table gives
no sequences; of extra columns none is looked at.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from parcelmart.llm.common import stage
from parcelmart.llm.huffman_ids import ended, encoder

CAPACITY = 2048
END_ID = 0
# Room for a piece's number beside its length in one integer.
NUMBER_BITS = 48
PIECES = "doc_id long, piece int, start long, length int, ids binary, ids_crc32 long, task int, place long"


def cut(sizes: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Owner, number, start and length of the pieces of texts with `sizes` ids (1 or more)."""
    counts = -(-sizes // capacity)
    owner = np.repeat(np.arange(len(sizes)), counts)
    number = np.arange(len(owner)) - np.repeat(np.cumsum(counts) - counts, counts)
    first = sizes - (counts - 1) * capacity
    start = np.where(number == 0, 0, first[owner] + (number - 1) * capacity)
    return owner, number, start, np.where(number == 0, first[owner], capacity)


def pieces(docs: DataFrame, path: str, capacity: int = CAPACITY, end_id: int = END_ID) -> DataFrame:
    """All pieces with their ids (little-endian) and checksum (of 32-bit ids), written; `task` and `place`: who cut it, as which of its length."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        task, encode = TaskContext.get().partitionId(), encoder(path)
        seen = np.zeros(capacity + 1, np.int64)
        for batch in batches:
            at = 0
            for ids, sizes in encode.batches(batch.column("text")):
                doc_ids = batch.column("doc_id").slice(at, len(sizes))
                at += len(sizes)
                owner, number, start, length = cut(sizes + 1, capacity)
                raw = ended(ids, sizes, end_id).buffers()[2]
                bounds = np.concatenate(([0], np.cumsum(length)))
                offsets = pa.py_buffer((bounds * ids.itemsize).astype(np.int32))
                wide = memoryview(np.frombuffer(raw, ids.dtype).astype("<u4")).cast("B")
                sums = [zlib.crc32(wide[4 * a : 4 * b]) for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True)]
                columns = [
                    doc_ids.take(pa.array(owner)),
                    pa.array(number, pa.int32()),
                    pa.array(start, pa.int64()),
                    pa.array(length, pa.int32()),
                    pa.Array.from_buffers(pa.binary(), len(length), [None, offsets, raw]),
                    pa.array(sums, pa.int64()),
                    pa.array(np.full(len(length), task), pa.int32()),
                    pa.array(seen[length] + _number_among_equal(length), pa.int64()),
                ]
                seen += np.bincount(length, minlength=capacity + 1)
                yield pa.RecordBatch.from_arrays(columns, names=[c.split()[0] for c in PIECES.split(", ")])

    slim = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return stage(slim.mapInArrow(run, PIECES), "pieces")


def _number_among_equal(values: np.ndarray) -> np.ndarray:
    order = np.argsort(values, kind="stable")
    ordered = values[order]
    out = np.empty(len(values), np.int64)
    out[order] = np.arange(len(values)) - np.searchsorted(ordered, ordered)
    return out


@dataclass(frozen=True)
class Runs:
    """Pieces `first` .. of a length go to sequences `base` .., `each` to a sequence, from `offset` on."""

    length: np.ndarray
    first: np.ndarray
    each: np.ndarray
    base: np.ndarray
    offset: np.ndarray
    sequences: int

    def find(self, length: np.ndarray, number: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Sequence and offset of the numbered pieces."""
        run = np.searchsorted((self.length << NUMBER_BITS) + self.first, (length << NUMBER_BITS) + number, "right") - 1
        sequence, slot = np.divmod(number - self.first[run], self.each[run])
        return self.base[run] + sequence, self.offset[run] + slot * length


def filling(left: np.ndarray, at_most: np.ndarray) -> tuple[dict[int, int], dict[int, int]]:
    """The next sequence by best-two-fit: pieces of each length it takes, and how many it must find for that."""
    room, length = len(left) - 1, int(at_most[-1])
    taken: dict[int, int] = {}
    while length:
        taken[length] = min(int(left[length]), room // length)
        room -= taken[length] * length
        smallest = length
        length = int(at_most[min(room, length - 1)])
    if not room or sum(taken.values()) < 2:
        return taken, taken
    pair = _best_two(left, taken, smallest, room + smallest)
    if pair is None:
        return taken, taken
    needed, final = dict(taken), dict(taken)
    final[smallest] -= 1
    for length in pair:
        needed[length] = needed.get(length, 0) + 1
        final[length] = final.get(length, 0) + 1
    return {length: n for length, n in final.items() if n}, needed


def _best_two(left: np.ndarray, taken: dict[int, int], smallest: int, gap: int) -> tuple[int, int] | None:
    """Two lengths not taken whose sum is the largest within the gap and beyond the smallest piece."""
    free = left[: gap + 1].copy()
    for length, n in taken.items():
        if length <= gap:
            free[length] -= n
    there = np.flatnonzero(free)
    if not len(there):
        return None
    at_most = np.zeros(gap + 1, np.int64)
    at_most[there] = there
    at_most = np.maximum.accumulate(at_most)
    other = at_most[gap - there]
    fits = (other > there) | ((other == there) & (free[there] > 1))
    if not fits.any():
        return None
    sums = np.where(fits, there + other, 0)
    best = int(np.argmax(sums))
    return (int(there[best]), int(other[best])) if sums[best] > smallest else None


def plan(counts: np.ndarray) -> Runs:
    """Best-two-fit of all pieces; `counts[n]` pieces have length n, the last length is the capacity."""
    left, number = counts.astype(np.int64).copy(), np.zeros(len(counts), np.int64)
    lengths = np.arange(len(counts))
    rows: list[tuple[int, int, int, int, int]] = []
    base = 0
    while left.any():
        at_most = np.maximum.accumulate(np.where(left > 0, lengths, 0))
        final, needed = filling(left, at_most)
        times = min((int(left[n]) - needed[n]) // each + 1 for n, each in final.items())
        offset = 0
        for length, each in final.items():
            rows.append((length, int(number[length]), each, base, offset))
            number[length] += each * times
            left[length] -= each * times
            offset += each * length
        base += times
    table = np.array(sorted(rows), np.int64).reshape(-1, 5)
    return Runs(*table.T, sequences=base)


def placed(found: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """Pieces (with any further columns) and their `sequence_id` and `offset`."""
    counts = found.groupBy("task", "length").agg(F.count("*").alias("n"))
    counts = stage(counts, "piece-counts")
    histogram = np.zeros(capacity + 1, np.int64)
    by_length = counts.groupBy("length").agg(F.sum("n").alias("n")).toArrow()  # at most one row per length
    histogram[by_length.column("length").to_numpy()] = by_length.column("n").to_numpy()
    runs = found.sparkSession.sparkContext.broadcast(plan(histogram))
    before = F.sum("n").over(W.partitionBy("length").orderBy("task").rowsBetween(W.unboundedPreceding, -1))
    shifts = counts.select("task", "length", F.coalesce(before, F.lit(0)).alias("before"))
    rest = [c for c in found.columns if c not in ("task", "place")]
    numbered = found.join(shifts, ["task", "length"]).select(*rest, (F.col("before") + F.col("place")).alias("number"))
    kept = ", ".join(f"{name} {kind}" for name, kind in numbered.dtypes if name != "number")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            length = batch.column("length").to_numpy().astype(np.int64)
            sequence, offset = runs.value.find(length, batch.column("number").to_numpy())
            columns = [*(batch.column(c) for c in rest), pa.array(sequence), pa.array(offset)]
            yield pa.RecordBatch.from_arrays(columns, names=[*rest, "sequence_id", "offset"])

    return numbered.mapInArrow(run, f"{kept}, sequence_id long, offset long")


def packed(docs: DataFrame, path: str, capacity: int = CAPACITY, end_id: int = END_ID) -> DataFrame:
    """Every piece of every document with its ids and its place in a sequence."""
    return placed(pieces(docs, path, capacity, end_id), capacity)


def sequences(places: DataFrame) -> DataFrame:
    """(sequence_id, ids, lengths): the ids of each sequence in a row, and the lengths of its pieces."""
    parts = F.array_sort(F.collect_list(F.struct("offset", "length", "ids")))
    held = places.groupBy("sequence_id").agg(parts.alias("parts"))
    ids = F.aggregate("parts", F.lit(b"").cast("binary"), lambda joined, part: F.concat(joined, part["ids"]))
    return held.select("sequence_id", ids.alias("ids"), F.col("parts.length").alias("lengths"))
