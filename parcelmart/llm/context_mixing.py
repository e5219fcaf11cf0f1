"""Language-model scores by logistic mixing of hashed-context bit predictors.

A text is lower-cased (A-Z) and cut into words and one end. It is predicted bit by bit, from
the first word to the last. Of every token the bits say whether it is the word that a
copy of the text would have next, else whether the document has had it before, else whether the
corpus knows it; which one of the words of such a class it is follows from their counts,
and a word the corpus does not know is spelled. Every bit is predicted in several
contexts (place, what the last three tokens were, the word before, by count and by hash), each a
cell that counts what came after it. The predictions are mixed in the logistic domain by weights
that a gate (kind of bit, place) selects; cells and weights follow the text bit by bit.

What a copy would have next is known from hashed contexts (48 bits) of three words: every context of every teaching
document counts, with the word after it (as a mark of 16 bits) and whether the end follows that. Told is what the smallest
(doc_id, word) has after the context, or the largest if the smallest is the document's own. A document never learns from itself: its own tokens are taken off all counts.

Words are spelled by their UTF-8 bytes and a closing space, the end by a line feed and a space, each bit
predicted in the contexts of the last one to four bytes of the word and of all of it so far, hashed with
the bits of the byte so far into tables of counts. These are mixed alike, by weights gated by
bit and by how many of the contexts are known; a word has one spelling probability, so it is
computed once per chunk and not once per occurrence:

1. tasks number the words of their chunk of documents (`tokenize`),
2. words meet in one count per word over all teaching documents (`counted`, in packed lists, by parts of the
   vocabulary as many as there are chunks), and so do all contexts, by ranges of their hashes (`copies`),
3. tables of counts are summed over parts of the vocabulary, and weights are learnt on
   all of it and averaged (`learn`),
4. counts of words that several chunks have and continuations go back to the chunks, where words that one
   document may have alone are spelled and documents are mixed side by side, a bit of each at a time (`scored`).

Contexts travel once per slice of a chunk, so one that all documents share comes a few times per slice and not per document.

Counts, vocabulary and contexts grow with the corpus and are only ever joined; the spelling's
tables have a fixed number of slots (31 MB).

Defined results: a null or empty text is the end alone; repeated rows are separate
documents, rows of one doc_id no evidence for each other's copies; a null doc_id counts as the text ""
in the hash and as the smallest id for copies (one with -2^63); texts are scored whole at any length; with nothing to learn from all words are spelled, a bit
for each bit; an empty table gives an empty result; columns but doc_id and text are not looked at.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field
from itertools import repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from parcelmart.llm.common import doc_key, parallelism, stage

# Contexts and the bits of their tables' sizes.
ORDERS = (1, 2, 3, 4)
TABLE_BITS = (16, 17, 19, 20, 21)
# A gate of a spelled bit: its number in the byte, and how many contexts are known.
LEVELS = len(TABLE_BITS) + 1
GATES = 8 * LEVELS
# Bytes of text that share one numbering of words.
CHUNK_BYTES = 32 << 20
# Bytes of text that are numbered, and tokens that are mixed, at once.
PART_BYTES, MIXED_TOKENS = 4 << 20, 200_000
# Words of the vocabulary that one task counts bits of.
WORDS_PER_TASK = 1_000_000
SYMBOLS_PER_STEP = 1 << 20
SYMBOLS_PER_UPDATE = 1 << 13
RATE = 0.4
# Parts of the tables that are summed at once.
PIECE = 1 << 16
# One context in so many is kept: all; marks that are kept of what comes next: the word, after the last word's context the end, too.
SAMPLED, NEXT = 1, 2
MARKS = 65_535
# Words whose contexts are sorted at once, and bytes of text whose contexts meet in one part.
SLICE_WORDS, BYTES_PER_PART = 500_000, 8 << 20
# Documents that are mixed side by side.
SIDE_BY_SIDE = 2048
# Bits of each that are looked up at once.
STEPS = 32
END = b"\n"

_MIX = np.uint64(0x9E3779B97F4A7C15)
_NODE = np.uint64(0xC2B2AE3D27D4EB4F)
_POWER = 0x100000001B3


def teaches(doc_id: Column | str = "doc_id") -> Column:
    return doc_key(doc_id) % 7 != 2


@dataclass
class Model:
    """Counts of ones and of all bits per slot, and the mixing weights per gate."""

    ones: list[np.ndarray] = field(default_factory=lambda: [np.zeros(1 << b, np.float32) for b in TABLE_BITS])
    seen: list[np.ndarray] = field(default_factory=lambda: [np.zeros(1 << b, np.float32) for b in TABLE_BITS])
    weights: np.ndarray = field(default_factory=lambda: np.full((GATES, len(TABLE_BITS)), 0.3))


def symbols(words: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray, list[np.ndarray]]:
    """All bytes of the words with their closing space, places in the word, first bytes, and context hashes."""
    flat = np.frombuffer(b" ".join(words) + b" ", np.uint8)
    sizes = np.fromiter(map(len, words), np.int64, len(words)) + 1
    firsts = np.cumsum(sizes) - sizes
    place = np.arange(len(flat)) - np.repeat(firsts, sizes)
    wide = flat.astype(np.uint64) + np.uint64(1)
    contexts, context = [], np.zeros(len(flat), np.uint64)
    for order in range(1, max(ORDERS) + 1):
        before = np.zeros(len(flat), np.uint64)
        before[order:] = wide[:-order] if order < len(flat) else 0
        before[place < order] = 0
        context = context << np.uint64(9) | before
        if order in ORDERS:
            contexts.append(context)
    powers = np.multiply.accumulate(np.full(int(place.max(initial=0)) + 2, _POWER, np.uint64))
    sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum(wide * powers[place])))
    prefix = sums[:-1] - np.repeat(sums[firsts], sizes)
    contexts.append(prefix)
    return flat, place, firsts, contexts


def upper(contexts: list[np.ndarray]) -> list[np.ndarray]:
    """What slots of all bits of a byte share."""
    return [(c >> np.uint64(29)) * _NODE for c in contexts]


def _slot(context: np.ndarray, salt: np.ndarray, high: np.ndarray, size: int) -> np.ndarray:
    return ((context ^ salt) * _MIX ^ high) * _MIX >> np.uint64(64 - size)


def slots(contexts: list[np.ndarray], node: np.ndarray, shared: list[np.ndarray] | None = None) -> list[np.ndarray]:
    salt = node.astype(np.uint64) * _NODE
    parts = zip(contexts, shared or upper(contexts), TABLE_BITS, strict=True)
    return [_slot(c, salt, high, size) for c, high, size in parts]


def ascending(words: list[bytes]) -> np.ndarray:
    """Places of the words in the order of their bytes, so that words follow those that begin alike."""
    return pc.array_sort_indices(pa.array(words, pa.binary())).to_numpy().astype(np.int64)


def beginnings(flat: np.ndarray, place: np.ndarray, firsts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """What ascending words begin with: bytes that the word before does not have after the same beginning, and of all bytes the number of theirs among these.

    A byte's contexts lie in its word, so equal beginnings have equal bits.
    """
    sizes = np.diff(firsts, append=len(flat))
    shift = np.diff(firsts, prepend=0)
    # The word before has its closing space there, or another byte, or ended earlier.
    before = np.arange(len(flat)) - np.repeat(shift, sizes)
    differs = (flat[before] != flat) | (place >= np.repeat(shift, sizes))
    alike = np.minimum.reduceat(np.where(differs, place, np.repeat(sizes, sizes)), firsts)
    new = place >= np.repeat(alike, sizes)
    order = np.argsort(place.astype(np.uint16) if len(sizes) and sizes.max() < 1 << 16 else place, kind="stable")
    latest = np.maximum.accumulate(np.where(new[order], np.arange(len(flat)), 0))
    number = np.empty(len(flat), np.int64)
    number[order] = (np.cumsum(new) - 1)[order[latest]]
    return new, number


def known_contexts(inputs: list[np.ndarray]) -> np.ndarray:
    return sum((x != 0).view(np.int8) for x in inputs).astype(np.int64)


def bits(flat: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(number, the byte's bits so far after a leading one, the bit) from the highest bit on."""
    for k in range(8):
        yield k, (1 << k) | (flat.astype(np.int64) >> (8 - k)), flat >> (7 - k) & 1


def _batches(words: list[bytes], most: int) -> Iterator[slice]:
    begin, total = 0, 0
    for at, word in enumerate(words):
        total += len(word) + 1
        if total >= most:
            yield slice(begin, at + 1)
            begin, total = at + 1, 0
    if begin < len(words):
        yield slice(begin, len(words))


def count_bits(model: Model, words: list[bytes], counts: np.ndarray) -> None:
    """Add each word's bits, as often as the word occurs; of words that begin alike these bits at once."""
    order = ascending(words)
    words, counts = [words[i] for i in order.tolist()], counts[order]
    for part in _batches(words, SYMBOLS_PER_STEP):
        flat, place, firsts, contexts = symbols(words[part])
        weight = np.repeat(counts[part], np.diff(firsts, append=len(flat))).astype(np.float64)
        new, number = beginnings(flat, place, firsts)
        weight = np.tile(np.bincount(number, weight), 8)
        salted = [(node.astype(np.uint64) * _NODE, bit.astype(np.uint64)) for _, node, bit in bits(flat[new])]
        for k, size in enumerate(TABLE_BITS):
            context = contexts[k][new]
            high = upper([context])[0]
            at = np.concatenate([_slot(context, salt, high, size) << np.uint64(1) | bit for salt, bit in salted])
            both = np.bincount(at.view(np.int64), weight, 2 << size).reshape(-1, 2)
            model.seen[k] += both.sum(axis=1).astype(np.float32)
            model.ones[k] += both[:, 1].astype(np.float32)


def _stretched(ones, seen):
    return np.log((ones + 0.4) / (seen - ones + 0.4))


def without_one(model: Model) -> list[np.ndarray]:
    """Predictions of every slot without a token that has it: one of a 0 in its bit, one of a 1."""
    tables = []
    for ones, seen in zip(model.ones, model.seen, strict=True):
        table = np.empty((len(ones), 2), np.float32)
        for bit in (0, 1):
            rest = np.maximum(ones - np.float32(bit), 0)
            table[:, bit] = _stretched(rest, np.maximum(seen - 1, rest))
        tables.append(table.ravel())
    return tables


def learn_weights(model: Model, words: list[bytes], counts: np.ndarray, tables: list[np.ndarray] | None = None) -> np.ndarray:
    """Weights after one pass over the words, a gradient step for every gate and batch; `tables`: the model's `without_one`."""
    tables = tables or without_one(model)
    weights, step = model.weights.copy(), 0
    for part in _batches(words, SYMBOLS_PER_UPDATE):
        flat, _, firsts, contexts = symbols(words[part])
        weight = np.repeat(counts[part], np.diff(firsts, append=len(flat))).astype(np.float64)
        step += 1
        rate = RATE / np.sqrt(step)
        shared = upper(contexts)
        for k, node, bit in bits(flat):
            # Without the token that is being predicted.
            own = bit.astype(np.int64)
            inputs = [table.take(slot.view(np.int64) << 1 | own, mode="clip") for table, slot in zip(tables, slots(contexts, node, shared), strict=True)]
            gate = k * LEVELS + known_contexts(inputs)
            total = sum(w.take(gate) * x for w, x in zip(weights.T, inputs, strict=True))
            error = (bit - 1 / (1 + np.exp(-np.clip(total, -30, 30)))) * weight
            norm = np.maximum(np.bincount(gate, weight, GATES), 1e-9)
            for n, x in enumerate(inputs):
                weights[:, n] += rate * np.bincount(gate, error * x, GATES) / norm
    return weights


class Speller:
    """log10 of the probability of words."""

    def __init__(self, model: Model):
        self.weights = model.weights.astype(np.float32)
        self.tables = [_stretched(ones, seen).astype(np.float32) for ones, seen in zip(model.ones, model.seen, strict=True)]

    def bit_totals(self, flat, contexts) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        shared = upper(contexts)
        for k, node, bit in bits(flat):
            inputs = [table.take(slot.view(np.int64), mode="clip") for table, slot in zip(self.tables, slots(contexts, node, shared), strict=True)]
            gate = k * LEVELS + known_contexts(inputs)
            total = sum(w.take(gate) * x for w, x in zip(self.weights.T, inputs, strict=True))
            yield bit, np.clip(total, -20, 20)

    def __call__(self, words: list[bytes]) -> np.ndarray:
        out, order = np.zeros(len(words)), ascending(words)
        words = [words[i] for i in order.tolist()]
        for part in _batches(words, SYMBOLS_PER_STEP // 2):
            flat, place, firsts, contexts = symbols(words[part])
            new, number = beginnings(flat, place, firsts)
            cost = np.zeros(int(new.sum()))
            for bit, total in self.bit_totals(flat[new], [c[new] for c in contexts]):
                cost -= np.log1p(np.exp(np.where(bit == 1, -total, total)))
            out[order[part]] = np.add.reduceat(cost[number], firsts) / np.log(10)
        return out


# ---- the corpus -------------------------------------------------------------

TOKENS = (
    "kind int, chunk long, slot int, doc_id long, held_out boolean, n_bytes long, tokens binary, width int,"
    " local int, word binary, n long, documents long, context long, place int, next binary"
)
_KINDS = {"int": pa.int32(), "long": pa.int64(), "boolean": pa.bool_(), "binary": pa.binary()}
# Rows of `tokens`: documents, words, contexts (if asked for), how often tokens repeat, and all words of the chunk.
DOCUMENT, WORDS, CONTEXT, REPEATS, LISTED = range(5)
LISTED_WORDS = 20_000
# Parts of the vocabulary per task that reads documents.
PARTS = 4


def _planes(ids: np.ndarray, width: int) -> bytes:
    """Numbers as planes of bytes, which compress well."""
    return ids.astype("<u4").view(np.uint8).reshape(-1, 4)[:, :width].T.tobytes()


def _from_planes(raw: bytes, width: int) -> np.ndarray:
    planes = np.frombuffer(raw, np.uint8).reshape(width, -1).astype(np.int64)
    return sum(planes[k] << (8 * k) for k in range(width))


def _words(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """All words of the lower-cased texts, and how many each text has."""
    split = pc.ascii_split_whitespace(pc.ascii_lower(texts.fill_null("")))
    flat, bounds = split.flatten(), split.offsets.to_numpy()
    filled = pc.binary_length(flat).to_numpy(zero_copy_only=False) > 0
    sums = np.concatenate(([0], np.cumsum(filled)))
    return flat.filter(pa.array(filled)), np.diff(sums[bounds - bounds[0]])


def word_hash(word: bytes) -> int:
    """What Spark's xxhash64 gives, unsigned."""
    return xxhash.xxh64_intdigest(word, 42)


def marks(hashes: np.ndarray) -> np.ndarray:
    """Marks of words, from 1 on."""
    return (hashes & np.uint64(0xFFFFFFFF)) % np.uint64(MARKS) + np.uint64(1)


def context_hashes(whole: np.ndarray) -> np.ndarray:
    """Of every word the hash of the three before it, from the words' hashes; of no use at a document's first three."""
    context = np.zeros(len(whole), np.uint64)
    for back in (1, 2, 3):
        context[back:] = context[back:] * _MIX + whole[: max(len(whole) - back, 0)]
    return (context ^ context >> np.uint64(29)) * _NODE


def _listed(words: pa.Array) -> list:
    return words.to_numpy(zero_copy_only=False).tolist()


def _hashes(words: list[bytes]) -> np.ndarray:
    """`word_hash` of all words."""
    return np.fromiter(map(xxhash.xxh64_intdigest, words, repeat(42)), np.uint64, len(words))


def _packed(words: list[bytes]) -> bytes:
    return zlib.compress(b" ".join(words), 1)


def _unpacked(raw: bytes) -> list[bytes]:
    return zlib.decompress(raw).split(b" ")


def _numbers(rows: np.ndarray) -> bytes:
    """A table of numbers, column by column."""
    return zlib.compress(np.ascontiguousarray(rows.T).astype("<u4").tobytes(), 1)


def _from_numbers(raw: bytes, columns: int) -> np.ndarray:
    return np.frombuffer(zlib.decompress(raw), "<u4").reshape(columns, -1).astype(np.int64)


class Chunk:
    """Documents with the words they have numbered; number 0 is the end."""

    def __init__(self, number: int, parts: int = 1, contexts: bool = True):
        self.number, self.size, self.spread, self.contexts = number, 0, parts, contexts
        self.parts: list[tuple] = []

    def add(self, batch: pa.RecordBatch) -> None:
        words, sizes = _words(batch.column("text"))
        raw = pc.binary_length(batch.column("text")).fill_null(0).to_numpy().astype(np.int64)
        held = batch.column("held_out").to_numpy(zero_copy_only=False).astype(bool)
        self.parts.append((batch.column("doc_id"), held, raw, words.dictionary_encode(), sizes))
        # Also bounds the number of empty documents.
        self.size += int(raw.sum()) + 64 * len(raw)

    def rows(self) -> Iterator[pa.RecordBatch]:
        if not self.parts:
            return
        # Words are numbered in the order in which they come.
        numbered = pa.chunked_array([part[3] for part in self.parts]).unify_dictionaries()
        words = [END, *_listed(numbered.chunk(0).dictionary.cast(pa.binary()))]
        hashes = _hashes(words)
        n, documents = np.zeros(len(words), np.int64), np.zeros(len(words), np.int64)
        repeats = np.zeros((2, int(_STARTS[2])), np.int64)
        width = 3 if len(words) < 1 << 24 else 4
        slot = 0
        for (doc_id, held, raw, _, sizes), chosen in zip(self.parts, numbered.chunks, strict=True):
            ids = chosen.indices.to_numpy().astype(np.uint32) + np.uint32(1)
            ends, teach = np.cumsum(sizes), np.repeat(~held, sizes)
            before, _ = earlier(np.repeat(np.arange(len(sizes)), sizes), ids)
            n += np.bincount(ids[teach], minlength=len(words))
            documents += np.bincount(ids[teach & (before == 0)], minlength=len(words))
            n[0] += int((~held).sum())
            place = np.arange(len(ids)) - np.repeat(ends - sizes, sizes)
            counted = teach & (place > 0)
            for cell in repeat_cells(place, before > 0):
                repeats[1] += np.bincount(cell[counted], minlength=repeats.shape[1])
                repeats[0] += np.bincount(cell[counted & (before > 0)], minlength=repeats.shape[1])
            for at in range(0, len(sizes), 256):
                these = slice(at, at + 256)
                tokens = [_planes(ids[b - k : b], width) for b, k in zip(ends[these].tolist(), sizes[these].tolist(), strict=True)]
                yield self._batch(DOCUMENT, slot=slot + np.arange(at, at + len(tokens)), doc_id=doc_id[these], held_out=held[these], n_bytes=raw[these], tokens=tokens, width=np.full(len(tokens), width))
            if self.contexts:
                yield from self._contexts(hashes, doc_id, held, ids, ends, place, slot)
            slot += len(sizes)
        documents[0] = n[0]
        yield self._batch(REPEATS, local=np.arange(repeats.shape[1]), n=repeats[0], documents=repeats[1])
        both = np.stack((n, documents), axis=1)
        for at in range(0, len(words), LISTED_WORDS):
            yield self._batch(LISTED, slot=[at], word=[_packed(words[at : at + LISTED_WORDS])], next=[_numbers(both[at : at + LISTED_WORDS])])
        part = (hashes % np.uint64(self.spread)).astype(np.int64)
        order = np.argsort(part, kind="stable")
        counts = np.column_stack((np.arange(len(words)), both))
        for these in np.split(order, np.flatnonzero(np.diff(part[order])) + 1):
            yield self._batch(WORDS, slot=part[these[:1]], word=[_packed([words[i] for i in these.tolist()])], next=[_numbers(counts[these])])

    def _contexts(self, hashes, doc_id, held, ids, ends, place, slot) -> Iterator[pa.RecordBatch]:
        whole = hashes[ids]
        context = context_hashes(whole)
        at = np.flatnonzero((place > 2) & (context >> np.uint64(32) & np.uint64(SAMPLED - 1) == 0))
        doc = np.searchsorted(ends, at, "right")
        # Marks of all tokens, each document's followed by the end's.
        marked = np.empty(len(ids) + len(ends), "<u2")
        sizes = np.diff(ends, prepend=0)
        marked[np.arange(len(ids)) + np.repeat(np.arange(len(ends)), sizes)] = marks(whole)
        marked[ends + np.arange(len(ends))] = marks(hashes[:1])
        stops = ends[doc] + 1
        stops[:-1] = np.where(doc[1:] == doc[:-1], at[1:], stops[:-1])
        lengths = np.minimum(stops - at, NEXT)
        for begin in range(0, len(at), 10_000):
            these = slice(begin, begin + 10_000)
            starts = (at + doc)[these].tolist()
            kept = [None if held[d] else marked[a : a + k].tobytes() for d, a, k in zip(doc[these].tolist(), starts, lengths[these].tolist(), strict=True)]
            yield self._batch(CONTEXT, slot=slot + doc[these], doc_id=doc_id.take(pa.array(doc[these])), context=context[at[these]].view(np.int64), place=place[at[these]], next=kept)

    def _batch(self, kind: int, **columns) -> pa.RecordBatch:
        size = len(next(iter(columns.values())))
        columns |= {"kind": np.full(size, kind), "chunk": np.full(size, self.number)}
        fields = [c.split() for c in TOKENS.split(", ")]
        arrays = [pa.nulls(size, _KINDS[t]) if n not in columns else columns[n].cast(_KINDS[t]) if isinstance(columns[n], pa.Array) else pa.array(columns[n], _KINDS[t]) for n, t in fields]
        return pa.RecordBatch.from_arrays(arrays, names=[n for n, _ in fields])


def tokenize(docs: DataFrame, contexts: bool = True) -> DataFrame:
    """Rows of TOKENS, whose kinds are

    documents: in their chunk's word numbers, the end (number 0) not listed;
    words of a chunk: how often and in how many teaching documents they occur there, in lists by number and in
    lists by part of the vocabulary;
    contexts: where a context ends, and in teaching documents what comes next, a row each (left out if not `contexts`;
    `copies` makes its lists from documents and words);
    repeats: per cell of `repeat_cells` how many tokens teaching documents have, and how many of them again.
    """
    slim = docs.select(F.col("doc_id").cast("long").alias("doc_id"), (~teaches()).alias("held_out"), "text")
    parts = max(PARTS * slim.rdd.getNumPartitions(), 1)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        chunk = Chunk(TaskContext.get().partitionId() << 24, parts, contexts)
        for batch in batches:
            ends = np.cumsum(pc.binary_length(batch.column("text")).fill_null(0).to_numpy().astype(np.int64) + 64)
            at = 0
            while at < batch.num_rows:
                begun = ends[at - 1] if at else 0
                to = max(at + 1, int(np.searchsorted(ends, begun + PART_BYTES, "right")))
                chunk.add(batch.slice(at, to - at))
                at = to
                if chunk.size >= CHUNK_BYTES:
                    yield from chunk.rows()
                    chunk = Chunk(chunk.number + 1, parts, contexts)
        yield from chunk.rows()

    return slim.mapInArrow(run, TOKENS)


def earlier(doc: np.ndarray, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """How often the token's document has it before, and at all; documents follow each other."""
    run = np.arange(len(ids))
    key = doc * np.int64(int(ids.max(initial=0)) + 1) + ids
    size = len(ids).bit_length()
    if int(key.max(initial=0)).bit_length() + size < 64:
        # Numbers that have the token's place in their last bits sort faster than places.
        key = np.sort(key << size | run)
        order, key = key & ((1 << size) - 1), key >> size
    else:
        order = np.argsort(key, kind="stable")
        key = key[order]
    new = np.ones(len(ids), bool)
    new[1:] = key[1:] != key[:-1]
    firsts = np.flatnonzero(new)
    lengths = np.diff(firsts, append=len(ids))
    before, total = np.empty(len(ids), np.int64), np.empty(len(ids), np.int64)
    before[order] = run - np.repeat(firsts, lengths)
    total[order] = np.repeat(lengths, lengths)
    return before, total


COUNTED = "chunk long, word binary, next binary, n long, distinct long, once long, documents long"


def counted(tokens: DataFrame) -> DataFrame:
    """Counts of all words over the corpus, in two kinds of rows:

    per part of the vocabulary its words and (n, documents) packed, and sums over them: tokens, words that teaching
    documents have, words that one of them has, words per document;
    per part and chunk that shares words with others, (number, n, documents) of those, packed.
    """
    names = [c.split()[0] for c in COUNTED.split(", ")]
    kinds = [_KINDS[c.split()[1]] for c in COUNTED.split(", ")]

    def sums(lists: list[tuple[int, bytes, bytes]]) -> pa.RecordBatch:
        known: dict[bytes, int] = {}
        places, tables = [], []
        for _, words, numbers in lists:
            these = _unpacked(words)
            places.append(np.fromiter((known.setdefault(w, len(known)) for w in these), np.int64, len(these)))
            tables.append(_from_numbers(numbers, 3))
        total, chunks = np.zeros((2, len(known)), np.int64), np.zeros(len(known), np.int64)
        for place, table in zip(places, tables, strict=True):
            # A chunk has a word once.
            total[:, place] += table[1:]
            chunks[place] += 1
        taught = total[0] > 0
        whole = (None, _packed(list(known)), _numbers(total.T), int(total[0].sum()), int(taught.sum()), int((total[1] == 1).sum()), int(total[1].sum()))
        rows = [whole]
        for (chunk, _, _), place, table in zip(lists, places, tables, strict=True):
            shared = chunks[place] > 1
            if shared.any():
                rows.append((chunk, None, _numbers(np.column_stack((table[0][shared], *total[:, place[shared]]))), *[None] * 4))
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), kinds, strict=True)], names=names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, part = [], None
        for batch in batches:
            for row in batch.to_pylist():
                if row["slot"] != part and held:
                    yield sums(held)
                    held = []
                part = row["slot"]
                held.append((row["chunk"], row["word"], row["next"]))
        if held:
            yield sums(held)

    lists = tokens.where(F.col("kind") == WORDS).select("slot", "chunk", "word", "next")
    return lists.repartition(parallelism(tokens.sparkSession), "slot").sortWithinPartitions("slot").mapInArrow(run, COUNTED)


def vocabulary(counts: DataFrame) -> DataFrame:
    """(word, n, documents): every word of the corpus, how often and in how many teaching documents it occurs."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for word, numbers in zip(batch.column("word").to_pylist(), batch.column("next").to_pylist(), strict=True):
                n, documents = _from_numbers(numbers, 2)
                yield pa.RecordBatch.from_arrays([pa.array(_unpacked(word), pa.binary()), pa.array(n), pa.array(documents)], names=["word", "n", "documents"])

    lists = counts.where(F.col("word").isNotNull()).select("word", "next")
    return lists.mapInArrow(run, "word binary, n long, documents long")


# What comes after a context: the mark with its bytes swapped (so that numbers sort as its bytes do), then a bit for the end; 0 for nothing.
TAGS = 1 << 17


def tags(mark: np.ndarray, ends: np.ndarray) -> np.ndarray:
    return mark.astype("<u2").byteswap().astype(np.int64) << 1 | ends


def tag_marks(tag: np.ndarray) -> np.ndarray:
    return (tag >> 1).astype("<u2").byteswap()


def ordered_ids(doc_id: pa.ChunkedArray | pa.Array) -> np.ndarray:
    """Unsigned numbers in the order of the ids, null first."""
    return doc_id.fill_null(-(1 << 63)).to_numpy().astype(np.int64).view(np.uint64) ^ np.uint64(1 << 63)


def _long_numbers(columns: list[np.ndarray]) -> bytes:
    """Unsigned numbers in planes of bytes, of each column as many as it needs."""
    size, planes, widths = len(columns[0]), [], []
    for column in columns:
        width = max(1, -(-int(column.max(initial=0)).bit_length() // 8))
        widths.append(width)
        planes.append(column.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :width].T.tobytes())
    return size.to_bytes(4, "little") + bytes(widths) + pa.compress(b"".join(planes), "zstd", asbytes=True)


def _from_long_numbers(raw: bytes, columns: int) -> list[np.ndarray]:
    size, widths = int.from_bytes(raw[:4], "little"), raw[4 : 4 + columns]
    planes = np.frombuffer(pa.decompress(raw[4 + columns :], size * sum(widths), "zstd"), np.uint8).reshape(-1, size)
    out, at = [], 0
    for width in widths:
        wide = np.zeros((size, 8), np.uint8)
        wide[:, :width] = planes[at : at + width].T
        out.append(wide.view("<u8").reshape(-1))
        at += width
    return out


def _least(first: np.ndarray, group: np.ndarray, who: np.ndarray, tag: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The smallest (who, tag) of every group, of those that have a tag; (0, 0) if none has."""
    least = np.minimum.reduceat(np.where(tag > 0, who, ~np.uint64(0)), first)
    tagged = np.minimum.reduceat(np.where((tag > 0) & (who == least[group]), tag, TAGS), first)
    none = tagged == TAGS
    return np.where(none, np.uint64(0), least), np.where(none, 0, tagged)


def _most(first: np.ndarray, group: np.ndarray, who: np.ndarray, tag: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The largest, likewise."""
    most = np.maximum.reduceat(np.where(tag > 0, who, np.uint64(0)), first)
    return most, np.maximum.reduceat(np.where(who == most[group], tag, 0), first)


def _runs(ascending: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where runs of equal values begin, and of every value the number of its run."""
    new = np.ones(len(ascending), bool)
    new[1:] = ascending[1:] != ascending[:-1]
    return np.flatnonzero(new), np.cumsum(new) - 1


@dataclass
class Contexts:
    """Contexts of documents in a row: where they occur, whose, what is next, sorted by hash; each hash once and where it begins."""

    at: np.ndarray
    who: np.ndarray
    group: np.ndarray
    hashes: np.ndarray
    tag: np.ndarray
    first: np.ndarray

    def one(self) -> tuple[np.ndarray, np.ndarray]:
        return _least(self.first, self.group, self.who, self.tag)

    def two(self) -> tuple[np.ndarray, np.ndarray]:
        return _most(self.first, self.group, self.who, self.tag)


def contexts_of(ids: np.ndarray, sizes: np.ndarray, who: np.ndarray, held: np.ndarray, hashes: np.ndarray) -> Contexts | None:
    """All contexts of three words; `at` counts each document's words and its end. None if there are none."""
    ends = np.cumsum(sizes)
    doc = np.repeat(np.arange(len(sizes), dtype=np.int32), sizes)
    whole = hashes.take(ids)
    later = np.ones(len(ids), bool)
    for back in range(3):
        later[(ends - sizes + back)[sizes > back]] = False
    at = np.flatnonzero(later)
    if not len(at):
        return None
    context = context_hashes(whole)[at] >> np.uint64(16)
    order = np.argsort(context)
    context, at = context[order], at[order]
    first, group = _runs(context)
    doc = doc[at]
    tag = np.where(held[doc], 0, tags(marks(whole[at]), at == ends[doc] - 1))
    return Contexts(at + doc, who[doc], group, context[first], tag, first)


def _word_numbers(documents: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    """Word numbers of documents in a row, without ends, and how many each has."""
    ids = [_from_planes(raw, width).astype(np.uint32) for raw, width in zip(documents.column("tokens").to_pylist(), documents.column("width").to_pylist(), strict=True)]
    return np.concatenate([np.zeros(0, np.uint32), *ids]), np.array([len(x) for x in ids], np.int64)


def _slices(ids: np.ndarray, sizes: np.ndarray, doc_id: pa.ChunkedArray, held: np.ndarray, hashes: np.ndarray) -> Iterator[tuple[int, int, Contexts | None]]:
    """(first document, first of its words and ends, contexts) of slices of a chunk's documents, the same whenever they are made."""
    who, ends = ordered_ids(doc_id), np.cumsum(sizes)
    for low, high in _groups(sizes, SLICE_WORDS):
        begin = int(ends[low] - sizes[low])
        yield low, begin + low, contexts_of(ids[begin : ends[high - 1]], sizes[low:high], who[low:high], held[low:high], hashes)


def _chunk_words(listed: pa.Table) -> tuple[list[bytes], np.ndarray]:
    words = [word for part in listed.sort_by("slot").column("word").to_pylist() for word in _unpacked(part)]
    return words, _hashes(words)


COPIES = "chunk long, slot int, place int, next binary"
# Of a context whose smallest (doc_id, next) is of a document of the slice.
OWN = TAGS


def copies(tokens: DataFrame) -> DataFrame:
    """(chunk, slot, place, next): what follows a chunk's contexts in the corpus, per slice (its first document) and part of the hashes.

    Every context of every document takes part. Of a context's continuations the smallest and the largest (doc_id, next)
    are told, so a document that is one of them has the other. `next` packs, per context of the slice, ascending: the smallest's tag (xor the
    slice's own smallest) and, if that document is in the slice, OWN and the tag of the largest if it is another document.
    """
    total = tokens.where(F.col("kind") == DOCUMENT).agg(F.coalesce(F.sum("n_bytes"), F.lit(0))).first()[0]
    parts = 1 + total // BYTES_PER_PART
    kinds = [_KINDS[c.split()[1]] for c in COPIES.split(", ")]
    names = [c.split()[0] for c in COPIES.split(", ")]

    def lists(texts: pa.Table) -> pa.Table:
        is_list = pc.equal(texts.column("kind"), LISTED)
        documents = texts.filter(pc.invert(is_list)).sort_by("slot")
        _, hashes = _chunk_words(texts.filter(is_list))
        chunk = texts.column("chunk")[0].as_py()
        ids, sizes = _word_numbers(documents)
        held = documents.column("held_out").to_numpy()
        rows = []
        for low, _, found in _slices(ids, sizes, documents.column("doc_id"), held, hashes):
            if found is None:
                continue
            part = (found.hashes >> np.uint64(16)) * np.uint64(parts) >> np.uint64(32)
            first, _ = _runs(part)
            ones, twos = found.one(), found.two()
            for begin, end in zip(first.tolist(), [*first[1:].tolist(), len(part)], strict=True):
                these = slice(begin, end)
                (one, one_tag), (two, two_tag) = ((x[these] for x in pair) for pair in (ones, twos))
                base = one[one_tag > 0].min(initial=~np.uint64(0))
                near = np.where(one_tag > 0, one - base, np.uint64(0))
                gaps = np.diff(found.hashes[these], prepend=np.uint64(0))
                body = _long_numbers([gaps, near, one_tag, one ^ two, one_tag ^ two_tag])
                rows.append((chunk, low, int(part[begin]), int(base).to_bytes(8, "little") + body))
        return pa.Table.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True) if rows else [[]] * 4, kinds, strict=True)], names=names)

    def told(held: list[tuple[int, int, int, bytes]]) -> pa.RecordBatch:
        columns = [_from_long_numbers(body[8:], 5) for *_, body in held]
        bases = np.array([int.from_bytes(body[:8], "little") for *_, body in held], np.uint64)
        lengths = [len(c[0]) for c in columns]
        context = np.concatenate([np.cumsum(c[0], dtype=np.uint64) for c in columns])
        near, one_tag, both, both_tags = (np.concatenate([c[k] for c in columns]) for k in (1, 2, 3, 4))
        columns.clear()
        one_tag = one_tag.astype(np.int64)
        one = np.where(one_tag > 0, near + np.repeat(bases, lengths), np.uint64(0))
        two, two_tag = one ^ both, one_tag ^ both_tags.astype(np.int64)
        order = np.argsort(context)
        first, group = _runs(context[order])
        least, least_tag = _least(first, group, one[order], one_tag[order])
        most, most_tag = _most(first, group, two[order], two_tag[order])
        other = np.where(most != least, most_tag, 0)
        own = (one_tag[order] > 0) & (one[order] == least[group])
        tag, second = np.empty(len(order), np.int64), np.empty(len(order), np.int64)
        tag[order] = least_tag[group] ^ one_tag[order]
        second[order] = np.where(own, OWN | other[group], 0)
        stops = np.cumsum(lengths)
        packed = [_long_numbers([tag[stop - n : stop], second[stop - n : stop]]) for stop, n in zip(stops.tolist(), lengths, strict=True)]
        rows = zip(*((*row[:3], body) for row, body in zip(held, packed, strict=True)), strict=True)
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(rows, kinds, strict=True)], names=names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, part = [], None
        for batch in batches:
            for row in batch.to_pylist():
                if row["place"] != part and held:
                    yield told(held)
                    held = []
                part = row["place"]
                held.append(tuple(row[name] for name in names))
        if held:
            yield told(held)

    texts = tokens.where(F.col("kind").isin(DOCUMENT, LISTED)).select("chunk", "kind", "slot", "doc_id", "held_out", "tokens", "width", "word")
    spread = texts.groupBy("chunk").applyInArrow(lists, COPIES).repartition(parallelism(tokens.sparkSession), "place")
    return spread.sortWithinPartitions("place").mapInArrow(run, COPIES)


def repeat_rates(tokens: DataFrame) -> dict[int, tuple[int, int]]:
    """Per cell of `repeat_cells`: tokens of teaching documents that repeat, and all; a fixed number of cells."""
    rows = tokens.where(F.col("kind") == REPEATS).groupBy("local").agg(F.sum("n").alias("ones"), F.sum("documents").alias("seen")).collect()
    return {r.local: (r.ones, r.seen) for r in rows}


def _words_of(batches: Iterator[pa.RecordBatch]) -> tuple[list[bytes], np.ndarray]:
    words, counts = [], [np.zeros(0, np.int64)]
    for batch in batches:
        words += _listed(batch.column("word"))
        counts.append(batch.column("n").to_numpy())
    return words, np.concatenate(counts)


def learn(vocab: DataFrame) -> Model:
    """Tables summed over parts of the vocabulary, then weights learnt on all of it and averaged by tokens."""
    # Words the corpus does not know are what is spelled, so every word it knows counts once.
    known = vocab.where("n > 0").select("word", F.lit(1).cast("long").alias("n"))
    size = known.count()
    tasks = max(1, -(-size // WORDS_PER_TASK))
    dealt = stage(known.repartition(tasks, "word").sortWithinPartitions(F.xxhash64("word"), "word"), "known-words")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = Model()
        for batch in batches:
            words, counts = _words_of([batch])
            held.append((words, counts))
            if sum(len(w) for w, _ in held) >= 100_000:
                _count_held(model, held)
        _count_held(model, held)
        for k, (ones, seen) in enumerate(zip(model.ones, model.seen, strict=True)):
            for at in range(0, len(ones), PIECE):
                if seen[at : at + PIECE].any():
                    both = np.stack((ones[at : at + PIECE], seen[at : at + PIECE])).astype("<f4").tobytes()
                    yield pa.RecordBatch.from_pylist([{"k": k, "at": at, "both": both}], schema=pieces)

    held: list = []
    pieces = pa.schema([("k", pa.int32()), ("at", pa.int32()), ("both", pa.binary())])

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, total = None, None
        for batch in batches:
            for row in batch.to_pylist():
                both = np.frombuffer(row["both"], "<f4").astype(np.float64)
                if (row["k"], row["at"]) == last:
                    total += both
                    continue
                if last is not None:
                    yield pa.RecordBatch.from_pylist([{"k": last[0], "at": last[1], "both": total.astype("<f4").tobytes()}], schema=pieces)
                last, total = (row["k"], row["at"]), both
        if last is not None:
            yield pa.RecordBatch.from_pylist([{"k": last[0], "at": last[1], "both": total.astype("<f4").tobytes()}], schema=pieces)

    kinds = "k int, at int, both binary"
    spread = dealt.select("word", "n").mapInArrow(count, kinds).repartition(parallelism(vocab.sparkSession), "k", "at")
    model = Model()
    # The tables' size is fixed, and so is what reaches the driver.
    for row in spread.sortWithinPartitions("k", "at").mapInArrow(add, kinds).toArrow().to_pylist():
        ones, seen = np.frombuffer(row["both"], "<f4").reshape(2, -1)
        model.ones[row["k"]][row["at"] : row["at"] + PIECE] = ones
        model.seen[row["k"]][row["at"] : row["at"] + PIECE] = seen

    def weigh(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, total = Model(model.ones, model.seen, model.weights), 0
        tables = without_one(own)
        for batch in batches:
            words, counts = _words_of([batch])
            own.weights = learn_weights(own, words, counts, tables)
            total += int(counts.sum())
        yield pa.RecordBatch.from_pylist([{"n": total, "weights": own.weights.ravel().tolist()}], schema=learnt)

    learnt = pa.schema([("n", pa.int64()), ("weights", pa.list_(pa.float64()))])
    # One row per task, averaged by the tokens it has seen.
    parts = dealt.mapInArrow(weigh, "n long, weights array<double>")
    number = F.posexplode("weights").alias("i", "w")
    rows = parts.where("n > 0").select("n", number).groupBy("i").agg((F.sum(F.col("n") * F.col("w")) / F.sum("n")).alias("w")).collect()
    for row in rows:
        model.weights.ravel()[row.i] = row.w
    return model


def _count_held(model: Model, held: list) -> None:
    if held:
        count_bits(model, [w for words, _ in held for w in words], np.concatenate([counts for _, counts in held]))
        held.clear()


def spelled(vocab: DataFrame, model: Model) -> DataFrame:
    """(word, n, log10_p) of every word of the corpus."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        speller = Speller(model)
        for batch in batches:
            p = pa.array(speller(_listed(batch.column("word"))))
            yield pa.RecordBatch.from_arrays([batch.column("word"), batch.column("n"), p], names=["word", "n", "log10_p"])

    return vocab.select("word", "n").mapInArrow(run, "word binary, n long, log10_p double")


# ---- documents ----------------------------------------------------------------

# Kinds of bits: is the token repeated, known to the corpus, what a copy has next? Of each kind
# the sizes of its contexts, what their predictions weigh at first, and how many bits a cell's first prediction is worth.
REPEATED, KNOWN, COPIED = range(3)
PLACES, LASTS, CLASSES, COUNTS, HASHED, RUNS = 16, 27, 64, 16, 64, 8
CONTEXTS = ((PLACES, LASTS, COUNTS, HASHED), (PLACES, CLASSES, COUNTS, HASHED), (RUNS, PLACES, CLASSES, HASHED))
FIRST_WEIGHTS = ((0.4, 0.4, 0.15, 0.05), (0.3, 0.4, 0.2, 0.1), (0.7, 0.1, 0.1, 0.1))
FIRST_WORTH = ((16, 16, 4, 2), (8, 4, 4, 2), (6, 4, 4, 2))
# How sure a copy is after so many words that it had.
COPY_RATES = (0.6, 0.85, 0.92, 0.95, 0.97, 0.98, 0.985, 0.99)
GATE_SPAN = 4
DOC_GATES = 3 * (PLACES // GATE_SPAN)
DOC_RATE = 0.02
MOST_WORTH = 60
_STARTS = np.cumsum([0, *(n for kind in CONTEXTS for n in kind)])
CELLS = int(_STARTS[-1])


def _log2(x: np.ndarray) -> np.ndarray:
    return np.minimum(np.log2(x + 1.0).astype(np.int64), PLACES - 1)


def _before(values: np.ndarray, place: np.ndarray, back: int, missing: int) -> np.ndarray:
    """The value of the token `back` places before, in the same document."""
    out = np.full(len(values), missing, np.int64)
    out[back:] = values[:-back] if back < len(values) else 0
    return np.where(place >= back, out, missing)


def repeat_cells(place: np.ndarray, repeats: np.ndarray) -> list[np.ndarray]:
    """Cells by the place and by which of the last three tokens repeated, as the corpus counts them for all documents."""
    last = sum(3**k * _before(repeats + 1, place, k + 1, 0) for k in range(3))
    return [_log2(place), _STARTS[1] + last]


def first_cells(rates: dict[int, tuple[int, int]], unknown: float) -> tuple[np.ndarray, np.ndarray]:
    """First prediction and worth of every cell, the same for all documents."""
    p, worth = np.zeros(CELLS), np.zeros(CELLS)
    ones, seen = (sum(r[k] for cell, r in rates.items() if cell < PLACES) for k in (0, 1))
    general = ((ones + 0.4) / (seen + 1), 1 - unknown, 0.9)
    for kind, sizes in enumerate(CONTEXTS):
        for j, size in enumerate(sizes):
            begin = int(_STARTS[4 * kind + j])
            p[begin : begin + size], worth[begin : begin + size] = general[kind], FIRST_WORTH[kind][j]
    for cell, (ones, seen) in rates.items():
        p[cell] = (ones + 2 * general[0]) / (seen + 2)
    begin = int(_STARTS[4 * COPIED])
    p[begin : begin + RUNS] = COPY_RATES
    return np.clip(p, 1e-3, 1 - 1e-3), worth


@dataclass
class Facts:
    """What is known of a chunk's words: counts, log10 of spelling probabilities, marks; tokens of teaching documents."""

    count: np.ndarray
    spelling: np.ndarray
    marks: np.ndarray
    total: int


def predicted(ids: np.ndarray, sizes: np.ndarray, doc_id: pa.ChunkedArray, held: np.ndarray, hashes: np.ndarray, found: pa.Table) -> np.ndarray:
    """The mark that a copy has next, for every word and end of a chunk's documents; 0 for none. The latest context counts.

    found: the chunk's rows of `copies`.
    """
    out = np.zeros(len(ids) + len(sizes), np.uint16)
    found = found.sort_by([("slot", "ascending"), ("place", "ascending")])
    slots, packed = found.column("slot").to_numpy(), found.column("next")
    end = marks(hashes[:1]).astype(np.uint16)
    for low, begin, contexts in _slices(ids, sizes, doc_id, held, hashes):
        if contexts is None:
            continue
        first, stop = np.searchsorted(slots, (low, low + 1))
        answers = [_from_long_numbers(raw, 2) for raw in packed.slice(first, stop - first).to_pylist()]
        tag, second = (np.concatenate(c).astype(np.int64) for c in zip(*answers, strict=True))
        one, one_tag = contexts.one()
        tag ^= one_tag
        # A document whose own continuation is the smallest is told the largest.
        own = (second >= OWN)[contexts.group] & (contexts.who == one[contexts.group])
        tag = np.where(own, (second & (OWN - 1))[contexts.group], tag[contexts.group])
        at = contexts.at + begin
        out[at[tag & 1 == 1] + 1] = end
        out[at[tag > 0]] = tag_marks(tag[tag > 0])
    return out


@dataclass
class Bits:
    """The bits of documents in a row: cells of their contexts, gate, bit; per document how many, and what is not mixed."""

    cells: np.ndarray
    gates: np.ndarray
    bit: np.ndarray
    many: np.ndarray
    within: np.ndarray


def document_bits(ids: np.ndarray, sizes: np.ndarray, held: np.ndarray, copied: np.ndarray, facts: Facts) -> Bits:
    """What is to be predicted of each document, and the log10 probability of what follows from counts.

    ids: word numbers of documents in a row, each with its end; sizes: their words without the end;
    copied: mark of the word that a copy has next, or 0.
    """
    lengths = sizes + 1
    starts = np.cumsum(lengths) - lengths
    doc = np.repeat(np.arange(len(sizes)), lengths)
    place = np.arange(len(ids)) - starts[doc]
    before, own = earlier(doc, ids)
    # A teaching document's tokens are not evidence for it.
    known = facts.count[ids] - np.where(held[doc], 0, own)
    total = facts.total - np.where(held, 0, lengths)
    first = before == 0
    mass = np.cumsum(np.where(first, known, 0))
    mass -= np.where(first, known, 0)
    mass -= np.concatenate((mass, [0]))[starts][doc]
    unseen = total[doc] - mass
    hits = (copied != 0) & (copied == facts.marks[ids])
    asks_copy = copied != 0
    asks_repeat = ~hits & (place > 0)
    asks_known = ~hits & first & (unseen > 0)
    with np.errstate(divide="ignore"):
        again = np.log10(np.maximum(before, 1) / np.maximum(place, 1))
        corpus = np.log10(np.maximum(known, 1) / np.maximum(unseen, 1))
    within = np.where(hits, 0.0, np.where(~first, again, np.where((known > 0) & asks_known, corpus, facts.spelling[ids])))
    # The bits of all documents, each token's in order.
    many = asks_copy.astype(np.int64) + asks_repeat + asks_known
    ends = np.cumsum(many)
    begin = ends - many
    n_bits = int(ends[-1]) if len(ends) else 0
    # A bit's four cells are moved as one number.
    cells, bit, kind = np.zeros(n_bits, np.int64), np.zeros(n_bits, bool), np.zeros(n_bits, np.int8)
    by_place, by_last = repeat_cells(place, ~first)
    classes = np.where(~first, 1, np.where(known > 0, 2, 3))
    last = sum(4**k * _before(classes, place, k + 1, 0) for k in range(3))
    counts = _log2(_before(np.maximum(known, 0), place, 1, 0))
    hashed = _before(facts.marks[ids].astype(np.int64) & (HASHED - 1), place, 1, 0)
    run = _hit_runs(hits, place)
    contexts = ((by_place, by_last - _STARTS[1], counts, hashed), (by_place, last, counts, hashed), (run, by_place, last, hashed))
    # A token's bits: copied, repeated, known.
    after = {COPIED: 0, REPEATED: asks_copy.astype(np.int64), KNOWN: asks_copy.astype(np.int64) + asks_repeat}
    for which, asked, answer in ((REPEATED, asks_repeat, ~first), (KNOWN, asks_known, known > 0), (COPIED, asks_copy, hits)):
        asks = np.flatnonzero(asked)
        at = (begin + after[which]).take(asks)
        rows = np.empty((len(asks), 4), np.int16)
        for j in range(4):
            rows[:, j] = contexts[which][j].take(asks) + _STARTS[4 * which + j]
        cells[at] = rows.view(np.int64).ravel()
        bit[at], kind[at] = answer.take(asks), which
    gates = kind * np.int8(PLACES // GATE_SPAN) + (np.repeat(by_place, many) // GATE_SPAN).astype(np.int8)
    bits_of = np.bincount(doc, many, len(sizes)).astype(np.int64)
    return Bits(cells.view(np.int16).reshape(-1, 4), gates, bit, bits_of, np.bincount(doc, within, len(sizes)))


def document_scores(parts: list[Bits], begin: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    """log10 probability of each document; `begin`: first prediction and worth of every cell."""
    cells, gates, bit, many, within = (np.concatenate([getattr(p, name) for p in parts]) for name in ("cells", "gates", "bit", "many", "within"))
    # Their bits are held once.
    parts.clear()
    first = np.cumsum(many) - many
    order = np.argsort(-many, kind="stable")
    for at in range(0, len(order), SIDE_BY_SIDE):
        these = order[at : at + SIDE_BY_SIDE]
        within[these] += mixed(first[these], many[these], cells, gates, bit, begin)
    return within


def _hit_runs(hits: np.ndarray, place: np.ndarray) -> np.ndarray:
    """How many tokens right before had what a copy has, up to RUNS - 1."""
    broken = ~hits
    number = np.arange(len(hits))
    since = np.maximum.accumulate(np.where(broken, number, -1)) if len(hits) else number
    run = np.zeros(len(hits), np.int64)
    run[1:] = number[:-1] - since[:-1]
    return np.minimum(np.minimum(run, place), RUNS - 1)


def mixed(first: np.ndarray, n_bits: np.ndarray, cells: np.ndarray, gates: np.ndarray, bit: np.ndarray, begin: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    """log10 probability of each document's bits (`n_bits` descending), mixed bit by bit, a bit of every document at a time."""
    # One row of cells, and of weights, after the other; arrays of a step go by context, then document.
    # A cell's prediction and worth are moved as one number.
    states = np.tile(np.stack(begin, axis=1).astype(np.float32).view(np.int64).ravel(), len(first))
    weights = np.tile(np.repeat(np.array(FIRST_WEIGHTS, np.float32), PLACES // GATE_SPAN, axis=0).T, (1, len(first)))
    out = np.zeros(len(first))
    rows = np.arange(len(first))
    cell_rows, gate_rows = rows * CELLS, rows * DOC_GATES
    packed = cells.view(np.int64).ravel()
    steps = np.arange(int(n_bits.max(initial=0)))
    for step, active in enumerate(np.searchsorted(-n_bits, -steps).tolist()):
        if step % STEPS == 0:
            # Of the next steps what the documents that are left have; beyond a document's end nothing is looked at.
            at = np.minimum(first[:active] + np.arange(step, min(step + STEPS, len(steps)))[:, None], len(bit) - 1)
            bits_ahead, gates_ahead = bit.take(at), gates.take(at) + gate_rows[:active]
            ones_ahead = bits_ahead.astype(np.float32)
            places = packed.take(at).view(np.int16).reshape(*at.shape, 4).transpose(0, 2, 1) + cell_rows[:active]
            places = np.ascontiguousarray(places)
        ahead = step % STEPS
        is_one, one = bits_ahead[ahead, :active], ones_ahead[ahead, :active]
        place, gate = places[ahead, :, :active], gates_ahead[ahead, :active]
        state, weight = states.take(place, mode="clip"), weights.take(gate, axis=1, mode="clip")
        both = state.view(np.float32)
        guess, seen = both[:, ::2], both[:, 1::2]
        stretched = np.log(guess / (1 - guess))
        total = (weight * stretched).sum(axis=0)
        chance = 1 / (1 + np.exp(-np.minimum(np.maximum(total, -9), 9)))
        out[:active] += np.log10(np.where(is_one, chance, 1 - chance))
        weights[:, gate] = weight + DOC_RATE * (one - chance) * stretched
        np.minimum(np.maximum(guess + (one - guess) / (seen + 1.5), 1e-3), 1 - 1e-3, out=guess)
        np.minimum(seen + 1, MOST_WORTH, out=seen)
        states[place] = state
    return out


SCORES = (
    "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long,"
    " base_score double, score double, bits_per_byte double"
)


def _groups(sizes: np.ndarray, most: int) -> Iterator[tuple[int, int]]:
    """Documents that are handled at once, of `most` in size together, or one."""
    ends, at = np.cumsum(sizes, dtype=np.int64), 0
    while at < len(ends):
        begun = ends[at - 1] if at else 0
        to = max(at + 1, int(np.searchsorted(ends, begun + most, "right")))
        # Many empty documents make a group, too.
        to = min(to, at + 8 * SIDE_BY_SIDE)
        yield at, to
        at = to


def scored(docs: DataFrame) -> DataFrame:
    """Rows of SCORES for every row of docs (doc_id, text)."""
    tokens = stage(tokenize(docs, contexts=False), "tokens", partition_by="kind")
    found = stage(copies(tokens), "copies")
    counts = stage(counted(tokens), "word-counts")
    sums = counts.agg(*(F.coalesce(F.sum(c), F.lit(0)) for c in ("n", "distinct", "once", "documents"))).first()
    total, distinct = sums[0], sums[1]
    # Of the words that are new to a document, those that no other teaching document has.
    begin = first_cells(repeat_rates(tokens), sums[2] / sums[3] if sums[3] else 1.0)
    model = learn(vocabulary(counts))
    nothing = [F.lit(None).cast("int").alias(name) for name in ("slot", "place")]
    shared = counts.where(F.col("word").isNull()).select("chunk", *nothing, "next")
    told = shared.unionByName(found)
    columns = ("kind", "slot", "doc_id", "held_out", "n_bytes", "tokens", "width", "word", "next")
    texts = tokens.where(F.col("kind").isin(DOCUMENT, LISTED)).select(F.col("chunk").alias("own_chunk"), *columns)
    names = [c.split()[0] for c in SCORES.replace("\n", "").split(",")]
    schema = pa.schema(list(zip(names, (pa.int64(), pa.bool_(), *[pa.int64()] * 3, *[pa.float64()] * 3), strict=True)))

    held_model = docs.sparkSession.sparkContext.broadcast(model)  # 31 MB at any size of the corpus

    def run(texts: pa.Table, told: pa.Table) -> pa.Table:
        is_list, is_copy = pc.equal(texts.column("kind"), LISTED), pc.is_valid(told.column("place"))
        documents, listed = texts.filter(pc.invert(is_list)).sort_by("slot"), texts.filter(is_list).sort_by("slot")
        shared, found = told.filter(pc.invert(is_copy)), told.filter(is_copy)
        words, hashes = _chunk_words(listed)
        count, documents_with = np.concatenate([_from_numbers(part, 2) for part in listed.column("next").to_pylist()], axis=1)
        for part in shared.column("next").to_pylist():
            local, n, m = _from_numbers(part, 3)
            count[local], documents_with[local] = n, m
        # A word of two teaching documents is known to every document.
        spelling, alone = np.zeros(len(words)), np.flatnonzero(documents_with < 2)
        spelling[alone] = Speller(held_model.value)([words[i] for i in alone])
        facts = Facts(count, spelling, marks(hashes).astype(np.uint16), total)
        base = np.log10((count + 1) / (total + distinct + 1))
        del words, listed, shared
        held = documents.column("held_out").to_numpy()
        ids, all_sizes = _word_numbers(documents)
        copied = predicted(ids, all_sizes, documents.column("doc_id"), held, hashes, found)
        starts = np.cumsum(all_sizes) - all_sizes
        bits, columns = [], []
        for low, high in _groups(pc.binary_length(documents.column("tokens")).to_numpy(), 3 * MIXED_TOKENS):
            sizes = all_sizes[low:high]
            begin_at, n_words = int(starts[low]), int(sizes.sum())
            doc = np.repeat(np.arange(len(sizes)), sizes + 1)
            # Number 0 is the end.
            joined = np.zeros(n_words + len(sizes), np.int64)
            joined[np.arange(n_words) + np.repeat(np.arange(len(sizes)), sizes)] = ids[begin_at : begin_at + n_words]
            bits.append(document_bits(joined, sizes, held[low:high], copied[begin_at + low :][: len(joined)], facts))
            columns.append((sizes + 1, np.bincount(doc, count[joined] > 0, len(sizes)).astype(np.int64), np.bincount(doc, base[joined], len(sizes))))
        n_tokens, n_known, base_score = (np.concatenate(c) for c in zip(*columns, strict=True))
        score = document_scores(bits, begin)
        n_bytes = np.maximum(documents.column("n_bytes").to_numpy(), 1)
        pa.default_memory_pool().release_unused()
        arrays = [n_tokens, n_known, np.full(len(score), total), base_score, score, -score * np.log2(10) / n_bytes]
        return pa.Table.from_arrays([documents.column("doc_id"), documents.column("held_out"), *map(pa.array, arrays)], schema=schema)

    # A chunk is bounded by CHUNK_BYTES (or one document), whatever the corpus holds.
    return texts.groupBy("own_chunk").cogroup(told.groupBy("chunk")).applyInArrow(run, SCORES)
