"""Token ids as canonical length-limited Huffman code in independent blocks.

`write` encodes texts with a public tokenizer, counts all ids, builds one
code from the global counts and writes a folder of three Parquet tables:

    blocks    one row per block of BLOCK ids: shard, block, at, n_tokens, payload,
              checkpoints, doc_ids, doc_tokens, first_start
    codebook  id, length; codes are canonical (by length, then id)
    shards    shard, start, n_tokens: ids of all shards before, ids of the shard

Shards are ranges of doc_id (or of the order given) and a shard is one file or more, so blocks by
(shard, block) hold all ids in ascending doc_id order (or that order). `payload` is the bit
string of a block, `checkpoints` (little-endian unsigned 32-bit) the bit offset
of every STEP-th id; a decoder steps from all checkpoints at once and looks
`limit` bits up in one table. `doc_tokens` are the ids each document has in
the block; the first may have begun earlier, at `first_start` of its shard.

Rows as files: Spark's committer makes a repeated task harmless, and blocks are
read by column. Defined results: a null or empty text is the end id alone;
repeated rows follow each other; a null doc_id comes first; an empty table
writes empty tables and reads back as none; a text may run over many blocks, its ids up to
2 GB; columns but doc_id and text are not written.
"""

from __future__ import annotations

import os
import re
import zlib
from collections.abc import Iterator
from functools import cache
from itertools import compress, repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from parcelmart.llm.common import parallelism, stage

END_ID = 2
BLOCK = 1 << 18
STEP = 128
LIMIT = 17
# Pieces a worker keeps, at most, and those it encodes as one text.
CACHE_PIECES = 1_000_000
JOINED = 4096
BATCH_BYTES = 1 << 23
# Unicode's White_Space characters.
WHITE = "\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
# The tokenizer never joins what stands before white space to what follows, so
# a text is the concatenation of these pieces' ids.
PIECE = re.compile(f"[{WHITE}]*[^{WHITE}]+|[{WHITE}]+")
# White space before a space, and the separator used below (a pattern of Arrow's).
_ODD = f"[{WHITE}] |\\x00"
# A full stop or comma that may belong to more than itself; letters about which all Unicode versions agree.
_RUN = "(^|[^A-Za-z0-9\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u024f])[.,]"
PRINTS = "<u4"


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


class Encoder:
    """Ids of texts; pieces seen before are looked up.

    Texts are cut and their pieces numbered as Arrow arrays, so each distinct
    piece of a batch is looked up once and numpy lays out the ids. Unknown pieces
    that begin with a space are encoded as one long text and told apart by the ids' lengths.
    """

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.size = self.tokenizer.get_vocab_size(with_added_tokens=True)
        self.kind = "<u2" if self.size <= 1 << 16 else "<u4"
        # A byte-level token has one character per byte.
        self.bytes = np.zeros(self.size, np.int64)
        for token, number in self.tokenizer.get_vocab(with_added_tokens=True).items():
            self.bytes[number] = len(token)
        special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        # Pieces that cannot follow others in one text (a pattern of Arrow's).
        self.apart = "|".join(["^[^ ]", f"[{WHITE}]$", *map(re.escape, special)])
        # Pieces by number; their ids stand in `pool`, from `starts` on; `seen` counts their batches.
        self.known: dict[str, int] = {"": 0}
        self.starts, self.sizes, self.seen = (np.zeros(1 << 16, np.int64) for _ in range(3))
        self.pool, self.used = np.zeros(1 << 18, self.kind), 0

    def _forget(self) -> None:
        """Keep the pieces that most batches had, half of what may be kept; age their counts."""
        count = len(self.known)
        keep = self.seen[:count] > 1
        if keep.sum() > CACHE_PIECES // 2:
            keep = self.seen[:count] > np.partition(self.seen[:count], count - CACHE_PIECES // 2)[count - CACHE_PIECES // 2]
        keep[0] = True
        names = list(compress(self.known, keep))
        sizes, starts = self.sizes[:count][keep], self.starts[:count][keep]
        ends = np.cumsum(sizes)
        ids = self.pool[np.arange(ends[-1]) + np.repeat(starts - ends + sizes, sizes)]
        self.known = dict(zip(names, range(len(names)), strict=True))
        self.seen[: len(names)] = self.seen[:count][keep] // 2
        self.seen[len(names) :] = 0
        self.sizes[: len(names)], self.starts[: len(names)] = sizes, ends - sizes
        self.pool[: len(ids)], self.used = ids, len(ids)

    def __call__(self, texts: list[str | None]) -> Iterator[bytes]:
        for ids, sizes in self.batches(pa.array(texts, pa.string())):
            for part in np.split(ids, np.cumsum(sizes)[:-1]):
                yield part.tobytes()

    def batches(self, texts: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """All ids of some following texts, and how many each text has."""
        texts = texts.fill_null("")
        ends = np.cumsum(pc.binary_length(texts).to_numpy(zero_copy_only=False), dtype=np.int64)
        at = 0
        while at < len(texts):
            begun = ends[at - 1] if at else 0
            to = max(at + 1, int(np.searchsorted(ends, begun + BATCH_BYTES, "right")))
            yield self._encoded(texts.slice(at, to - at))
            at = to

    def _encoded(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        pieces = _pieces(texts)
        bounds = pieces.offsets.to_numpy()
        numbered = pieces.flatten().dictionary_encode()
        number = self._numbers(numbered.dictionary)[numbered.indices.to_numpy()]
        lengths = self.sizes[number]
        ends = np.concatenate(([0], np.cumsum(lengths)))
        ids = self.pool[np.arange(ends[-1]) + np.repeat(self.starts[number] - ends[:-1], lengths)]
        return ids, np.diff(ends[bounds - bounds[0]])

    def _numbers(self, pieces: pa.Array) -> np.ndarray:
        """Numbers of distinct pieces; unknown ones become known."""
        if len(self.known) > CACHE_PIECES:
            self._forget()
        names = pieces.to_pylist()
        numbers = np.fromiter(map(self.known.get, names, repeat(-1)), np.int64, len(names))
        new = numbers < 0
        if new.any():
            numbers[new] = np.arange(len(self.known), len(self.known) + int(new.sum()))
            self._learn(pieces.filter(pa.array(new)))
            self.known.update(zip(compress(names, new), numbers[new].tolist(), strict=True))
        self.seen[numbers] += 1
        return numbers

    def _learn(self, new: pa.Array) -> None:
        """Append the ids of new pieces, which take the next numbers."""
        alone = pc.match_substring_regex(new, self.apart).to_numpy(zero_copy_only=False)
        lengths = pc.binary_length(new).to_numpy()
        names = new.to_pylist()
        order = np.concatenate((np.flatnonzero(alone), np.flatnonzero(~alone)))
        encode = self.tokenizer.encode_batch_fast
        parts = [np.array(e.ids, self.kind) for e in encode(list(compress(names, alone)), add_special_tokens=False)]
        sizes = [np.fromiter(map(len, parts), np.int64, len(parts))]
        following, lengths = list(compress(names, ~alone)), lengths[~alone]
        for at in range(0, len(following), JOINED):
            ids = np.array(encode(["".join(following[at : at + JOINED])], add_special_tokens=False)[0].ids, self.kind)
            ends, reached = np.cumsum(lengths[at : at + JOINED]), np.cumsum(self.bytes[ids])
            cuts = np.searchsorted(reached, ends)
            if not np.array_equal(reached[np.minimum(cuts, len(reached) - 1)], ends):
                raise ValueError("the tokenizer joined words across white space")
            parts.append(ids)
            sizes.append(np.diff(cuts, prepend=-1))
        self._append(order + len(self.known), np.concatenate(parts), np.concatenate(sizes))

    def _append(self, numbers: np.ndarray, ids: np.ndarray, sizes: np.ndarray) -> None:
        count, used = int(numbers.max()) + 1, self.used + len(ids)
        if count > len(self.starts):
            self.starts, self.sizes, self.seen = (np.pad(x, (0, 2 * count - len(x))) for x in (self.starts, self.sizes, self.seen))
        if used > len(self.pool):
            self.pool = np.pad(self.pool, (0, 2 * used - len(self.pool)))
        self.pool[self.used : used] = ids
        self.sizes[numbers] = sizes
        self.starts[numbers] = self.used + np.cumsum(sizes) - sizes
        self.used = used


def _pieces(texts: pa.Array) -> pa.ListArray:
    """Texts cut before spaces that follow no other white space, and between letters or digits and full stops or commas."""
    spaced = pc.replace_substring(texts, " ", "\0 ")
    marked = pc.replace_substring(pc.replace_substring(spaced, ".", "\0."), ",", "\0,")
    plain = pc.split_pattern(pc.if_else(pc.match_substring_regex(texts, _RUN), spaced, marked), "\0")
    odd = pc.match_substring_regex(texts, _ODD)
    if not pc.any(odd).as_py():
        return plain
    cut = pa.array([PIECE.findall(t) for t in texts.filter(odd).to_pylist()], plain.type)
    flags = odd.to_numpy(zero_copy_only=False)
    order = np.where(flags, len(plain) + np.cumsum(flags) - 1, np.arange(len(plain)))
    return pa.concat_arrays([plain, cut]).take(pa.array(order))


@cache
def encoder(path: str) -> Encoder:
    return Encoder(path)


def encoded(docs: DataFrame, path: str, end_id: int = END_ID, order: Column | None = None) -> DataFrame:
    """(doc_id, ids) with ids as little-endian unsigned 16-bit integers, or 32-bit for larger vocabularies; and `place`, the order if given."""
    slim = docs.select(F.col("doc_id").cast("long"), "text", *([] if order is None else [order.alias("place")]))
    places = [] if order is None else ["place"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(path)
        for batch in batches:
            at = 0
            for ids, sizes in encode.batches(batch.column("text")):
                part = batch.slice(at, len(sizes))
                at += len(sizes)
                columns = [part.column("doc_id"), ended(ids, sizes, end_id), *(part.column(c) for c in places)]
                yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "ids", *places])

    return slim.mapInArrow(run, "doc_id long, ids binary" + "".join(f", {c} {dict(slim.dtypes)[c]}" for c in places))


def ended(ids: np.ndarray, sizes: np.ndarray, end_id: int) -> pa.Array:
    """The ids of each text and the end id, as bytes."""
    ends = np.cumsum(sizes + 1)
    out = np.full(len(ids) + len(sizes), end_id, ids.dtype)
    inside = np.ones(len(out), bool)
    inside[ends - 1] = False
    out[inside] = ids
    offsets = np.concatenate(([0], ends)) * out.itemsize
    if offsets[-1] >= 1 << 31:
        raise ValueError("the ids of one text take more than 2 GB")
    return pa.Array.from_buffers(pa.binary(), len(sizes), [None, pa.py_buffer(offsets.astype(np.int32)), pa.py_buffer(out)])


def id_type(path: str) -> str:
    return encoder(path).kind


def counts(ids: DataFrame, kind: str, size: int) -> np.ndarray:
    """How often each id occurs; at most one row per id of the vocabulary reaches the driver."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size, np.int64)
        for batch in batches:
            for at in range(0, batch.num_rows, 2048):
                joined = b"".join(batch.column("ids").slice(at, 2048).to_pylist())
                total += np.bincount(np.frombuffer(joined, kind), minlength=size)
        seen = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(seen), pa.array(total[seen])], names=["id", "n"])

    rows = ids.select("ids").mapInArrow(run, "id long, n long").groupBy("id").agg(F.sum("n").alias("n")).toArrow()
    out = np.zeros(size, np.int64)
    out[rows.column("id").to_numpy()] = rows.column("n").to_numpy()
    return out


def code_lengths(weights: np.ndarray, limit: int = LIMIT) -> np.ndarray:
    """Lengths of an optimal prefix code of at most `limit` bits (package merge); 0 for weight 0.

    Each level merges the weights with the pairs of the level before; the
    2n - 2 cheapest entries of the last level, followed down, say how often
    each symbol is chosen, which is its length.
    """
    used = np.flatnonzero(weights)
    lengths = np.zeros(len(weights), np.uint8)
    n = len(used)
    if n < 2:
        lengths[used] = 1
        return lengths
    if n > 1 << limit:
        raise ValueError(f"{n} ids do not fit codes of {limit} bits")
    order = used[np.argsort(weights[used], kind="stable")]
    leaves = weights[order].astype(np.int64)
    level, leaf_flags = leaves, []
    for _ in range(limit):
        leaf_flags.append(None)
        pairs = level[: len(level) // 2 * 2].reshape(-1, 2).sum(axis=1)
        merged = np.concatenate((leaves, pairs))
        by_weight = np.argsort(merged, kind="stable")
        leaf_flags[-1] = by_weight < n
        level = merged[by_weight]
    # The first level is the leaves alone; the last round's pairs are one level too many.
    flags = [np.ones(n, bool), *leaf_flags[: limit - 1]]
    chosen, take = np.zeros(n, np.int64), 2 * n - 2
    for flag in reversed(flags):
        leaf = int(flag[:take].sum())
        chosen[:leaf] += 1
        take = 2 * (min(take, len(flag)) - leaf)
    lengths[order] = chosen
    return lengths


def canonical(lengths: np.ndarray) -> np.ndarray:
    """Codes by length, then id."""
    codes = np.zeros(len(lengths), np.uint64)
    code, last = 0, 0
    for symbol in np.lexsort((np.arange(len(lengths)), lengths)):
        length = int(lengths[symbol])
        if length:
            code <<= length - last
            codes[symbol] = code
            code, last = code + 1, length
    return codes


def lookup(lengths: np.ndarray) -> tuple[np.ndarray, int]:
    """For every value of the next `width` bits: the id times 256 plus the length of its code."""
    width = max(int(lengths.max(initial=1)), 1)
    symbols = np.lexsort((np.arange(len(lengths)), lengths))
    symbols = symbols[lengths[symbols] > 0]
    spans = np.left_shift(1, width - lengths[symbols].astype(np.int64))
    table = np.ones(1 << width, np.uint32)
    table[: int(spans.sum())] = np.repeat(symbols << 8 | lengths[symbols], spans)
    return table, width


def pack(ids: np.ndarray, codes: np.ndarray, lengths: np.ndarray) -> tuple[bytes, bytes]:
    """The block's bit string and its checkpoints."""
    size = lengths[ids].astype(np.int64)
    ends = np.cumsum(size)
    offsets = ends - size
    value = codes[ids] << (64 - (offsets & 31) - size).astype(np.uint64)
    words = int(ends[-1] >> 5) + 2
    word = offsets >> 5
    # Codes never share a bit, so sums (exact below 2^53) stand for unions.
    bits = np.bincount(word, (value >> np.uint64(32)).astype(np.float64), words)
    bits += np.bincount(word + 1, (value & np.uint64(0xFFFFFFFF)).astype(np.float64), words)
    payload = bits.astype(">u4").tobytes()[: int(ends[-1] + 7) // 8]
    return payload, offsets[::STEP].astype("<u4").tobytes()


def unpack(payload: bytes, checkpoints: bytes, n: int, table: tuple[np.ndarray, int]) -> np.ndarray:
    """The ids of a block: all checkpoints step together."""
    entries, width = table
    raw = np.frombuffer(payload + bytes(8), np.uint8).astype(np.uint32)
    window = raw[:-3] << 24 | raw[1:-2] << 16 | raw[2:-1] << 8 | raw[3:]
    at = np.frombuffer(checkpoints, "<u4").astype(np.uint32)
    end = np.uint32((len(window) - 1) * 8)
    out = np.empty((STEP, len(at)), np.uint32)
    left, mask = np.uint32(32 - width), np.uint32((1 << width) - 1)
    for step in range(STEP):
        peek = (window[at >> 3] >> (left - (at & 7))) & mask
        np.take(entries, peek, out=out[step])
        at += out[step] & 255
        np.minimum(at, end, out=at)  # the last checkpoint may run past its block
    return (out >> 8).T.reshape(-1)[:n]


BLOCKS = (
    "shard int, block int, at long, n_tokens int, payload binary, checkpoints binary,"
    " doc_ids array<long>, doc_tokens array<int>, first_start long"
)


def write(docs: DataFrame, folder: str, path: str, end_id: int = END_ID, limit: int = LIMIT, order: Column | None = None) -> None:
    """Encode every row of docs (doc_id, text) and write the tables to `folder`, by `order` if given, else by doc_id."""
    spark, kind = docs.sparkSession, id_type(path)
    size = encoder(path).size
    ids = stage(encoded(docs, path, end_id, order), "token-ids")
    weights = counts(ids, kind, size)
    # A vocabulary too large for the limit gets the bits it needs.
    lengths = code_lengths(weights, max(limit, int(np.count_nonzero(weights)).bit_length()))
    codes = canonical(lengths)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        shard = TaskContext.get().partitionId()
        held: list[np.ndarray] = []
        docs_here: list[tuple[int | None, int]] = []
        block, at, begun, total = 0, 0, 0, 0

        def full(upto: int):
            nonlocal held, docs_here, block, at, begun, total
            joined = np.concatenate(held)
            part, rest = joined[:upto], joined[upto:]
            payload, checkpoints = pack(part, codes, lengths)
            over = len(rest)
            listed = [*docs_here]
            if over:
                listed[-1] = (listed[-1][0], listed[-1][1] - over)
            row = [shard, block, at, upto, payload, checkpoints, [d for d, _ in listed], [n for _, n in listed], begun]
            # The last document goes on in the next block if ids are left.
            begun = (begun if len(listed) == 1 else at + upto - listed[-1][1]) if over else at + upto
            docs_here = [(docs_here[-1][0], over)] if over else []
            held, total, at, block = [rest] if over else [], over, at + upto, block + 1
            return row

        def out(rows):
            return pa.RecordBatch.from_arrays(
                [pa.array(x, t) for x, t in zip(zip(*rows, strict=True), types, strict=True)], names=names
            )

        names = [x.split()[0] for x in BLOCKS.split(", ")]
        types = [pa.int32(), pa.int32(), pa.int64(), pa.int32(), pa.binary(), pa.binary(), pa.list_(pa.int64()), pa.list_(pa.int32()), pa.int64()]
        for batch in batches:
            for doc_id, value in zip(batch.column("doc_id").to_pylist(), batch.column("ids"), strict=True):
                more = np.frombuffer(value.as_buffer(), kind)
                held.append(more)
                docs_here.append((doc_id, len(more)))
                total += len(more)
                while total >= BLOCK:
                    yield out([full(BLOCK)])
        if total:
            yield out([full(total)])

    first = "doc_id" if order is None else "place"
    ordered = ids.repartitionByRange(parallelism(spark), first).sortWithinPartitions(first, "doc_id", "ids").select("doc_id", "ids")
    # Blocks are compressed already, and one row is large.
    blocks = ordered.mapInArrow(run, BLOCKS).write.option("compression", "none").option("parquet.page.size.row.check.min", "4")
    blocks.parquet(f"{folder}/blocks")
    book = [(int(i), int(lengths[i])) for i in np.flatnonzero(lengths)]
    spark.createDataFrame(book, "id int, length int").coalesce(1).write.parquet(f"{folder}/codebook")
    shards = spark.read.schema(BLOCKS).parquet(f"{folder}/blocks").groupBy("shard").agg(F.sum("n_tokens").alias("n_tokens"))
    # One row per shard goes through this window.
    before = W.orderBy("shard").rowsBetween(W.unboundedPreceding, -1)
    shards.select("shard", F.coalesce(F.sum("n_tokens").over(before), F.lit(0)).alias("start"), "n_tokens").write.parquet(f"{folder}/shards")


def read_codebook(spark: SparkSession, folder: str) -> np.ndarray:
    book = spark.read.parquet(f"{folder}/codebook").toArrow()
    ids = book.column("id").to_numpy()
    lengths = np.zeros(int(ids.max(initial=0)) + 1, np.uint8)
    lengths[ids] = book.column("length").to_numpy()
    return lengths


SEGMENTS = "shard int, block int, doc_id long, doc_start long, n long, crc long"


def read(spark: SparkSession, folder: str) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 of every document, decoded from the files."""
    lengths = read_codebook(spark, folder)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = lookup(lengths)
        for batch in batches:
            for row in batch.to_pylist():
                ids = unpack(row["payload"], row["checkpoints"], row["n_tokens"], table).astype(PRINTS)
                ends = np.cumsum(row["doc_tokens"])
                starts = ends - row["doc_tokens"]
                crc = [zlib.crc32(ids[a:b]) for a, b in zip(starts.tolist(), ends.tolist(), strict=True)]
                doc_start = starts + row["at"]
                doc_start[0] = row["first_start"]
                same = [pa.array(np.full(len(ends), row[c], np.int32)) for c in ("shard", "block")]
                rest = (pa.array(row["doc_ids"], pa.int64()), pa.array(doc_start), pa.array(row["doc_tokens"], pa.int64()), pa.array(crc, pa.int64()))
                yield pa.RecordBatch.from_arrays([*same, *rest], names=[x.split()[0] for x in SEGMENTS.split(", ")])

    pieces = spark.read.schema(BLOCKS).parquet(f"{folder}/blocks").mapInArrow(run, SEGMENTS)
    parts = F.array_sort(F.collect_list(F.struct("block", "n", "crc"))).alias("parts")
    whole = pieces.groupBy("shard", "doc_start", "doc_id").agg(parts, F.sum("n").alias("n_tokens"))
    shards = spark.read.parquet(f"{folder}/shards").select("shard", F.col("start").alias("shard_start"))
    joined = whole.join(shards, "shard").select("doc_id", (F.col("shard_start") + F.col("doc_start")).alias("start"), "n_tokens", "parts")

    def combine(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            crc = []
            for parts in batch.column("parts").to_pylist():
                total = parts[0]["crc"]
                for part in parts[1:]:
                    total = crc_joined(total, part["crc"], 4 * part["n"])
                crc.append(total)
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array(crc, pa.int64())], names=["doc_id", "start", "n_tokens", "ids_crc32"])

    return joined.mapInArrow(combine, "doc_id long, start long, n_tokens long, ids_crc32 long")


def crc_joined(first: int, second: int, size: int) -> int:
    """crc32 of two byte strings in a row from their own, the second of `size` bytes.

    Appending a byte multiplies the first's remainder by x^8 modulo the (bit-reversed) polynomial.
    """

    def times(a: int, b: int) -> int:
        out = 0
        for bit in range(31, -1, -1):
            if a >> bit & 1:
                out ^= b
            b = b >> 1 ^ (0xEDB88320 if b & 1 else 0)
        return out

    power, factor, n = 1 << 31, 1 << 23, size
    while n:
        if n & 1:
            power = times(power, factor)
        factor, n = times(factor, factor), n >> 1
    return times(power, first) ^ second
