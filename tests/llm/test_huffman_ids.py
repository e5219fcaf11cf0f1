"""Huffman-coded token ids: exact round trips and optimal lengths."""

import heapq
import random
import zlib

import numpy as np
import pytest
from tokenizers import Tokenizer

from conftest import TESTDATA
from parcelmart.llm import huffman_ids as m
from parcelmart.llm import queries
from parcelmart.llm.common import shared_path

ODD = ["a  b\n c <|endoftext|> x\x1cy !\x1c? \x85 z\xa0q　r  ", "   ", None, "don't I'll  'S\t\tx", "", "x" * 3000, " lead", "trail \n"]


def expected(rows, end_id=m.END_ID):
    """doc_id, start, n_tokens, crc of (doc_id, text) in ascending order, by the tokenizer itself."""
    tokenizer, out, start = Tokenizer.from_file(m.tokenizer_path()), [], 0
    for doc_id, text in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0)):
        ids = np.array([*tokenizer.encode(text or "", add_special_tokens=False).ids, end_id], "<u4")
        out.append((doc_id, start, len(ids), zlib.crc32(ids.tobytes())))
        start += len(ids)
    return out


def test_query_equals_the_tokenizer(spark):
    sf_dir = str(TESTDATA / "sf0.01")
    rows = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()]
    found = sorted(tuple(r) for r in queries.op3_token_ids(spark, sf_dir).collect())
    assert found == expected(rows)


def test_documents_over_many_blocks_and_edge_cases(spark, monkeypatch):
    monkeypatch.setattr(m, "BLOCK", 300)
    rows = [(3, " ".join(f"w{i}" for i in range(2000))), *((10 + i, t) for i, t in enumerate(ODD)), (None, "no id"), (3, None), (50, "same"), (50, "same")]
    docs = spark.createDataFrame([(d, t, "x") for d, t in rows], "doc_id long, text string, ids string")
    folder = shared_path(spark, "test-ids")
    m.write(docs, folder, m.tokenizer_path())
    found = m.read(spark, folder).collect()
    assert sorted((r.start, r.n_tokens) for r in found)[0][0] == 0
    # Repeated ids follow each other in any order: compare what does not depend on it.
    drop = lambda rows: sorted(((d, n, c) for d, _, n, c in rows), key=str)
    assert drop(map(tuple, found)) == drop(expected(rows))
    starts = sorted((r.start, r.n_tokens) for r in found)
    assert all(a + n == b for (a, n), (b, _) in zip(starts, starts[1:], strict=False))
    assert spark.read.parquet(f"{folder}/blocks").count() > 5


def test_empty_table(spark):
    folder = shared_path(spark, "test-ids")
    m.write(spark.createDataFrame([], "doc_id long, text string"), folder, m.tokenizer_path())
    assert m.read(spark, folder).count() == 0


def test_pieces_give_the_texts_ids(monkeypatch):
    tokenizer = Tokenizer.from_file(m.tokenizer_path())
    draw = random.Random(4)
    marks = ["a", "Word", "é", "ß", "ǆ", "1", "'s", "'", ".", "!?", "***", " ", "  ", "\n", "\t", "\xa0", "\x1c", "\0", "<|endoftext|>", "|", "語", "\u0301"]
    texts = [t or "" for t in ODD] + ["".join(draw.choices(marks, k=draw.randint(1, 12))) for _ in range(5000)]
    wanted = [np.array(tokenizer.encode(t, add_special_tokens=False).ids, "<u2").tobytes() for t in texts]
    encode = m.Encoder(m.tokenizer_path())
    assert list(encode(texts)) == wanted
    assert list(encode(texts)) == wanted
    monkeypatch.setattr(m, "CACHE_PIECES", 40)
    monkeypatch.setattr(m, "BATCH_BYTES", 200)
    encode = m.Encoder(m.tokenizer_path())
    assert list(encode(texts)) == wanted
    assert len(encode.known) < 200


@pytest.mark.parametrize(("size", "limit"), [(3000, 18), (300, 9), (300, 12), (5, 3), (2, 4), (1, 4)])
def test_code_is_complete_and_short(size, limit):
    weights = np.random.default_rng(size).zipf(1.2, size) % 100_000 + 1
    lengths = m.code_lengths(weights, limit)
    heap, best = weights.tolist(), 0
    heapq.heapify(heap)
    while len(heap) > 1:
        pair = heapq.heappop(heap) + heapq.heappop(heap)
        best += pair
        heapq.heappush(heap, pair)
    assert lengths.max() <= limit and (lengths > 0).all()
    assert sum(2.0 ** -float(n) for n in lengths) == (1.0 if size > 1 else 0.5)
    cost = int((lengths * weights).sum())
    assert cost >= best and (lengths.max() == limit or size == 1 or cost == best)
    ids = np.random.default_rng(1).integers(0, size, 5000).astype(np.uint16)
    payload, checkpoints = m.pack(ids, m.canonical(lengths), lengths)
    assert (m.unpack(payload, checkpoints, len(ids), m.lookup(lengths)) == ids).all()


def test_crc_of_a_concatenation():
    a, b = b"hello" * 100, b"worldx" * 77
    assert m.crc_joined(zlib.crc32(a), zlib.crc32(b), len(b)) == zlib.crc32(a + b)
    assert m.crc_joined(zlib.crc32(a), zlib.crc32(b""), 0) == zlib.crc32(a)
