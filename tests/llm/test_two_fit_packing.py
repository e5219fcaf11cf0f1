"""Packing: whole documents, exact ids, sequences without gaps, and best-two-fit one by one."""

import random
import zlib
from collections import Counter

import numpy as np
import pytest
from tokenizers import Tokenizer

from conftest import TESTDATA
from parcelmart.llm import huffman_ids, queries
from parcelmart.llm import two_fit_packing as m


def one_by_one(lengths, capacity):
    """Best-two-fit with a list of pieces: the lengths in each sequence."""
    left, out = sorted(lengths, reverse=True), []
    while left:
        held, rest, room = [], [], capacity
        for n in left:
            if n <= room:
                held.append(n)
                room -= n
            else:
                rest.append(n)
        if room and len(held) > 1:
            gap = room + held[-1]
            kinds = sorted(set(rest))
            sums = [(a + b, -a, a, b) for a in kinds for b in kinds if (a < b or (a == b and rest.count(a) > 1)) and a + b <= gap]
            if sums and max(sums)[0] > held[-1]:
                _, _, a, b = max(sums)
                rest.append(held.pop())
                held += [a, b]
                rest.remove(a)
                rest.remove(b)
        out.append(tuple(sorted(held, reverse=True)))
        left = sorted(rest, reverse=True)
    return Counter(out)


def sequences_of(lengths, capacity):
    lengths = np.array(lengths, np.int64)
    runs = m.plan(np.bincount(lengths, minlength=capacity + 1))
    sequence, offset = runs.find(lengths, m._number_among_equal(lengths))
    held = {}
    for n, s, o in zip(lengths.tolist(), sequence.tolist(), offset.tolist(), strict=True):
        held.setdefault(s, []).append((o, n))
    assert sorted(held) == list(range(runs.sequences))
    for parts in held.values():
        ends = 0
        for o, n in sorted(parts):
            assert o == ends
            ends += n
        assert ends <= capacity
    return Counter(tuple(sorted((n for _, n in parts), reverse=True)) for parts in held.values())


@pytest.mark.parametrize("seed", range(60))
def test_plan_is_best_two_fit(seed):
    draw = random.Random(seed)
    capacity = draw.choice([10, 20, 64])
    lengths = [draw.randint(1, draw.choice([3, capacity // 2, capacity])) for _ in range(draw.randint(1, 120))]
    assert sequences_of(lengths, capacity) == one_by_one(lengths, capacity)


def test_two_pieces_replace_the_smallest():
    # Greedy puts 6 and 3 together; 2 and 2 fill the gap of 4.
    assert sequences_of([6, 3, 2, 2], 10) == Counter({(6, 2, 2): 1, (3,): 1}) == one_by_one([6, 3, 2, 2], 10)


def test_many_pieces_need_few_fillings():
    draw = np.random.default_rng(3)
    counts = np.bincount(draw.integers(1, 2049, 3_000_000), minlength=2049) * 1000
    runs = m.plan(counts)
    total = int((counts * np.arange(2049)).sum())
    assert runs.sequences <= 1.01 * total / 2048 and len(runs.length) < 50_000


@pytest.mark.parametrize("size", [1, 5, 9, 10, 11, 20, 21, 39])
def test_cutting(size):
    owner, number, start, length = m.cut(np.array([3, size, 3]), 10)
    mine = owner == 1
    assert number[mine].tolist() == list(range(mine.sum())) and length[mine].sum() == size
    assert (start[mine] == np.cumsum(length[mine]) - length[mine]).all() and (length[mine][1:] == 10).all()


def check(spark, rows, places, capacity, end_id=0):
    """Every document's pieces hold its ids, every sequence its pieces without gaps; returns the sequences."""
    tokenizer = Tokenizer.from_file(huffman_ids.tokenizer_path())
    expected = Counter()
    for doc_id, text in rows:
        ids = np.array([*tokenizer.encode(text or "", add_special_tokens=False).ids, end_id], "<u4")
        first = (len(ids) - 1) % capacity + 1
        cuts = [0, *range(first, len(ids) + 1, capacity)]
        for piece, (a, b) in enumerate(zip(cuts, cuts[1:], strict=False)):
            expected[(doc_id, piece, a, b - a, zlib.crc32(ids[a:b].tobytes()))] += 1
    found = places.collect()
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in found) == expected
    held = {}
    for r in found:
        held.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for parts in held.values():
        parts.sort()
        assert parts[0][0] == 0 and sum(parts[-1]) <= capacity
        assert all(a + n == b for (a, n), (b, _) in zip(parts, parts[1:], strict=False))
    return held


def test_query(spark):
    sf_dir = str(TESTDATA / "sf0.01")
    rows = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()]
    held = check(spark, rows, queries.op12_two_fit_packing(spark, sf_dir), 2048)
    total = sum(n for parts in held.values() for _, n in parts)
    assert len(held) <= 1.01 * total / 2048 + 1
    lengths = [n for parts in held.values() for _, n in parts]
    assert Counter(tuple(sorted((n for _, n in parts), reverse=True)) for parts in held.values()) == one_by_one(lengths, 2048)


def test_edge_cases_and_sequences(spark):
    rows = [(None, "no id"), (1, None), (2, ""), (3, "  \n "), (4, "same text"), (4, "same text"), (5, "word " * 3000)]
    rows += [(10 + i, "a b c") for i in range(400)]
    docs = spark.createDataFrame([(d, t, "x", 1) for d, t in rows], "doc_id long, text string, ids string, place long").repartition(7)
    places = m.packed(docs, huffman_ids.tokenizer_path(), 64, 9)
    held = check(spark, rows, places, 64, 9)
    whole = {r.sequence_id: r for r in m.sequences(places).collect()}
    assert set(whole) == set(held)
    for key, parts in held.items():
        assert [n for _, n in parts] == whole[key].lengths and len(whole[key].ids) == 2 * sum(whole[key].lengths)


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert m.packed(docs, huffman_ids.tokenizer_path()).count() == 0
