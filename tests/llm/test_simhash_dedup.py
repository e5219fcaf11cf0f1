"""SimHash near-duplicates against brute force, and the defined edge cases."""

import random
import re

import numpy as np
import pytest
import xxhash

from conftest import TESTDATA
from parcelmart.llm import queries, simhash_dedup as m

SCHEMA = "doc_id long, text string, fp string"


def slow_fingerprint(text):
    text = re.sub("[A-Z]", lambda x: x[0].lower(), text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    shingles = [" ".join(words[i : i + 4]) for i in range(max(1, len(words) - 3))] if words else []
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def slow_components(rows, most=4):
    """Smallest id reachable, by index of (doc_id, fingerprint)."""
    parent = list(range(len(rows)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    fps = np.array([fp for _, fp in rows], np.uint64)
    for i in range(len(rows)):
        for j in np.flatnonzero(np.bitwise_count(fps ^ fps[i]) <= most):
            a, b = root(i), root(int(j))
            parent[max(a, b)] = min(a, b)
    smallest = {}
    for i, (doc_id, _) in enumerate(rows):
        if doc_id is not None:
            smallest[root(i)] = min(smallest.get(root(i), doc_id), doc_id)
    return [(doc_id, f"{fp:016x}", smallest.get(root(i))) for i, (doc_id, fp) in enumerate(rows)]


def in_order(rows):
    return sorted(rows, key=str)


def test_query_equals_brute_force(spark):
    sf_dir = str(TESTDATA / "sf0.01")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()
    expected = slow_components([(r.doc_id, slow_fingerprint(r.text)) for r in docs])
    found = [tuple(r) for r in queries.op2_simhash_near_dedup(spark, sf_dir).collect()]
    assert in_order(found) == in_order(expected)
    assert any(doc_id != component for doc_id, _, component in found)


@pytest.mark.parametrize("bits", [3, 4, 8])
def test_every_near_pair_is_linked(spark, bits):
    draw = np.random.default_rng(bits)
    base = draw.integers(0, 1 << 64, 300, dtype=np.uint64)
    near = base.copy()
    for i in range(len(near)):
        for bit in random.Random(i).sample(range(64), bits):
            near[i] ^= np.uint64(1) << np.uint64(bit)
    fps = np.unique(np.concatenate((base, near)))
    rows = spark.createDataFrame([(int(x),) for x in fps.view(np.int64)], "fp long")
    found = {frozenset(r) for r in m.near_links(rows, bits).collect()}
    near = [(i, j) for i in range(len(fps)) for j in np.flatnonzero(np.bitwise_count(fps ^ fps[i]) <= bits) if j > i]
    signed = fps.view(np.int64)
    assert found == {frozenset((int(signed[i]), int(signed[j]))) for i, j in near}


def test_a_dense_ball_in_small_blocks_stays_one_group(spark):
    """Chains over anchors that are dealt out as pairs of blocks, compared by the forest."""
    center, draw = 0x0123456789ABCDEF, random.Random(5)
    ball = {center}
    while len(ball) < 600:
        ball.add(center ^ sum(1 << b for b in draw.sample(range(64), draw.randint(1, 3))))
    fps = np.array(sorted(ball), np.uint64)
    rows = [(int(x),) for x in fps.view(np.int64)]
    edges = m.near_links(spark.createDataFrame(rows, "fp long"), 4, block_rows=100)
    from parcelmart.llm.components import components

    grouped = components(edges).collect()
    expected = slow_components([(i, int(fp)) for i, fp in enumerate(fps)])
    assert len({r.root for r in grouped}) == len({c for _, _, c in expected if sum(x[2] == c for x in expected) > 1})


def test_edge_cases(spark):
    long = " ".join(f"w{i}" for i in range(50_000))
    rows = [(7, None, "x"), (3, "", "x"), (5, " \t\n ", None), (None, "lone words here", "x"), (9, long, "x"), (9, long, "x"), (4, "One Two", "x"), (6, "one two", "x")]
    docs = spark.createDataFrame(rows, SCHEMA)
    found = in_order((r.doc_id, f"{r.fp & (1 << 64) - 1:016x}", r.component_id) for r in m.near_duplicates(docs).collect())
    assert found == in_order(slow_components([(i, slow_fingerprint(t)) for i, t, _ in rows]))
    kept = m.one_of_each(docs)
    assert kept.columns == docs.columns
    assert sorted((r.doc_id for r in kept.collect()), key=str) == [3, 4, 9, None]


def test_empty_table(spark):
    docs = spark.createDataFrame([], SCHEMA)
    assert m.near_duplicates(docs).count() == 0
    assert m.one_of_each(docs).count() == 0
