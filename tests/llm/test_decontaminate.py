"""Decontamination against brute force over all windows, and the defined edge cases."""

import re
from collections import Counter

import numpy as np
import pytest

from conftest import TESTDATA
from parcelmart.llm import decontaminate as m
from parcelmart.llm import queries

DOCS = "doc_id long, text string, similarity string"
ITEMS = "item_id long, text string"


def slow_matches(docs, items, threshold=0.8):
    """{(doc_id, item_id): similarity} by comparing every window of every item's size."""
    out = {}
    for item_id, item in items:
        a = re.findall(r"\w+", (item or "").lower())
        k = min(5, len(a))
        own = Counter(tuple(a[i : i + k]) for i in range(len(a) - k + 1)) if a else Counter()
        for doc_id, text in docs:
            b = re.findall(r"\w+", (text or "").lower())
            grams = [tuple(b[i : i + k]) for i in range(len(b) - k + 1)] if a else []
            if not set(grams) & set(own):
                continue
            size = min(sum(own.values()), len(grams))
            best = 0.0
            for i in range(len(grams) - size + 1):
                window = Counter(grams[i : i + size])
                common = sum((window & own).values())
                best = max(best, common / (size + sum(own.values()) - common))
            if best >= threshold:
                out[doc_id, item_id] = best
    return out


def found(rows):
    return {(r.doc_id, r.item_id): r.similarity for r in rows}


def test_query_equals_brute_force(spark):
    sf_dir = str(TESTDATA / "sf0.01")
    pairs = lambda name, key: [tuple(r) for r in spark.read.parquet(f"{sf_dir}/{name}.parquet").select(key, "text").collect()]
    expected = slow_matches(pairs("documents", "doc_id"), pairs("benchmark", "item_id"))
    assert found(queries.op4_decontaminate(spark, sf_dir).collect()) == expected
    assert expected


def test_edited_passages(spark):
    item = " ".join(f"word{i}" for i in range(60))
    tokens = item.split()
    changed = lambda *at: " ".join("other" if i in at else t for i, t in enumerate(tokens))
    rows = [
        (1, f"before it {item} and after"),
        (2, "Before, " + item.upper().replace(" ", ", ") + "!"),
        (3, "x " + changed(30) + " y"),
        (4, "x " + changed(15, 45) + " y"),
        (5, "x " + " ".join(tokens[:-4]) + " y y y y y"),
        (6, " ".join(tokens[:-3])),
        (7, " ".join(reversed(tokens))),
        (8, "nothing of it " * 50),
    ]
    docs = spark.createDataFrame([(*r, "x") for r in rows], DOCS)
    items = spark.createDataFrame([(5, item)], ITEMS)
    got = m.contaminated(docs, items).collect()
    assert found(got) == slow_matches(rows, [(5, item)])
    assert {r.doc_id for r in got} == {1, 2, 3, 5, 6}
    assert {r.first_word for r in got if r.doc_id == 1} == {2}
    kept = m.clean_documents(docs, items)
    assert kept.columns == docs.columns and {r.doc_id for r in kept.collect()} == {4, 7, 8}


def test_edge_cases(spark, monkeypatch):
    monkeypatch.setattr(m, "ITEM_BLOCK", 3)
    items = [(1, None), (2, ""), (3, "short one"), (4, "a a a a a a a a"), (None, "an item without any id at all here"), (6, "twice twice twice"), (6, "twice twice twice"), (7, "é ü ñ ß œ ł ø")]
    rows = [(1, None), (2, ""), (3, "a short one indeed"), (4, "a " * 30_000), (None, "x an item without any id at all here"), (6, "see twice twice twice"), (6, "see twice twice twice"), (8, "É Ü Ñ ß Œ Ł Ø"), (9, "short")]
    docs, bench = spark.createDataFrame([(*r, "x") for r in rows], DOCS), spark.createDataFrame(items, ITEMS)
    got = m.contaminated(docs, bench).collect()
    assert found(got) == slow_matches(rows, items)
    # Two equal rows, each against two equal items.
    assert sum(r.doc_id == 6 for r in got) == 4


@pytest.mark.parametrize("radius", [3, 12, 20])
def test_index_finds_every_item_within_the_radius(radius):
    draw = np.random.default_rng(radius)
    items = draw.integers(0, 1 << 64, 300, dtype=np.uint64)
    flips = np.array([sum(1 << int(b) for b in draw.choice(64, draw.integers(0, radius + 4), replace=False)) for _ in items], np.uint64)
    query, item, distance = m.BlockIndex(items, radius).near(items ^ flips)
    expected = np.bitwise_count((items ^ flips)[:, None] ^ items[None, :])
    assert set(zip(query.tolist(), item.tolist(), strict=True)) == set(map(tuple, np.argwhere(expected <= radius).tolist()))
    assert (distance == expected[query, item]).all()


def test_empty_tables(spark):
    docs, items = spark.createDataFrame([(1, "a b c d e f", "x")], DOCS), spark.createDataFrame([(1, "a b c d e f")], ITEMS)
    assert m.contaminated(docs.limit(0), items).count() == 0
    assert m.contaminated(docs, items.limit(0)).count() == 0
    assert m.clean_documents(docs, items.limit(0)).count() == 1
    assert m.clean_documents(docs, items).count() == 0
