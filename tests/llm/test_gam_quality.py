"""The additive quality model: held-out accuracy, its parts, and the defined edge cases."""

import zlib

import numpy as np

from conftest import TESTDATA
from parcelmart.llm import gam_quality as m
from parcelmart.llm import queries

SCHEMA = "doc_id long, text string, score string"


def test_held_out_accuracy(spark):
    sf_dir = str(TESTDATA / "sf0.1")
    found = {r.doc_id: r for r in queries.op5_quality_gam(spark, sf_dir).collect()}
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{sf_dir}/labels.parquet").collect()}
    assert len(found) == spark.read.parquet(f"{sf_dir}/documents.parquet").count()
    held = [k for k in labels if found[k].held_out]
    assert all(found[k].held_out == (zlib.crc32(str(k).encode()) % 3 == 1) for k in found)
    assert all(r.predicted == (r.score >= 0.5) and 0 <= r.score <= 1 for r in found.values())
    for label in (0, 1):
        own = [k for k in held if labels[k] == label]
        assert np.mean([found[k].predicted == label for k in own]) > 0.97


def test_interactions_are_learnt():
    """An exclusive or of two features has no main effect: only pair tables can express it."""
    x = np.random.default_rng(1).random((4000, 3))
    y = ((x[:, 0] > 0.5) ^ (x[:, 1] > 0.5)).astype(float)
    model = m.fit(x, y)
    assert (0, 1) in model.pairs
    assert np.mean((model.score(x) >= 0.5) == y) > 0.95
    main = m.Model(model.intercept, model.cuts, model.tables)
    assert np.mean((main.score(x) >= 0.5) == y) < 0.75


def test_a_score_is_a_sum_of_table_entries():
    x = np.random.default_rng(2).random((500, 3))
    model = m.fit(x, (x[:, 2] > 0.7).astype(float))
    for row, score in zip(x[:20], model.score(x[:20]), strict=True):
        total = model.intercept + sum(t[np.searchsorted(c, v, side="right")] for t, c, v in zip(model.tables, model.cuts, row, strict=True))
        for (a, b), t in zip(model.pairs, model.pair_tables, strict=True):
            total += t[np.searchsorted(model.pair_cuts[a], row[a], side="right"), np.searchsorted(model.pair_cuts[b], row[b], side="right")]
        assert abs(1 / (1 + np.exp(-total)) - score) < 1e-9


def test_edge_cases(spark):
    texts = ["plain words in a row and more of them"] * 30 + ["x x x x x x x x x x"] * 30
    rows = [(i, t, "old") for i, t in enumerate(texts)] + [(None, "no id", "old"), (100, None, "old"), (101, "", "old"), (102, "word " * 100_000, "old"), (103, "same", "old"), (103, "same", "old")]
    docs = spark.createDataFrame(rows, SCHEMA)
    labels = spark.createDataFrame([(i, int(i < 30), 0) for i in range(60)] + [(None, 1, 0), (100, None, 0), (5, 0, 0)], "doc_id long, quality int, toxic int")
    model = m.train(docs, labels)
    out = m.scored(docs, model)
    found = out.collect()
    assert out.columns == ["doc_id", "text", "score", "predicted"] and len(found) == len(rows)
    assert all(0 <= r.score <= 1 for r in found)
    assert len({r.score for r in found if r.doc_id == 103}) == 1
    kept = m.good_documents(docs, labels)
    assert kept.columns == docs.columns
    assert {r.doc_id for r in kept.collect()} >= set(range(30)) and not {r.doc_id for r in kept.collect()} & set(range(30, 60))


def test_no_labels_and_empty_tables(spark):
    empty = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    docs = spark.createDataFrame([(1, "a", "x")], SCHEMA)
    assert [r.score for r in m.scored(docs, m.train(docs, empty)).collect()] == [0.5]
    none = spark.createDataFrame([], SCHEMA)
    assert m.scored(none, m.train(none, empty)).count() == 0
