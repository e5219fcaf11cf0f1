"""Hard negatives against plain Python, products against numpy, and the query against its SQL."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from compare import oracle_connection, oracle_rows, spark_rows
from conftest import TESTDATA
from parcelmart.llm import oracle, queries
from parcelmart.llm import strassen_negatives as m

SCHEMA = "vec_id long, embedding array<double>, label int, row string, rank int"
COLUMNS = ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]


@pytest.mark.parametrize("shape", [(1, 1, 1), (5, 7, 3), (33, 40, 65), (70, 129, 100), (0, 4, 4), (4, 0, 4)])
@pytest.mark.parametrize("bits", [8, 40, 63])
def test_products_are_exact(shape, bits):
    draw = np.random.default_rng(sum(shape) + bits)
    a = draw.integers(-(2 ** (bits - 1)), 2 ** (bits - 1), shape[:2])
    b = draw.integers(-(2 ** (bits - 1)), 2 ** (bits - 1), shape[1:])
    expected = np.array([[(sum(int(x) * int(y) for x, y in zip(r, c, strict=True)) + 2**63) % 2**64 - 2**63 for c in b.T] for r in a], np.int64)
    assert (m.strassen(a, b, leaf=4) == expected.reshape(shape[0], shape[2])).all()


@pytest.mark.parametrize("k", [1, 3, 10])
def test_best_keeps_the_order_of_ties(k):
    scores = np.random.default_rng(k).integers(-3, 3, 200)
    assert m.best(scores, k).tolist() == sorted(range(200), key=lambda i: (-scores[i], i))[:k]


def brute_force(vectors, anchor, n_positives=5, n_negatives=10, low=30, high=90):
    """`vectors`: (vec_id, label, ints)."""
    out = []
    for i, (vec_id, label, v) in enumerate(vectors):
        if not anchor(vec_id):
            continue
        scores = [(-sum(x * y for x, y in zip(v, w, strict=False)), other, j, mark) for j, (other, mark, w) in enumerate(vectors) if j != i]
        scores.sort()
        for ps, positive, _, _ in [s for s in scores if s[3] == label][:n_positives]:
            inside = [s for s in scores if s[3] != label and low * -ps <= 100 * -s[0] <= high * -ps]
            out += [(vec_id, positive, rank + 1, s[1], -ps, -s[0]) for rank, s in enumerate(inside[:n_negatives])]
    return sorted(out)


def found(df):
    return sorted(tuple(r) for r in df.select(*COLUMNS).collect())


def test_query_equals_its_sql(spark):
    sf_dir = TESTDATA / "sf0.01"
    rows = spark_rows(queries.op13_hard_negatives(spark, str(sf_dir)))
    assert rows[1] and rows == oracle_rows(oracle_connection(sf_dir), oracle.ORACLE["op13_hard_negatives"])


@pytest.mark.parametrize("cells", [None, 64])
def test_hot_label_ties_and_small_tiles(spark, monkeypatch, cells):
    if cells:
        monkeypatch.setattr(m, "TILE_CELLS", cells)
        monkeypatch.setattr(m, "ANCHOR_CELLS", cells // 4)
    draw = random.Random(2)
    vectors = [(i, draw.choice([1, 1, 1, 2, 3, i]), [draw.randint(-2, 3) for _ in range(draw.randint(0, 4))]) for i in range(300)]
    vectors += vectors[:20]
    df = spark.createDataFrame(vectors, "vec_id long, label long, vector array<long>").repartition(6)
    rows = found(m.mine(df, F.col("vec_id") % 10 == 0))
    expected = brute_force(vectors, lambda i: i % 10 == 0)
    # Rows under one id may be told apart by their labels only: compare without the order of equals.
    assert rows == expected


def test_unusable_rows_and_quantising(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [0.5, 0.25], 1), (1, [0.5, 0.2499], 1), (2, [0.25, 0.12], 2), (3, None, 1), (4, [nan, 1.0], 1), (5, [inf, 1.0], 2)]
    rows += [(6, [None, 1.0], 2), (7, [0.2, 0.2], None), (None, [0.3, 0.3], 2), (8, [], 2), (9, [-0.001, 1e300], 3)]
    df = m.quantised(spark.createDataFrame([(*r, "x", 5) for r in rows], SCHEMA))
    kept = {r.vec_id: r.vector for r in df.collect()}
    assert kept == {0: [128, 64], 1: [128, 63], 2: [64, 30], 8: [], 9: [-1, 2**63 - 1]}
    small = df.where("vec_id < 9")
    assert found(m.mine(small, F.col("vec_id") == 0)) == [(0, 1, 1, 2, 128 * 128 + 64 * 63, 64 * 128 + 30 * 64)]


def test_negative_and_zero_positives(spark):
    vectors = [(0, 1, [1]), (1, 1, [-5]), (2, 1, [0]), (3, 2, [0]), (4, 2, [-2]), (5, 2, [-4])]
    df = spark.createDataFrame(vectors, "vec_id long, label long, vector array<long>")
    assert found(m.mine(df, F.col("vec_id") == 0)) == brute_force(vectors, lambda i: i == 0) == [(0, 2, 1, 3, 0, 0)]


def test_empty_tables_and_lone_labels(spark):
    empty = spark.createDataFrame([], "vec_id long, label long, vector array<long>")
    assert found(m.mine(empty, F.col("vec_id") == 0)) == []
    lone = spark.createDataFrame([(0, 1, [1]), (1, 2, [1])], empty.schema)
    assert found(m.mine(lone, F.col("vec_id") == 0)) == []
