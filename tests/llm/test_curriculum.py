"""Mixing against its SQL and against plain loops, and the defined edge cases."""

import math
from pathlib import Path

import pytest
from compare import oracle_connection, oracle_rows, spark_rows

from conftest import TESTDATA
from parcelmart.llm import curriculum as m
from parcelmart.llm import oracle, queries

SCHEMA = "doc_id long, text string, source string, size string, tilt string, before string, target string"


def test_query_equals_its_sql(spark):
    sf_dir = Path(TESTDATA / "sf0.01")
    key = "op10_mix_sources"
    assert spark_rows(queries.QUERIES[key](spark, str(sf_dir))) == oracle_rows(oracle_connection(sf_dir), oracle.ORACLE[key])


def test_query_is_in_training_order(spark):
    found = [r.first_position for r in queries.op10_mix_sources(spark, str(TESTDATA / "sf0.01")).collect()]
    taken = [t for t in found if t is not None]
    assert 0 < len(taken) < len(found) and found == sorted(taken) + [None] * (len(found) - len(taken))


def slow_targets(sizes):
    """Share by weight, give back what is above twice the size, share that again."""
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: m.WEIGHTS[i % 3] for i, s in enumerate(names)}
    out, rest, open_names = {}, 1.5 * sum(sizes.values()), set(names)
    while True:
        total = sum(weight[s] for s in open_names)
        full = {s for s in open_names if rest * weight[s] / total > 2 * sizes[s]}
        if not full:
            return out | {s: rest * weight[s] / total for s in open_names}
        out |= {s: 2.0 * sizes[s] for s in full}
        rest -= sum(2.0 * sizes[s] for s in full)
        open_names -= full


@pytest.mark.parametrize("sizes", [[5], [1, 1], [100, 1, 1], [0, 7, 900], [3, 50, 20, 0, 8, 1000, 13]])
def test_targets_equal_the_repeated_sharing(spark, sizes):
    given = {f"s{i}" if i else None: n for i, n in enumerate(sizes)}
    rows = spark.createDataFrame(list(given.items()), "source string, source_size long")
    found = {r.source: r.target for r in m.targets(rows).collect()}
    expected = slow_targets(given)
    assert found.keys() == expected.keys()
    assert all(math.isclose(found[s], expected[s], abs_tol=1e-9) for s in found)


def test_positions_follow_the_schedules(spark):
    """At any time the copies placed so far match the integral of each source's schedule."""
    rows = [(i, "w " * (1 + i % 7), "abc"[i % 3]) for i in range(3000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    mixed = m.mix(docs)
    ordered = m.training_order(mixed)
    places = ordered.select("source", "mix_position", "size", "target").collect()
    assert [r.mix_position for r in places] == sorted(r.mix_position for r in places)
    tilt = dict(zip("abc", m.TILTS, strict=True))
    for source in "abc":
        own = [r for r in places if r.source == source]
        total = sum(r.size for r in own)
        assert abs(total - own[0].target) <= 4
        for t in (0.1, 0.25, 0.5, 0.9):
            share = sum(r.size for r in own if r.mix_position <= t) / total
            assert abs(share - (t + tilt[source] * (t - t * t))) < 0.02
    assert ordered.count() == sum(len(r.positions) for r in mixed.collect())


def test_edge_cases(spark):
    rows = [(1, None, "a"), (2, "", None), (None, "no id here", "a"), (4, "x " * 100_000, "b"), (5, "same words", "c"), (5, "same words", "c"), (6, "one two three", None)]
    docs = spark.createDataFrame([(*r, "s", "t", "b", "g") for r in rows], SCHEMA)
    mixed = m.mix(docs)
    assert mixed.columns == ["doc_id", "text", "source", "tilt", "before", *m.ADDED]
    found = mixed.collect()
    assert len(found) == len(rows)
    assert all(r.taken == r.size * r.copies <= 2 * r.size and len(r.positions) == r.copies for r in found)
    assert all((r.tilt, r.before) == ("t", "b") for r in found)
    again = m.mix(docs).collect()
    assert sorted(map(str, found)) == sorted(map(str, again))


def test_empty_table(spark):
    docs = spark.createDataFrame([], SCHEMA)
    assert m.mix(docs).count() == 0
    assert m.training_order(m.mix(docs)).count() == 0
