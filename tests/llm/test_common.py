"""Helpers that operators share."""

from collections import Counter

from parcelmart.llm import common as m


def test_ranks_of_a_hot_group_and_of_ties(spark):
    rows = spark.range(5000).selectExpr("IF(id % 3 = 0, 'hot', CAST(id % 11 AS STRING)) AS g", "CAST((id * 7919) % 40 AS INT) AS o", "id AS payload", "id % 2 AS unseen")
    found = m.ranked(rows, "g", ["o"], unkept=("unseen",))
    assert found.columns == ["g", "o", "payload", "rank", "total"]
    held = {}
    for r in found.collect():
        held.setdefault(r.g, []).append((r["rank"], r.o, r.total))
    sizes = Counter(r.g for r in rows.collect())
    assert {g: len(x) for g, x in held.items()} == sizes
    for g, x in held.items():
        x.sort()
        assert [rank for rank, _, _ in x] == list(range(sizes[g])) and {total for _, _, total in x} == {sizes[g]}
        assert [o for _, o, _ in x] == sorted(o for _, o, _ in x)
    assert m.ranked(rows.where("false"), "g", ["o"]).count() == 0


def test_a_stage_leaves_the_setting_as_it_was(spark):
    for before in ("false", "true"):
        spark.conf.set(m.REMOVE_SHUFFLES, before)
        df = spark.range(100).repartition(3).groupBy((m.F.col("id") % 7).alias("k")).count()
        assert m.stage(df, "test").count() == df.count() == 7
        assert spark.conf.get(m.REMOVE_SHUFFLES) == before
    spark.conf.unset(m.REMOVE_SHUFFLES)
