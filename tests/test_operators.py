"""Operators on small hand-made tables."""

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from parcelmart.operators.aggregates import (
    category_columns,
    concat_distinct,
    count_where,
    pivot_counts,
    ratio,
    with_total,
)
from parcelmart.operators.changes import (
    Replicated,
    apply_changes,
    live_rows,
    newest_changes,
    parse_manifest,
)
from parcelmart.operators.joins import exclude, flag, join_optional, keep, latest_per_key
from parcelmart.operators.windows import previous_row


def rows(df, *columns):
    return sorted((tuple(row) for row in df.select(*columns).collect()), key=str)


@pytest.fixture(scope="module")
def scans(spark):
    noon, one = datetime(2024, 5, 1, 12), datetime(2024, 5, 1, 13)
    return spark.createDataFrame(
        [(1, 10, noon, 7), (2, 10, noon, 8), (3, 11, one, 7), (4, 11, noon, 9), (5, None, one, 7)],
        "id bigint, parcel_id bigint, date timestamp_ntz, user_id bigint",
    )


@pytest.fixture(scope="module")
def parcels(spark):
    return spark.createDataFrame([(10,), (11,), (12,)], "parcel_id bigint")


def test_latest_row_breaks_ties_by_id_and_keeps_misses(parcels, scans):
    latest = latest_per_key(scans, ["parcel_id"], ["date", "id"], ["user_id"])
    joined = parcels.join(latest, "parcel_id", "left")
    assert rows(joined, "parcel_id", "id", "user_id") == [(10, 2, 8), (11, 3, 7), (12, None, None)]


def test_latest_row_agrees_with_a_ranking_window(spark):
    from pyspark.sql import Window

    log = spark.range(2000).selectExpr(
        "id", "IF(id % 3 = 0, 1, id % 50) AS key", "(id * 7919) % 13 AS date"
    )
    window = Window.partitionBy("key").orderBy(F.desc("date"), F.desc("id"))
    ranked = log.withColumn("n", F.row_number().over(window)).where("n = 1")
    latest = latest_per_key(log, ["key"], ["date", "id"])
    assert rows(latest, "key", "id") == rows(ranked, "key", "id")


def test_exclusion_ignores_null_keys_where_not_in_would_not(spark, parcels, scans):
    assert rows(exclude(parcels, scans, ["parcel_id"]), "parcel_id") == [(12,)]
    parcels.createOrReplaceTempView("p")
    scans.createOrReplaceTempView("s")
    not_in = spark.sql("SELECT * FROM p WHERE parcel_id NOT IN (SELECT parcel_id FROM s)")
    assert not_in.count() == 0


def test_keep_and_flag_do_not_multiply_rows(parcels, scans):
    assert rows(keep(parcels, scans, ["parcel_id"]), "parcel_id") == [(10,), (11,)]
    flagged = flag(parcels, scans, ["parcel_id"], "seen")
    assert rows(flagged, "parcel_id", "seen") == [(10, True), (11, True), (12, False)]


def test_optional_join_keeps_null_keys_and_adds_no_match(spark):
    left = spark.createDataFrame(
        [(1, 5), (2, None), (3, 6), (0, None)], "id bigint, cancellation_id bigint"
    )
    right = spark.createDataFrame([(5, "A"), (9, "B")], "cancellation_id bigint, category string")
    joined = join_optional(left, right, "cancellation_id", "id")
    assert joined.columns == ["id", "cancellation_id", "category"]
    assert rows(joined, "id", "cancellation_id", "category") == [
        (0, None, None),
        (1, 5, "A"),
        (2, None, None),
        (3, 6, None),
    ]


def test_optional_join_spreads_null_keys_over_partitions(spark):
    left = spark.range(4000).selectExpr("id", "CAST(NULL AS BIGINT) AS key")
    right = spark.range(10).selectExpr("id AS key", "id AS value")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        sizes = (
            join_optional(left, right, "key", "id")
            .groupBy(F.spark_partition_id())
            .count()
            .collect()
        )
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert len(sizes) == 8
    assert max(row["count"] for row in sizes) < 1000


def test_pivot_counts_merges_categories_and_weights(spark):
    df = spark.createDataFrame([("a", 2), ("b", 3), ("c", 5), (None, 7)], "kind string, n int")
    columns = category_columns(["a", "b", "c"], {"b": "a"})
    assert columns == {"a": ["a", "b"], "c": ["c"]}
    assert df.agg(*pivot_counts(F.col("kind"), columns)).first().asDict() == {"a": 2, "c": 1}
    weighted = df.agg(*pivot_counts(F.col("kind"), columns, F.col("n"))).first()
    assert weighted.asDict() == {"a": 5, "c": 5}


def test_ratio_of_an_empty_group_is_null(spark):
    df = spark.createDataFrame([(1, 0), (1, 4)], "part int, whole int")
    values = df.select(ratio(F.col("part"), F.col("whole"), 100).alias("r")).collect()
    assert [row["r"] for row in values] == [None, 25.0]


def test_concat_distinct_orders_values_and_reduces_minima(spark):
    df = spark.createDataFrame(
        [(1, "b", "x", 3), (1, "a", "x", 2), (1, "b", None, 9), (2, None, "z", 1)],
        "k int, m string, p string, t int",
    )
    joined = concat_distinct(df, ["k"], ["m", "p"], " | ", smallest=["t"])
    assert rows(joined, "k", "m", "p", "t") == [(1, "a | b", "x", 2), (2, None, "z", 1)]


def test_total_row_counts_a_consumer_once(spark):
    counts = spark.createDataFrame(
        [(1, "SE", 1), (1, "NL", 2), (2, "SE", 1), (3, None, 4)],
        "consumer int, country string, n bigint",
    )
    totals = (
        with_total(counts, "consumer", "country", "n", "All")
        .groupBy("country")
        .agg(F.count("*").alias("consumers"), count_where(F.col("n") >= 3).alias("busy"))
    )
    assert rows(totals, "country", "consumers", "busy") == [("All", 3, 2), ("NL", 1, 0), ("SE", 2, 0)]


def test_total_rows_equal_grouping_sets(spark):
    base = spark.range(500).selectExpr("id % 40 AS consumer", "concat('C', id % 3) AS country")
    counts = base.groupBy("consumer", "country").agg(F.count("*").alias("n"))
    base.createOrReplaceTempView("base")
    sets = spark.sql(
        "SELECT coalesce(country, 'All') AS country, consumer, count(*) AS n FROM base"
        " GROUP BY GROUPING SETS ((consumer, country), (consumer))"
    )
    ours = with_total(counts, "consumer", "country", "n", "All")
    assert rows(ours, "country", "consumer", "n") == rows(sets, "country", "consumer", "n")


def test_previous_row_within_and_across_slices(spark):
    stops = spark.createDataFrame(
        [
            (1, 1, "TERMINAL", 100),
            (1, 1, "CONSUMER_STOP", 7),
            (1, 5, "CONSUMER_STOP", 8),
            (1, 400, "CONSUMER_STOP", 9),
            (2, 3, "CONSUMER_STOP", 7),
            (3, 2, "CONSUMER_STOP", 5),
            (3, 90, "CONSUMER_STOP", 4),
        ],
        "route_id int, sequence int, kind string, stop_id int",
    )
    pairs = previous_row(
        stops, ["route_id"], "sequence", ["kind", "stop_id"], ["kind", "stop_id"], width=4
    )
    assert rows(pairs, "route_id", "stop_id", "previous.stop_id") == [
        (1, 100, 7),
        (1, 7, None),
        (1, 8, 100),
        (1, 9, 8),
        (2, 7, None),
        (3, 4, 5),
        (3, 5, None),
    ]


def test_previous_row_equals_lag_for_a_very_large_key(spark):
    from pyspark.sql import Window

    df = spark.range(3000).selectExpr(
        "IF(id % 3 = 0, 0, id % 20) AS key", "(id * 37) % 501 AS position", "id"
    )
    window = Window.partitionBy("key").orderBy("position", "id")
    plain = df.withColumn("before", F.lag("id").over(window))
    ours = previous_row(df, ["key"], "position", ["id"], ["id"], width=16)
    assert rows(ours, "key", "id", "previous.id") == rows(plain, "key", "id", "before")


LOG = "key bigint, at int, change_id bigint, gone boolean, value string"


def test_change_log_converges_in_any_order_and_on_replay(spark):
    log = spark.createDataFrame(
        [
            (1, 1, 1, False, "a"),
            (1, 2, 2, False, "b"),
            (2, 1, 3, False, "c"),
            (2, 3, 4, True, None),
            (3, 2, 5, False, "d"),
            (3, 2, 6, False, "e"),
        ],
        LOG,
    )
    keys, order = ["key"], ["at", "change_id"]
    final = newest_changes(log, keys, order, F.col("gone"))
    expected = [(1, "b"), (3, "e")]
    assert rows(final, "key", "value") == expected
    empty = spark.createDataFrame([], LOG)
    late, early = log.where("at >= 2"), log.where("at < 2")
    for batches in ([early, late], [late, early], [late, early, late]):
        state = empty
        for batch in batches:
            state = apply_changes(state, batch, keys, order)
        assert rows(live_rows(state, "gone"), "key", "value") == expected


def test_manifest_expands_groups_once():
    jobs = parse_manifest(["orders", "routes:stops", " stops : parcels"], keys=("id",))
    assert [job.table for job in jobs] == ["orders", "routes", "stops", "parcels"]
    assert all(isinstance(job, Replicated) and job.keys == ("id",) for job in jobs)


def test_a_change_without_a_mark_deletes_nothing(spark):
    log = spark.createDataFrame(
        [(1, 1, 1, None, "a"), (2, 1, 2, True, "b"), (3, 1, 3, False, "c")], LOG
    )
    final = newest_changes(log, ["key"], ["at", "change_id"], F.col("gone"))
    assert rows(final, "value") == [("a",), ("c",)]
    state = apply_changes(log.limit(0), log, ["key"], ["at", "change_id"])
    assert rows(live_rows(state, "gone"), "value") == [("a",), ("c",)]
