"""Versions, bucketed merges, daily partials, sets as bitmaps, range joins, documents taken apart."""

import re
from collections import Counter
from datetime import date, datetime, timedelta
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from conftest import TESTDATA
from parcelmart.functions.clock import AsOf
from parcelmart.functions.variants import found_paths, taken_apart
from parcelmart.operators import bitmaps
from parcelmart.operators.changes import BucketedState, Replicated, replicate_buckets
from parcelmart.operators.partials import DailyPartials
from parcelmart.operators.ranges import within
from parcelmart.plans import upkeep
from parcelmart.sources.logs import stored_logs
from parcelmart.sources.parts import PartStore
from parcelmart.sources.sinks import published, table_versions, write_files, write_table
from parcelmart.sources.versions import Conflict, Versions

SF = str(TESTDATA / "sf0.001")


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def rows(df):
    return sorted((tuple(row) for row in df.collect()), key=str)


# Versions ------------------------------------------------------------------


def test_readers_see_whole_versions_only(spark, tmp_path):
    path = write_files(spark.range(3), str(tmp_path), "mart")
    before = published(spark, path)
    # Between write and switch: the data of the next version lies there, nothing refers to it.
    versions = Versions(spark, path)
    spark.range(99).write.parquet(f"{path}/{versions.new_folder(2)}")
    assert published(spark, path).count() == 3
    # A failed write.
    broken = spark.range(9).select(F.raise_error(F.lit("no")).alias("id"))
    with pytest.raises(Exception, match="no"):
        write_files(broken, str(tmp_path), "mart")
    assert published(spark, path).count() == 3 and versions.numbers() == [1]
    # A reader that resolved the old version goes on with it.
    write_files(spark.range(5), str(tmp_path), "mart")
    assert before.count() == 3 and published(spark, path).count() == 5
    assert published(spark, path, version=1).count() == 3


def test_versions_are_kept_for_some_refreshes(spark, tmp_path):
    for n in range(1, 7):
        path = write_files(spark.range(n), str(tmp_path), "mart", keep=2)
    assert Versions(spark, path).numbers() == [5, 6]
    assert len([p for p in (Path(path) / "data").iterdir() if not p.name.startswith(".")]) == 2
    assert published(spark, path).count() == 6
    with pytest.raises(FileNotFoundError):
        published(spark, f"{tmp_path}/nothing")


def test_one_of_two_writers_is_told(spark, tmp_path):
    first, second = Versions(spark, str(tmp_path)), Versions(spark, str(tmp_path))
    first.commit(1, {"folder": "data/000000000001-a"})
    with pytest.raises(Conflict):
        second.commit(1, {"folder": "data/000000000001-b"})
    assert second.current() == (1, {"folder": "data/000000000001-a"})


def test_tables_are_switched_behind_a_view(spark, tmp_path):
    spark.sql(f"CREATE DATABASE IF NOT EXISTS marts LOCATION '{tmp_path}/marts'")
    try:
        for n in range(1, 6):
            name = write_table(spark.range(n), "counts", "marts", keep=2)
            assert spark.read.table(name).count() == n
        with pytest.raises(Exception, match="no"):
            write_table(spark.range(9).select(F.raise_error(F.lit("no")).alias("id")), "counts", "marts", keep=2)
        assert spark.read.table(name).count() == 5
        assert table_versions(spark, "counts", "marts") == [4, 5]
    finally:
        spark.sql("DROP DATABASE marts CASCADE")


# Bucketed merge ---------------------------------------------------------------

CHANGE = "id bigint, at timestamp_ntz, n int, gone boolean, value string"


def change(id, day, value, gone=False, n=0):
    return (id, datetime(2024, 1, 1) + timedelta(days=day), n, gone, value)


def state_in(spark, tmp_path, buckets=8, **settings):
    return BucketedState(spark, str(tmp_path / "state"), CHANGE, ["id"], ["at", "n"], "gone", buckets, **settings)


def live(state):
    return {r.id: r.value for r in state.live().collect()}


def test_late_changes_deletes_and_marks(spark, tmp_path):
    state = state_in(spark, tmp_path)
    batch = lambda *changes: spark.createDataFrame(list(changes), CHANGE)
    first = batch(change(1, 1, "a"), change(2, 1, "b"), change(3, 5, "c", gone=True), change(4, 1, "d", gone=None))
    state.merge(first)
    assert live(state) == {1: "a", 2: "b", 4: "d"}
    # Older than the delete; a tie by the second order column; an insert and delete at once; a NULL mark.
    second = batch(change(3, 4, "late"), change(1, 1, "A", n=1), change(5, 2, "e"), change(5, 3, "e", gone=True), change(2, 2, "B", gone=None))
    state.merge(second)
    assert live(state) == {1: "A", 2: "B", 4: "d"}
    before = rows(state.all_rows())
    for again in (first, second, first):
        state.merge(again)
        assert rows(state.all_rows()) == before
    # A batch of another order gives the same.
    other = BucketedState(spark, str(tmp_path / "other"), CHANGE, ["id"], ["at", "n"], "gone", 3)
    other.merge(second)
    other.merge(first)
    assert rows(other.all_rows()) == before


def test_only_touched_buckets_are_written(spark, tmp_path):
    state = state_in(spark, tmp_path, buckets=16)
    state.merge(spark.createDataFrame([change(i, 1, "x") for i in range(200)], CHANGE))
    before = state.store.parts()
    assert len(before) == 16
    merge = state.merge(spark.createDataFrame([change(7, 2, "y"), change(7, 3, "z"), change(300, 1, "new")], CHANGE))
    after = state.store.parts()
    assert 1 <= len(merge.rewritten) <= 2
    assert {part for part in after if after[part] != before[part]} == set(map(str, merge.rewritten))
    assert live(state)[7] == "z" and len(live(state)) == 201
    # Readers of the version before still find its files.
    assert state.store.read_version(before).count() == 200
    # The number of buckets stays what it was; nothing arrives, nothing happens.
    again = state_in(spark, tmp_path, buckets=999)
    assert again.buckets == 16 and again.merge(spark.createDataFrame([], CHANGE)).rewritten == []
    assert len(live(again)) == 201


def test_tombstones_go_when_nothing_older_may_come(spark, tmp_path):
    state = state_in(spark, tmp_path, buckets=1)
    state.merge(spark.createDataFrame([change(1, 1, "a"), change(1, 2, "a", gone=True), change(2, 9, "b", gone=True), change(3, 1, "c")], CHANGE))
    assert state.all_rows().count() == 3
    state.merge(spark.createDataFrame([change(4, 9, "d")], CHANGE), oldest=datetime(2024, 1, 6))
    assert sorted(r.id for r in state.all_rows().collect()) == [2, 3, 4]
    # What is older was taken in before or is too late; the limit stays.
    state.merge(spark.createDataFrame([change(1, 1, "back"), change(2, 8, "old"), change(5, 9, "e")], CHANGE))
    assert live(state) == {3: "c", 4: "d", 5: "e"}


def test_a_merge_from_an_old_version_conflicts(spark, tmp_path):
    store = PartStore(spark, str(tmp_path / "parts"), "id bigint, part string")
    data = spark.createDataFrame([(1, "a")], "id bigint, part string")
    store.replace(data, "part", ["a"], 0)
    with pytest.raises(Conflict):
        store.replace(data, "part", ["a"], 0)
    with pytest.raises(ValueError, match="not rewritten"):
        store.replace(data, "part", ["b"], 1)
    store.replace(data.where("false"), "part", ["a"], 1)
    assert store.read().count() == 0 and store.parts() == {}


def test_several_keys_hot_keys_and_null_keys(spark, tmp_path):
    schema = "a string, b bigint, at int, gone boolean"
    state = BucketedState(spark, str(tmp_path / "state"), schema, ["a", "b"], ["at"], "gone", 4)
    log = spark.range(3000).selectExpr("IF(id % 3 = 0, 'hot', CAST(id % 7 AS STRING)) AS a", "IF(id % 3 = 0, NULL, id % 5) AS b", "CAST(id AS INT) AS at", "false AS gone")
    state.merge(log.where("at % 2 = 0"))
    state.merge(log.where("at % 2 = 1"))
    newest = log.groupBy("a", "b").agg(F.max("at").alias("at"))
    assert rows(state.live().select("a", "b", "at")) == rows(newest)


def test_a_manifest_of_buckets(spark, tmp_path):
    manifest = [Replicated(name, order=("at", "n")) for name in ("first", "second")]
    states = {e.table: BucketedState(spark, str(tmp_path / e.table), CHANGE, e.keys, e.order, "gone", 4) for e in manifest}
    found = replicate_buckets(manifest, lambda e: states[e.table], lambda name: spark.createDataFrame([change(len(name), 1, name)], CHANGE))
    assert {name: live(state) for name, state in states.items()} == {"first": {5: "first"}, "second": {6: "second"}}
    assert all(len(merge.rewritten) == 1 for merge in found.values())


def test_changes_between_versions(spark, tmp_path):
    state = state_in(spark, tmp_path)
    state.merge(spark.createDataFrame([change(i, 1, "x") for i in range(5)], CHANGE))
    signed = lambda version: sorted((r.id, r.value, r.sign) for r in state.changes_since(version).collect())
    assert signed(0) == [(i, "x", 1) for i in range(5)] and signed(1) == []
    state.merge(spark.createDataFrame([change(1, 2, "y"), change(2, 2, "x", gone=True), change(3, 0, "old"), change(9, 1, "new")], CHANGE))
    assert signed(1) == [(1, "x", -1), (1, "y", 1), (2, "x", -1), (9, "new", 1)]


# Daily partials -----------------------------------------------------------------


def test_windows_follow_three_batches(spark, tmp_path):
    schema = "id bigint, change int, gone boolean, buyer_id bigint, created_at timestamp_ntz, cancellation_id bigint, cents bigint"
    final = spark.range(400).selectExpr(
        "id", "id % 7 AS buyer_id", "TIMESTAMP_NTZ '2024-03-01 00:00:00' + make_dt_interval(CAST(id % 40 AS INT), CAST(id % 24 AS INT)) AS created_at",
        "IF(id % 6 = 0, id, NULL) AS cancellation_id", "id * 3 AS cents",
    )
    names = [part.split()[0] for part in schema.split(", ")]
    batches = [b.select(*names) for b in upkeep._in_three_batches(final, "created_at", "cancellation_id")]
    orders = upkeep.replicated(spark, batches[0], "test-orders")
    partials = DailyPartials(spark, str(tmp_path / "partials"), "buyer_id bigint", "orders bigint, cents bigint")
    day, groups = F.to_date("created_at"), {"buyer_id": F.col("buyer_id")}
    measures, counted = {"orders": F.lit(1), "cents": F.col("cents")}, F.col("cancellation_id").isNull()
    for batch in batches:
        held = partials.store.parts()
        orders.merge(batch)
        days = partials.refresh(orders, day, groups, measures, counted)
        whole = orders.live().where(counted).withColumn("day", day)
        for first, last in ((None, None), (date(2024, 3, 5), date(2024, 3, 20))):
            inside = whole if first is None else whole.where(F.col("day").between(first, last))
            expected = inside.groupBy("buyer_id").agg(F.count("*").alias("orders"), F.sum("cents").alias("cents"))
            window = partials.window(first, last)
            assert rows(window) == rows(expected)
        # The plan opens the files of the window's days only, and no orders.
        opened = {re.search(r"_part=([\d-]+)", name).group(1) for name in window.inputFiles()}
        assert opened and all("2024-03-05" <= d <= "2024-03-20" for d in opened)
        assert all("partials" in name for name in window.inputFiles())
        now = partials.store.parts()
        assert {d for d in now if held.get(d) != now[d]} <= set(days)
    # One order changes: one day is rewritten. A refresh without changes, or repeated, does nothing.
    orders.merge(batches[2].where("id = 7").withColumn("cancellation_id", F.lit(1).cast("bigint")).withColumn("change", F.lit(4)))
    assert partials.refresh(orders, day, groups, measures, counted) == ["2024-03-08"]
    assert partials.refresh(orders, day, groups, measures, counted) == []
    expected = orders.live().where(counted).groupBy("buyer_id").agg(F.count("*"), F.sum("cents"))
    assert rows(partials.window()) == rows(expected)


def test_windows_begin_after_midnight(spark, tmp_path):
    as_of = AsOf(datetime(2024, 6, 5, 12))
    start = as_of.day(months=-3)
    at = lambda day, *clock: datetime(day.year, day.month, day.day, *clock)
    final = [(1, at(start)), (2, at(start, 0, 0, 1)), (3, at(start) + timedelta(days=1))]
    batch = spark.createDataFrame([(i, 1, False, 5, when, None) for i, when in final], "id bigint, change int, gone boolean, buyer_id bigint, created_at timestamp_ntz, cancellation_id bigint")
    orders = upkeep.replicated(spark, batch, "test-orders")
    orders.merge(batch)
    partials = upkeep.ecommerce_partials(spark, str(tmp_path / "partials"))
    upkeep.refresh_ecommerce(partials, orders)
    assert rows(partials.window(start, by=["created_date"])) == [(start, 1), (start + timedelta(days=1), 1)]


# Bitmaps --------------------------------------------------------------------------


def test_sets_unite_and_meet(spark):
    visits = spark.createDataFrame(
        [(1, "a", 0), (1, "a", -5), (1, "b", 32768), (2, "b", 32768), (2, "b", 32769), (2, "a", 0), (3, "c", None), (3, "c", 10**12)],
        "day int, shop string, id bigint",
    )
    daily = bitmaps.id_sets(visits, ["day", "shop"], "id")
    assert rows(bitmaps.distinct_counts(daily, ["shop"], "n")) == [("a", 2), ("b", 2), ("c", 1)]
    assert rows(bitmaps.distinct_counts(daily, ["day"], "n")) == [(1, 3), (2, 3), (3, 1)]
    members = bitmaps.id_sets(spark.createDataFrame([("x", 32768), ("x", -5), ("y", 7)], "club string, id bigint"), ["club"], "id")
    met = bitmaps.shared_by(bitmaps.united(daily, ["day"]), members, ["day", "club"])
    assert rows(bitmaps.sizes(met, ["day", "club"], "n")) == [(1, "x", 2), (2, "x", 1)]


def test_no_ids_are_shuffled_for_distinct_counts(spark):
    df = upkeep.distinct_buyers_per_week(spark, SF)
    df.collect()
    exchanges = re.findall(r"Exchange hashpartitioning\(([^)]*)\)", df._jdf.queryExecution().executedPlan().toString())
    assert exchanges and not any("buyer" in keys or "custkey" in keys for keys in exchanges)
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    assert "bitmap_construct_agg" in plan and "count(distinct" not in plan.lower()


# Range join -------------------------------------------------------------------------


def brute_pairs(left, right, seconds, before):
    return sorted(
        (a, b)
        for key, a, t in left
        for other, b, u in right
        if key is not None and key == other and t is not None and u is not None and t - timedelta(seconds=before) <= u <= t + timedelta(seconds=seconds)
    )


@pytest.mark.parametrize(("seconds", "before"), [(900, 0), (0, 0), (60, 600), (7, 3)])
def test_range_join_with_a_hot_key(spark, seconds, before):
    start = datetime(2024, 3, 30, 23, 50)
    spread = lambda i: start + timedelta(seconds=(i * 7919) % 9000, microseconds=i % 3 * 333_333)
    left = [(1 if i % 3 == 0 else i % 9, i, spread(i)) for i in range(240)] + [(None, 900, start), (1, 901, None)]
    right = [(1 if i % 3 == 0 else i % 9, i, spread(i + 17)) for i in range(240)] + [(None, 900, start), (1, 901, None)]
    frames = [spark.createDataFrame(data, f"key int, {side} int, {side}_time timestamp_ntz") for data, side in ((left, "l"), (right, "r"))]
    joined = within(*frames, ["key"], "l_time", "r_time", seconds, before)
    assert sorted((r.l, r.r) for r in joined.collect()) == brute_pairs(left, right, seconds, before)
    plan = plan_of(joined)
    assert "NestedLoop" not in plan and "Cartesian" not in plan and re.search(r"Join \[key\S*, _bin", plan)


def test_a_hot_key_is_dealt_out_by_its_bins(spark):
    """A user with a third of all rows: no join key has more rows than its bin."""
    events = spark.range(9000).selectExpr("IF(id % 3 = 0, -1, id) AS key", "id", "TIMESTAMP_NTZ '2024-01-01' + make_dt_interval(0, 0, CAST(id AS INT)) AS at")
    joined = within(events.toDF("key", "a", "at_a"), events.toDF("key", "b", "at_b"), ["key"], "at_a", "at_b", 600)
    counts = Counter(r.key for r in joined.select("key").collect())
    # Of the hot user, every event meets itself and the next three.
    assert counts[-1] == 3000 * 4 - 6 and sum(counts.values()) == counts[-1] + 6000


# Documents -----------------------------------------------------------------------------


def test_documents_are_parsed_once(spark):
    texts = ['{"a": {"b": 5}, "c": "x"}', '{"a": {"b": "5"}}', '{"a": ', None, "7", '{"a": null, "c": 1.5}']
    df = spark.createDataFrame(list(enumerate(texts)), "id int, text string")
    out = taken_apart(df, "text", {"b": ("$.a.b", "int"), "c": ("$.c", "string")})
    assert rows(out) == [(0, 5, "x"), (1, 5, None), (2, None, None), (3, None, None), (4, None, None), (5, None, "1.5")]
    assert out._jdf.queryExecution().optimizedPlan().toString().count("parse_json") <= 1
    assert "a" in found_paths(df, "text") or found_paths(df, "text") == "VARIANT"
    assert found_paths(df.where("id < 2"), "text") == "OBJECT<a: OBJECT<b: VARIANT>, c: STRING>"


# Stored logs ------------------------------------------------------------------------------


def final_plan(df):
    """Lines of the plan that ran, without subqueries and their plans."""
    lines = df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0].splitlines()
    out, inside = [], None
    for line in lines:
        depth = len(line) - len(line.lstrip(" :+-*|"))
        if inside is not None and depth > inside:
            continue
        inside = depth if "Subquery" in line[depth : depth + 12] else None
        if inside is None:
            out.append((depth, line))
    return out


def scans_of(df, table):
    return [line for _, line in final_plan(df) if "FileScan" in line and table in line]


def moved(df, table):
    """Is there an exchange between a scan of the table and the join above it?"""
    lines = final_plan(df)
    for at, (depth, line) in enumerate(lines):
        if "FileScan" in line and table in line:
            for above, parent in reversed(lines[:at]):
                if above < depth:
                    depth = above
                    if "Exchange" in parent:
                        return True
                    if "Join" in parent:
                        break
    return False


@pytest.mark.parametrize("name", ["backlog_from_stored_log", "due_vs_scanned_from_stored_log"])
def test_logs_are_read_by_day_and_not_moved(spark, name):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        df = upkeep.QUERIES[name](spark, str(TESTDATA / "sf0.01"))
        df.collect()
        (scan,) = scans_of(df, "scanning_log")
        assert "Bucketed: true" in scan
        days = scan.split("PartitionFilters: ")[1]
        # The days of the attempts' deadlines are known once those are read.
        assert ("subquery" in days) == name.startswith("due") and ">= " in days
        assert not moved(df, "scanning_log")
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_a_stored_log_keeps_all_rows(spark):
    t = upkeep.StandInTables(spark, SF)
    columns = ("id", "parcel_id", "user_id", "date")
    stored = upkeep.on_stored_logs(spark, SF)
    assert rows(stored("scanning_log", *columns)) == rows(t("scanning_log", *columns))
    assert rows(stored("parcels", "id")) == rows(t("parcels", "id"))
    first = date(1998, 8, 9)
    late = t("scanning_log", *columns).where(F.to_date("date") >= F.lit(first))
    # Whole months are read, so no row from that day on is missing.
    read = stored.log("scanning_log", *columns, since=first)
    assert rows(read.where(F.to_date("date") >= F.lit(first))) == rows(late)
    assert rows(read.select(F.min(F.to_date("date")) >= F.lit(date(1998, 8, 1)))) == [(True,)]
    by_day = stored_logs(t, stored.stored["scanning_log"].split(".")[0], {"parcel_status_updates": ("date", "consignment_id")}, 2)
    updates = t("parcel_status_updates", "id", "date")
    assert rows(by_day.log("parcel_status_updates", "id", "date", since=first)) == rows(updates.where(F.to_date("date") >= F.lit(first)))
    assert rows(t.log("scanning_log", *columns, since=first)) == rows(t("scanning_log", *columns))
