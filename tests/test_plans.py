"""Marts on hand-made tables, properties and physical plans."""

import re
from datetime import datetime, timedelta
from functools import reduce

import pytest
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import _parse_datatype_string

import __spark_entry__ as entry
from conftest import TESTDATA
from parcelmart.functions.clock import AsOf
from parcelmart.plans import (
    booking,
    consumers,
    direct,
    legs,
    lockers,
    quality,
    registry,
    routes,
    unassigned,
)
from parcelmart.sources.schemas import CONSUMERS, OPERATIONS, schema_of
from parcelmart.sources.sinks import published
from parcelmart.sources.standin import STANDIN_AS_OF, StandInTables
from parcelmart.sources.tables import (
    CatalogTables,
    JdbcTables,
    ParquetTables,
    Shares,
    Split,
    Strides,
    Tables,
    declared,
    fitted_cuts,
    interval_bounds,
    split_by_bounds,
    typed,
)

SF = str(TESTDATA / "sf0.001")
NOW = datetime(2024, 6, 5, 12)
TODAY = NOW.date()
AS_OF = AsOf(NOW)


class GivenTables(Tables):
    """Tables from literal rows; those not given are empty."""

    def __init__(self, spark, **given):
        super().__init__(spark)
        self.given = given

    def load(self, name, wanted):
        schema = _parse_datatype_string(schema_of(name))
        records = [
            tuple(record.get(field.name) for field in schema.fields)
            for record in self.given.get(name, [])
        ]
        return self.spark.createDataFrame(records, schema)


def place(terminal_id=1, zone_id=200, zone_type="TO_DOOR"):
    return {
        "postal_code_zones": [
            {"id": zone_id, "city": "A", "country_code": "SE", "type": zone_type, "terminal_id": terminal_id}
        ],
        "warehouses": [{"id": terminal_id, "code": "T", "name": "Terminal", "address_id": 1}],
        "addresses": [{"id": 1, "country_code": "SE"}],
    }


def test_attempts_count_parcels_and_late_cancellations(spark):
    def attempt(number, cancelled=None):
        return {
            "id": number,
            "order_id": number,
            "date": TODAY,
            "deadline": datetime(2024, 6, 4, 12),
            "type": "DELIVERY",
            "cancellation_id": cancelled,
        }

    tables = GivenTables(
        spark,
        consignments=[attempt(1), attempt(2), attempt(3), attempt(4, 40), attempt(5, 50)],
        orders=[{"id": i, "buyer_id": 1, "delivery_postal_code_zone_id": 200} for i in range(1, 6)],
        cancellations=[
            {"id": 40, "date": datetime(2024, 6, 4, 12)},
            {"id": 50, "date": datetime(2024, 6, 4, 12, 1)},
        ],
        # Attempts with no, one and three parcels.
        parcel_consignments=[
            {"parcel_id": 10 + i, "consignment_id": c} for i, c in enumerate([2, 3, 3, 3])
        ],
        **place(),
    )
    row = booking.planned_attempts_by_terminal_day(tables, AS_OF).first()
    assert row["attempts"] == 1 + 1 + 3 + 1
    assert row["cancelled_attempts"] == 1
    assert row["routes_saved"] is False
    assert row["day_of_week"] == "Wednesday"


def test_empty_day_gives_no_rows(spark):
    tables = GivenTables(spark, **place())
    assert booking.planned_attempts_by_terminal_day(tables, AS_OF).count() == 0
    assert split_by_bounds(tables("orders", "id"), "id") is None


def test_box_states_by_priority(spark):
    boxes = [
        {"id": i, "locker_id": 1, "board_id": 1, "slot_id": i, "error_code": "E" if i == 3 else None}
        for i in range(1, 7)
    ]
    held = [
        {"id": 1, "box_id": 2, "parcel_id": 2, "state": "PRESENT"},
        {"id": 2, "box_id": 3, "parcel_id": 3, "state": "PRESENT"},
        {"id": 3, "box_id": 4, "parcel_id": 4, "state": "PRESENT"},
        {"id": 4, "box_id": 5, "parcel_id": 5, "state": "RESERVED"},
        {"id": 5, "box_id": 6, "parcel_id": 6, "state": "PICKED_UP"},
    ]
    parcels = [
        {"id": i, "order_id": i, "type": "RETURN" if i == 4 else "DELIVERY"} for i in range(2, 7)
    ]
    tables = GivenTables(
        spark,
        locker_boxes=boxes,
        parcel_box_assignments=held,
        parcels=parcels,
        orders=[{"id": i, "token": f"T{i}"} for i in range(2, 7)],
    )
    states = {row["slot_id"]: row["state"] for row in lockers.box_status(tables, AS_OF).collect()}
    assert states == {1: 1, 2: 2, 3: 3, 4: 4, 5: 5, 6: 1}


def test_scans_at_or_before_the_deadline_do_not_count(spark):
    deadline = datetime(2024, 6, 4, 12)
    tables = GivenTables(
        spark,
        consignments=[
            {"id": 1, "order_id": 1, "date": TODAY, "deadline": deadline, "type": "DELIVERY"},
            {"id": 2, "order_id": 2, "date": TODAY, "deadline": deadline, "type": "DELIVERY"},
        ],
        orders=[{"id": i, "delivery_postal_code_zone_id": 200} for i in (1, 2)],
        parcel_consignments=[
            {"parcel_id": 10, "consignment_id": 1},
            {"parcel_id": 11, "consignment_id": 1},
            {"parcel_id": 12, "consignment_id": 2},
        ],
        parcels=[{"id": i, "order_id": 1, "visible": i != 12} for i in (10, 11, 12)],
        scanning_log=[
            {"id": 1, "parcel_id": 10, "date": deadline},
            {"id": 2, "parcel_id": 11, "date": datetime(2024, 6, 4, 13)},
            {"id": 3, "parcel_id": 11, "date": datetime(2024, 6, 4, 14)},
            {"id": 4, "parcel_id": 12, "date": datetime(2024, 6, 4, 14)},
        ],
        **place(),
    )
    row = routes.due_vs_scanned(tables, AS_OF).first()
    assert (row["consignments"], row["parcels_due"], row["scanned_parcels"]) == (4, 2, 1)


def test_scan_flags_depend_on_the_terminal(spark):
    tables = GivenTables(
        spark,
        orders=[
            {"id": 1, "buyer_id": 9, "created_at": NOW, "delivery_postal_code_zone_id": 200}
        ],
        buyers=[{"id": 9, "external_name": "Shop"}],
        postal_code_zones=[
            {"id": 200, "country_code": "SE", "type": "TO_DOOR", "terminal_id": 1}
        ],
        warehouses=[
            {"id": 1, "code": "T1", "address_id": 1},
            {"id": 2, "code": "T2", "address_id": 2},
        ],
        addresses=[{"id": 1, "country_code": "SE"}, {"id": 2, "country_code": "BE"}],
        users=[{"id": 5, "user_settings_id": 5}],
        user_settings=[{"id": 5, "warehouse_id": 2}],
        parcels=[{"id": 10, "order_id": 1, "visible": True}, {"id": 11, "order_id": 1, "visible": False}],
        scanning_log=[{"id": i, "parcel_id": p, "user_id": 5} for i, p in ((1, 10), (2, 10), (3, 11))],
    )
    row = unassigned.orders_not_assigned(tables, AS_OF).first().asDict()
    assert (row["orders"], row["parcels"]) == (1, 2)
    assert [row[name] for name in unassigned.SCANS] == [1, 0, 0, 1]


def test_arrival_past_midnight_counts_as_failure(spark):
    tables = GivenTables(
        spark,
        routes=[{"id": 1, "due_date": TODAY, "city": "A", "terminal": "T", "type": "DISTRIBUTION"}],
        consumer_stops=[{"id": 1, "route_id": 1, "estimated_interval_id": 1}],
        interval_bounds=[{"id": 1, "start_ts": datetime(2024, 6, 5, 0, 1)}],
        routeopt_service_time_data=[
            {"consumer_stop_id": 1, "arrival_time": datetime(2024, 6, 4, 23, 59)}
        ],
    )
    row = quality.eta_vs_arrival(tables, AS_OF).first()
    assert row["avg_minutes"] == -1438 and row["count_fail"] == 1 and row["std_minutes"] == 0


def test_both_forms_of_unassigned_orders_agree(spark):
    tables = StandInTables(spark, SF)
    listed = (
        unassigned.orders_not_assigned_union(tables, STANDIN_AS_OF)
        .where("parcel_id IS NOT NULL")
        .groupBy("merchant", "terminal_code", "country", "delivery_type")
        .agg(
            F.count_distinct("order_id").alias("orders"),
            F.count_distinct("parcel_id").alias("parcels"),
        )
    )
    counted = unassigned.orders_not_assigned(tables, STANDIN_AS_OF).select(listed.columns)
    assert sorted(listed.collect()) == sorted(counted.collect())


@pytest.mark.parametrize("name", sorted(OPERATIONS | CONSUMERS))
def test_standin_tables_have_the_declared_schema(spark, name):
    declared = _parse_datatype_string(schema_of(name))
    found = StandInTables(spark, SF)(name, *[field.name for field in declared.fields]).schema
    assert [(f.name, f.dataType) for f in found] == [(f.name, f.dataType) for f in declared]


def test_interval_bounds_equal_the_two_lookups(spark):
    tables = StandInTables(spark, SF)
    kept = tables("interval_bounds", "id", "start_ts", "stop_ts")
    assert sorted(interval_bounds(tables).collect()) == sorted(kept.collect())


def test_every_published_table_is_registered_once():
    assert len(registry.MARTS) == 64
    names = [(mart.schema, mart.table) for mart in registry.MARTS.values()]
    assert len(set(names)) == 64
    assert [len(registry.due(c)) for c in ("1 minute", "10 minutes", "1 hour", "4 hours", "daily")] == [
        4,
        31,
        12,
        2,
        15,
    ]


def test_marts_are_replaced_and_repeatable(spark, tmp_path):
    tables = StandInTables(spark, SF)
    keys = [
        "limits_from_today",
        "cancellation_rate_per_day",
        "planned_attempts_by_terminal_day",
        "planned_box_attempts",
    ]
    first = registry.refresh_files(keys, tables, STANDIN_AS_OF, str(tmp_path))
    before = {key: sorted(published(spark, path).collect()) for key, path in first.items()}
    second = registry.refresh_files(keys, tables, STANDIN_AS_OF, str(tmp_path))
    assert first == second
    after = {key: sorted(published(spark, path).collect()) for key, path in second.items()}
    assert before == after
    # The two marts of one extract are what the plan gives.
    plan = booking.planned_attempts_by_terminal_day(tables, STANDIN_AS_OF)
    for key in keys[2:]:
        rows = published(spark, first[key]).select(*plan.columns)
        assert sorted(rows.collect()) == sorted(plan.collect())
    stamped = published(spark, first["cancellation_rate_per_day"])
    assert [row[0] for row in stamped.select("refreshed_at").distinct().collect()] == [STANDIN_AS_OF.now]
    assert "refreshed_at" not in published(spark, first["limits_from_today"]).columns


def test_parquet_and_catalog_sources_read_the_same_table(spark, tmp_path):
    rows = StandInTables(spark, SF)("consumer", "id", "consumer_id", "push_notification_token", "created_at")
    rows.write.parquet(f"{tmp_path}/consumer")
    files = ParquetTables(spark, str(tmp_path))("consumer", "id as key", "consumer_id")
    spark.sql(f"CREATE DATABASE IF NOT EXISTS people LOCATION '{tmp_path}/people'")
    rows.write.mode("overwrite").saveAsTable("people.consumer")
    try:
        catalog = CatalogTables(spark, {"consumers": "people"})("consumer", "id as key", "consumer_id")
        assert sorted(files.collect()) == sorted(catalog.collect())
    finally:
        spark.sql("DROP DATABASE people CASCADE")


def test_jdbc_reads_are_split_by_range(spark):
    tables = JdbcTables(
        spark,
        {"url": "jdbc:mysql://host/{database}", "user": "u", "password": "p", "driver": "d"},
        {"operations": "ops", "consumers": "people"},
        {"orders": Split("id", 10, 90, 16)},
    )
    options = tables.options("orders", "operations", tables.splits["orders"])
    assert options["url"] == "jdbc:mysql://host/ops"
    assert options["fetchsize"] == "2000"
    assert options["preferTimestampNTZ"] == "true"
    assert [options[k] for k in ("partitionColumn", "lowerBound", "upperBound", "numPartitions")] == [
        "id",
        "10",
        "90",
        "16",
    ]
    split = split_by_bounds(spark.range(5, 25), "id", 8)
    assert split == Split("id", 5, 24, 8)


class Server(JdbcTables):
    """Stands for a row store: its queries run on Spark's own views."""

    def query(self, sql, database, split=None):
        self.asked = [*getattr(self, "asked", []), sql]
        return self.spark.sql(sql)

    def in_shares(self, relation, database, predicates):
        self.shares = [self.spark.sql(f"SELECT * FROM {relation} WHERE {predicate}") for predicate in predicates]
        return reduce(DataFrame.union, self.shares)


def served(spark, rows, split):
    names = [field.name for field in declared("orders").fields]
    columns = [c if c in rows.columns else f"CAST(NULL AS {kind}) AS {c}" for c, kind in spark.createDataFrame([], schema_of("orders")).dtypes]
    rows.selectExpr(*columns).select(*names).createOrReplaceTempView("orders")
    connection = {"url": "jdbc:mysql://host/{database}"}
    return Server(spark, connection, {"operations": "ops", "consumers": "people"}, {"orders": split})


UNEVEN = {
    "even": "id",
    "crowded below": "CAST(id * id * id / 1000000 AS BIGINT)",
    "hot": "IF(id % 3 = 0, 500, id)",
    "hot and nulls": "IF(id % 3 = 0, 1, IF(id % 3 = 1, NULL, id))",
    "one value": "7",
    "all null": "CAST(NULL AS BIGINT)",
}


@pytest.mark.parametrize("name", UNEVEN)
@pytest.mark.parametrize("negative", [False, True])
def test_shares_are_even_and_whole(spark, name, negative):
    key = "id - 3000" if negative else "id"
    rows = spark.range(6000).selectExpr(f"{key} AS id", f"CAST({UNEVEN[name]} AS BIGINT) AS buyer_id")
    tables = served(spark, rows, Shares("buyer_id", 12, spread="id"))
    found = tables("orders", "id", "buyer_id")
    assert sorted(found.collect(), key=str) == sorted(rows.collect(), key=str)
    assert max(share.count() for share in tables.shares) <= 2 * 6000 / 12
    tables("orders", "id")
    assert len(tables.asked) == 1
    # The next refresh fits the shares to what there is then.
    tables.begin_refresh()
    served(spark, rows.where("id % 2 = 0"), None)
    assert sorted(tables("orders", "id").collect()) == sorted(rows.where("id % 2 = 0").select("id").collect())
    assert len(tables.asked) == 2
    # The same by Spark's own quantiles.
    shares = [rows.where(F.expr(p)).count() for p in fitted_cuts(rows, "buyer_id", 12, spread="id").predicates()]
    assert sum(shares) == 6000 and max(shares) <= 2 * 6000 / 12


def test_shares_of_days_texts_and_nothing(spark):
    rows = spark.range(3000).selectExpr("id", "TIMESTAMP_NTZ '2024-01-01' + make_dt_interval(0, 0, CAST(id / 2 AS INT)) AS created_at", "concat('it''s ', id % 100) AS token")
    for column in ("created_at", "token"):
        tables = served(spark, rows, Shares(column, 6, spread="id"))
        assert tables("orders", "id").count() == 3000 and len(tables.shares) >= 6
        assert max(share.count() for share in tables.shares) <= 1000
    assert fitted_cuts(rows, "created_at", 4).predicates()[0].startswith("(created_at < TIMESTAMP '2024-01-01")
    empty = served(spark, rows.where("false"), Shares("id", 6))
    assert empty.fitted("orders") is None
    assert fitted_cuts(rows.where("false"), "id", 6).predicates() == ["1 = 1"]


def test_bounds_are_asked_of_the_server(spark):
    tables = served(spark, spark.range(5, 25), Strides("id", 8))
    assert tables.fitted("orders") == Split("id", 5, 24, 8) == tables.fitted("orders")
    assert len(tables.asked) == 1 and tables.fitted("parcels") is None
    tables.begin_refresh()
    served(spark, spark.range(0), None)
    assert tables.fitted("orders") is None


def test_memberships_without_a_consumer_do_not_count(spark):
    later = NOW + timedelta(days=3)
    rows = [{"id": i, "consumer_id": key, "active": True, "valid_to": later} for i, key in enumerate((7, 7, None))]
    found = consumers.active_memberships(GivenTables(spark, timeslot_subscription=rows), AS_OF).first()
    assert (found.active_memberships, found.signed_up) == (2, 1)


def test_stops_without_an_interval_are_no_neighbours(spark):
    stops = [
        {"id": i, "route_id": 1, "sequence": i, "address_id": 5, "estimated_interval_id": key}
        for i, key in ((1, 10), (2, None), (3, 11))
    ]
    given = GivenTables(
        spark,
        routes=[{"id": 1, "type": "DISTRIBUTION", "due_date": TODAY}],
        consumer_stops=stops,
        addresses=[{"id": 5, "coordinate": (1.0, 2.0)}],
        routeopt_service_time_data=[{"route_id": 1, "consumer_stop_id": i, "departure_time": NOW} for i in (1, 2, 3)],
    )
    found = {r.stop_id: r.prev_stop_id for r in legs.stop_pairs(given, AS_OF).collect()}
    assert found == {1: None, 3: 1}
    assert {r.stop_id for r in legs.leg_time_features(given, AS_OF).collect()} == {1, 3}


def test_locker_zones_without_a_terminal_have_no_backlog(spark):
    zones = [{"id": z, "type": "TO_LOCKER", "terminal_id": key} for z, key in ((1, 3), (2, None))]
    orders = [{"id": z, "created_at": NOW, "locker_id": z, "delivery_postal_code_zone_id": z} for z in (1, 2)]
    given = GivenTables(
        spark,
        postal_code_zones=zones,
        orders=orders,
        parcels=[{"id": 100 + z, "order_id": z} for z in (1, 2)],
        lockers=[{"id": z, "identifier": f"L{z}"} for z in (1, 2)],
    )
    assert [(r.identifier, r.orders) for r in lockers.locker_backlog(given, AS_OF).collect()] == [("L1", 1)]


def test_orders_of_terminals_without_an_address_are_not_listed(spark):
    given = GivenTables(
        spark,
        warehouses=[{"id": w, "code": f"T{w}", "address_id": key} for w, key in ((1, 9), (2, None))],
        addresses=[{"id": 9, "country_code": "SE"}],
        postal_code_zones=[{"id": w, "type": "TO_DOOR", "country_code": "SE", "terminal_id": w} for w in (1, 2)],
        orders=[{"id": w, "buyer_id": 4, "created_at": NOW, "delivery_postal_code_zone_id": w} for w in (1, 2)],
        parcels=[{"id": w, "order_id": w, "visible": True} for w in (1, 2)],
        buyers=[{"id": 4, "external_name": "shop"}],
    )
    assert [r.terminal_code for r in unassigned.orders_not_assigned(given, AS_OF).collect()] == ["T1"]
    with pytest.raises(ValueError, match="UNASSIGNED_TERMINAL"):
        unassigned.orders_not_assigned_one_terminal(given, AS_OF)


def test_jdbc_columns_get_their_declared_types(spark):
    """Points are taken apart on the server and put together again; nothing else changes."""
    tables = JdbcTables(spark, {"url": "jdbc:mysql://host/{database}"}, {"operations": "ops", "consumers": "people"})
    assert tables.relation("orders") == "orders"
    assert "ST_X(coordinate) AS coordinate_x, ST_Y(coordinate) AS coordinate_y" in tables.relation("addresses")
    served = {f.name: f.dataType.simpleString() for f in declared("addresses").fields if f.name != "coordinate"}
    nulls = [F.lit(None).cast(kind).alias(name) for name, kind in served.items() if name != "id"]
    rows = spark.sql("SELECT * FROM VALUES (1, 2.5D, 3.5D), (2, NULL, NULL) AS v(id, coordinate_x, coordinate_y)")
    found = typed(rows.select("*", *nulls), "addresses")
    assert found.dtypes == spark.createDataFrame([], schema_of("addresses")).dtypes
    assert [r.coordinate for r in found.orderBy("id").collect()] == [(2.5, 3.5), None]


def test_a_refresh_resolves_the_intervals_itself(spark, tmp_path):
    """Catalog tables as the operations database has them: no table of interval bounds."""
    source, names = StandInTables(spark, SF), ("locker_consignments", "orders", "postal_code_zones", "warehouses", "parcels", "locker_pallet_parcels", "intervals", "timestamps")
    spark.sql(f"CREATE DATABASE IF NOT EXISTS ops LOCATION '{tmp_path}/ops'")
    spark.sql(f"CREATE DATABASE IF NOT EXISTS published LOCATION '{tmp_path}/published'")
    try:
        for name in names:
            source(name, *[f.name for f in declared(name).fields]).write.mode("overwrite").saveAsTable(f"ops.{name}")
        tables = CatalogTables(spark, {"operations": "ops"})
        written = registry.refresh_tables(["due_vs_palletized"], tables, STANDIN_AS_OF, {"reports": "published"})
        found = spark.read.table(written["due_vs_palletized"]).drop("refreshed_at")
        assert sorted(found.collect()) == sorted(lockers.due_vs_palletized(source, STANDIN_AS_OF).collect())
    finally:
        spark.sql("DROP DATABASE ops CASCADE")
        spark.sql("DROP DATABASE published CASCADE")


def test_the_scan_log_is_cut_to_the_candidates_before_it_is_reduced(spark):
    for plan in (lockers.locker_backlog, lockers.old_undelivered, lockers.order_progress_over_time, unassigned.orders_not_assigned):
        log = plan(StandInTables(spark, SF), STANDIN_AS_OF)._jdf.queryExecution().optimizedPlan().toString()
        assert "Join LeftSemi" in log


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("key", sorted(set(entry.core_queries()) - set(entry.streams.QUERIES)))
def test_no_nested_loops(spark, key):
    plan = plan_of(entry.core_queries()[key](spark, SF))
    assert not re.search("NestedLoop|CartesianProduct", plan)
    assert "Python" not in plan and "Pandas" not in plan


class Node:
    """A logical plan read from its printed form."""

    def __init__(self, lines):
        depth = lambda line: len(line) - len(line.lstrip(" :+-"))
        self.text, rest = lines[0].lstrip(" :+-"), lines[1:]
        starts = [i for i, line in enumerate(rest) if depth(line) == depth(rest[0])] if rest else []
        self.children = [Node(rest[a:b]) for a, b in zip(starts, [*starts[1:], len(rest)], strict=False)]

    def walk(self):
        yield self
        for child in self.children:
            yield from child.walk()

    def has(self, text):
        return any(text in node.text for node in self.walk())


def logical(df):
    return Node(df._jdf.queryExecution().optimizedPlan().toString().splitlines())


@pytest.mark.parametrize("plan", [booking.orders_booked_by_terminal_day, booking.scheduled_by_group_merchant, booking.planned_attempts_by_terminal_day])
def test_facts_are_counted_per_zone_before_addresses_join(spark, plan):
    root = logical(plan(StandInTables(spark, SF), STANDIN_AS_OF))
    # Addresses come from the embeddings and suppliers, facts from the orders.
    joins = [n for n in root.walk() if n.text.startswith("Join") and n.has("vec_id#") and any(not child.has("vec_id#") for child in n.children)]
    with_facts = [child for n in joins for child in n.children if not child.has("vec_id#") and child.has("o_orderkey#")]
    assert with_facts
    for child in with_facts:
        assert any(node.text.startswith("Aggregate [zone_id") for node in child.walk())


def test_return_routes_are_not_multiplied_by_pallets(spark):
    root = logical(routes.return_route_schedule(StandInTables(spark, SF), STANDIN_AS_OF))
    # The pallets' side of the join by merchant is one row per merchant.
    joins = [n for n in root.walk() if n.text.startswith("Join Inner") and "buyer_id" in n.text]
    sides = [child for n in joins for child in n.children if child.has("collect_set(identifier")]
    assert sides and all(not child.has("o_orderkey#") or child.has("Aggregate [buyer_id") for child in sides)


def test_reports_join_by_day(spark):
    root = logical(quality.eta_vs_arrival_city(StandInTables(spark, SF), STANDIN_AS_OF))
    assert any(n.text.startswith("Join Inner") and "consignment_id" in n.text and "date" in n.text for n in root.walk())


def test_filters_and_columns_reach_the_scan(spark):
    plan = plan_of(direct.cancellation_rate_by_ship_day(spark, SF))
    assert re.search(r"PushedFilters: \[.*GreaterThanOrEqual\(l_shipdate", plan)
    schema = re.search(r"ReadSchema: struct<([^>]*)>", plan).group(1)
    assert {part.split(":")[0] for part in schema.split(",")} == {
        "l_orderkey",
        "l_returnflag",
        "l_linestatus",
        "l_shipdate",
    }


def test_repeated_inputs_are_shuffled_once(spark):
    df = direct.previous_event(spark, SF)
    df.collect()
    assert "ReusedExchange" in plan_of(df)
