"""Operational tables derived from the driver's TPC-H-like parquet tables.

The operational schema has no public data, so every table is computed by Spark
from the given files with fixed integer expressions (order key ``k``, nation
key ``nk``).  Marts run on it exactly as on real tables.  The expressions are
listed in FIXTURES.md section D; tables missing there are derived in the same
style here.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession

from parcelmart.functions.clock import AsOf
from parcelmart.functions.vocabulary import (
    BOX_SIZES,
    CANCELLATION_CATEGORIES,
    MISS_CATEGORIES,
)
from parcelmart.sources.tables import Tables

STANDIN_NOW = datetime(1998, 8, 23, 12)
STANDIN_AS_OF = AsOf(STANDIN_NOW)

NOW = "TIMESTAMP_NTZ '1998-08-23 12:00:00'"
TODAY = "DATE '1998-08-23'"
NO_TIME = "CAST(NULL AS TIMESTAMP_NTZ)"
DAY = "date_add(CAST(created AS DATE), CAST(1 + k % 7 AS INT))"
ROUTE = "CAST(datediff(d, DATE '1990-01-01') AS BIGINT) * 100 + nk % 7 * 2 + k % 2"
MERCHANT_ROUTE = "CAST(datediff(d, DATE '1990-01-01') AS BIGINT) * 100 + 50 + nk % 7"
MERCHANT_STOP = 4_000_000_000_000
PARCEL = "CAST(l_orderkey * 1000000 + l_partkey AS BIGINT)"

DOOR = "k % 2 = 0 AND k % 8 <> 0"
BOX = "k % 2 = 1 AND k % 9 <> 0"
PLANNED = f"(({DOOR}) OR ({BOX}))"
ON_STOP = "k % 10 <> 2"
ON_MERCHANT_STOP = "k % 20 = 2"

COUNTRIES = ("SE", "NL", "FI", "DK", "BE")
ZONES = (
    "Europe/Stockholm",
    "Europe/Amsterdam",
    "Europe/Helsinki",
    "Europe/Copenhagen",
    "Europe/Brussels",
    "UTC",
)
WEEKDAYS = ("MONDAY", "TUESDAY", "WEDNESDAY", "THURSDAY", "FRIDAY", "SATURDAY", "SUNDAY")


def created(key: str) -> str:
    """Creation time of an order: a fixed number of hours before now."""
    hours = f"IF({key} % 3 = 0, {key} * 7919 % 9587, {key} * 7919 % 967)"
    return f"timestampadd(HOUR, -CAST({hours} AS INT), {NOW})"


def pick(values, index: str) -> str:
    """SQL expression choosing a value by zero-based index."""
    listed = ", ".join(f"'{value}'" for value in values)
    return f"array({listed})[CAST({index} AS INT)]"


class StandInTables(Tables):
    """Operational and consumer tables over a folder of driver parquet files."""

    def __init__(self, spark: SparkSession, sf_dir: str) -> None:
        super().__init__(spark)
        self.sf_dir = sf_dir.rstrip("/")

    def load(self, name: str, wanted: frozenset[str]) -> DataFrame:
        return getattr(self, f"_{name}")(wanted)

    def raw(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")

    # Building blocks -----------------------------------------------------

    def _base(self, where: str = "true") -> DataFrame:
        """One row per order: k, buyer, nk, priority, created, d."""
        return (
            self.raw("orders")
            .selectExpr(
                "o_orderkey AS k",
                "o_custkey AS buyer",
                "o_custkey % 25 AS nk",
                "o_orderpriority AS priority",
            )
            .where(where)
            .selectExpr("*", f"{created('k')} AS created")
            .selectExpr("*", f"{DAY} AS d")
        )

    def _items(self, where: str = "true") -> DataFrame:
        """Distinct (l_orderkey, l_partkey): one row per parcel."""
        return (
            self.raw("lineitem").select("l_orderkey", "l_partkey").where(where).distinct()
        )

    def _first_parcel(self, where: str) -> DataFrame:
        return (
            self.raw("lineitem")
            .selectExpr("l_orderkey AS k", "l_partkey")
            .where(where)
            .groupBy("k")
            .agg({"l_partkey": "min"})
            .selectExpr("k", "k * 1000000 + `min(l_partkey)` AS parcel_id")
        )

    def _order_events(self) -> DataFrame:
        """Events spread over orders, with a time a few days after creation."""
        created_day = f"CAST({created('k')} AS DATE)"
        return (
            self.raw("events")
            .selectExpr(
                "event_id AS id",
                "event_id - event_id % 2 + (event_id div 2) % 2 AS k",
                "user_id",
                "ts",
            )
            .selectExpr(
                "*", f"date_add({created_day}, CAST(id * 31 % 9 AS INT)) AS target"
            )
            .selectExpr(
                "id",
                "k",
                "user_id",
                "ts + make_dt_interval(datediff(target, CAST(ts AS DATE))) AS date",
            )
        )

    def _nations(self) -> DataFrame:
        return self.raw("nation").selectExpr(
            "CAST(n_nationkey AS BIGINT) AS n",
            "n_name",
            f"{pick(COUNTRIES, 'n_regionkey')} AS country_code",
        )

    # Orders and parcels --------------------------------------------------

    def _orders(self, wanted: frozenset[str]) -> DataFrame:
        return self._base().selectExpr(
            "k AS id",
            "buyer AS buyer_id",
            "created AS created_at",
            "200 + 2 * nk + k % 2 AS delivery_postal_code_zone_id",
            "IF(k % 2 = 1, k % 25 + 1, NULL) AS locker_id",
            "IF(k % 37 = 0, k, NULL) AS cancellation_id",
            "concat('T', k) AS token",
            "IF(k % 7 = 0, 'cart--Route', 'cart--Basket') AS cart_id",
        )

    def _consignments(self, wanted: frozenset[str]) -> DataFrame:
        return self._base(DOOR).selectExpr(
            "k AS id",
            "k AS order_id",
            "d AS date",
            "timestampadd(HOUR, -12, CAST(d AS TIMESTAMP_NTZ)) AS deadline",
            "IF(priority LIKE '1%', 'RETURN', 'DELIVERY') AS type",
            "IF(k % 11 = 0, k, NULL) AS cancellation_id",
            "IF(k % 13 = 0, k, NULL) AS miss_id",
            "IF(k % 41 = 0, NULL, k) AS interval_id",
        )

    def _locker_consignments(self, wanted: frozenset[str]) -> DataFrame:
        return self._base(BOX).selectExpr(
            "k AS id",
            "k AS order_id",
            "IF(k % 41 = 0, NULL, k) AS estimated_interval_id",
            "IF(priority LIKE '1%', 'RETURN', 'DELIVERY') AS consignment_type",
            "IF(k % 11 = 0, k, NULL) AS cancellation_id",
            "IF(k % 13 = 0, k, NULL) AS miss_id",
            "IF(k % 4 = 1, k, NULL) AS parcel_box_assignment_id",
        )

    def _cancellations(self, wanted: frozenset[str]) -> DataFrame:
        category = pick(CANCELLATION_CATEGORIES, f"(k div 11) % {len(CANCELLATION_CATEGORIES)}")
        return self._base(f"k % 37 = 0 OR (k % 11 = 0 AND {PLANNED})").selectExpr(
            "k AS id",
            f"{category} AS cancellation_category",
            "timestampadd(HOUR, CAST(k % 48 - 24 AS INT), CAST(d AS TIMESTAMP_NTZ)) AS date",
        )

    def _misses(self, wanted: frozenset[str]) -> DataFrame:
        category = pick(MISS_CATEGORIES, f"(k div 13) % {len(MISS_CATEGORIES)}")
        return self._base(f"k % 13 = 0 AND {PLANNED}").selectExpr(
            "k AS id", f"{category} AS category"
        )

    def _intervals(self, wanted: frozenset[str]) -> DataFrame:
        return self._base(PLANNED).selectExpr(
            "k AS id", "2 * k AS start_timestamp_id", "2 * k + 1 AS stop_timestamp_id"
        )

    def _timestamps(self, wanted: frozenset[str]) -> DataFrame:
        return self._base(PLANNED).selectExpr(
            "stack(2,"
            " 2 * k, timestampadd(HOUR, CAST(8 + k % 8 AS INT), CAST(d AS TIMESTAMP_NTZ)),"
            " 2 * k + 1, timestampadd(HOUR, CAST(10 + k % 8 AS INT), CAST(d AS TIMESTAMP_NTZ)))"
            " AS (id, date)"
        )

    def _interval_bounds(self, wanted: frozenset[str]) -> DataFrame:
        return self._base(PLANNED).selectExpr(
            "k AS id",
            "timestampadd(HOUR, CAST(8 + k % 8 AS INT), CAST(d AS TIMESTAMP_NTZ)) AS start_ts",
            "timestampadd(HOUR, CAST(10 + k % 8 AS INT), CAST(d AS TIMESTAMP_NTZ)) AS stop_ts",
        )

    def _parcels(self, wanted: frozenset[str]) -> DataFrame:
        recalled = "l_partkey % 17 = 0"
        return self._items().selectExpr(
            f"{PARCEL} AS id",
            "l_orderkey AS order_id",
            "IF(l_orderkey % 5 = 0, 'RETURN', 'DELIVERY') AS type",
            "l_partkey % 10 <> 0 AS visible",
            f"IF({recalled}, TIMESTAMP_NTZ '1998-08-16 00:00:00', NULL) AS recall_requested_at",
            f"IF({recalled}, 'REQUESTED_BY_MERCHANT', NULL) AS recall_reason",
            f"{created('l_orderkey')} AS created_at",
            f"IF(l_partkey % 3 = 0, {PARCEL}, NULL) AS machine_dimensions_id",
        )

    def _parcel_consignments(self, wanted: frozenset[str]) -> DataFrame:
        return self._items("l_orderkey % 2 = 0 AND l_orderkey % 8 <> 0").selectExpr(
            f"{PARCEL} AS parcel_id", "l_orderkey AS consignment_id"
        )

    def _dimensions(self, wanted: frozenset[str]) -> DataFrame:
        return self._items("l_partkey % 3 = 0").selectExpr(
            f"{PARCEL} AS id", "IF(l_partkey % 6 = 0, 'HEAVY', NULL) AS sorting_deviation"
        )

    def _scanning_log(self, wanted: frozenset[str]) -> DataFrame:
        first = self._first_parcel("true")
        return self._order_events().join(first, "k").select("id", "parcel_id", "user_id", "date")

    def _parcel_status_updates(self, wanted: frozenset[str]) -> DataFrame:
        return self._order_events().selectExpr(
            "id",
            "k AS consignment_id",
            "array(2, 3, 8, 10, 3)[CAST(id % 5 AS INT)] AS parcel_status_id",
            "date",
            "user_id",
            "id % 6 = 0 AS with_neighbour",
        )

    def _parcel_box_assignments(self, wanted: frozenset[str]) -> DataFrame:
        # k % 4 = 1 are locker orders; the parcel comes from their items.
        base = self._base("k % 4 = 1").join(self._first_parcel("k % 4 = 1"), "k")
        return base.selectExpr(
            "k AS id",
            "parcel_id",
            "k % 200 AS box_id",
            "array('PRESENT', 'PICKED_UP', 'RESERVED')[CAST(k % 3 AS INT)] AS state",
            "IF(k % 3 = 1, timestampadd(HOUR, 24, CAST(d AS TIMESTAMP_NTZ)), NULL) AS picked_up",
            "timestampadd(HOUR, CAST(24 * (k % 5) AS INT), CAST(d AS TIMESTAMP_NTZ))"
            " AS reservation_expires_at",
        )

    def _ratings(self, wanted: frozenset[str]) -> DataFrame:
        return self._base(f"k % 3 = 0 AND {DOOR}").selectExpr(
            "k AS id",
            "k AS consignment_id",
            "CAST(1 + k % 5 AS INT) AS score",
            "array('DRIVER', 'TIME', 'PARCEL')[CAST(k % 3 + k % 2 AS INT)] AS rating_category",
        )

    def _slot_payments(self, wanted: frozenset[str]) -> DataFrame:
        return self._base(DOOR).selectExpr(
            "k AS consignment_id",
            "IF(k % 4 = 0, 'COMPLETED', 'PENDING') AS status",
            "IF(k % 12 = 0, 'TIMESLOT', 'HOME') AS purchase_type",
            """CASE k % 10
                 WHEN 2 THEN '{"timeWindow": {"timeslotSpec": null}}'
                 WHEN 4 THEN '{"timeWindow": {}}'
                 WHEN 6 THEN '{timeWindow'
                 ELSE concat('{"timeWindow": {"timeslotSpec": "S', k % 5, '"}}')
               END AS reference""",
        )

    def _on_demand_pickups(self, wanted: frozenset[str]) -> DataFrame:
        return self._base("k % 6 = 0").selectExpr(
            "k AS order_id", "CAST(1 + k % 9 AS INT) AS estimated_parcels"
        )

    # Routes, stops, pallets ----------------------------------------------

    def _routes(self, wanted: frozenset[str]) -> DataFrame:
        planned = self._base(PLANNED).selectExpr(
            f"{ROUTE} AS id", "d", "nk % 7 AS terminal", "IF(k % 2 = 0, 0, 1) AS kind"
        )
        merchant = self._base(f"{ON_MERCHANT_STOP} AND {DOOR}").selectExpr(
            f"{MERCHANT_ROUTE} AS id", "d", "nk % 7 AS terminal", "2 AS kind"
        )
        return (
            planned.unionByName(merchant)
            .distinct()
            .selectExpr(
                "id",
                "d AS due_date",
                "array('DISTRIBUTION', 'LOCKER', 'MERCHANT')[kind] AS type",
                "concat('TERM', terminal) AS terminal",
                "IF(terminal = 6, 'OTHER', concat('City ', terminal)) AS city",
                "concat('Cage ', id) AS title",
                "IF(id % 3 = 0, 'TRUCK', 'VAN') AS vehicle_type",
                "id % 5 AS owner_operator_id",
                "IF(terminal = 5, NULL, id) AS routeopt_route_id",
            )
        )

    def _consumer_stops(self, wanted: frozenset[str]) -> DataFrame:
        tail = [
            "CAST(k * 31 % 1009 AS INT) AS sequence",
            "1000000000 + k % 200 AS address_id",
            "IF(k % 43 = 0, NULL, k) AS estimated_interval_id",
        ]
        planned = self._base(PLANNED).selectExpr("k AS id", f"{ROUTE} AS route_id", *tail)
        merchant = self._base(f"{ON_MERCHANT_STOP} AND {DOOR}").selectExpr(
            f"{MERCHANT_STOP} + k AS id", f"{MERCHANT_ROUTE} AS route_id", *tail
        )
        return planned.unionByName(merchant)

    def _consumer_stop_consignments(self, wanted: frozenset[str]) -> DataFrame:
        planned = self._base(f"{ON_STOP} AND {DOOR}").selectExpr(
            "k AS id", "k AS consumer_stop_id", "k AS consignment_id", "'DELIVERY' AS type"
        )
        merchant = self._base(f"{ON_MERCHANT_STOP} AND {DOOR}").selectExpr(
            f"{MERCHANT_STOP} + k AS id",
            f"{MERCHANT_STOP} + k AS consumer_stop_id",
            "k AS consignment_id",
            "IF(k % 3 = 0, 'LOADING_OF_PARCELS', 'UNLOADING_OF_PARCELS') AS type",
        )
        return planned.unionByName(merchant)

    def _terminal_stops(self, wanted: frozenset[str]) -> DataFrame:
        """Two per route: loading (earliest interval) and return (latest)."""
        planned = self._base(PLANNED).selectExpr(f"{ROUTE} AS route_id", "nk", "k")
        merchant = self._base(f"{ON_MERCHANT_STOP} AND {DOOR}").selectExpr(
            f"{MERCHANT_ROUTE} AS route_id", "nk", "k"
        )
        ends = (
            planned.unionByName(merchant)
            .groupBy("route_id")
            .agg({"nk": "min", "k": "min"})
            .withColumnsRenamed({"min(nk)": "nk", "min(k)": "k"})
        )
        return ends.selectExpr(
            "route_id",
            "nk % 7 AS address_id",
            "k AS estimated_interval_id",
            "explode(array(1, 2)) AS sequence",
        ).selectExpr("route_id * 10 + sequence AS id", "*")

    def _terminal_stop_consignments(self, wanted: frozenset[str]) -> DataFrame:
        return self._base(f"{ON_STOP} AND {DOOR}").selectExpr(
            f"({ROUTE}) * 10 + 1 AS terminal_stop_id", "k AS consignment_id"
        )

    def _locker_stops(self, wanted: frozenset[str]) -> DataFrame:
        return self._base(BOX).selectExpr("k AS stop_id", "k % 25 + 1 AS locker_id")

    def _locker_pallets(self, wanted: frozenset[str]) -> DataFrame:
        return (
            self._base(f"{BOX} AND k % 5 <> 0")
            .selectExpr(f"{ROUTE} AS route_id", "k % 25 + 1 AS locker_id")
            .distinct()
            .selectExpr("route_id * 100 + locker_id AS id", "route_id", "locker_id")
        )

    def _locker_pallet_parcels(self, wanted: frozenset[str]) -> DataFrame:
        orders = self._base(f"{BOX} AND k % 5 <> 0").selectExpr(
            "k AS l_orderkey", f"({ROUTE}) * 100 + k % 25 + 1 AS locker_pallet_id"
        )
        return (
            self._items("l_orderkey % 2 = 1 AND l_orderkey % 9 <> 0 AND l_orderkey % 5 <> 0")
            .join(orders, "l_orderkey")
            .selectExpr(f"{PARCEL} AS id", "locker_pallet_id", f"{PARCEL} AS parcel_id")
        )

    def _pallets(self, wanted: frozenset[str]) -> DataFrame:
        return self.raw("customer").where("c_custkey % 3 = 0").selectExpr(
            "c_custkey AS id",
            "concat('PAL-', c_custkey % 50) AS identifier",
            f"timestampadd(HOUR, -CAST(24 * (c_custkey % 10) AS INT), {NOW}) AS created_at",
        )

    def _pallet_parcels(self, wanted: frozenset[str]) -> DataFrame:
        orders = self._base("k % 5 = 0").selectExpr("k AS l_orderkey", "buyer AS pallet_id")
        return (
            self._items("l_orderkey % 5 = 0")
            .join(orders, "l_orderkey")
            .selectExpr("pallet_id", f"{PARCEL} AS parcel_id")
        )

    def _return_pallet_details(self, wanted: frozenset[str]) -> DataFrame:
        return self.raw("customer").where("c_custkey % 3 = 0").selectExpr(
            "c_custkey AS merchant_id",
            "IF(c_custkey % 4 = 0, c_custkey, NULL) AS route_id",
            "c_custkey AS pallet_id",
        )

    def _user_routes(self, wanted: frozenset[str]) -> DataFrame:
        """Drivers of a route: users who reported on its orders."""
        seen = self.raw("events").where("event_id % 4 <> 3").selectExpr(
            "event_id - event_id % 2 + (event_id div 2) % 2 AS k", "user_id"
        )
        return (
            self._base(PLANNED)
            .join(seen, "k")
            .selectExpr(
                f"explode(array({ROUTE}, IF({ON_MERCHANT_STOP}, {MERCHANT_ROUTE}, {ROUTE})))"
                " AS route_id",
                "user_id",
            )
            .distinct()
        )

    def _route_ids(self) -> DataFrame:
        return self._routes(frozenset()).select("id", "type", "terminal")

    def _route_history(self, wanted: frozenset[str]) -> DataFrame:
        return self._route_ids().where("id % 9 = 0").selectExpr("id", "id AS route_child_id")

    def _route_vehicle_images(self, wanted: frozenset[str]) -> DataFrame:
        return self._route_ids().where("type = 'DISTRIBUTION'").selectExpr(
            "id AS route_id",
            """CASE id % 4
                 WHEN 0 THEN concat('ABO', id % 10)
                 WHEN 1 THEN concat(' ab-0 ', id % 10, ' ')
                 WHEN 2 THEN concat('XYZ ', id % 10)
               END AS license_plate""",
            "id AS image_id",
        )

    def _images(self, wanted: frozenset[str]) -> DataFrame:
        return self._route_ids().where("id % 3 <> 0").selectExpr(
            "id", "concat('https://images.example/', id, '.jpg') AS url"
        )

    def _service_rows(self) -> DataFrame:
        start = "timestampadd(HOUR, CAST(8 + k % 8 AS INT), CAST(d AS TIMESTAMP_NTZ))"
        return self._base(PLANNED).selectExpr(
            f"{ROUTE} AS route_id",
            "k AS consumer_stop_id",
            "CAST(NULL AS BIGINT) AS terminal_stop_id",
            f"timestampadd(MINUTE, CAST(k * 17 % 91 - 45 AS INT), {start}) AS arrival_time",
            f"timestampadd(MINUTE, CAST(k * 17 % 91 - 40 AS INT), {start}) AS departure_time",
        )

    def _routeopt_service_time_data(self, wanted: frozenset[str]) -> DataFrame:
        if "terminal_stop_id" not in wanted and "route_id" not in wanted:
            # Terminal rows have no consumer stop and cannot match one.
            return self._service_rows()
        day = "CAST(date_add(DATE '1990-01-01', CAST(route_id div 100 AS INT)) AS TIMESTAMP_NTZ)"
        terminal = self._terminal_stops(frozenset()).selectExpr(
            "route_id",
            "CAST(NULL AS BIGINT) AS consumer_stop_id",
            "id AS terminal_stop_id",
            f"timestampadd(MINUTE, 360 + 600 * (sequence - 1), {day}) AS arrival_time",
            f"timestampadd(MINUTE, 390 + 600 * (sequence - 1), {day}) AS departure_time",
        )
        return self._service_rows().unionByName(terminal)

    def _routeopt_drive_time_data(self, wanted: frozenset[str]) -> DataFrame:
        """Legs: terminal to stop, stop to terminal, stop to stop by k % 3."""
        return self._base(f"{ON_STOP} AND {DOOR}").selectExpr(
            f"{ROUTE} AS route_id",
            "IF(k % 3 = 0, NULL, k) AS from_consumer_stop_id",
            "CASE k % 3 WHEN 0 THEN k WHEN 1 THEN NULL ELSE k + 2 END AS to_consumer_stop_id",
            f"CASE WHEN k % 3 < 2 THEN ({ROUTE}) * 10 + 1 + k % 3 END AS terminal_stop_id",
            "CAST(60 + k % 900 AS DOUBLE) AS estimated_drive_time",
            "CAST(100 + k % 7000 AS DOUBLE) AS distance",
        )

    def _routeopt_routes(self, wanted: frozenset[str]) -> DataFrame:
        return self._route_ids().selectExpr(
            "id", "id % 7 AS optimization_id", "id AS routeopt_vehicle_and_user_id"
        )

    def _routeopt_optimizations(self, wanted: frozenset[str]) -> DataFrame:
        return self._nations().selectExpr(
            "n AS id", f"{pick(ZONES, 'n % 6')} AS timezone", "n AS optimization_settings_id"
        ).selectExpr("id", "IF(id = 6, NULL, timezone) AS timezone", "optimization_settings_id")

    def _routeopt_settings(self, wanted: frozenset[str]) -> DataFrame:
        return self._nations().selectExpr(
            "n AS id", "n % 5 AS routeopt_graph_settings_id"
        )

    def _routeopt_graph_settings(self, wanted: frozenset[str]) -> DataFrame:
        return self._nations().selectExpr(
            "n AS id",
            "CAST(n AS DOUBLE) / 2 AS drive_time_factor",
            "CAST(n + 1 AS DOUBLE) / 4 AS initial_drive_time_factor",
        )

    def _routeopt_vehicles_and_users(self, wanted: frozenset[str]) -> DataFrame:
        return self._route_ids().selectExpr(
            "id", "id % 10 AS vehicle_id", "id % 25 AS routeopt_vehicle_and_user_settings_id"
        )

    def _routeopt_vehicles_and_users_settings(self, wanted: frozenset[str]) -> DataFrame:
        return self._nations().selectExpr("n AS id", "n % 4 AS user_optimization_settings_id")

    def _user_optimization_settings(self, wanted: frozenset[str]) -> DataFrame:
        return self._nations().selectExpr(
            "n AS id",
            "IF(n = 3, 'TRAINEE', concat('LEVEL_', n)) AS user_type",
            "CAST(n + 2 AS DOUBLE) / 2 AS drive_time_factor",
        )

    def _vehicles(self, wanted: frozenset[str]) -> DataFrame:
        return self.raw("supplier").selectExpr(
            "s_suppkey AS id",
            "IF(s_suppkey % 10 = 9, 'own fleet 9', concat(' ab-0', s_suppkey, ' '))"
            " AS license_plate",
        )

    # Grouping of routes ---------------------------------------------------

    def _group_days(self) -> DataFrame:
        return self._nations().selectExpr("*", "explode(sequence(0, 6)) AS w")

    def _routeopt_groups(self, wanted: frozenset[str]) -> DataFrame:
        return self._group_days().selectExpr(
            "n * 7 + w AS id",
            "concat('Group ', n, ' ', w) AS title",
            "IF(n = 24, 'OTHER', n_name) AS city",
            "concat('TERM', n % 7) AS terminal_code",
            "n * 7 + w AS routeopt_group_settings_id",
            f"IF(n % 6 = 5, {NOW}, NULL) AS deleted_at",
        )

    def _routeopt_group_settings(self, wanted: frozenset[str]) -> DataFrame:
        return self._group_days().selectExpr(
            "n * 7 + w AS id", f"{pick(WEEKDAYS, 'w')} AS delivery_day"
        )

    def _routeopt_group_settings_consignment_types(self, wanted: frozenset[str]) -> DataFrame:
        return self._group_days().selectExpr(
            "n * 7 + w AS routeopt_group_settings_id",
            "explode(IF(w % 2 = 0, array('DELIVERY', 'RETURN'), array('DELIVERY')))"
            " AS consignment_type",
        )

    def _collection_points(self, wanted: frozenset[str]) -> DataFrame:
        return self._nations().selectExpr("n", "explode(array(0, 1)) AS x").selectExpr(
            "2 * n + x AS id", f"IF((2 * n + x) % 9 = 8, {NOW}, NULL) AS deleted_at"
        )

    def _collection_point_intervals(self, wanted: frozenset[str]) -> DataFrame:
        return self._group_days().selectExpr("*", "explode(array(0, 1)) AS x").selectExpr(
            "(n * 7 + w) * 2 + x AS id",
            "2 * n + x AS collection_point_id",
            "n * 7 + w AS routeopt_group_id",
            f"{pick(WEEKDAYS, 'w')} AS delivery_day",
            "CAST((8 + (n + x) % 8) * 3600 AS INT) AS collection_start",
            "CAST(600 * (n % 12) AS INT) AS routing_cutoff_seconds",
            f"IF(n % 11 = 10, {NOW}, NULL) AS deleted_at",
        )

    def _buyer_collection_points(self, wanted: frozenset[str]) -> DataFrame:
        return self.raw("customer").selectExpr(
            "c_custkey AS buyer_id", "c_custkey % 50 AS collection_point_id"
        )

    def _collection_point_schedules(self, wanted: frozenset[str]) -> DataFrame:
        return self._group_days().selectExpr(
            "n * 7 + w AS id",
            "2 * n AS pickup_collection_point_id",
            f"{pick(WEEKDAYS, 'w')} AS pickup_day",
            "CAST((14 + (n + w) % 6) * 3600 + 1800 * (w % 2) AS INT) AS pickup_time_end",
        )

    def _recurring_pickup_schedule(self, wanted: frozenset[str]) -> DataFrame:
        return self.raw("supplier").selectExpr(
            "s_suppkey AS id",
            "concat('Round ', s_suppkey) AS name",
            "s_suppkey % 7 AS start_terminal_id",
            f"IF(s_suppkey % 4 = 3, {NOW}, NULL) AS deleted_at",
        )

    def _recurring_pickup_schedule_merchant_schedules(self, wanted: frozenset[str]) -> DataFrame:
        return (
            self._group_days()
            .where("(n + w) % 5 <> 4")
            .selectExpr("n * 7 + w AS s", "explode(array(1, 2)) AS x")
            .selectExpr(
                "s * 10 + x AS id",
                "s AS collection_point_schedule_id",
                "(s div 7 + x) % 10 AS recurring_pickup_route_id",
            )
        )

    # Master data ----------------------------------------------------------

    def _postal_code_zones(self, wanted: frozenset[str]) -> DataFrame:
        return self._nations().selectExpr("*", "explode(array(0, 1)) AS x").selectExpr(
            "200 + 2 * n + x AS id",
            "IF(n = 24, 'OTHER', n_name) AS title",
            "IF(n = 24, 'OTHER', n_name) AS city",
            "country_code",
            "IF(x = 0, 'TO_DOOR', 'TO_LOCKER') AS type",
            "IF(n = 17, NULL, n % 7) AS terminal_id",
            f"IF(n % 12 = 11, {NOW}, NULL) AS deleted_at",
        )

    def _terminals(self) -> DataFrame:
        """All suppliers are terminals."""
        return (
            self.raw("supplier")
            .selectExpr("s_suppkey AS id", "CAST(s_nationkey AS BIGINT) AS n", "s_acctbal")
            .join(self._nations(), "n")
        )

    def _warehouses(self, wanted: frozenset[str]) -> DataFrame:
        return self._terminals().selectExpr(
            "id",
            "concat('Terminal ', id) AS name",
            "concat('TERM', id) AS code",
            "IF(id = 6, 'OTHER', concat('City ', id)) AS city",
            "IF(id = 4, NULL, id) AS address_id",
            f"timestampadd(HOUR, -CAST(2400 + 24 * id AS INT), {NOW}) AS created_at",
            f"IF(id = 5, {NOW}, NULL) AS deleted_at",
            "IF(id % 2 = 0, 'LEFT', 'RIGHT') AS sorting_machine_assign_direction",
            "id % 3 = 0 AS sorting_machine_books_delivery",
            "CAST(10 + id AS INT) AS sorting_machine_maximum_routes_per_lane",
            "CAST(1 + id % 3 AS INT) AS sorting_machine_minimum_routes_per_lane",
        )

    def _addresses(self, wanted: frozenset[str]) -> DataFrame:
        terminal = self._terminals().selectExpr(
            "id",
            "concat('Street ', id) AS street",
            "concat('P', id) AS postal_code",
            "concat('City ', id) AS city",
            "country_code",
            "named_struct('x', s_acctbal / 100, 'y', s_acctbal / 200) AS coordinate",
        )
        homes = self.raw("embeddings").selectExpr(
            "1000000000 + vec_id AS id",
            "concat('Street ', vec_id) AS street",
            "concat('P', vec_id % 90) AS postal_code",
            "concat('Town ', vec_id % 30) AS city",
            f"{pick(COUNTRIES, 'vec_id % 5')} AS country_code",
            "named_struct('x', CAST(embedding[0] AS DOUBLE),"
            " 'y', CAST(embedding[1] AS DOUBLE)) AS coordinate",
        )
        return terminal.unionByName(homes)

    def _buyers(self, wanted: frozenset[str]) -> DataFrame:
        return self.raw("customer").selectExpr(
            "c_custkey AS id",
            "c_name AS name",
            "IF(c_custkey % 50 = 0, concat('Box Merchant ', c_custkey), c_name) AS external_name",
            "c_custkey AS buyer_settings_id",
            f"IF(c_custkey % 41 = 0, {NOW}, NULL) AS deleted_at",
        )

    def _buyer_settings(self, wanted: frozenset[str]) -> DataFrame:
        return self.raw("customer").selectExpr(
            "c_custkey AS id", "c_custkey % 20 = 0 AS on_demand_pickup"
        )

    def _buyer_tags(self, wanted: frozenset[str]) -> DataFrame:
        return (
            self.raw("customer")
            .selectExpr(
                "c_custkey AS buyer_id",
                "explode(filter(array(IF(c_mktsegment = 'BUILDING', 2, NULL),"
                " IF(c_custkey % 7 = 0, 3, NULL)), x -> x IS NOT NULL)) AS tag_id",
            )
            .selectExpr("buyer_id", "CAST(tag_id AS BIGINT) AS tag_id")
        )

    def _tags(self, wanted: frozenset[str]) -> DataFrame:
        return self.raw("region").selectExpr(
            "CAST(r_regionkey AS BIGINT) AS id",
            "CAST(r_regionkey % 2 AS BIGINT) AS tag_type_id",
            "r_name AS name",
        )

    def _lockers(self, wanted: frozenset[str]) -> DataFrame:
        return self._nations().selectExpr("n + 1 AS id", "*").selectExpr(
            "id",
            "concat('L', id) AS identifier",
            "concat('Locker ', id) AS name",
            "concat('Town ', n) AS city",
            "country_code AS country",
            "concat('Street ', n) AS street",
            "id % 6 <> 0 AS enabled",
            "named_struct('x', CAST(id AS DOUBLE) / 4, 'y', CAST(id AS DOUBLE) / 8) AS coordinate",
            f"date_sub({TODAY}, CAST(30 * id AS INT)) AS installation_date",
            "2 * (id % 25) AS collection_point_id",
            "200 + 2 * (id % 25) + 1 AS postal_code_zone_id",
            "id % 7 AS location_partner_id",
            f"IF(id = 13, {NOW}, NULL) AS deleted_at",
        )

    def _locker_boxes(self, wanted: frozenset[str]) -> DataFrame:
        return self.raw("part").selectExpr(
            "p_partkey AS id",
            "CAST(split(p_brand, '#')[1] AS BIGINT) AS locker_id",
            "CAST(p_size % 5 AS INT) AS board_id",
            "CAST(p_partkey % 10 AS INT) AS slot_id",
            f"{pick(BOX_SIZES, 'p_size % 4')} AS size",
            "IF(p_type = 'PROMO', concat('E', p_size), NULL) AS error_code",
        )

    def _locker_location_partners(self, wanted: frozenset[str]) -> DataFrame:
        return self.raw("region").selectExpr("CAST(r_regionkey AS BIGINT) AS id", "r_name AS name")

    def _users(self, wanted: frozenset[str]) -> DataFrame:
        return self.raw("events").select("user_id").distinct().selectExpr(
            "user_id AS id",
            "concat('First', user_id) AS first_name",
            "concat('Last', user_id) AS last_name",
            "concat('+46', 1000 + user_id) AS phone_number",
            "user_id AS user_settings_id",
        )

    def _user_settings(self, wanted: frozenset[str]) -> DataFrame:
        return self.raw("events").select("user_id").distinct().selectExpr(
            "user_id AS id", "user_id % 7 AS warehouse_id"
        )

    def _owner_operators(self, wanted: frozenset[str]) -> DataFrame:
        return self.raw("region").selectExpr(
            "CAST(r_regionkey AS BIGINT) AS id", "concat('Courier ', r_name) AS name"
        )

    def _owner_operator_users(self, wanted: frozenset[str]) -> DataFrame:
        return self.raw("events").select("user_id").distinct().where("user_id % 8 <> 7").selectExpr(
            "user_id", "user_id % 5 AS owner_operator_id"
        )

    def _chrono_consignment_limits(self, wanted: frozenset[str]) -> DataFrame:
        return self._terminals().selectExpr("id AS t", "explode(sequence(0, 9)) AS i").selectExpr(
            "t * 100 + i AS id",
            "concat('TERM', t) AS terminal",
            "date_add(DATE '1998-08-20', i) AS date",
            "100 + 10 * i AS maximum_number_of_consignments",
            "i % 2 = 1 AS block_direct_checkout_merchants",
        )

    def _sms_notifications(self, wanted: frozenset[str]) -> DataFrame:
        return self.raw("events").selectExpr(
            "event_id AS id",
            "concat(array('projects/', 'Projects/', 'sms/')[CAST(event_id % 3 AS INT)], event_id)"
            " AS message_id",
            "ts - make_dt_interval(9291) AS sent",
            "IF(value > 1, ts - make_dt_interval(9291, -1), NULL) AS delivered",
        )

    # Consumer database ------------------------------------------------------

    def _consumer(self, wanted: frozenset[str]) -> DataFrame:
        day = f"date_sub({TODAY}, CAST(c_custkey * 37 % 700 AS INT))"
        return self.raw("customer").selectExpr(
            "c_custkey AS id",
            "c_custkey + 500000 AS consumer_id",
            "IF(c_custkey % 3 <> 0, concat('push-', c_custkey), NULL) AS push_notification_token",
            f"IF(c_custkey % 29 = 0, NULL, CAST({day} AS TIMESTAMP_NTZ)) AS created_at",
        )

    def _consumer_order(self, wanted: frozenset[str]) -> DataFrame:
        return self.raw("orders").selectExpr("o_custkey AS consumer_id", "o_orderkey AS order_id")

    def _timeslot_subscription(self, wanted: frozenset[str]) -> DataFrame:
        cancelled = "ts - make_dt_interval(CAST(9291 + event_id % 500 - event_id % 200 AS INT))"
        return self.raw("events").where("event_type = 'signup'").selectExpr(
            "event_id AS id",
            "IF(event_id % 31 = 0, NULL, user_id) AS consumer_id",
            "event_id % 3 <> 0 AS active",
            f"timestampadd(HOUR, CAST(24 * (event_id % 90 - 30) AS INT), {NOW}) AS valid_to",
            f"IF(event_id % 4 = 0, {cancelled}, NULL) AS cancelled_at",
            "ts - make_dt_interval(CAST(9291 + event_id % 500 AS INT)) AS created_at",
        )
