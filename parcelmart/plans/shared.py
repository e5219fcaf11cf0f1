"""Relations several marts start from.

Foreign keys are trusted: a key that is not NULL has a match. A table that a query
would join only to follow a key (and takes no column from) is left out, and the
key must not be NULL, as the join would have dropped the row.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parcelmart.functions import vocabulary as v
from parcelmart.functions.clock import AsOf, ts_lit
from parcelmart.functions.predicates import json_path_set
from parcelmart.operators.joins import distinct_keys
from parcelmart.sources.tables import Tables

c = F.col


def zones(t: Tables) -> DataFrame:
    return t(
        "postal_code_zones",
        "id as zone_id",
        "title as zone_title",
        "city as zone_city",
        "country_code as country",
        "type as zone_type",
        "terminal_id",
    )


def terminals(t: Tables, with_country: bool = False, addressed: bool = False) -> DataFrame:
    """Terminals; the country costs a pass over the (large) address table.

    ``addressed`` keeps those with an address without reading it.
    """
    found = t(
        "warehouses",
        "id as terminal_id",
        "code as terminal_code",
        "name as terminal_name",
        "address_id",
    )
    if with_country:
        address = t("addresses", "id as address_id", "country_code as terminal_country")
        found = found.join(address, "address_id")
    elif addressed:
        found = found.where(c("address_id").isNotNull())
    return found.drop("address_id")


def zone_terminals(
    t: Tables,
    zone_type: str | None = None,
    with_country: bool = False,
    addressed: bool = False,
) -> DataFrame:
    """Zones with the terminal that serves them: a small dimension."""
    places = zones(t)
    if zone_type:
        places = places.where(c("zone_type") == zone_type)
    return places.join(terminals(t, with_country, addressed), "terminal_id")


def routes_due(t: Tables, due, route_type: str, *columns: str) -> DataFrame:
    """Routes of one type whose due date satisfies ``due(column)``."""
    wanted = dict.fromkeys(["id as route_id", "due_date", "type as route_type", *columns])
    return (
        t("routes", *wanted)
        .where(due(c("due_date")) & (c("route_type") == route_type))
        .drop("route_type")
    )


def door_attempts(t: Tables, routes: DataFrame) -> DataFrame:
    """Home attempts on the given routes with their zone; one row per stop."""
    stops = t("consumer_stops", "id as stop_id", "route_id")
    on_stop = t("consumer_stop_consignments", "consumer_stop_id as stop_id", "consignment_id")
    attempts = t(
        "consignments",
        "id as consignment_id",
        "order_id",
        "date",
        "type",
        "cancellation_id",
        "miss_id",
    )
    orders = t("orders", "id as order_id", "delivery_postal_code_zone_id as zone_id")
    return (
        routes.join(stops, "route_id")
        .join(on_stop, "stop_id")
        .drop("stop_id")
        .join(attempts, "consignment_id")
        .join(orders, "order_id")
    )


def box_attempts(t: Tables, routes: DataFrame) -> DataFrame:
    """Locker attempts on the given routes.

    A route stops at a locker and carries pallets for it; every parcel of a
    pallet counts once per stop of the route at that locker.  Stops are
    counted per (route, locker) first and carried as the weight ``attempts``,
    so stops and parcels are never paired row by row.
    """
    stops = (
        routes.join(t("consumer_stops", "id as stop_id", "route_id"), "route_id")
        .join(t("locker_stops", "stop_id", "locker_id"), "stop_id")
        .groupBy(*routes.columns, "locker_id")
        .agg(F.count("*").alias("stops"))
    )
    pallets = t("locker_pallets", "id as locker_pallet_id", "route_id", "locker_id")
    on_pallet = t("locker_pallet_parcels", "locker_pallet_id", "parcel_id")
    parcels = t("parcels", "id as parcel_id", "order_id")
    carried = (
        pallets.join(stops, ["route_id", "locker_id"])
        .join(on_pallet, "locker_pallet_id")
        .join(parcels, "parcel_id")
        .groupBy(*routes.columns, "order_id")
        .agg(F.sum("stops").alias("attempts"))
    )
    attempts = t(
        "locker_consignments",
        "id as consignment_id",
        "order_id",
        "estimated_interval_id",
        "consignment_type as type",
        "cancellation_id",
        "miss_id",
    )
    orders = t("orders", "id as order_id", "delivery_postal_code_zone_id as zone_id")
    return carried.join(orders, "order_id").join(attempts, "order_id")


def starts(t: Tables, key: str) -> DataFrame:
    """Interval start by interval id, keyed by the given column name."""
    return t("interval_bounds", f"id as {key}", "start_ts")


def starting_on(t: Tables, key: str, day: date, after: date) -> DataFrame:
    """Ids of intervals that start on a day (a range test, so it is pushed down)."""
    return (
        starts(t, key)
        .where((c("start_ts") >= ts_lit(day)) & (c("start_ts") < ts_lit(after)))
        .drop("start_ts")
    )


def attempts_on_day(t: Tables, as_of: AsOf, *extra: str) -> DataFrame:
    """Home consignments due today."""
    columns = dict.fromkeys(
        ["id as consignment_id", "order_id", "date", "deadline", "type", "cancellation_id", *extra]
    )
    return t("consignments", *columns).where(c("date") == F.lit(as_of.today))


def cancellations(t: Tables) -> DataFrame:
    return t(
        "cancellations",
        "id as cancellation_id",
        "cancellation_category",
        "date as cancelled_at",
    )


def paid_timeslots(t: Tables) -> DataFrame:
    """Consignments with a completed payment for a time slot."""
    chosen = (c("purchase_type") == "TIMESLOT") | json_path_set(
        c("reference"), v.TIMESLOT_JSON_PATH
    )
    payments = t("slot_payments", "consignment_id", "status", "purchase_type", "reference")
    return distinct_keys(
        payments.where((c("status") == "COMPLETED") & chosen), ["consignment_id"]
    )


def tagged_buyers(t: Tables) -> DataFrame:
    """Buyers carrying the e-commerce tag, one row per tag entry."""
    return (
        t("buyer_tags", "buyer_id", "tag_id")
        .where(c("tag_id") == v.E_COMMERCE_TAG)
        .drop("tag_id")
    )


def live_buyers(t: Tables) -> DataFrame:
    return (
        t("buyers", "id as buyer_id", "external_name", "deleted_at")
        .where(c("deleted_at").isNull())
        .drop("deleted_at")
    )


def buyer_names(t: Tables) -> DataFrame:
    return t("buyers", "id as buyer_id", "external_name")
