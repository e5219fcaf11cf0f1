"""Booked and newly created orders."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parcelmart.functions import vocabulary as v
from parcelmart.functions.clock import AsOf, ts_lit
from parcelmart.functions.predicates import billable, like_any_case, on_or_between
from parcelmart.functions.timeparts import clock_of_seconds, day_name, to_zone
from parcelmart.operators.joins import flag, join_optional, keep
from parcelmart.plans.shared import (
    buyer_names,
    cancellations,
    tagged_buyers,
    zone_terminals,
    zones,
)
from parcelmart.sources.tables import Tables

c = F.col


def _next_days(t: Tables, as_of: AsOf, *extra: str) -> DataFrame:
    """Home attempts from today to five days ahead."""
    return t("consignments", "id as consignment_id", "order_id", "date", "type", *extra).where(
        on_or_between(c("date"), as_of.today, as_of.day(5)) & c("type").isin(*v.ATTEMPT_TYPES)
    )


def _order_zones(t: Tables, *extra: str) -> DataFrame:
    return t("orders", "id as order_id", "delivery_postal_code_zone_id as zone_id", *extra)


def orders_booked_by_terminal_day(t: Tables, as_of: AsOf) -> DataFrame:
    on_stop = t("consumer_stop_consignments", "consignment_id")
    # Uncancelled attempts of a zone and day are one row, cancelled ones a row per cancellation,
    # before the terminals' addresses join.
    per_zone = (
        flag(_next_days(t, as_of, "cancellation_id").join(_order_zones(t), "order_id"), on_stop, ["consignment_id"], "on_stop")
        .groupBy("zone_id", day_name(c("date")).alias("day_of_week"), "cancellation_id")
        .agg(F.count("*").alias("attempts"), F.bool_or("on_stop").alias("on_stop"))
    )
    return (
        per_zone.join(zone_terminals(t, v.TO_DOOR, with_country=True), "zone_id")
        .groupBy("terminal_code", "terminal_country", "day_of_week", "zone_title")
        .agg(
            (F.sum("attempts") - F.count_distinct("cancellation_id")).alias("order_count"),
            F.count_distinct("cancellation_id").alias("cancelled_count"),
            F.bool_or("on_stop").alias("routes_saved"),
        )
    )


def limits_from_today(t: Tables, as_of: AsOf) -> DataFrame:
    return t(
        "chrono_consignment_limits",
        "terminal",
        "id",
        "date",
        "maximum_number_of_consignments",
        "block_direct_checkout_merchants",
    ).where(c("date") >= F.lit(as_of.today))


def routes_saved_today(t: Tables, as_of: AsOf) -> DataFrame:
    today = (
        t("consignments", "id as consignment_id", "date", "cancellation_id")
        .where((c("date") == F.lit(as_of.today)) & c("cancellation_id").isNull())
        .select("consignment_id")
    )
    on_stop = t("consumer_stop_consignments", "consumer_stop_id as stop_id", "consignment_id")
    stops = t("consumer_stops", "id as stop_id", "route_id")
    routes = t("routes", "id as route_id", "type", "city").where(c("type") == v.DISTRIBUTION)
    return (
        today.join(on_stop, "consignment_id")
        .join(stops, "stop_id")
        .join(routes, "route_id")
        .groupBy("city")
        .agg(
            F.count_distinct("route_id").alias("routes"),
            (F.count("consignment_id") > 0).alias("routes_saved"),
        )
    )


def cutoff_by_group(t: Tables, as_of: AsOf) -> DataFrame:
    """Latest routing cut-off of today's schedules per terminal."""
    schedules = t(
        "collection_point_intervals",
        "collection_point_id",
        "routeopt_group_id",
        "delivery_day",
        "collection_start",
        "routing_cutoff_seconds",
        "deleted_at",
    ).where(
        c("deleted_at").isNull()
        & (c("delivery_day") == F.upper(day_name(F.lit(as_of.today))))
    )
    points = t("collection_points", "id as collection_point_id", "deleted_at").where(
        c("deleted_at").isNull()
    )
    buyers = t("buyers", "id as buyer_id", "deleted_at").where(c("deleted_at").isNull())
    served = t("buyer_collection_points", "buyer_id", "collection_point_id").join(
        buyers, "buyer_id"
    )
    groups = t("routeopt_groups", "id as routeopt_group_id", "terminal_code")
    cutoff = ts_lit(as_of.today) + F.make_dt_interval(
        secs=c("collection_start") - c("routing_cutoff_seconds")
    )
    live = keep(
        schedules.drop("deleted_at").join(points.drop("deleted_at"), "collection_point_id"),
        served,
        ["collection_point_id"],
    )
    return (
        live.join(groups, "routeopt_group_id")
        .groupBy("terminal_code", "delivery_day")
        .agg(
            F.max(cutoff).alias("cutoff"),
            clock_of_seconds(F.min("collection_start")).alias("collection_start"),
        )
    )


def planned_attempts_by_terminal_day(t: Tables, as_of: AsOf) -> DataFrame:
    """Billable attempts of the next days, counted per parcel.

    Feeds two published tables with the same content.
    """
    planned = join_optional(
        _next_days(t, as_of, "deadline", "cancellation_id"),
        cancellations(t),
        "cancellation_id",
        "consignment_id",
    ).where(billable(c("cancelled_at"), c("deadline")))
    parcels = t("parcel_consignments", "consignment_id", "parcel_id")
    on_stop = t("consumer_stop_consignments", "consignment_id", "id as on_stop_id")
    # An attempt has one zone: counted by it first, so only counts meet the terminals' addresses.
    per_zone = (
        planned.join(_order_zones(t), "order_id")
        .join(parcels, "consignment_id", "left")
        .join(on_stop, "consignment_id", "left")
        .groupBy("zone_id", "date")
        .agg(
            F.count("consignment_id").alias("attempts"),
            F.count("cancelled_at").alias("cancelled_attempts"),
            F.count("on_stop_id").alias("on_stops"),
        )
    )
    return (
        per_zone.join(zone_terminals(t, v.TO_DOOR, with_country=True), "zone_id")
        .groupBy("terminal_code", "terminal_country", "date")
        .agg(
            F.sum("attempts").alias("attempts"),
            F.sum("cancelled_attempts").alias("cancelled_attempts"),
            (F.sum("on_stops") > 0).alias("routes_saved"),
        )
        .withColumn("day_of_week", day_name(c("date")))
        .withColumn("route_group", F.lit("Route group name"))
    )


def events_last_48h_by_hour(t: Tables, as_of: AsOf) -> DataFrame:
    """Tagged merchants' uncancelled orders of the last 48 hours by hour."""
    orders = t("orders", "id as order_id", "buyer_id", "created_at", "cancellation_id").where(
        c("cancellation_id").isNull() & (c("created_at") > ts_lit(as_of.shift(hours=-48)))
    )
    slot = [F.to_date("created_at").alias("created_date"), F.hour("created_at").alias("hour")]
    # By id first: a large merchant is a few rows when its tag joins.
    per_buyer = orders.groupBy("buyer_id", *slot).agg(
        F.count("order_id").alias("n"), F.min("created_at").alias("first")
    )
    return (
        per_buyer.join(tagged_buyers(t), "buyer_id")
        .groupBy("created_date", "hour")
        .agg(
            F.sum("n").alias("orders"),
            to_zone(F.min("first"), "Europe/Stockholm").alias("first_created_local"),
        )
    )


def orders_per_day_per_city(t: Tables, as_of: AsOf) -> DataFrame:
    orders = _order_zones(t, "created_at", "cancellation_id").where(
        c("cancellation_id").isNull() & (c("created_at") > ts_lit(as_of.day(-14)))
    )
    return (
        orders.join(zone_terminals(t), "zone_id")
        .groupBy(F.to_date("created_at").alias("created_date"), "terminal_code")
        .agg(F.count("order_id").alias("orders"), F.min("country").alias("country"))
    )


def scheduled_by_group_merchant(t: Tables, as_of: AsOf) -> DataFrame:
    """Booked orders that fall on their group's schedule, per merchant."""
    groups = t(
        "routeopt_groups",
        "title",
        "city as zone_city",
        "terminal_code",
        "routeopt_group_settings_id as settings_id",
        "deleted_at",
    ).where(c("deleted_at").isNull())
    days = t("routeopt_group_settings", "id as settings_id", "delivery_day as weekday")
    types = t(
        "routeopt_group_settings_consignment_types",
        "routeopt_group_settings_id as settings_id",
        "consignment_type as type",
    )
    slot = ["weekday", "type", "zone_city", "terminal_code"]
    schedule = (
        groups.join(days, "settings_id")
        .join(types, "settings_id")
        .groupBy(*slot)
        .agg(F.max("title").alias("route_group"))
    )
    booked = (
        t("consignments", "id as consignment_id", "order_id", "date", "type", "cancellation_id")
        .where(on_or_between(c("date"), as_of.today, as_of.day(5)))
        .join(_order_zones(t, "buyer_id"), "order_id")
    )
    on_stop = t("consumer_stop_consignments", "consignment_id")
    # Counted per zone, merchant and day before the terminals' addresses and the schedule join.
    per_zone = (
        flag(booked, on_stop, ["consignment_id"], "on_stop")
        .groupBy("zone_id", "buyer_id", "date", "type", "cancellation_id")
        .agg(F.count("*").alias("attempts"), F.bool_or("on_stop").alias("on_stop"))
        .withColumn("weekday", F.upper(day_name(c("date"))))
    )
    merchants = buyer_names(t).where(~like_any_case(c("external_name"), v.BOX_MERCHANT_PATTERN))
    return (
        per_zone.join(zone_terminals(t, v.TO_DOOR, with_country=True), "zone_id")
        .join(schedule, slot)
        .groupBy("terminal_code", "terminal_country", "date", "buyer_id")
        .agg(
            (F.sum("attempts") - F.count_distinct("cancellation_id")).alias("order_count"),
            F.count_distinct("cancellation_id").alias("cancelled_count"),
            F.max("route_group").alias("route_group"),
            F.bool_or("on_stop").alias("routes_saved"),
        )
        .join(merchants, "buyer_id")
        .withColumn("day_of_week", day_name(c("date")))
        .withColumnRenamed("external_name", "merchant")
        .drop("buyer_id")
    )


def ecommerce_orders_per_day(t: Tables, as_of: AsOf) -> DataFrame:
    orders = t("orders", "id as order_id", "buyer_id", "created_at", "cancellation_id").where(
        c("cancellation_id").isNull() & (c("created_at") > ts_lit(as_of.day(months=-3)))
    )
    per_buyer = orders.groupBy("buyer_id", F.to_date("created_at").alias("created_date")).agg(
        F.count("order_id").alias("n")
    )
    return (
        per_buyer.join(tagged_buyers(t), "buyer_id")
        .groupBy("created_date")
        .agg(F.sum("n").alias("orders"))
    )


def box_orders_per_day(t: Tables, as_of: AsOf) -> DataFrame:
    orders = _order_zones(t, "created_at", "cancellation_id", "locker_id").where(
        c("locker_id").isNotNull()
        & c("cancellation_id").isNull()
        & (c("created_at") > ts_lit(as_of.day(months=-12)))
    )
    return (
        orders.join(zones(t), "zone_id")
        .groupBy(F.to_date("created_at").alias("created_date"), "country")
        .agg(F.count("order_id").alias("orders"))
    )


def on_demand_pickups(t: Tables, as_of: AsOf) -> DataFrame:
    attempts = (
        t("consignments", "id as consignment_id", "order_id", "date", "cancellation_id")
        .where(c("cancellation_id").isNull() & (c("date") >= F.lit(as_of.day(-7))))
        .drop("cancellation_id")
    )
    orders = (
        _order_zones(t, "buyer_id", "token", "cancellation_id")
        .where(c("cancellation_id").isNull())
        .drop("cancellation_id")
    )
    places = zones(t).select("zone_id", "zone_city")
    # Counted per merchant id first; names join the few result rows.
    return (
        attempts.join(t("on_demand_pickups", "order_id", "estimated_parcels"), "order_id")
        .join(orders, "order_id")
        .join(places, "zone_id")
        .groupBy("date", "zone_city", "buyer_id")
        .agg(
            F.count("consignment_id").alias("pickups"),
            F.sum("estimated_parcels").alias("estimated_parcels"),
            F.min("token").alias("token"),
        )
        .join(buyer_names(t), "buyer_id")
        .select(
            F.date_format("date", "yyyy-MM-dd").alias("pickup_date"),
            c("zone_city").alias("city"),
            c("external_name").alias("merchant"),
            "pickups",
            "estimated_parcels",
            "token",
        )
    )


def on_demand_returns(t: Tables, as_of: AsOf) -> DataFrame:
    """Returns of on-demand merchants: new ones, or recalled a week ago.

    The recall test is an equality with midnight seven days ago, so a recall
    at another time of that day is not listed.
    """
    week_ago = ts_lit(as_of.day(-7))
    settings = t("buyer_settings", "id as buyer_settings_id", "on_demand_pickup").where(
        c("on_demand_pickup")
    )
    buyers = (
        t("buyers", "id as buyer_id", "external_name", "buyer_settings_id")
        .where(c("buyer_id") != v.INTERNAL_BUYER)
        .join(settings, "buyer_settings_id")
        .select("buyer_id", "external_name")
    )
    parcels = t("parcels", "order_id", "type", "recall_requested_at", "created_at").where(
        ((c("type") == v.RETURN) & (c("created_at") > week_ago))
        | (c("recall_requested_at") == week_ago)
    )
    return (
        parcels.join(t("orders", "id as order_id", "buyer_id", "token"), "order_id")
        .join(buyers, "buyer_id")
        .select("buyer_id", "external_name", "token", "recall_requested_at", "type")
    )


def planned_box_attempts(t: Tables, as_of: AsOf) -> DataFrame:
    """Published beside the attempts table with the same rows."""
    return planned_attempts_by_terminal_day(t, as_of)
