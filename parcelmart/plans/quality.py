"""Delivery quality: terminals, ratings, time slots, arrival times."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parcelmart.functions import vocabulary as v
from parcelmart.functions.clock import AsOf, ts_lit
from parcelmart.functions.predicates import billable, on_or_between
from parcelmart.functions.timeparts import outside_window, seconds_of_day, to_zone, week_label
from parcelmart.operators.aggregates import count_where
from parcelmart.operators.joins import exclude, join_optional, keep
from parcelmart.plans.shared import (
    attempts_on_day,
    buyer_names,
    cancellations,
    paid_timeslots,
    routes_due,
    starts,
    zones,
)
from parcelmart.sources.tables import Tables

c = F.col


def terminal_list(t: Tables, as_of: AsOf) -> DataFrame:
    addresses = t(
        "addresses",
        "id as address_id",
        "street",
        "postal_code",
        "country_code as country",
        "coordinate.x as coordinate_x",
        "coordinate.y as coordinate_y",
    )
    return (
        t(
            "warehouses",
            "created_at",
            "id",
            "name",
            "code",
            "address_id",
            "deleted_at",
            "sorting_machine_assign_direction",
            "sorting_machine_books_delivery",
            "sorting_machine_maximum_routes_per_lane",
            "sorting_machine_minimum_routes_per_lane",
        )
        .where(c("deleted_at").isNull())
        .join(addresses, "address_id")
        .drop("address_id", "deleted_at")
    )


def timeslots_due(t: Tables, as_of: AsOf) -> DataFrame:
    """Today's billable attempts with a paid time slot, times in CET."""
    attempts = join_optional(
        attempts_on_day(t, as_of, "interval_id").where(c("type").isin(*v.ATTEMPT_TYPES)),
        cancellations(t),
        "cancellation_id",
        "consignment_id",
    ).where(
        billable(
            c("cancelled_at"), c("deadline"), c("cancellation_category"), v.BILLABLE_CANCELLATIONS
        )
    )
    orders = t(
        "orders", "id as order_id", "token", "delivery_postal_code_zone_id as zone_id"
    )
    spans = t("interval_bounds", "id as interval_id", "start_ts", "stop_ts")
    return (
        keep(attempts, paid_timeslots(t), ["consignment_id"])
        .join(orders, "order_id")
        .join(spans, "interval_id")
        .join(zones(t), "zone_id")
        .select(
            "token",
            to_zone(c("start_ts"), "CET").alias("tstart"),
            to_zone(c("stop_ts"), "CET").alias("tstop"),
            "zone_title",
            "country",
        )
    )


def _attempts_of_year(t: Tables, as_of: AsOf) -> DataFrame:
    return t("consignments", "id as consignment_id", "order_id", "date", "type").where(
        on_or_between(c("date"), as_of.day(months=-12), as_of.today)
        & c("type").isin(*v.ATTEMPT_TYPES)
    )


def avg_rating_merchant_zone(t: Tables, as_of: AsOf) -> DataFrame:
    orders = t(
        "orders", "id as order_id", "buyer_id", "delivery_postal_code_zone_id as zone_id"
    ).where(c("zone_id") != v.TEST_ZONE)
    return (
        _attempts_of_year(t, as_of)
        .join(t("ratings", "consignment_id", "score"), "consignment_id")
        .join(orders, "order_id")
        .join(zones(t), "zone_id")
        .groupBy("buyer_id", c("zone_title").alias("zone"))
        .agg(F.avg("score").alias("avg_rating"))
        .join(buyer_names(t), "buyer_id")
        .withColumnRenamed("external_name", "name")
    )


def avg_rating_week(t: Tables, as_of: AsOf) -> DataFrame:
    """Average rating per merchant and week; an attempt counts once per stop."""
    return (
        _attempts_of_year(t, as_of)
        .join(t("ratings", "consignment_id", "score"), "consignment_id")
        .join(t("consumer_stop_consignments", "consignment_id"), "consignment_id")
        .join(t("orders", "id as order_id", "buyer_id"), "order_id")
        .groupBy("buyer_id", week_label(c("date")).alias("week"))
        .agg(F.avg("score").alias("avg_rating"))
        .join(buyer_names(t), "buyer_id")
        .withColumnRenamed("external_name", "name")
    )


def avg_rating_day(t: Tables, as_of: AsOf) -> DataFrame:
    """Last week's home deliveries per day and merchant, rated or not."""
    attempts = t(
        "consignments", "id as consignment_id", "order_id", "date", "cancellation_id", "miss_id"
    ).where(
        (c("date") >= F.lit(as_of.day(-7)))
        & (c("date") < F.lit(as_of.today))
        & c("cancellation_id").isNull()
        & c("miss_id").isNull()
    )
    orders = t(
        "orders", "id as order_id", "buyer_id", "delivery_postal_code_zone_id as zone_id"
    )
    door = zones(t).where(c("zone_type") == v.TO_DOOR).select("zone_id")
    ratings = t("ratings", "id as rating_id", "consignment_id", "score")
    # Summed by merchant id first; merchants sharing both names are merged after.
    return (
        attempts.join(orders, "order_id")
        .join(door, "zone_id")
        .join(ratings, "consignment_id", "left")
        .groupBy("date", "buyer_id")
        .agg(
            F.sum("score").alias("score"),
            F.count("rating_id").alias("rated"),
            F.count("consignment_id").alias("consignments"),
        )
        .join(t("buyers", "id as buyer_id", "name", "external_name"), "buyer_id")
        .groupBy("date", "name", "external_name")
        .agg(
            F.try_divide(F.sum("score").cast("double"), F.sum("rated").cast("double")).alias(
                "avg_rating"
            ),
            F.sum("rated").alias("rated"),
            F.sum("consignments").alias("consignments"),
        )
    )


def neighbour_deliveries_per_day(t: Tables, as_of: AsOf) -> DataFrame:
    """Parcels left with a neighbour, from the day after two months ago."""
    first = ts_lit(as_of.day(days=1, months=-2))
    return (
        t("parcel_status_updates", "id", "date", "with_neighbour")
        .where(c("with_neighbour") & (c("date") >= first))
        .groupBy(F.to_date("date").alias("date"))
        .agg(F.count_distinct("id").alias("delivered_to_neighbour"))
    )


def timeslot_success(t: Tables, as_of: AsOf) -> DataFrame:
    """Paid time slots of the last 14 days and how many were missed.

    An order counts once (by its first attempt).  A delivery more than 15
    minutes outside the slot is a miss; one that never happened is not.
    """
    routes = routes_due(
        t, lambda due: on_or_between(due, as_of.day(-14), as_of.day(-1)), v.DISTRIBUTION
    )
    attempts = t("consignments", "id as consignment_id", "order_id", "interval_id", "cancellation_id")
    open_attempts = attempts.where(
        c("cancellation_id").isNull() & c("interval_id").isNotNull()
    ).drop("cancellation_id")
    # Few routes are recent, so each larger table is joined to what they have left of the one before.
    visited = (
        routes.join(t("consumer_stops", "id as stop_id", "route_id"), "route_id")
        .join(
            t("consumer_stop_consignments", "consumer_stop_id as stop_id", "consignment_id"),
            "stop_id",
        )
        .select("consignment_id", "stop_id", "due_date")
        .join(open_attempts, "consignment_id")
    )
    spans = t("interval_bounds", "id as interval_id", "start_ts", "stop_ts")
    first = F.struct("consignment_id", "stop_id", "due_date", "interval_id")
    slots = (
        keep(visited, paid_timeslots(t), ["consignment_id"])
        .join(t("orders", "id as order_id", "token"), "order_id")
        .groupBy("token")
        .agg(F.min(first).alias("first"))
        .select("token", "first.*")
        .join(spans, "interval_id")
    )
    reports = t("parcel_status_updates", "id", "consignment_id", "parcel_status_id", "date").where(
        c("parcel_status_id") == v.DELIVERED
    )
    delivered = (
        keep(reports, slots, ["consignment_id"])
        .groupBy("consignment_id")
        .agg(F.max_by("date", "id").alias("delivered"))
    )
    missed = outside_window(
        to_zone(c("delivered"), "CET"),
        to_zone(c("start_ts"), "CET"),
        to_zone(c("stop_ts"), "CET"),
        minutes=15,
    )
    return (
        slots.join(delivered, "consignment_id", "left")
        .groupBy("due_date")
        .agg(count_where(missed).alias("not_ok"), F.count("token").alias("slots"))
    )


def _spread(seconds: Column) -> list[Column]:
    """Mean and population deviation in minutes of a difference in seconds."""
    return [
        (F.avg(seconds) / 60).alias("avg_minutes"),
        (F.stddev_pop(seconds) / 60).alias("std_minutes"),
    ]


def eta_vs_arrival(t: Tables, as_of: AsOf) -> DataFrame:
    """Planned against measured arrival per day and city.

    Compares times of day, so an arrival past midnight shows as a day's
    difference; it then counts as a failure.
    """
    routes = t("routes", "id as route_id", "due_date", "city", "terminal").where(
        (c("due_date") > F.lit(as_of.day(-7))) & (c("city") != v.TEST_CITY)
    )
    stops = t("consumer_stops", "id as stop_id", "route_id", "estimated_interval_id")
    measured = t(
        "routeopt_service_time_data", "consumer_stop_id as stop_id", "arrival_time"
    ).where(c("stop_id").isNotNull())
    late = seconds_of_day(c("start_ts")) - seconds_of_day(c("arrival_time"))
    return (
        routes.join(stops, "route_id")
        .join(starts(t, "estimated_interval_id"), "estimated_interval_id")
        .join(measured, "stop_id")
        .withColumn("late", late)
        .groupBy("due_date", "city")
        .agg(
            *_spread(c("late")),
            count_where(F.abs(c("late")) > 30 * 60).alias("count_fail"),
            F.count("arrival_time").alias("count_all"),
            F.min("terminal").alias("terminal"),
        )
    )


def eta_vs_arrival_city(t: Tables, as_of: AsOf) -> DataFrame:
    """Planned arrival against the driver's own status report.

    Leaves out split routes and differences of three hours and more.
    """
    routes = routes_due(t, lambda due: due > F.lit(as_of.day(-7)), v.DISTRIBUTION, "city")
    whole = exclude(routes, t("route_history", "route_child_id as route_id"), ["route_id"])
    drivers = t("user_routes", "route_id", "user_id")
    eta = t("consumer_stops", "id as stop_id", "route_id", "estimated_interval_id").join(
        starts(t, "estimated_interval_id"), "estimated_interval_id"
    )
    on_stop = t("consumer_stop_consignments", "consumer_stop_id as stop_id", "consignment_id")
    attempts = (
        t("consignments", "id as consignment_id", "order_id", "date", "type", "cancellation_id")
        .where(c("cancellation_id").isNull() & c("type").isin(*v.ATTEMPT_TYPES))
        .drop("cancellation_id")
    )
    orders = t("orders", "id as order_id", "delivery_postal_code_zone_id as zone_id")
    visits = whole.join(eta, "route_id").join(on_stop, "stop_id").join(attempts, "consignment_id")
    # A report belongs to the attempt's day: the log is read from the first of these days on and joined by day.
    updates = (
        t.log(
            "parcel_status_updates",
            "consignment_id",
            "user_id",
            "parcel_status_id as status",
            "date as reported_at",
            since=visits.select(F.min("date")).scalar(),
        )
        .where(c("status").isin(v.COLLECTED, v.DELIVERED, v.MISSED))
        .withColumn("date", F.to_date("reported_at"))
    )
    matching = ((c("type") == v.DELIVERY) & c("status").isin(v.DELIVERED, v.MISSED)) | (
        (c("type") == v.RETURN) & (c("status") == v.COLLECTED)
    )
    difference = seconds_of_day(c("start_ts")) - seconds_of_day(c("reported_at"))
    # Drivers join by route and user at once: joined by route alone they would
    # multiply all attempts of the route.
    return (
        visits.join(updates, ["consignment_id", "date"])
        .where(matching)
        .withColumn("late", difference)
        .where(F.abs(c("late")) < 3 * 3600)
        .join(drivers, ["route_id", "user_id"])
        .join(t("parcel_consignments", "consignment_id"), "consignment_id")
        .join(orders, "order_id")
        .join(zones(t).select("zone_id", "country"), "zone_id")
        .groupBy("city", "due_date")
        .agg(*_spread(c("late")), F.min("country").alias("country"))
    )
