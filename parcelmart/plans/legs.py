"""Feature tables about the legs between stops of a route."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parcelmart.functions import vocabulary as v
from parcelmart.functions.clock import AsOf, ts_lit
from parcelmart.functions.timeparts import day_name, seconds_of_day, to_zone
from parcelmart.operators.joins import join_optional, keep
from parcelmart.operators.windows import previous_row
from parcelmart.plans.shared import routes_due
from parcelmart.sources.tables import Tables

c = F.col

CONSUMER_STOP = "CONSUMER_STOP"
TERMINAL = "TERMINAL"


def _recent_routes(t: Tables, as_of: AsOf, *columns: str) -> DataFrame:
    return routes_due(
        t, lambda due: due >= F.lit(as_of.day(months=-1)), v.DISTRIBUTION, *columns
    )


def _departures(t: Tables, as_of: AsOf) -> DataFrame:
    """Stops of recent distribution routes with position and departure.

    Consumer and terminal stops have separate ids, so the kind of stop is
    part of the key.
    """
    columns = ["id as stop_id", "route_id", "sequence", "address_id", "estimated_interval_id"]
    stops = (
        t("consumer_stops", *columns)
        .withColumn("stop_kind", F.lit(CONSUMER_STOP))
        .unionByName(t("terminal_stops", *columns).withColumn("stop_kind", F.lit(TERMINAL)))
        .where(c("estimated_interval_id").isNotNull())
        .drop("estimated_interval_id")
    )
    measured = t(
        "routeopt_service_time_data",
        "route_id",
        "consumer_stop_id",
        "terminal_stop_id",
        "departure_time",
    ).select(
        "route_id",
        F.coalesce("consumer_stop_id", "terminal_stop_id").alias("stop_id"),
        F.when(c("consumer_stop_id").isNotNull(), CONSUMER_STOP)
        .otherwise(TERMINAL)
        .alias("stop_kind"),
        "departure_time",
    )
    addresses = t(
        "addresses", "id as address_id", "coordinate.x as lng", "coordinate.y as lat"
    )
    routes = _recent_routes(t, as_of).select("route_id")
    return (
        routes.join(stops, "route_id")
        .join(measured, ["route_id", "stop_kind", "stop_id"])
        .join(addresses, "address_id")
        .withColumn("departure_cet", to_zone(c("departure_time"), "CET"))
        .drop("address_id", "departure_time")
    )


def stop_pairs(t: Tables, as_of: AsOf) -> DataFrame:
    """Every stop with the stop before it on the same route."""
    pairs = previous_row(
        _departures(t, as_of),
        keys=["route_id"],
        order="sequence",
        tie_breaks=["stop_kind", "stop_id"],
        carry=["stop_kind", "stop_id", "sequence", "lng", "lat"],
    )
    return pairs.select(
        "route_id",
        c("sequence").alias("stop_sequence"),
        "stop_kind",
        "stop_id",
        c("lng").alias("stop_lng"),
        c("lat").alias("stop_lat"),
        c("departure_cet").alias("planned_departure_cet"),
        c("previous.stop_kind").alias("prev_stop_kind"),
        c("previous.stop_id").alias("prev_stop_id"),
        c("previous.sequence").alias("start_sequence_stop"),
        c("previous.lng").alias("start_lng"),
        c("previous.lat").alias("start_lat"),
    )


def leg_time_features(t: Tables, as_of: AsOf) -> DataFrame:
    """Weekday and seconds since midnight of every planned departure."""
    return _departures(t, as_of).select(
        "route_id",
        "stop_kind",
        "stop_id",
        F.upper(day_name(c("departure_cet"))).alias("day_of_week"),
        seconds_of_day(c("departure_cet")).alias("time_of_day"),
    )


def _drive_factors(t: Tables) -> DataFrame:
    """Settings of the planning run behind a route: factors and driver level."""
    planned = t(
        "routeopt_routes",
        "id as routeopt_route_id",
        "optimization_id",
        "routeopt_vehicle_and_user_id as pairing_id",
    )
    runs = t("routeopt_optimizations", "id as optimization_id", "optimization_settings_id as rs_id")
    settings = t("routeopt_settings", "id as rs_id", "routeopt_graph_settings_id as graph_id")
    graphs = t(
        "routeopt_graph_settings",
        "id as graph_id",
        "drive_time_factor as graph_factor",
        "initial_drive_time_factor as initial_factor",
    )
    pairings = t(
        "routeopt_vehicles_and_users",
        "id as pairing_id",
        "routeopt_vehicle_and_user_settings_id as pairing_settings_id",
    )
    pairing_settings = t(
        "routeopt_vehicles_and_users_settings",
        "id as pairing_settings_id",
        "user_optimization_settings_id as user_settings_id",
    )
    users = t(
        "user_optimization_settings",
        "id as user_settings_id",
        "user_type",
        "drive_time_factor as user_factor",
    )
    return (
        planned.join(runs.join(settings, "rs_id").join(graphs, "graph_id"), "optimization_id", "left")
        .join(pairings, "pairing_id", "left")
        .join(pairing_settings.join(users, "user_settings_id"), "pairing_settings_id", "left")
        .select(
            "routeopt_route_id",
            "graph_factor",
            "initial_factor",
            "user_factor",
            F.expr("try_cast(replace(user_type, 'LEVEL_', '') AS BIGINT)").alias("driver_level"),
        )
    )


def _reports_per_day(t: Tables, as_of: AsOf) -> DataFrame:
    """First and last report per consignment and day, by what it may be about.

    They are matched to the due dates of recent routes, so older ones are not read.
    """
    updates = t(
        "parcel_status_updates", "consignment_id", "parcel_status_id as status", "date"
    ).where(
        c("status").isin(v.COLLECTED, v.DELIVERED, v.MISSED)
        & (c("date") >= ts_lit(as_of.day(months=-1)))
    )
    delivery = F.when(c("status").isin(v.DELIVERED, v.MISSED), c("date"))
    collection = F.when(c("status").isin(v.COLLECTED, v.MISSED), c("date"))
    return updates.groupBy("consignment_id", F.to_date("date").alias("due_date")).agg(
        F.min(delivery).alias("delivery_first"),
        F.max(delivery).alias("delivery_last"),
        F.min(collection).alias("collection_first"),
        F.max(collection).alias("collection_last"),
    )


def _typed_parcels(t: Tables, consignments: DataFrame) -> DataFrame:
    """Parcels of these consignments with their type."""
    carried = keep(t("parcel_consignments", "consignment_id", "parcel_id"), consignments, ["consignment_id"])
    return carried.join(t("parcels", "id as parcel_id", "type as parcel_type"), "parcel_id")


def _by_type(delivery: str, collection: str):
    return F.when(c("parcel_type") == v.DELIVERY, c(delivery)).when(
        c("parcel_type") == v.RETURN, c(collection)
    )


def _with_stop_facts(t: Tables, as_of: AsOf, sides: DataFrame) -> DataFrame:
    """Add place, parcels, reports and measured times of each side's stop.

    A side is one end of a leg, so its consignments are joined to it alone
    and never paired with those of the other end.  Ends at the terminal have
    no stop id; their NULL keys are spread by ``leg_no``.
    """
    on_stop = t("consumer_stop_consignments", "consumer_stop_id as stop_id", "consignment_id")
    # Only what the sides' stops carry is followed into the parcel links and the log.
    carried = keep(on_stop, sides, ["stop_id"])
    times = (
        t(
            "routeopt_service_time_data",
            "consumer_stop_id as stop_id",
            "departure_time",
            "arrival_time",
        )
        .where(c("stop_id").isNotNull())
        .groupBy("stop_id")
        .agg(F.min("departure_time").alias("departure"), F.min("arrival_time").alias("arrival"))
    )
    stops = t("consumer_stops", "id as stop_id", "sequence", "address_id").withColumn(
        "at_stop", F.lit(True)
    )
    places = t("addresses", "id as address_id", "coordinate.x as x", "coordinate.y as y")
    facts = [*sides.columns, "at_stop", "sequence", "address_id", "departure", "arrival"]
    rows = join_optional(sides, [stops, times, on_stop], "stop_id", "leg_no")
    rows = join_optional(rows, _typed_parcels(t, carried), "consignment_id", "leg_no")
    rows = join_optional(
        rows, _reports_per_day(t, as_of), "consignment_id", "leg_no", also=["due_date"]
    )
    grouped = rows.groupBy(*facts).agg(
        F.count_distinct("parcel_id").alias("num_parcels"),
        F.min(_by_type("delivery_first", "collection_first")).alias("first_processed"),
        F.max(_by_type("delivery_last", "collection_last")).alias("last_processed"),
    )
    return join_optional(grouped, places, "address_id", "leg_no")


def _terminal_stop_facts(t: Tables, legs: DataFrame) -> DataFrame:
    """Per terminal stop of these legs: place, loading reports and measured times."""
    on_stop = keep(
        t("terminal_stop_consignments", "terminal_stop_id as ts_id", "consignment_id"), legs, ["ts_id"]
    )
    updates = t(
        "parcel_status_updates", "consignment_id", "parcel_status_id as status", "date"
    ).where(c("status").isin(v.COLLECTED, v.RETURN_LABEL_COLLECTED))
    loaded = F.when(c("status") == v.COLLECTED, c("date"))
    labelled = F.when(c("status") == v.RETURN_LABEL_COLLECTED, c("date"))
    reports = keep(updates, on_stop, ["consignment_id"]).groupBy("consignment_id").agg(
        F.min(loaded).alias("delivery_first"),
        F.max(loaded).alias("delivery_last"),
        F.min(labelled).alias("collection_first"),
        F.max(labelled).alias("collection_last"),
    )
    types = _typed_parcels(t, on_stop).select("consignment_id", "parcel_type").distinct()
    work = (
        on_stop.join(reports, "consignment_id")
        .join(types, "consignment_id")
        .groupBy("ts_id")
        .agg(
            F.min(_by_type("delivery_first", "collection_first")).alias("ts_first_processed"),
            F.max(_by_type("delivery_last", "collection_last")).alias("ts_last_processed"),
        )
    )
    times = (
        t(
            "routeopt_service_time_data",
            "terminal_stop_id as ts_id",
            "departure_time",
            "arrival_time",
        )
        .where(c("ts_id").isNotNull())
        .groupBy("ts_id")
        .agg(
            F.min("departure_time").alias("ts_departure"), F.min("arrival_time").alias("ts_arrival")
        )
    )
    places = t("terminal_stops", "id as ts_id", "sequence as ts_sequence", "address_id").join(
        t("addresses", "id as address_id", "coordinate.x as ts_x", "coordinate.y as ts_y"),
        "address_id",
        "left",
    )
    return (
        places.join(work, "ts_id", "left").join(times, "ts_id", "left").drop("address_id")
    )


def drive_legs(t: Tables, as_of: AsOf) -> DataFrame:
    """Planned legs of recent distribution routes with measured times.

    A leg side without a consumer stop is the terminal.  The base drive time
    takes the planner's factors out again; a zero factor gives NULL.
    """
    routes = keep(
        _recent_routes(t, as_of, "terminal", "vehicle_type", "routeopt_route_id"),
        t("user_routes", "route_id"),
        ["route_id"],
    )
    terminals = (
        t("warehouses", "code as terminal", "address_id", "deleted_at")
        .where(c("deleted_at").isNull())
        .join(
            t("addresses", "id as address_id", "country_code as country", "city", "postal_code"),
            "address_id",
        )
        .drop("address_id", "deleted_at")
    )
    planned = t(
        "routeopt_drive_time_data",
        "route_id",
        "from_consumer_stop_id as from_id",
        "to_consumer_stop_id as to_id",
        "terminal_stop_id as ts_id",
        "estimated_drive_time",
        "distance",
    )
    ends = ["ts_id", "from_id", "to_id"]
    leg = [*routes.columns, *ends, "leg_no", "router_drive_time", "distance"]
    legs = (
        planned.join(routes, "route_id")
        .groupBy(*routes.columns, *ends)
        .agg(
            F.min("estimated_drive_time").alias("router_drive_time"),
            F.min("distance").alias("distance"),
        )
        .withColumn("leg_no", F.pmod(F.xxhash64("route_id", *ends), F.lit(2**40)))
    )
    sides = legs.select(
        *leg, F.expr("stack(2, 'from', from_id, 'to', to_id) AS (side, stop_id)")
    )
    seen = [
        "at_stop",
        "sequence",
        "x",
        "y",
        "departure",
        "arrival",
        "num_parcels",
        "first_processed",
        "last_processed",
    ]

    def end(side: str):
        return F.max(F.when(c("side") == side, F.struct(*seen))).alias(side)

    # Both ends of a leg come back together in one row.
    both = _with_stop_facts(t, as_of, sides).groupBy(*leg).agg(end("from"), end("to"))
    at_from, at_to = c("from.at_stop").isNotNull(), c("to.at_stop").isNotNull()
    factors = c("user_factor") * c("graph_factor")
    return (
        join_optional(both, _terminal_stop_facts(t, legs), "ts_id", "leg_no")
        .join(terminals, "terminal")
        .join(_drive_factors(t), "routeopt_route_id", "left")
        .select(
            "route_id",
            c("due_date").cast("timestamp_ntz").alias("route_date"),
            F.lit(v.DISTRIBUTION).alias("route_type"),
            "terminal",
            "driver_level",
            "vehicle_type",
            F.when(at_from, CONSUMER_STOP).otherwise(TERMINAL).alias("from_stop_type"),
            F.when(at_to, CONSUMER_STOP).otherwise(TERMINAL).alias("to_stop_type"),
            F.coalesce("from.sequence", "ts_sequence").alias("from_sequence"),
            F.coalesce("to.sequence", "ts_sequence").alias("to_sequence"),
            F.when(at_from, c("from.x")).otherwise(c("ts_x")).alias("from_coord_x"),
            F.when(at_from, c("from.y")).otherwise(c("ts_y")).alias("from_coord_y"),
            F.when(at_to, c("to.x")).otherwise(c("ts_x")).alias("to_coord_x"),
            F.when(at_to, c("to.y")).otherwise(c("ts_y")).alias("to_coord_y"),
            "country",
            "city",
            "postal_code",
            F.try_divide(
                c("router_drive_time"),
                F.when(at_from, factors).otherwise(factors * c("initial_factor")),
            ).alias("base_drive_time"),
            "router_drive_time",
            "distance",
            c("from.num_parcels").alias("from_num_parcels"),
            c("to.num_parcels").alias("to_num_parcels"),
            c("from.last_processed").alias("from_cs_last_processed"),
            c("to.first_processed").alias("to_cs_first_processed"),
            "ts_first_processed",
            "ts_last_processed",
            F.when(at_from, c("from.departure"))
            .otherwise(c("ts_departure"))
            .alias("departure_actual"),
            F.when(at_to, c("to.arrival")).otherwise(c("ts_arrival")).alias("arrival_actual_next"),
        )
    )
