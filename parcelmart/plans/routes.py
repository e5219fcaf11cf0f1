"""Routes of the day: vehicles, loading, scans, ratings."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parcelmart.functions import vocabulary as v
from parcelmart.functions.clock import AsOf, ts_lit
from parcelmart.functions.predicates import like_any_case, on_or_between, same_text
from parcelmart.functions.text import (
    admin_link,
    comparable_plate,
    compare_text,
    joined,
    plain_plate,
)
from parcelmart.functions.timeparts import clock_text, to_country_time, to_zone
from parcelmart.operators.joins import join_optional, keep
from parcelmart.plans.shared import (
    attempts_on_day,
    door_attempts,
    routes_due,
    starts,
    zone_terminals,
    zones,
)
from parcelmart.sources.tables import Tables

c = F.col


def _first_driver(t: Tables) -> DataFrame:
    """One driver per route (smallest id) with name and phone."""
    drivers = (
        t("user_routes", "route_id", "user_id")
        .groupBy("route_id")
        .agg(F.min("user_id").alias("user_id"))
    )
    users = t("users", "id as user_id", "first_name", "last_name", "phone_number")
    return drivers.join(users, "user_id").withColumn(
        "driver", joined(" ", c("first_name"), c("last_name"))
    ).drop("first_name", "last_name")


def plate_compare(t: Tables, as_of: AsOf) -> DataFrame:
    """Planned against photographed number plate; one row per route.

    Where a route has several photos, drivers or terminals, the smallest id
    of each is shown.
    """
    routes = (
        t(
            "routes",
            "id as route_id",
            "due_date",
            "city",
            "owner_operator_id",
            "routeopt_route_id",
        )
        .where(on_or_between(c("due_date"), as_of.day(-2), as_of.today))
        .where(c("routeopt_route_id").isNotNull())
    )
    photos = (
        t("route_vehicle_images", "route_id", "license_plate", "image_id")
        .groupBy("route_id")
        .agg(F.min(F.struct("image_id", "license_plate")).alias("photo"))
        .select(
            "route_id", c("photo.image_id").alias("image_id"), c("photo.license_plate").alias("seen")
        )
    )
    planned = t(
        "routeopt_routes",
        "id as routeopt_route_id",
        "routeopt_vehicle_and_user_id as pairing_id",
    )
    pairings = t("routeopt_vehicles_and_users", "id as pairing_id", "vehicle_id")
    vehicles = t("vehicles", "id as vehicle_id", "license_plate as plate").where(
        ~like_any_case(c("plate"), v.OWN_FLEET_PATTERN)
    )
    couriers = t("owner_operators", "id as owner_operator_id", "name as courier")
    cities = (
        t("warehouses", "id as terminal_id", "city", "address_id")
        .groupBy("city")
        .agg(F.min(F.struct("terminal_id", "address_id")).alias("terminal"))
        .select("city", c("terminal.address_id").alias("address_id"))
        .join(t("addresses", "id as address_id", "country_code as country"), "address_id", "left")
        .drop("address_id")
    )
    images = t("images", "id as image_id", "url as image_url")
    return (
        routes.join(photos, "route_id")
        .join(planned, "routeopt_route_id")
        .join(pairings, "pairing_id")
        .join(vehicles, "vehicle_id")
        .join(_first_driver(t), "route_id")
        .join(couriers, "owner_operator_id")
        .join(cities, "city", "left")
        .join(images, "image_id", "left")
        .select(
            "route_id",
            c("seen").alias("actual_plate"),
            plain_plate(c("plate")).alias("routed_plate"),
            compare_text(comparable_plate(c("plate")), comparable_plate(c("seen"))).alias("valid"),
            F.date_format("due_date", "yyyy-MM-dd").alias("route_date"),
            admin_link(v.ADMIN_URL, "users", c("user_id")).alias("user_link"),
            "driver",
            "city",
            "image_url",
            "courier",
            "country",
        )
    )


def loading_inspection(t: Tables, as_of: AsOf) -> DataFrame:
    """Today's distribution routes with loading time, driver and courier.

    The route type is compared without regard to case.
    """
    routes = t(
        "routes",
        "id as route_id",
        "title as cage_name",
        "city",
        "terminal",
        "due_date",
        "type",
        "routeopt_route_id",
    ).where((c("due_date") == F.lit(as_of.today)) & same_text(c("type"), "Distribution"))
    stops = t("terminal_stops", "id as terminal_stop_id", "route_id", "estimated_interval_id")
    used = keep(
        routes.drop("due_date", "type").join(stops, "route_id"),
        t("terminal_stop_consignments", "terminal_stop_id"),
        ["terminal_stop_id"],
    )
    loading = (
        used.join(starts(t, "estimated_interval_id"), "estimated_interval_id")
        .groupBy("route_id", "cage_name", "city", "terminal", "routeopt_route_id")
        .agg(F.min("start_ts").alias("loading"))
    )
    couriers = (
        t("owner_operator_users", "user_id", "owner_operator_id")
        .groupBy("user_id")
        .agg(F.min("owner_operator_id").alias("owner_operator_id"))
        .join(
            t("owner_operators", "id as owner_operator_id", "name as courier"),
            "owner_operator_id",
        )
        .drop("owner_operator_id")
    )
    drivers = _first_driver(t).join(couriers, "user_id", "left")
    planned = t("routeopt_routes", "id as routeopt_route_id", "optimization_id")
    return (
        loading.join(planned, "routeopt_route_id")
        .join(drivers, "route_id", "left")
        .select(
            clock_text(to_zone(c("loading"), "Europe/Stockholm")).alias("loading_time"),
            "route_id",
            "cage_name",
            F.lit(None).cast("string").alias("bay"),
            "user_id",
            "driver",
            "phone_number",
            "courier",
            "optimization_id",
            "city",
            "terminal",
        )
    )


def ratings_in_routes_today(t: Tables, as_of: AsOf) -> DataFrame:
    """Every attempt on the business day's routes with its rating, if any."""
    routes = routes_due(t, lambda due: due == F.lit(as_of.business_day()), v.DISTRIBUTION)
    ratings = t("ratings", "consignment_id", "score", "rating_category")
    return (
        door_attempts(t, routes)
        .join(zones(t), "zone_id")
        .join(ratings, "consignment_id", "left")
        .select(
            "consignment_id",
            "score",
            "rating_category",
            "country",
            c("zone_city").alias("city"),
        )
    )


def _scan_matches(t: Tables, due: DataFrame) -> DataFrame:
    """Due parcels with their scans after the deadline, reduced per parcel.

    ``rows`` is the size of the joined result a line stands for (one row per
    matching scan, at least one), ``scanned`` whether there was any.  A parcel
    with very many scans is reduced before it is shuffled again.
    """
    carried = t("parcel_consignments", "consignment_id", "parcel_id")
    visible = t("parcels", "id as parcel_id", "visible").where(c("visible"))
    first = due.select(F.min("deadline")).scalar()
    scans = t.log("scanning_log", "parcel_id", "date as scanned_at", since=first)
    linked = join_optional(
        due.join(carried, "consignment_id", "left"),
        visible.select("parcel_id", c("parcel_id").alias("due_parcel_id")),
        "parcel_id",
        "consignment_id",
    ).drop("parcel_id")
    spread = linked.withColumn(
        "_key", F.coalesce(c("due_parcel_id"), -1 - c("consignment_id"))
    )
    late = (c("_key") == c("parcel_id")) & (c("scanned_at") > c("deadline"))
    keys = [name for name in due.columns if name != "deadline"]
    return (
        spread.join(scans, late, "left")
        .groupBy(*keys, "due_parcel_id")
        .agg(
            F.count("*").alias("rows"),
            (F.count("scanned_at") > 0).alias("scanned"),
        )
    )


def due_vs_scanned(t: Tables, as_of: AsOf) -> DataFrame:
    orders = t("orders", "id as order_id", "delivery_postal_code_zone_id as zone_id")
    due = (
        attempts_on_day(t, as_of)
        .where(c("type").isin(*v.ATTEMPT_TYPES) & c("cancellation_id").isNull())
        .join(orders, "order_id")
        .join(zone_terminals(t, v.TO_DOOR), "zone_id")
        .select("consignment_id", "deadline", "terminal_code")
    )
    return (
        _scan_matches(t, due)
        .groupBy("terminal_code")
        .agg(
            F.sum("rows").alias("consignments"),
            F.count_distinct("due_parcel_id").alias("parcels_due"),
            F.count_distinct(F.when(c("scanned"), c("due_parcel_id"))).alias("scanned_parcels"),
        )
    )


def scanning_progress(t: Tables, as_of: AsOf) -> DataFrame:
    orders = t("orders", "id as order_id", "delivery_postal_code_zone_id as zone_id")
    due = (
        attempts_on_day(t, as_of)
        .where(c("cancellation_id").isNull())
        .join(orders, "order_id")
        .join(zone_terminals(t), "zone_id")
        .select("consignment_id", "deadline", "terminal_code", "country")
    )
    return (
        _scan_matches(t, due)
        .groupBy("terminal_code")
        .agg(
            F.min("country").alias("country"),
            F.count_distinct("consignment_id").alias("consignments"),
            F.count_distinct("due_parcel_id").alias("parcels_due"),
            F.count_distinct(F.when(c("scanned"), c("due_parcel_id"))).alias("scanned_parcels"),
        )
    )


def return_route_schedule(t: Tables, as_of: AsOf) -> DataFrame:
    """Merchant routes loading soon, with their merchants and return pallets.

    Only pallets of the last week that hold parcels and are not on a route
    count.  The loading time is local to the country of the stop.
    """
    window = c("start_ts").between(
        ts_lit(as_of.shift(hours=-12)), ts_lit(as_of.shift(days=1))
    )
    loading = (
        t("terminal_stops", "route_id", "sequence", "estimated_interval_id")
        .where(c("sequence") == 1)
        .join(starts(t, "estimated_interval_id").where(window), "estimated_interval_id")
        .select("route_id", "start_ts")
    )
    routes = (
        t("routes", "id as route_id", "type", "terminal", "owner_operator_id")
        .where(c("type") == v.MERCHANT)
        .drop("type")
        .join(loading, "route_id")
    )
    stops = t("consumer_stops", "id as stop_id", "route_id", "address_id")
    unloading = t(
        "consumer_stop_consignments", "consumer_stop_id as stop_id", "consignment_id", "type"
    ).where(c("type") == v.UNLOADING)
    route = ["route_id", "terminal", "owner_operator_id"]
    merchants = (
        routes.join(stops, "route_id")
        .join(unloading.drop("type"), "stop_id")
        .join(t("consignments", "id as consignment_id", "order_id"), "consignment_id")
        .join(t("orders", "id as order_id", "buyer_id"), "order_id")
        .join(t("addresses", "id as address_id", "country_code"), "address_id")
        .withColumn("local_start", to_country_time(c("start_ts"), c("country_code")))
        .groupBy(*route, "buyer_id")
        .agg(F.min("local_start").alias("loading_time"))
    )
    pallets = (
        t("pallets", "id as pallet_id", "identifier", "created_at")
        .where(c("created_at") > ts_lit(as_of.shift(days=-7)))
        .drop("created_at")
    )
    free = t("return_pallet_details", "merchant_id as buyer_id", "route_id as used", "pallet_id").where(
        c("used").isNull()
    )
    filled = keep(
        free.drop("used").join(pallets, "pallet_id"),
        t("pallet_parcels", "pallet_id"),
        ["pallet_id"],
    )
    # A merchant is one row with the list of its pallets, so no route is multiplied by them.
    names = t("buyers", "id as buyer_id", "external_name as merchant")
    stocked = filled.groupBy("buyer_id").agg(F.collect_set("identifier").alias("held")).join(names, "buyer_id")
    listed = F.array_sort(F.array_distinct(F.flatten(F.collect_list("held"))))
    lists = (
        merchants.join(stocked, "buyer_id")
        .groupBy(*route)
        .agg(
            F.min("loading_time").alias("loading_time"),
            F.expr(f"listagg(DISTINCT merchant, '{v.LIST_SEPARATOR}') WITHIN GROUP (ORDER BY merchant)").alias("merchants"),
            listed.alias("_pallets"),
        )
        .withColumn("pallets", F.when(F.size("_pallets") > 0, F.array_join("_pallets", v.LIST_SEPARATOR)))
    )
    couriers = t("owner_operators", "id as owner_operator_id", "name as courier")
    return (
        lists.join(couriers, "owner_operator_id")
        .join(_first_driver(t), "route_id", "left")
        .select(
            "route_id",
            "terminal",
            "loading_time",
            "merchants",
            "pallets",
            "driver",
            "phone_number",
            F.lit(True).alias("has_parcels"),
            "courier",
        )
        .orderBy("loading_time", "route_id")
    )
