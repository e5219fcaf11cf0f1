"""Parcel lockers: orders, boxes, backlog."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parcelmart.functions import vocabulary as v
from parcelmart.functions.clock import AsOf, ts_lit
from parcelmart.functions.predicates import like_any_case
from parcelmart.functions.text import admin_link, joined
from parcelmart.functions.timeparts import clock_of_seconds
from parcelmart.operators.aggregates import category_columns, count_where, pivot_counts, ratio
from parcelmart.operators.joins import (
    exclude,
    flag,
    join_optional,
    keep,
    latest_per_key,
)
from parcelmart.plans.shared import (
    buyer_names,
    starting_on,
    zone_terminals,
    zones,
)
from parcelmart.sources.tables import Tables

c = F.col


def _orders(t: Tables, *extra: str) -> DataFrame:
    return t("orders", "id as order_id", "delivery_postal_code_zone_id as zone_id", *extra)


def new_events_last_24h(t: Tables, as_of: AsOf) -> DataFrame:
    """Locker orders created in the last 24 hours per merchant and locker."""
    recent = c("created_at").between(ts_lit(as_of.shift(days=-1)), ts_lit(as_of.now))
    orders = _orders(t, "buyer_id", "locker_id", "created_at").where(
        recent & c("locker_id").isNotNull()
    )
    merchants = buyer_names(t).where(~like_any_case(c("external_name"), v.BOX_MERCHANT_PATTERN))
    # Counted by ids first, so a large merchant is small before names join.
    return (
        orders.groupBy("buyer_id", "locker_id", "zone_id")
        .agg(F.count("order_id").alias("orders"))
        .join(zone_terminals(t), "zone_id")
        .join(t("lockers", "id as locker_id"), "locker_id")
        .join(merchants, "buyer_id")
        .groupBy("external_name", "locker_id", c("terminal_name").alias("terminal"), "country")
        .agg(F.sum("orders").alias("orders"))
    )


def _box_returns(t: Tables, assignments: DataFrame) -> DataFrame:
    """Returned orders of the given box assignments with the locker's country."""
    returns = t(
        "locker_consignments",
        "order_id",
        "consignment_type",
        "parcel_box_assignment_id as assignment_id",
    ).where((c("consignment_type") == v.RETURN) & c("assignment_id").isNotNull())
    boxes = t("locker_boxes", "id as box_id", "locker_id")
    lockers = t("lockers", "id as locker_id", "country")
    return (
        returns.join(assignments, "assignment_id")
        .join(boxes, "box_id")
        .join(lockers, "locker_id")
        .select("country", "state", "order_id")
        .distinct()
    )


def _assignments(t: Tables) -> DataFrame:
    return t(
        "parcel_box_assignments",
        "id as assignment_id",
        "box_id",
        "state",
        "reservation_expires_at as expires",
    )


def returns_present_vs_picked(t: Tables, as_of: AsOf) -> DataFrame:
    expiring = _assignments(t).where(
        c("expires").between(ts_lit(as_of.today), ts_lit(as_of.day(1)))
        & c("state").isin(v.PRESENT, v.PICKED_UP)
    )
    return (
        _box_returns(t, expiring)
        .groupBy("country")
        .agg(
            count_where(c("state") == v.PRESENT).alias("returns_present"),
            count_where(c("state") == v.PICKED_UP).alias("returns_picked_up"),
        )
    )


def returns_present(t: Tables, as_of: AsOf) -> DataFrame:
    waiting = _assignments(t).where(
        (c("expires") > ts_lit(as_of.day(months=-1))) & (c("state") == v.PRESENT)
    )
    return (
        _box_returns(t, waiting).groupBy("country").agg(F.count("*").alias("returns_present"))
    )


def order_progress_over_time(t: Tables, as_of: AsOf) -> DataFrame:
    """Where the parcels of the last 30 days' locker orders are."""
    orders = (
        _orders(t, "created_at", "locker_id", "cancellation_id", "cart_id")
        .where(
            (c("created_at") > ts_lit(as_of.shift(days=-30)))
            & c("locker_id").isNotNull()
            & c("cancellation_id").isNull()
            & (F.substring("cart_id", 7, 5) != "Route")
        )
        .select("order_id", "zone_id", F.to_date("created_at").alias("created_date"))
        .join(zones(t).select("zone_id", "country"), "zone_id")
    )
    parcels = t("parcels", "id as parcel_id", "order_id", "recall_reason")
    boxed = t("parcel_box_assignments", "parcel_id", "id as assignment_id", "picked_up")
    rows = orders.join(parcels, "order_id").join(boxed, "parcel_id", "left")
    never_boxed = c("assignment_id").isNull()
    # The scan log is cut to these parcels before it is reduced; none is scanned before it is ordered.
    log = t.log("scanning_log", "parcel_id", since=as_of.day(-30))
    scans = keep(log, orders.join(parcels, "order_id"), ["parcel_id"])
    return (
        flag(rows, scans, ["parcel_id"], "scanned")
        .groupBy("created_date", "country")
        .agg(
            F.count("order_id").alias("orders"),
            F.count("picked_up").alias("picked_up"),
            count_where(~never_boxed & c("picked_up").isNull()).alias("in_locker"),
            count_where(never_boxed & c("scanned") & c("recall_reason").isNull()).alias(
                "at_depot"
            ),
            count_where(~c("scanned")).alias("not_at_depot"),
            F.count("recall_reason").alias("recalled"),
        )
    )


def _live_lockers(t: Tables, *columns: str) -> DataFrame:
    return (
        t("lockers", "id as locker_id", *columns, "deleted_at")
        .where(c("deleted_at").isNull())
        .drop("deleted_at")
    )


def lockers_with_info(t: Tables, as_of: AsOf) -> DataFrame:
    boxes = t("locker_boxes", "locker_id").groupBy("locker_id").agg(F.count("*").alias("boxes"))
    lockers = _live_lockers(
        t,
        "name",
        "identifier",
        "street",
        "installation_date",
        "enabled",
        "location_partner_id as partner_id",
        "postal_code_zone_id as zone_id",
    )
    partners = t("locker_location_partners", "id as partner_id", "name as partner")
    places = zone_terminals(t).select(
        "zone_id", "terminal_code", c("zone_city").alias("city"), "country"
    )
    return (
        lockers.join(partners, "partner_id", "left")
        .join(places, "zone_id")
        .join(boxes, "locker_id")
        .drop("partner_id", "zone_id")
    )


def lockers_with_errors(t: Tables, as_of: AsOf) -> DataFrame:
    broken = t("locker_boxes", "locker_id", "size", "error_code").where(
        c("error_code").isNotNull()
    )
    lockers = t(
        "lockers",
        "id as locker_id",
        "identifier as locker_identifier",
        "name as locker_name",
        "country",
    )
    return (
        broken.groupBy("locker_id")
        .agg(*pivot_counts(c("size"), category_columns(v.BOX_SIZES)))
        .join(lockers, "locker_id")
    )


def box_status(t: Tables, as_of: AsOf) -> DataFrame:
    """State of every box: 1 free, 2 delivery, 3 broken, 4 return, 5 reserved."""
    boxes = t("locker_boxes", "id as box_id", "locker_id", "board_id", "slot_id", "error_code")
    held = t("parcel_box_assignments", "box_id", "parcel_id", "state as held").where(
        c("held").isin(v.PRESENT, v.RESERVED)
    )
    parcels = t("parcels", "id as parcel_id", "order_id", "type", "recall_requested_at")
    orders = t("orders", "id as order_id", "cancellation_id", "token as order_token")
    # Boxes without a parcel are the rule; their NULL keys are spread.
    filled = join_optional(boxes.join(held, "box_id", "left"), parcels, "parcel_id", "box_id")
    rows = join_optional(filled, orders, "order_id", "box_id")
    valid = c("recall_requested_at").isNull() & c("cancellation_id").isNull()
    present = (c("held") == v.PRESENT) & valid
    state = (
        F.when(c("error_code").isNotNull(), 3)
        .when(present & (c("type") == v.DELIVERY), 2)
        .when(present & (c("type") == v.RETURN), 4)
        .when((c("held") == v.RESERVED) & valid, 5)
        .otherwise(1)
    )
    link = admin_link(v.ADMIN_URL, "orders", c("order_token"))
    return rows.select(
        "locker_id",
        "board_id",
        "slot_id",
        state.alias("state"),
        F.when(valid, link).otherwise(c("error_code")).alias("token"),
    )


def _present_per_box(t: Tables) -> DataFrame:
    """Boxes of all lockers with the number of parcels present in each."""
    present = (
        t("parcel_box_assignments", "box_id", "state")
        .where(c("state") == v.PRESENT)
        .groupBy("box_id")
        .agg(F.count("*").alias("present"))
    )
    boxes = t("locker_boxes", "id as box_id", "locker_id")
    return boxes.join(present, "box_id", "left").fillna(0, "present")


def boxes_per_locker(t: Tables, as_of: AsOf) -> DataFrame:
    return (
        _present_per_box(t)
        .groupBy("locker_id")
        .agg(F.count("*").alias("boxes"), F.sum("present").alias("assigned_parcels"))
        .join(t("lockers", "id as locker_id", "identifier"), "locker_id")
        .drop("locker_id")
    )


def locker_fill_ratio(t: Tables, as_of: AsOf) -> DataFrame:
    """Share of used boxes; a box counts once per parcel present in it."""
    lockers = t("lockers", "id as locker_id", "name", "postal_code_zone_id as zone_id")
    return (
        _present_per_box(t)
        .groupBy("locker_id")
        .agg(
            F.sum(F.greatest(c("present"), F.lit(1))).alias("boxes"),
            F.sum("present").alias("used_boxes"),
        )
        .withColumn("fill_percent", ratio(c("used_boxes"), c("boxes"), 100))
        .join(lockers, "locker_id")
        .join(zones(t).select("zone_id", "country"), "zone_id")
        .drop("zone_id")
    )


def locker_information(t: Tables, as_of: AsOf) -> DataFrame:
    """Live lockers with their pick-up days, times and collection round."""
    lockers = _live_lockers(
        t,
        "identifier",
        "name as locker_name",
        "enabled",
        "city",
        "country",
        "coordinate.y as coordinate_y",
        "coordinate.x as coordinate_x",
        "collection_point_id",
        "postal_code_zone_id as zone_id",
    )
    schedules = t(
        "collection_point_schedules",
        "id as schedule_id",
        "pickup_collection_point_id as collection_point_id",
        "pickup_day",
        "pickup_time_end",
    )
    newest = latest_per_key(
        t(
            "recurring_pickup_schedule_merchant_schedules",
            "id",
            "collection_point_schedule_id as schedule_id",
            "recurring_pickup_route_id as round_id",
        ),
        ["schedule_id"],
        ["id"],
        ["round_id"],
    ).drop("id")
    rounds = (
        t(
            "recurring_pickup_schedule",
            "id as round_id",
            "name as round_name",
            "start_terminal_id",
            "deleted_at",
        )
        .where(c("deleted_at").isNull())
        .drop("deleted_at")
    )
    places = zone_terminals(t).select(
        "zone_id", c("terminal_id").alias("zone_terminal_id"), c("terminal_name").alias("terminal")
    )

    def listed(text: str):
        return F.expr(f"listagg({text}, '{v.LIST_SEPARATOR}') WITHIN GROUP (ORDER BY schedule_id)")

    keys = [
        "locker_id",
        "identifier",
        "locker_name",
        "enabled",
        "city",
        "country",
        "coordinate_y",
        "coordinate_x",
        "terminal",
    ]
    return (
        lockers.join(schedules, "collection_point_id", "left")
        .join(newest, "schedule_id", "left")
        .join(rounds, "round_id", "left")
        .join(places, "zone_id", "left")
        .withColumn("city", F.upper("city"))
        .withColumn("day", F.left("pickup_day", F.lit(3)))
        .withColumn("eta", clock_of_seconds(c("pickup_time_end")))
        .groupBy(*keys)
        .agg(
            F.min("round_name").alias("round_name"),
            listed("day").alias("on_route"),
            listed("eta").alias("eta_per_day"),
            F.max(
                F.when(c("zone_terminal_id") != c("start_terminal_id"), 1).otherwise(0)
            ).alias("wrong_terminal"),
        )
    )


def failed_attempts_by_locker(t: Tables, as_of: AsOf) -> DataFrame:
    """Cancelled, never boxed parcels on today's locker routes.

    Counts one row per driver of the route, as drivers join the parcels;
    drivers are counted per route and carried as a weight.
    """
    routes = (
        t("routes", "id as route_id", "due_date", "type", "terminal")
        .where((c("due_date") == F.lit(as_of.today)) & (c("type") == v.LOCKER))
        .select("route_id", "terminal")
    )
    drivers = (
        routes.join(t("user_routes", "route_id", "user_id"), "route_id")
        .groupBy("route_id", "terminal")
        .agg(F.count("*").alias("drivers"), F.min("user_id").alias("user_id"))
    )
    pallets = t("locker_pallets", "id as locker_pallet_id", "route_id")
    on_pallet = t("locker_pallet_parcels", "locker_pallet_id", "parcel_id")
    parcels = (
        drivers.join(pallets, "route_id")
        .join(on_pallet, "locker_pallet_id")
        .join(t("parcels", "id as parcel_id", "order_id"), "parcel_id")
    )
    never_boxed = exclude(parcels, t("parcel_box_assignments", "parcel_id"), ["parcel_id"])
    cancelled = t("locker_consignments", "order_id", "cancellation_id").where(
        c("cancellation_id").isNotNull()
    )
    reasons = t("cancellations", "id as cancellation_id", "cancellation_category").where(
        c("cancellation_category") != "PARCEL_NOT_ADDED_TO_ROUTE"
    )
    users = t("users", "id as user_id", "first_name", "last_name", "phone_number")
    lockers = t("lockers", "id as locker_id", "identifier", "name", "country")
    return (
        never_boxed.join(cancelled, "order_id")
        .join(reasons, "cancellation_id")
        .join(t("orders", "id as order_id", "locker_id"), "order_id")
        .groupBy("locker_id")
        .agg(
            F.sum("drivers").alias("failed_parcels"),
            F.min(F.struct("route_id", "user_id", "terminal")).alias("first"),
        )
        .select("locker_id", "failed_parcels", "first.*")
        .join(lockers, "locker_id")
        .join(users, "user_id")
        .withColumn("driver", joined(", ", c("first_name"), c("last_name")))
        .drop("user_id", "first_name", "last_name", "locker_id")
        .orderBy(F.desc("failed_parcels"), "identifier")
    )


def old_undelivered(t: Tables, as_of: AsOf) -> DataFrame:
    """Locker parcels 5 to 30 days old, scanned but never boxed."""
    orders = (
        t(
            "orders",
            "id as order_id",
            "created_at",
            "locker_id",
            "cancellation_id",
            "cart_id",
            "token",
        )
        .where(
            (c("created_at") > ts_lit(as_of.shift(days=-30)))
            & (c("created_at") < ts_lit(as_of.day(-4)))
            & c("locker_id").isNotNull()
            & c("cancellation_id").isNull()
            & ~like_any_case(c("cart_id"), "%route%")
        )
        .drop("cancellation_id", "cart_id")
    )
    parcels = (
        t("parcels", "id as parcel_id", "order_id", "recall_reason")
        .where(c("recall_reason").isNull())
        .drop("recall_reason")
    )
    lockers = t("lockers", "id as locker_id", "postal_code_zone_id as zone_id")
    waiting = exclude(
        orders.join(parcels, "order_id"), t("parcel_box_assignments", "parcel_id"), ["parcel_id"]
    )
    log = t.log("scanning_log", "parcel_id", since=as_of.day(-30))
    scans = keep(log, waiting, ["parcel_id"])
    return (
        keep(waiting, scans, ["parcel_id"])
        .join(lockers, "locker_id")
        .join(zone_terminals(t), "zone_id")
        .select(
            admin_link(v.ADMIN_URL, "orders", c("token")).alias("order_link"),
            F.to_date("created_at").alias("created_date"),
            c("terminal_name").alias("terminal"),
            "country",
        )
    )


def due_vs_palletized(t: Tables, as_of: AsOf) -> DataFrame:
    """Today's locker parcels per terminal: due, and put on a pallet."""
    due = t(
        "locker_consignments",
        "order_id",
        "estimated_interval_id",
        "consignment_type",
        "cancellation_id",
    ).where(c("consignment_type").isin(*v.ATTEMPT_TYPES) & c("cancellation_id").isNull())
    today = starting_on(t, "estimated_interval_id", as_of.today, as_of.day(1))
    per_order = (
        due.join(today, "estimated_interval_id")
        .groupBy("order_id")
        .agg(F.count("*").alias("consignments"))
        .join(_orders(t), "order_id")
        .join(zone_terminals(t), "zone_id")
    )
    parcels = t("parcels", "id as parcel_id", "order_id")
    on_pallet = t("locker_pallet_parcels", "id as pallet_row", "parcel_id")
    linked = per_order.join(parcels, "order_id", "left")
    pallet_rows = on_pallet.groupBy("parcel_id").agg(F.count("*").alias("on_pallet"))
    return (
        join_optional(linked, pallet_rows, "parcel_id", "order_id")
        .groupBy(c("terminal_code").alias("terminal"), "order_id", "consignments")
        .agg(F.count("parcel_id").alias("parcels"), F.sum("on_pallet").alias("on_pallet"))
        .groupBy("terminal")
        .agg(
            F.sum("consignments").alias("consignments"),
            F.sum("parcels").alias("parcels_due"),
            F.coalesce(F.sum("on_pallet"), F.lit(0)).alias("parcels_on_pallet"),
        )
    )


def locker_backlog(t: Tables, as_of: AsOf) -> DataFrame:
    """Recent locker orders that were neither boxed nor sent home, per locker."""
    orders = (
        _orders(t, "locker_id", "created_at", "cancellation_id")
        .where(
            c("cancellation_id").isNull()
            & c("locker_id").isNotNull()
            & (c("created_at") >= ts_lit(as_of.day(-30)))
        )
        .select("order_id", "zone_id", "locker_id")
    )
    places = (
        zones(t)
        .where((c("zone_type") == v.TO_LOCKER) & c("terminal_id").isNotNull())
        .select("zone_id", "terminal_id")
    )
    not_home = exclude(orders.join(places, "zone_id"), t("consignments", "order_id"), ["order_id"])
    parcels = t("parcels", "id as parcel_id", "order_id")
    waiting = exclude(
        not_home.join(parcels, "order_id"),
        t("parcel_box_assignments", "parcel_id"),
        ["parcel_id"],
    )
    log = t.log("scanning_log", "id as scan_id", "parcel_id", "user_id", "date", since=as_of.day(-30))
    scans = latest_per_key(
        keep(log, waiting, ["parcel_id"]),
        ["parcel_id"],
        ["date", "scan_id"],
        ["user_id"],
    ).drop("date")
    stations = t("users", "id as user_id", "user_settings_id").join(
        t("user_settings", "id as user_settings_id", "warehouse_id"), "user_settings_id"
    )
    scanned = join_optional(
        waiting.join(scans, "parcel_id", "left"), stations, "user_id", "parcel_id"
    )
    return (
        scanned.groupBy("locker_id")
        .agg(
            F.count_distinct("order_id").alias("orders"),
            count_where(c("warehouse_id") == c("terminal_id")).alias("scanned_at_own_terminal"),
            F.count("scan_id").alias("scanned"),
        )
        .join(t("lockers", "id as locker_id", "identifier"), "locker_id")
        .drop("locker_id")
    )
