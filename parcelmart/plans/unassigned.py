"""Orders that are booked but not yet planned ("not assigned")."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parcelmart.functions import vocabulary as v
from parcelmart.functions.clock import AsOf, ts_lit
from parcelmart.functions.timeparts import micros_text
from parcelmart.operators.joins import distinct_keys, exclude, keep
from parcelmart.plans.shared import zone_terminals
from parcelmart.sources.tables import Tables

c = F.col

ORDER_KEYS = ["terminal_code", "country", "buyer_id", "delivery_type"]
SCANS = [
    "scanned",
    "scanned_at_own_terminal",
    "scanned_in_destination",
    "scanned_in_nl_be",
]


def _open_orders(t: Tables, as_of: AsOf, with_country: bool = False) -> DataFrame:
    """Uncancelled orders of the last 14 days with zone and terminal."""
    return (
        t(
            "orders",
            "id as order_id",
            "buyer_id",
            "created_at",
            "cancellation_id",
            "delivery_postal_code_zone_id as zone_id",
        )
        .where(c("cancellation_id").isNull() & (c("created_at") >= ts_lit(as_of.day(-14))))
        .drop("cancellation_id")
        .join(zone_terminals(t, with_country=with_country, addressed=True), "zone_id")
    )


def _live_consignments(t: Tables) -> DataFrame:
    return t("consignments", "order_id", "cancellation_id").where(c("cancellation_id").isNull())


def _on_todays_pallets(t: Tables, as_of: AsOf) -> DataFrame:
    routes = t("routes", "id as route_id", "due_date", "type").where(
        (c("type") == v.LOCKER) & (c("due_date") == F.lit(as_of.today))
    )
    pallets = t("locker_pallets", "id as locker_pallet_id", "route_id")
    on_pallet = t("locker_pallet_parcels", "locker_pallet_id", "parcel_id")
    return (
        routes.join(pallets, "route_id").join(on_pallet, "locker_pallet_id").select("parcel_id")
    )


def unassigned_parcels(t: Tables, as_of: AsOf) -> DataFrame:
    """Parcels of orders that nobody has planned yet.

    Home and locker orders are excluded by different tables.  An OR of NOT IN
    tests could only run as a nested loop; here each exclusion names the zone
    type it applies to, so all orders pass one anti join against planned
    orders and their parcels one against placed parcels.
    """
    door, box = c("zone_type") == v.TO_DOOR, c("zone_type") == v.TO_LOCKER
    planned = (
        _live_consignments(t)
        .select("order_id", F.lit(v.TO_DOOR).alias("zone_type"))
        .unionByName(
            t("locker_consignments", "order_id").withColumn("zone_type", F.lit(v.TO_LOCKER))
        )
    )
    placed = (
        t("parcel_box_assignments", "parcel_id")
        .unionByName(_on_todays_pallets(t, as_of))
        .withColumn("zone_type", F.lit(v.TO_LOCKER))
    )
    orders = _open_orders(t, as_of).where(
        door | (box & ~c("buyer_id").isin(*v.UNASSIGNED_EXCLUDED_BUYERS))
    )
    parcels = t("parcels", "id as parcel_id", "order_id", "visible", "recall_requested_at")
    unplanned = (
        exclude(orders, planned, ["order_id", "zone_type"])
        .join(parcels, "order_id")
        .where(box | c("recall_requested_at").isNull())
    )
    return (
        exclude(unplanned, placed, ["parcel_id", "zone_type"])
        .withColumn("delivery_type", F.when(door, "HOME").otherwise("BOX"))
        .drop("recall_requested_at")
    )


def _scan_places(t: Tables, parcels: DataFrame) -> DataFrame:
    """Distinct (parcel, terminal) pairs of these parcels' scans with the terminal's country."""
    stations = (
        t("users", "id as user_id", "user_settings_id")
        .join(t("user_settings", "id as user_settings_id", "warehouse_id"), "user_settings_id")
        .select("user_id", c("warehouse_id").alias("scan_terminal_id"))
    )
    places = t("warehouses", "id as scan_terminal_id", "code as scan_code", "address_id").join(
        t("addresses", "id as address_id", "country_code as scan_country"), "address_id"
    )
    # One small table of users, so no join meets on the few terminals. The log is
    # cut to the parcels first and reduced to (parcel, user): a parcel scanned
    # very often shrinks on the map side.
    users = stations.join(places, "scan_terminal_id").drop("scan_terminal_id")
    return (
        keep(t("scanning_log", "parcel_id", "user_id"), parcels, ["parcel_id"])
        .distinct()
        .join(users, "user_id", "left")
        .select("parcel_id", "scan_code", "scan_country")
        .distinct()
    )


def _counts(t: Tables, as_of: AsOf, keys: list[str], parcels: DataFrame) -> DataFrame:
    """Orders, parcels and scanned parcels per key.

    Every parcel is first reduced to one row with its scan flags, then every
    order, so the counts are plain sums instead of six distinct counts over a
    multiplied input.  Only visible parcels count as scanned.
    """
    scanned = c("scan_hit").isNotNull()
    seen = _scan_places(t, parcels).withColumn("scan_hit", F.lit(True))
    flags = {
        "scanned": scanned,
        "scanned_at_own_terminal": scanned & (c("scan_code") == c("terminal_code")),
        "scanned_in_destination": scanned & (c("scan_country") == c("country")),
        "scanned_in_nl_be": scanned & c("scan_country").isin("NL", "BE"),
    }
    per_parcel = (
        parcels.join(seen, "parcel_id", "left")
        .groupBy(*keys, "order_id", "parcel_id")
        .agg(
            *[
                F.max(F.when(c("visible") & flag, 1).otherwise(0)).alias(name)
                for name, flag in flags.items()
            ]
        )
    )
    per_order = per_parcel.groupBy(*keys, "order_id").agg(
        F.count("*").alias("parcels"), *[F.sum(name).alias(name) for name in SCANS]
    )
    merchants = t("buyers", "id as buyer_id", "external_name as merchant")
    tagged = distinct_keys(
        t("buyer_tags", "buyer_id", "tag_id").where(c("tag_id") == v.E_COMMERCE_TAG), ["buyer_id"]
    ).withColumn("tag_id", F.lit(v.E_COMMERCE_TAG))
    return (
        per_order.groupBy(*keys)
        .agg(
            F.count("*").alias("orders"),
            F.sum("parcels").alias("parcels"),
            *[F.sum(name).alias(name) for name in SCANS],
        )
        .join(merchants, "buyer_id")
        .join(tagged, "buyer_id", "left")
    )


def not_assigned_by_day(t: Tables, as_of: AsOf) -> DataFrame:
    """Counts per creation day and key: what both marts below are made of."""
    parcels = unassigned_parcels(t, as_of).withColumn("created_date", F.to_date("created_at"))
    return _counts(t, as_of, ["created_date", *ORDER_KEYS], parcels)


def over_days(by_day: DataFrame) -> DataFrame:
    """An order has one creation day, so the days' counts add up."""
    counts = ["orders", "parcels", *SCANS]
    keys = [name for name in by_day.columns if name not in ("created_date", *counts)]
    return by_day.groupBy(*keys).agg(*(F.sum(name).alias(name) for name in counts))


def of_terminal(by_day: DataFrame, terminal_code: str | None = v.UNASSIGNED_TERMINAL) -> DataFrame:
    if terminal_code is None:
        raise ValueError("set UNASSIGNED_TERMINAL in vocabulary.py")
    return by_day.where(c("terminal_code") == terminal_code)


def orders_not_assigned(t: Tables, as_of: AsOf) -> DataFrame:
    return over_days(not_assigned_by_day(t, as_of))


def orders_not_assigned_one_terminal(
    t: Tables, as_of: AsOf, terminal_code: str | None = v.UNASSIGNED_TERMINAL
) -> DataFrame:
    """The same per creation day, for the one terminal that the deployment names."""
    return of_terminal(not_assigned_by_day(t, as_of), terminal_code)


def orders_not_assigned_union(t: Tables, as_of: AsOf) -> DataFrame:
    """Row listing of unplanned orders, built from marker columns.

    Prototype of the mart above: every exclusion is a left-joined marker that
    must be missing, and the two branches are appended with UNION ALL.  Home
    orders without parcels are listed too.
    """

    def marked(df: DataFrame, keys: DataFrame, key: str, name: str) -> DataFrame:
        marker = distinct_keys(keys, [key]).withColumn(name, F.lit(1))
        return df.join(marker, key, "left")

    tags = (
        t("buyer_tags", "buyer_id", "tag_id")
        .where(c("tag_id") == v.E_COMMERCE_TAG)
        .join(t("tags", "id as tag_id", "name as tag_name"), "tag_id")
    )
    merchants = t("buyers", "id as buyer_id", "external_name as merchant")
    parcels = t("parcels", "id as parcel_id", "order_id", "visible", "recall_requested_at")
    orders = _open_orders(t, as_of, with_country=True)
    home = (
        marked(
            orders.where(c("zone_type") == v.TO_DOOR), _live_consignments(t), "order_id", "planned"
        )
        .where(c("planned").isNull())
        .join(parcels, "order_id", "left")
        .where(c("recall_requested_at").isNull())
        .withColumn("delivery_type", F.lit("HOME"))
    )
    box = marked(
        orders.where(
            (c("zone_type") == v.TO_LOCKER) & ~c("buyer_id").isin(*v.UNASSIGNED_EXCLUDED_BUYERS)
        ),
        t("locker_consignments", "order_id"),
        "order_id",
        "planned",
    ).join(parcels, "order_id")
    box = marked(box, t("parcel_box_assignments", "parcel_id"), "parcel_id", "boxed")
    box = (
        marked(box, _on_todays_pallets(t, as_of), "parcel_id", "on_pallet")
        .where(c("planned").isNull() & c("boxed").isNull() & c("on_pallet").isNull())
        .withColumn("delivery_type", F.lit("BOX"))
        .drop("boxed", "on_pallet")
    )
    return (
        home.unionByName(box)
        .join(merchants, "buyer_id")
        .join(tags, "buyer_id", "left")
        .select(
            micros_text(c("created_at")).alias("order_created_date"),
            "merchant",
            "zone_title",
            "terminal_code",
            "terminal_country",
            "country",
            "tag_id",
            "tag_name",
            "order_id",
            "parcel_id",
            "visible",
            "delivery_type",
        )
    )
