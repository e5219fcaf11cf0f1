"""Billable attempts, returns and parcel volumes."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parcelmart.functions import vocabulary as v
from parcelmart.functions.clock import AsOf
from parcelmart.functions.predicates import billable
from parcelmart.operators.joins import join_optional
from parcelmart.plans.shared import (
    attempts_on_day,
    buyer_names,
    cancellations,
    starting_on,
    zone_terminals,
    zones,
)
from parcelmart.sources.tables import Tables

c = F.col


def _billable_today(t: Tables, as_of: AsOf, categories=None) -> DataFrame:
    """Today's attempts that are billed, with zone and merchant ids."""
    attempts = join_optional(
        attempts_on_day(t, as_of), cancellations(t), "cancellation_id", "consignment_id"
    ).where(billable(c("cancelled_at"), c("deadline"), c("cancellation_category"), categories))
    orders = t(
        "orders", "id as order_id", "buyer_id", "delivery_postal_code_zone_id as zone_id"
    )
    return attempts.join(orders, "order_id")


def _with_visible_parcels(t: Tables, attempts: DataFrame) -> DataFrame:
    """Left join parcels; attempts whose parcels are all hidden disappear."""
    carried = t("parcel_consignments", "consignment_id", "parcel_id")
    parcels = t("parcels", "id as parcel_id", "visible")
    linked = attempts.join(carried, "consignment_id", "left")
    return join_optional(linked, parcels, "parcel_id", "consignment_id").where(
        c("visible") | c("parcel_id").isNull()
    )


def _parcel_counts() -> list:
    return [
        F.count_distinct("parcel_id").alias("parcels"),
        F.count_distinct("consignment_id").alias("consignments"),
        F.count("consignment_id").alias("parcel_consignments"),
    ]


def cross_country_billable(t: Tables, as_of: AsOf) -> DataFrame:
    abroad = zone_terminals(t, v.TO_DOOR, with_country=True).where(
        (c("zone_city") != v.TEST_CITY) & (c("country") != c("terminal_country"))
    )
    attempts = _billable_today(t, as_of).where(c("type").isin(*v.ATTEMPT_TYPES))
    return (
        _with_visible_parcels(t, attempts.join(abroad, "zone_id"))
        .groupBy(c("country").alias("destination_country"), "terminal_country")
        .agg(*_parcel_counts())
    )


def multi_country_terminals(t: Tables, as_of: AsOf) -> DataFrame:
    """Today's Dutch and Belgian parcels of terminals that serve several countries."""
    served = (
        t("postal_code_zones", "terminal_id", "country_code", "type", "deleted_at")
        .where(c("deleted_at").isNull() & (c("type") == v.TO_DOOR))
        .groupBy("terminal_id")
        .agg(F.count_distinct("country_code").alias("countries"))
        .where(c("countries") > 1)
    )
    places = (
        zone_terminals(t, v.TO_DOOR, addressed=True)
        .where(c("country").isin("NL", "BE"))
        .join(served, "terminal_id")
    )
    return (
        _billable_today(t, as_of)
        .join(t("parcel_consignments", "consignment_id", "parcel_id"), "consignment_id")
        .join(places, "zone_id")
        .groupBy("terminal_id", "terminal_name", "country", "countries")
        .agg(F.count("parcel_id").alias("parcels"))
        .select(
            c("terminal_name").alias("source_terminal"),
            c("country").alias("destination_country"),
            "parcels",
            "countries",
        )
    )


def billable_by_country_merchant(t: Tables, as_of: AsOf) -> DataFrame:
    places = zones(t).where(
        (c("zone_type") == v.TO_DOOR) & (c("zone_city") != v.TEST_CITY)
    )
    attempts = _billable_today(t, as_of, v.BILLABLE_CANCELLATIONS).where(
        c("type").isin(*v.ATTEMPT_TYPES)
    )
    return (
        _with_visible_parcels(t, attempts.join(places, "zone_id"))
        .groupBy("date", "country", "buyer_id")
        .agg(*_parcel_counts())
        .join(buyer_names(t), "buyer_id")
        .withColumnsRenamed({"buyer_id": "merchant_id", "external_name": "merchant"})
        .drop("date")
    )


def billable_returns_by_country(t: Tables, as_of: AsOf) -> DataFrame:
    attempts = _billable_today(t, as_of, v.BILLABLE_RETURN_CANCELLATIONS).where(
        (c("type") == v.RETURN) & (c("zone_id") != v.TEST_ZONE)
    )
    return (
        attempts.join(t("parcel_consignments", "consignment_id", "parcel_id"), "consignment_id")
        .join(zones(t), "zone_id")
        .groupBy("country")
        .agg(
            F.count("parcel_id").alias("parcels"),
            F.count_distinct("consignment_id").alias("consignments"),
        )
    )


def returns_by_merchant_zone(t: Tables, as_of: AsOf) -> DataFrame:
    attempts = attempts_on_day(t, as_of).where(
        (c("type") == v.RETURN) & c("cancellation_id").isNull()
    )
    orders = t(
        "orders", "id as order_id", "buyer_id", "delivery_postal_code_zone_id as zone_id"
    ).where(c("zone_id") != v.TEST_ZONE)
    door = zones(t).where(c("zone_type") == v.TO_DOOR)
    # Counted by ids first; names join the result rows.
    return (
        attempts.join(orders, "order_id")
        .join(t("parcel_consignments", "consignment_id", "parcel_id"), "consignment_id")
        .groupBy("buyer_id", "zone_id")
        .agg(
            F.count("parcel_id").alias("parcels"),
            F.count_distinct("consignment_id").alias("consignments"),
        )
        .join(door, "zone_id")
        .join(buyer_names(t), "buyer_id")
        .drop("zone_type")
    )


def volume_statistics(t: Tables, as_of: AsOf) -> DataFrame:
    """Parcels moving today per merchant and city: all, measured and heavy."""
    today = as_of.today
    uncancelled = (
        t(
            "orders",
            "id as order_id",
            "buyer_id",
            "delivery_postal_code_zone_id as zone_id",
            "cancellation_id",
        )
        .where(c("cancellation_id").isNull() & (c("zone_id") > v.TEST_ZONE))
        .drop("cancellation_id")
    )
    places = zones(t)
    parcels = t("parcels", "id as parcel_id", "order_id", "machine_dimensions_id as dimension_id")
    row = ["parcel_id", "dimension_id", "buyer_id", "zone_city", "country", "order_id"]
    home = (
        attempts_on_day(t, as_of)
        .where((c("type") == v.DELIVERY) & c("cancellation_id").isNull())
        .select("consignment_id", "order_id")
        .join(t("parcel_consignments", "consignment_id", "parcel_id"), "consignment_id")
        .join(uncancelled, "order_id")
        .join(places.where(c("zone_type") == v.TO_DOOR), "zone_id")
        .join(parcels.drop("order_id"), "parcel_id")
        .select(*row)
        .withColumn("delivery_type", F.lit("Home"))
    )
    due = t("locker_consignments", "order_id", "estimated_interval_id", "cancellation_id").where(
        c("cancellation_id").isNull()
    )
    interval = starting_on(t, "estimated_interval_id", today, as_of.day(1))
    box = (
        due.select("order_id", "estimated_interval_id")
        .join(interval, "estimated_interval_id")
        .join(uncancelled, "order_id")
        .join(places.where(c("zone_type") == v.TO_LOCKER), "zone_id")
        .join(parcels, "order_id")
        .select(*row)
        .withColumn("delivery_type", F.lit("Box"))
    )
    dimensions = t("dimensions", "id as dimension_id", "sorting_deviation")
    rows = home.unionByName(box).distinct()
    return (
        join_optional(rows, dimensions, "dimension_id", "parcel_id")
        .groupBy("buyer_id", "zone_city", "country", "delivery_type")
        .agg(
            F.count("parcel_id").alias("parcels"),
            F.count("dimension_id").alias("measured_parcels"),
            F.count("sorting_deviation").alias("heavy_parcels"),
        )
        .join(buyer_names(t), "buyer_id")
        .groupBy("external_name", c("zone_city").alias("city"), "country", "delivery_type")
        .agg(
            F.sum("parcels").alias("parcels"),
            F.sum("measured_parcels").alias("measured_parcels"),
            F.sum("heavy_parcels").alias("heavy_parcels"),
        )
    )
