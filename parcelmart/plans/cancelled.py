"""Cancellations and misses on routes."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parcelmart.functions import vocabulary as v
from parcelmart.functions.clock import AsOf
from parcelmart.functions.timeparts import to_zone
from parcelmart.operators.aggregates import category_columns, count_where, pivot_counts, ratio
from parcelmart.operators.joins import join_optional
from parcelmart.plans.shared import (
    box_attempts,
    cancellations,
    door_attempts,
    routes_due,
    starts,
    zone_terminals,
    zones,
)
from parcelmart.sources.tables import Tables

c = F.col


def cancellation_rate_per_day(t: Tables, as_of: AsOf) -> DataFrame:
    """Share of cancelled attempts per day and delivery type.

    Cancellations caused by merchants or consumers do not count.  Both
    branches are reduced to one row per attempt before the rates are taken,
    so parcels and stops of an attempt never reach the final aggregation.
    """

    def recent(due):
        return due > F.lit(as_of.day(months=-2))

    def branch(attempts: DataFrame, zone_type: str, label: str) -> DataFrame:
        places = zones(t).where(c("zone_type") == zone_type).select("zone_id")
        return (
            attempts.join(places, "zone_id")
            .select("due_date", "consignment_id", "cancellation_id")
            .withColumn("delivery_type", F.lit(label))
        )

    home = branch(
        door_attempts(t, routes_due(t, recent, v.DISTRIBUTION)), v.TO_DOOR, "Home"
    )
    timed = box_attempts(t, routes_due(t, recent, v.LOCKER)).where(
        c("estimated_interval_id").isNotNull()
    )
    box = branch(timed, v.TO_LOCKER, "Box")
    own = (
        t("cancellations", "id as cancellation_id", "cancellation_category")
        .where(~c("cancellation_category").isin(*v.EXTERNAL_CANCELLATIONS))
        .select("cancellation_id", c("cancellation_id").alias("own_cancellation_id"))
    )
    attempts = home.unionByName(box).distinct()
    return (
        join_optional(attempts, own, "cancellation_id", "consignment_id")
        .groupBy("due_date", "delivery_type")
        .agg(
            ratio(F.count_distinct("own_cancellation_id"), F.count("consignment_id")).alias(
                "cancellation_rate"
            )
        )
        .orderBy("due_date", "delivery_type")
    )


def _attempts_of_business_day(t: Tables, as_of: AsOf, *route_columns: str) -> DataFrame:
    """Home and locker attempts on the running business day's routes.

    ``attempts`` is how many rows each line stands for.
    """

    def today(due):
        return due == F.lit(as_of.business_day())

    extra = [column.split(" as ")[-1] for column in route_columns]
    keep = [
        *extra,
        "consignment_id",
        "cancellation_id",
        "miss_id",
        "zone_id",
        "type",
        "attempts",
        "date",
        "delivery_type",
    ]
    home = (
        door_attempts(t, routes_due(t, today, v.DISTRIBUTION, *route_columns))
        .withColumn("attempts", F.lit(1))
        .withColumn("delivery_type", F.lit("Home"))
        .select(*keep)
    )
    box = (
        box_attempts(t, routes_due(t, today, v.LOCKER, *route_columns))
        .join(starts(t, "estimated_interval_id"), "estimated_interval_id")
        .withColumn("date", F.to_date("start_ts"))
        .withColumn("delivery_type", F.lit("Box"))
        .select(*keep)
    )
    return home.unionByName(box)


def _per_terminal(t: Tables, per_zone: DataFrame) -> DataFrame:
    """Counts per delivery type and zone as counts per terminal.

    An attempt has one zone, so the counts add up; only they meet the terminals
    and their (large) addresses.
    """
    served = {"Home": v.TO_DOOR, "Box": v.TO_LOCKER}
    of_type = F.when(c("delivery_type") == "Home", served["Home"]).otherwise(served["Box"])
    keys = ["delivery_type", "terminal_id", "terminal_name", "terminal_country"]
    counts = [name for name in per_zone.columns if name not in ("delivery_type", "zone_id", "date")]
    return (
        per_zone.join(zone_terminals(t, with_country=True), "zone_id")
        .where(c("zone_type") == of_type)
        .groupBy(*keys)
        .agg(*(F.sum(name).alias(name) for name in counts), F.min("date").alias("date"))
        .drop("terminal_id")
        .distinct()
    )


def miss_category_pivot(t: Tables, as_of: AsOf) -> DataFrame:
    attempts = _attempts_of_business_day(t, as_of).where(
        (c("delivery_type") == "Box") | c("type").isin(*v.ATTEMPT_TYPES)
    )
    misses = t("misses", "id as miss_id", "category")
    per_zone = (
        join_optional(attempts, misses, "miss_id", "consignment_id")
        .groupBy("delivery_type", "zone_id")
        .agg(
            *pivot_counts(c("category"), category_columns(v.MISS_CATEGORIES), c("attempts")),
            F.sum("attempts").alias("consignment_total"),
            count_where(c("category").isNotNull(), c("attempts")).alias("miss_total"),
            F.min("date").alias("date"),
        )
    )
    return _per_terminal(t, per_zone)


def cancellation_category_pivot(t: Tables, as_of: AsOf) -> DataFrame:
    """Cancellation reasons per terminal, and when the operator's own happened.

    Hours are local to the route's planning time zone; without one the
    cancellation falls in no hour bucket.
    """
    attempts = _attempts_of_business_day(t, as_of, "routeopt_route_id")
    planned = t("routeopt_routes", "id as routeopt_route_id", "optimization_id")
    runs = t("routeopt_optimizations", "id as optimization_id", "timezone")
    hour = F.hour(to_zone(c("cancelled_at"), c("timezone")))
    own = c("cancellation_category").isin(*v.OPERATOR_CANCELLATIONS)
    weight = c("attempts")
    reasons = category_columns(v.CANCELLATION_CATEGORIES, v.MERGED_CANCELLATIONS)
    per_zone = (
        join_optional(attempts, cancellations(t), "cancellation_id", "consignment_id")
        .join(planned, "routeopt_route_id", "left")
        .join(runs, "optimization_id", "left")
        .groupBy("delivery_type", "zone_id")
        .agg(
            *pivot_counts(c("cancellation_category"), reasons, weight),
            count_where(c("cancellation_category").isNotNull(), weight).alias(
                "total_cancellations"
            ),
            F.sum(weight).alias("total_consignments"),
            F.min("date").alias("date"),
            count_where(own & (hour <= 15), weight).alias("own_before_16"),
            count_where(own & hour.between(16, 17), weight).alias("own_between_16_18"),
            count_where(own & (hour >= 18), weight).alias("own_after_18"),
        )
    )
    return _per_terminal(t, per_zone)
