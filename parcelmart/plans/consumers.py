"""App consumers, memberships and messages."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parcelmart.functions import vocabulary as v
from parcelmart.functions.clock import AsOf, ts_lit
from parcelmart.functions.timeparts import clamp_before, week_year_label
from parcelmart.operators.aggregates import count_where, ratio, with_total
from parcelmart.plans.shared import live_buyers, zones
from parcelmart.sources.tables import Tables

c = F.col


def active_memberships(t: Tables, as_of: AsOf) -> DataFrame:
    return (
        t("timeslot_subscription", "consumer_id", "active", "valid_to")
        .where((c("valid_to") > ts_lit(as_of.now)) & c("consumer_id").isNotNull())
        .agg(
            count_where(c("active")).alias("active_memberships"),
            F.count_distinct("consumer_id").alias("signed_up"),
        )
    )


def consumer_order_stats(t: Tables, as_of: AsOf) -> DataFrame:
    """Consumers by number of orders in 12 months, per country and overall.

    Orders are counted once per (consumer, country); the overall row sums
    those counts.  A consumer is one consumer overall but one in each country.
    """
    orders = t(
        "orders", "id as order_id", "delivery_postal_code_zone_id as zone_id", "created_at"
    ).where(c("created_at") >= ts_lit(as_of.day(months=-12)))
    links = t("consumer_order", "consumer_id as consumer_key", "order_id")
    per_zone = orders.join(links, "order_id").groupBy("consumer_key", "zone_id").agg(F.count("*").alias("orders"))
    return order_stats(t, per_zone)


def order_stats(t: Tables, per_zone: DataFrame) -> DataFrame:
    """The statistics from numbers of orders per (consumer_key, zone_id)."""
    consumers = t("consumer", "id as consumer_key", "consumer_id")
    counts = (
        per_zone.join(zones(t).select("zone_id", "country"), "zone_id", "left")
        .groupBy("consumer_key", "country")
        .agg(F.sum("orders").alias("n"))
        .join(consumers, "consumer_key")
        .groupBy("consumer_id", "country")
        .agg(F.sum("n").alias("n"))
    )
    total = F.count("consumer_id")
    once, twice, more = (
        count_where(condition) for condition in (c("n") == 1, c("n") == 2, c("n") >= 3)
    )
    return (
        with_total(counts, "consumer_id", "country", "n", "All")
        .groupBy("country")
        .agg(
            total.alias("consumers"),
            once.alias("one_order"),
            twice.alias("two_orders"),
            more.alias("three_or_more_orders"),
            ratio(once, total, 100).alias("one_order_percent"),
            ratio(twice, total, 100).alias("two_orders_percent"),
            ratio(more, total, 100).alias("three_or_more_orders_percent"),
        )
    )


def signups_over_time_clamped(t: Tables, as_of: AsOf) -> DataFrame:
    """Sign-ups per month; older or undated ones fall on the first day shown."""
    day = clamp_before(F.to_date("created_at"), F.lit(as_of.day(months=-12)))
    return (
        t("consumer", "id", "created_at")
        .withColumn("day", day)
        .groupBy(F.year("day").alias("year"), F.month("day").alias("month"))
        .agg(F.count("id").alias("consumers"), F.min("day").alias("date"))
    )


def new_cancellations_per_day(t: Tables, as_of: AsOf) -> DataFrame:
    return (
        t("timeslot_subscription", "id", "cancelled_at")
        .where(c("cancelled_at") >= ts_lit(as_of.day(months=-12)))
        .groupBy(F.to_date("cancelled_at").alias("cancelled_date"))
        .agg(F.count("id").alias("new_cancellations"))
    )


def new_subscriptions_per_day(t: Tables, as_of: AsOf) -> DataFrame:
    return (
        t("timeslot_subscription", "id", "created_at")
        .where(c("created_at") >= ts_lit(as_of.day(months=-12)))
        .groupBy(F.to_date("created_at").alias("created_date"))
        .agg(F.count("id").alias("new_subscriptions"))
    )


def on_demand_merchants(t: Tables, as_of: AsOf) -> DataFrame:
    settings = t("buyer_settings", "id as buyer_settings_id", "on_demand_pickup").where(
        c("on_demand_pickup")
    )
    return (
        t("buyers", "external_name", "buyer_settings_id")
        .join(settings, "buyer_settings_id")
        .drop("buyer_settings_id")
    )


def push_activated(t: Tables, as_of: AsOf) -> DataFrame:
    return t("consumer", "id", "push_notification_token").agg(
        F.count("push_notification_token").alias("push_activated"),
        F.count("id").alias("consumers"),
    )


def push_delivered(t: Tables, as_of: AsOf) -> DataFrame:
    """Push messages of the last month; the id prefix is case-sensitive."""
    return (
        t("sms_notifications", "id", "message_id", "sent", "delivered")
        .where(
            (c("sent") >= ts_lit(as_of.day(months=-1)))
            & c("message_id").startswith(v.PUSH_PREFIX)
        )
        .groupBy(F.to_date("sent").alias("date_sent"))
        .agg(F.count("delivered").alias("push_delivered"), F.count("id").alias("push_sent"))
        .withColumn("week_sent", week_year_label(c("date_sent")))
    )


def consumer_orders_by_merchant(t: Tables, as_of: AsOf) -> DataFrame:
    """Orders and parcels per consumer, merchant and country in six months."""
    orders = (
        t(
            "orders",
            "id as order_id",
            "buyer_id",
            "delivery_postal_code_zone_id as zone_id",
            "created_at",
        )
        .where(c("created_at") >= ts_lit(as_of.day(months=-6)))
        .drop("created_at")
    )
    per_order = (
        orders.join(t("parcels", "order_id"), "order_id")
        .groupBy("order_id", "buyer_id", "zone_id")
        .agg(F.count("*").alias("parcels"))
    )
    links = t("consumer_order", "consumer_id as consumer_key", "order_id")
    consumers = t("consumer", "id as consumer_key", "consumer_id")
    # Summed by ids first; names join the reduced rows.
    return (
        per_order.join(links, "order_id")
        .join(zones(t).select("zone_id", "country"), "zone_id")
        .groupBy("consumer_key", "buyer_id", "country", "order_id")
        .agg(F.sum("parcels").alias("parcels"))
        .groupBy("consumer_key", "buyer_id", "country")
        .agg(F.count("*").alias("orders"), F.sum("parcels").alias("parcels"))
        .join(live_buyers(t), "buyer_id")
        .join(consumers, "consumer_key")
        .groupBy("consumer_id", c("external_name").alias("merchant"), "country")
        .agg(F.sum("orders").alias("orders"), F.sum("parcels").alias("parcels"))
    )
