"""Tables and windows that are kept up to date by change batches, and the joins and counts that go with them.

Queries take ``(spark, sf_dir)`` like those of ``direct``.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from parcelmart.functions.clock import AsOf
from parcelmart.functions.timeparts import clamp_before, epoch_seconds
from parcelmart.functions.variants import taken_apart
from parcelmart.operators import bitmaps
from parcelmart.operators.changes import BucketedState
from parcelmart.operators.partials import DailyPartials
from parcelmart.operators.ranges import within
from parcelmart.plans import consumers, lockers, routes
from parcelmart.plans.direct import _read
from parcelmart.plans.shared import tagged_buyers, zones
from parcelmart.sources.logs import StoredLogs, stored_logs
from parcelmart.sources.scratch import fresh_folder
from parcelmart.sources.standin import STANDIN_AS_OF, StandInTables
from parcelmart.sources.tables import Tables

c = F.col

MINUTES = 15
LOG_BUCKETS = 8


def merge_touched_buckets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Newest event per user after two batches, and how many of 64 buckets the second one rewrote.

    The second batch is what some users did, some of it before what the first batch holds.
    """
    log = _read(spark, sf_dir, "events", "user_id", "ts", "event_id", "event_type", "value")
    gone = F.when(c("event_type") == "error", True).when(c("event_type") != "signup", False)
    log = log.withColumn("gone", gone)
    late = (c("user_id") % 16 == 3) & (c("event_id") % 3 != 0)
    state = BucketedState(
        spark,
        fresh_folder(spark, "events-by-user"),
        log.schema,
        keys=["user_id"],
        order=["ts", "event_id"],
        deleted="gone",
        buckets=64,
    )
    state.merge(log.where(~late))
    second = state.merge(log.where(late))
    return state.live().drop("gone").withColumn("buckets_rewritten", F.lit(len(second.rewritten)))


def _in_three_batches(final: DataFrame, day: str, cancelled: str | None) -> list[DataFrame]:
    """A table's rows as a change log: rows that come later, move to another day, are cancelled or go again."""
    first = final.where(c("id") % 5 != 4).withColumn(day, F.when(c("id") % 11 == 0, c(day) - F.expr("INTERVAL '1' DAY")).otherwise(c(day)))
    if cancelled:
        first = first.withColumn(cancelled, F.lit(None).cast(dict(final.dtypes)[cancelled]))
    passing = final.where(c("id") % 13 == 0).withColumn("id", -1 - c("id"))
    stamp = lambda df, number, dead=False: df.withColumn("change", F.lit(number)).withColumn("gone", F.lit(dead))
    return [
        stamp(first.unionByName(passing), 1),
        stamp(final.where((c("id") % 5 != 4) & (c("id") % 2 == 0)), 2).unionByName(stamp(passing, 2, True)),
        stamp(final.where((c("id") % 5 == 4) | (c("id") % 2 != 0)), 3),
    ]


def replicated(spark: SparkSession, batch: DataFrame, name: str, *more_keys: str) -> BucketedState:
    """An empty table for change batches like this one (id, change, gone and others)."""
    return BucketedState(spark, fresh_folder(spark, name), batch.schema, keys=["id", *more_keys], order=["change"], deleted="gone")


def part_day(moment: str) -> Column:
    """The day whose partial a row belongs to: windows begin after midnight, not at it."""
    return F.to_date(c(moment) - F.expr("INTERVAL '0.000001' SECOND"))


def after_batches(
    spark: SparkSession,
    batches: list[DataFrame],
    partials: DailyPartials,
    refresh: Callable[[BucketedState], object],
    *more_keys: str,
) -> DailyPartials:
    """Merge every batch and refresh the partials after each."""
    state = replicated(spark, batches[0], "replicated", *more_keys)
    for batch in batches:
        state.merge(batch)
        refresh(state)
    return partials


# Orders of tagged merchants per day -------------------------------------------


def ecommerce_partials(spark: SparkSession, root: str) -> DailyPartials:
    return DailyPartials(spark, root, "buyer_id bigint, created_date date", "orders bigint")


def refresh_ecommerce(partials: DailyPartials, orders: BucketedState) -> list[str]:
    groups = {"buyer_id": c("buyer_id"), "created_date": F.to_date("created_at")}
    return partials.refresh(orders, part_day("created_at"), groups, {"orders": F.lit(1)}, c("cancellation_id").isNull())


def ecommerce_orders(t: Tables, partials: DailyPartials, as_of: AsOf) -> DataFrame:
    """The mart of three months from the partials of their days."""
    return (
        partials.window(as_of.day(months=-3))
        .join(tagged_buyers(t), "buyer_id")
        .groupBy("created_date")
        .agg(F.sum("orders").alias("orders"))
    )


def ecommerce_orders_from_partials(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = StandInTables(spark, sf_dir)
    batches = _in_three_batches(t("orders", "id", "buyer_id", "created_at", "cancellation_id"), "created_at", "cancellation_id")
    partials = ecommerce_partials(spark, fresh_folder(spark, "partials"))
    after_batches(spark, batches, partials, lambda orders: refresh_ecommerce(partials, orders))
    return ecommerce_orders(t, partials, STANDIN_AS_OF)


# Orders to boxes per day and country ---------------------------------------------


def box_partials(spark: SparkSession, root: str) -> DailyPartials:
    return DailyPartials(spark, root, "zone_id bigint, created_date date", "orders bigint")


def refresh_box_orders(partials: DailyPartials, orders: BucketedState) -> list[str]:
    groups = {"zone_id": c("delivery_postal_code_zone_id"), "created_date": F.to_date("created_at")}
    counted = c("cancellation_id").isNull() & c("locker_id").isNotNull()
    return partials.refresh(orders, part_day("created_at"), groups, {"orders": F.lit(1)}, counted)


def box_orders(t: Tables, partials: DailyPartials, as_of: AsOf) -> DataFrame:
    """The mart of twelve months from the partials of their days."""
    return (
        partials.window(as_of.day(months=-12))
        .join(zones(t), "zone_id")
        .groupBy("created_date", "country")
        .agg(F.sum("orders").alias("orders"))
    )


def box_orders_from_partials(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = StandInTables(spark, sf_dir)
    columns = ("id", "delivery_postal_code_zone_id", "locker_id", "created_at", "cancellation_id")
    batches = _in_three_batches(t("orders", *columns), "created_at", "cancellation_id")
    partials = box_partials(spark, fresh_folder(spark, "partials"))
    after_batches(spark, batches, partials, lambda orders: refresh_box_orders(partials, orders))
    return box_orders(t, partials, STANDIN_AS_OF)


# Consumers by number of orders -------------------------------------------------------


def consumer_partials(spark: SparkSession, root: str) -> DailyPartials:
    return DailyPartials(spark, root, "consumer_key bigint, zone_id bigint", "orders bigint")


def refresh_consumer_orders(partials: DailyPartials, linked: BucketedState) -> list[str]:
    """``linked`` holds one row per order and consumer."""
    groups = {"consumer_key": c("consumer_key"), "zone_id": c("delivery_postal_code_zone_id")}
    return partials.refresh(linked, F.to_date("created_at"), groups, {"orders": F.lit(1)})


def consumer_stats_from_partials(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The mart of twelve months from the partials of their days."""
    t = StandInTables(spark, sf_dir)
    orders = t("orders", "id", "delivery_postal_code_zone_id", "created_at")
    linked = orders.join(t("consumer_order", "consumer_id as consumer_key", "order_id as id"), "id")
    partials = consumer_partials(spark, fresh_folder(spark, "partials"))
    batches = _in_three_batches(linked, "created_at", None)
    after_batches(spark, batches, partials, lambda table: refresh_consumer_orders(partials, table), "consumer_key")
    return consumers.order_stats(t, partials.window(STANDIN_AS_OF.day(months=-12)))


# Sign-ups per month -----------------------------------------------------------------


def signup_partials(spark: SparkSession, root: str) -> DailyPartials:
    return DailyPartials(spark, root, "created_date date", "consumers bigint")


def refresh_signups(partials: DailyPartials, table: BucketedState) -> list[str]:
    # Days without a date count on the first day shown, as older ones do.
    day = F.coalesce(F.to_date("created_at"), F.lit(date(1970, 1, 1)))
    return partials.refresh(table, day, {"created_date": day}, {"consumers": F.lit(1)})


def signups(partials: DailyPartials, as_of: AsOf) -> DataFrame:
    """The mart: sign-ups per month; what is older than twelve months falls on the first day shown."""
    return (
        partials.window()
        .withColumn("day", clamp_before(c("created_date"), F.lit(as_of.day(months=-12))))
        .groupBy(F.year("day").alias("year"), F.month("day").alias("month"))
        .agg(F.sum("consumers").alias("consumers"), F.min("day").alias("date"))
    )


def signups_from_partials(spark: SparkSession, sf_dir: str) -> DataFrame:
    signed_up = StandInTables(spark, sf_dir)("consumer", "id", "created_at")
    partials = signup_partials(spark, fresh_folder(spark, "partials"))
    after_batches(spark, _in_three_batches(signed_up, "created_at", None), partials, lambda table: refresh_signups(partials, table))
    return signups(partials, STANDIN_AS_OF)


# Sets, ranges, documents --------------------------------------------------------------


def distinct_buyers_per_week(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers who ordered, per nation and week (from Monday), from daily sets of customer keys."""
    orders = _read(spark, sf_dir, "orders", "o_custkey AS buyer", "o_orderdate")
    nations = _read(spark, sf_dir, "customer", "c_custkey AS buyer", "c_nationkey AS nation")
    daily = bitmaps.id_sets(orders, [F.to_date("o_orderdate").alias("day")], "buyer")
    weekly = bitmaps.united(daily, [F.trunc("day", "week").alias("week")])
    by_nation = bitmaps.id_sets(nations, ["nation"], "buyer")
    keys = ["nation", "week"]
    return bitmaps.sizes(bitmaps.shared_by(weekly, by_nation, keys), keys, "buyers")


def events_within_minutes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pairs of a user's events at most 15 minutes apart, the earlier first."""
    events = _read(spark, sf_dir, "events", "user_id", "event_id", "ts", "event_type")
    earlier = events.toDF("user_id", "first_id", "first_ts", "first_type")
    later = events.toDF("user_id", "second_id", "second_ts", "second_type")
    pairs = within(earlier, later, ["user_id"], "first_ts", "second_ts", MINUTES * 60)
    after = F.struct("second_ts", "second_id") > F.struct("first_ts", "first_id")
    apart = epoch_seconds(c("second_ts")) - epoch_seconds(c("first_ts"))
    return pairs.where(after).select("user_id", "first_id", "second_id", "first_type", "second_type", apart.alias("seconds"))


def event_props_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Properties of events as columns; of every 97th event only the beginning of the text is left."""
    events = _read(spark, sf_dir, "events", "event_id", "props")
    broken = events.withColumn("props", F.when(c("event_id") % 97 == 0, F.substring("props", 1, 4)).otherwise(c("props")))
    paths = {"k": ("$.k", "bigint"), "k_text": ("$.k", "string"), "missing": ("$.none.of", "string")}
    return taken_apart(broken, "props", paths, keep="document").select(
        "event_id", "k", "k_text", "missing", c("document").isNull().alias("malformed")
    )


# Marts on logs stored by day and parcel ---------------------------------------------


def on_stored_logs(spark: SparkSession, sf_dir: str) -> StoredLogs:
    """The stand-in tables, their scan log stored in a database of its own in the shared folder."""
    place = fresh_folder(spark, "logs")
    namespace = "logs_" + place.rsplit("-", 1)[1]
    spark.sql(f"CREATE DATABASE {namespace} LOCATION '{place}'")
    logs = {"scanning_log": ("date", "parcel_id")}
    return stored_logs(StandInTables(spark, sf_dir), namespace, logs, LOG_BUCKETS, "month")


def backlog_from_stored_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lockers.locker_backlog(on_stored_logs(spark, sf_dir), STANDIN_AS_OF)


def due_vs_scanned_from_stored_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    return routes.due_vs_scanned(on_stored_logs(spark, sf_dir), STANDIN_AS_OF)


QUERIES = {
    query.__name__: query
    for query in (
        merge_touched_buckets,
        ecommerce_orders_from_partials,
        box_orders_from_partials,
        signups_from_partials,
        consumer_stats_from_partials,
        distinct_buyers_per_week,
        events_within_minutes,
        event_props_columns,
        backlog_from_stored_log,
        due_vs_scanned_from_stored_log,
    )
}
