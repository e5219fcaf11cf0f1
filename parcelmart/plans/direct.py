"""The operators applied straight to the driver's tables.

Each query takes ``(spark, sf_dir)``.  They show every operator on whole
tables without the stand-in derivations in between, so filters and column
lists reach the parquet scans.
"""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from parcelmart.functions.clock import AsOf, ts_lit
from parcelmart.functions.predicates import json_path_set, like_any_case, same_text
from parcelmart.functions.text import comparable_plate, compare_text, joined
from parcelmart.functions.timeparts import (
    clamp_before,
    clock_text,
    day_name,
    epoch_seconds,
    iso_week_label,
    outside_window,
    seconds_of_day,
    to_country_time,
    to_zone,
    week_label,
)
from parcelmart.functions.vocabulary import LIST_SEPARATOR
from parcelmart.operators.aggregates import (
    category_columns,
    concat_distinct,
    count_distinct_where,
    count_where,
    pivot_counts,
    ratio,
    with_total,
)
from parcelmart.operators.changes import (
    apply_changes,
    live_rows,
    newest_changes,
    parse_manifest,
    replicate,
)
from parcelmart.operators.joins import exclude, flag, keep, latest_per_key
from parcelmart.operators.windows import previous_row
from parcelmart.sources.scratch import fresh_folder
from parcelmart.sources.tables import fitted_cuts, split_by_bounds

c = F.col

AS_OF = AsOf(datetime(1998, 8, 23, 9))
EVENTS_AS_OF = AsOf(datetime(2024, 1, 30))
EVENT_TYPES = ("view", "click", "purchase", "signup", "error")
PRIORITIES = ("1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW")


def _read(spark: SparkSession, sf_dir: str, name: str, *columns: str) -> DataFrame:
    df = spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
    return df.selectExpr(*columns) if columns else df


def _shipped(spark: SparkSession, sf_dir: str, first: date, last: date, *columns: str) -> DataFrame:
    """Lines shipped from ``first`` up to and including midnight of ``last``."""
    window = c("l_shipdate").between(ts_lit(first), ts_lit(last))
    return _read(spark, sf_dir, "lineitem", "l_shipdate", *columns).where(window)


# Scans, bounds, splits -----------------------------------------------------


def whole_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _read(spark, sf_dir, "customer")


def recent_key_bounds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Smallest and largest key under a time filter, in one pass."""
    recent = _read(spark, sf_dir, "orders", "o_orderkey", "o_orderdate").where(
        c("o_orderdate") > ts_lit(AS_OF.day(months=-2))
    )
    return recent.agg(F.min("o_orderkey").alias("min_id"), F.max("o_orderkey").alias("max_id"))


def range_split_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows per range split of the order key; outer splits are open-ended."""
    orders = _read(spark, sf_dir, "orders", "o_orderkey", "o_orderdate").where(
        c("o_orderdate") > ts_lit(AS_OF.day(months=-2))
    )
    split = split_by_bounds(orders, "o_orderkey", partitions=16)
    if split is None:
        return orders.groupBy(c("o_orderkey").alias("split")).agg(F.count("*").alias("orders"))
    stride = max(split.upper // split.partitions - split.lower // split.partitions, 1)
    number = F.floor((c("o_orderkey") - split.lower) / stride)
    return orders.groupBy(
        F.least(number, F.lit(split.partitions - 1)).alias("split")
    ).agg(F.count("*").alias("orders"))


def equal_share_reads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders read in eight shares of equal size by customer, who are as uneven as the data: each row is read once."""
    orders = _read(spark, sf_dir, "orders", "o_orderkey", "o_custkey")
    # A third of the orders have one customer, a fifth none.
    tenth = c("o_orderkey") % 10
    uneven = F.when(tenth < 3, F.lit(1)).when(tenth < 8, c("o_custkey"))
    orders = orders.withColumn("o_custkey", uneven)
    shares = fitted_cuts(orders, "o_custkey", 8, spread="o_orderkey").predicates()
    reads = F.array_compact(F.array(*[F.when(F.expr(share), F.lit(n)) for n, share in enumerate(shares)]))
    found = orders.withColumn("reads", reads)
    sizes = found.groupBy(c("reads")[0].alias("share")).agg(F.count("*").alias("n"), F.count_if(F.size("reads") == 1).alias("once"))
    return sizes.agg(
        F.sum("n").alias("orders"),
        F.sum("once").alias("read_once"),
        (F.max("n") <= 2 * F.sum("n") / 8).alias("balanced"),
    )


def day_limits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Plain projection with renames under a date filter."""
    return (
        _read(
            spark,
            sf_dir,
            "orders",
            "o_orderkey AS id",
            "o_custkey AS merchant",
            "o_orderdate AS date",
            "o_orderstatus AS state",
            "o_orderpriority AS priority",
        )
        .where(c("date") >= ts_lit(AS_OF.today))
        .withColumn("date", F.to_date("date"))
    )


def text_predicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Exact and case-blind text tests, lists, ranges and prefixes on parts."""
    name = c("p_name")
    return (
        _read(spark, sf_dir, "part", "p_name", "p_brand", "p_type", "p_size")
        .where(~like_any_case(name, "%BOLT%") & ~c("p_brand").isin("Brand#1", "Brand#2"))
        .groupBy("p_brand")
        .agg(
            count_where(same_text(c("p_type"), "promo")).alias("promo_any_case"),
            count_where(c("p_type") == "promo").alias("promo_exact"),
            count_where(F.substring("p_name", 1, 3) == "hot").alias("prefix_hot"),
            count_where(name.like("% r%")).alias("like_r"),
            count_where(c("p_size").between(5, 10)).alias("mid_size"),
        )
    )


def page_prefixes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages by exact address prefix."""
    return (
        _read(spark, sf_dir, "pages", "page_id", "url")
        .groupBy(F.substring("url", 1, 8).alias("prefix"))
        .agg(
            F.count("page_id").alias("pages"),
            count_where(like_any_case(c("url"), "%EXAMPLE.ORG/%")).alias("org_pages"),
        )
    )


# Joins ----------------------------------------------------------------------


def booked_lines_by_nation_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders shipped in the next days per supplier nation and weekday."""
    lines = _shipped(
        spark, sf_dir, AS_OF.today, AS_OF.day(5), "l_orderkey", "l_suppkey", "l_linestatus"
    )
    suppliers = _read(spark, sf_dir, "supplier", "s_suppkey AS l_suppkey", "s_nationkey AS n")
    nations = _read(spark, sf_dir, "nation", "n_nationkey AS n", "n_name AS nation")
    cancelled = c("l_linestatus") == "F"
    return (
        lines.join(suppliers, "l_suppkey")
        .join(nations, "n")
        .groupBy("nation", day_name(c("l_shipdate")).alias("day_of_week"))
        .agg(
            (
                F.count_distinct("l_orderkey") - count_distinct_where(cancelled, c("l_orderkey"))
            ).alias("order_count"),
            count_distinct_where(cancelled, c("l_orderkey")).alias("cancelled_count"),
            (count_where(~cancelled) > 0).alias("any_open"),
        )
    )


def cross_nation_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines of 30 days whose supplier and customer nations differ."""
    lines = _shipped(
        spark, sf_dir, AS_OF.day(-30), AS_OF.today, "l_orderkey", "l_partkey", "l_suppkey"
    )
    orders = _read(spark, sf_dir, "orders", "o_orderkey AS l_orderkey", "o_custkey")
    customers = _read(spark, sf_dir, "customer", "c_custkey AS o_custkey", "c_nationkey")
    suppliers = _read(spark, sf_dir, "supplier", "s_suppkey AS l_suppkey", "s_nationkey")
    return (
        lines.join(suppliers, "l_suppkey")
        .join(orders, "l_orderkey")
        .join(customers, "o_custkey")
        .where(c("c_nationkey") != c("s_nationkey"))
        .groupBy("c_nationkey", "s_nationkey")
        .agg(
            F.count_distinct("l_partkey").alias("parts"),
            F.count_distinct("l_orderkey").alias("orders"),
            F.count("*").alias("lines"),
        )
    )


def latest_line_per_part(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every part with its newest line and a five-way state."""
    newest = latest_per_key(
        _read(
            spark,
            sf_dir,
            "lineitem",
            "l_partkey AS p_partkey",
            "l_shipdate",
            "l_orderkey",
            "l_linenumber",
            "l_returnflag",
            "l_linestatus",
        ),
        ["p_partkey"],
        ["l_shipdate", "l_orderkey", "l_linenumber", "l_returnflag", "l_linestatus"],
    )
    broken = c("p_type") == "PROMO"
    state = (
        F.when(c("l_orderkey").isNull() & ~broken, 1)
        .when(broken, 3)
        .when(c("l_returnflag") == "R", 4)
        .when(c("l_linestatus") == "O", 2)
        .otherwise(5)
    )
    return (
        _read(spark, sf_dir, "part", "p_partkey", "p_type")
        .join(newest, "p_partkey", "left")
        .select("p_partkey", "l_orderkey", "l_shipdate", state.alias("state"))
    )


def customers_without_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Anti join against a log: merchants nobody reported on, per segment."""
    customers = _read(spark, sf_dir, "customer", "c_custkey AS user_id", "c_mktsegment")
    silent = exclude(customers, _read(spark, sf_dir, "events", "user_id"), ["user_id"])
    return silent.groupBy("c_mktsegment").agg(F.count("*").alias("customers"))


def orders_never_returned(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders 5 to 30 days old without a returned line, of reported customers."""
    window = c("o_orderdate").between(ts_lit(AS_OF.day(-30)), ts_lit(AS_OF.day(-5)))
    orders = _read(
        spark, sf_dir, "orders", "o_orderkey", "o_custkey AS user_id", "o_orderdate"
    ).where(window)
    returned = _read(
        spark, sf_dir, "lineitem", "l_orderkey AS o_orderkey", "l_returnflag"
    ).where(c("l_returnflag") == "R")
    open_orders = exclude(orders, returned, ["o_orderkey"])
    seen = keep(open_orders, _read(spark, sf_dir, "events", "user_id"), ["user_id"])
    return seen.select(
        F.concat(F.lit("orders/"), c("o_orderkey").cast("string")).alias("order_link"),
        F.to_date("o_orderdate").alias("created_date"),
    )


def customer_event_flags(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Existence flags per customer, counted by segment."""
    rows = _read(spark, sf_dir, "customer", "c_custkey AS user_id", "c_mktsegment")
    events = _read(spark, sf_dir, "events", "user_id", "event_type")
    for kind in ("purchase", "error"):
        rows = flag(rows, events.where(c("event_type") == kind), ["user_id"], kind)
    return rows.groupBy("c_mktsegment").agg(
        F.count("*").alias("customers"),
        count_where(c("purchase")).alias("with_purchase"),
        count_where(c("error")).alias("with_error"),
        count_where(c("purchase") & ~c("error")).alias("clean_buyers"),
    )


def late_events_after_signup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Equi join with an inequality: is there an event a day after a sign-up?

    A user's newest event decides that for each of the user's sign-ups, so
    sign-ups are never paired with all events.
    """
    events = _read(spark, sf_dir, "events", "event_id", "user_id", "event_type", "ts")
    due = (
        events.where(c("event_type") == "signup")
        .withColumn("cut", F.expr("ts + INTERVAL '1' DAY"))
        .select("user_id", "event_id", "cut")
    )
    latest = latest_per_key(events, ["user_id"], ["ts"], [])
    return (
        due.join(latest, "user_id")
        .groupBy((c("user_id") % 7).alias("terminal"))
        .agg(
            F.count("event_id").alias("due"),
            F.count_distinct("user_id").alias("users_due"),
            count_distinct_where(c("ts") > c("cut"), c("user_id")).alias("users_seen_later"),
        )
    )


# Aggregation ---------------------------------------------------------------


def cancellation_rate_by_ship_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ratio of distinct counts per day and branch over two months."""
    lines = _shipped(
        spark,
        sf_dir,
        AS_OF.day(days=1, months=-2),
        AS_OF.today,
        "l_orderkey",
        "l_returnflag",
        "l_linestatus",
    )
    branch = F.when(c("l_returnflag") == "R", "Box").otherwise("Home")
    return (
        lines.groupBy(
            F.to_date("l_shipdate").alias("due_date"),
            branch.alias("delivery_type"),
            "l_orderkey",
        )
        .agg(F.bool_or(c("l_linestatus") == "F").alias("cancelled"))
        .groupBy("due_date", "delivery_type")
        .agg(
            ratio(count_where(c("cancelled")), F.count("*")).alias("cancellation_rate"),
            F.count("*").alias("orders"),
        )
    )


def event_type_pivot(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One column per event type, two types sharing one."""
    reasons = category_columns(EVENT_TYPES, {"click": "view"})
    return (
        _read(spark, sf_dir, "events", "user_id", "event_type", "ts")
        .groupBy((c("user_id") % 7).alias("terminal"), F.to_date("ts").alias("day"))
        .agg(*pivot_counts(c("event_type"), reasons), F.count("*").alias("total"))
    )


def priority_pivot_by_nation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order priorities of 30 days per customer nation."""
    orders = _read(spark, sf_dir, "orders", "o_custkey", "o_orderdate", "o_orderpriority").where(
        c("o_orderdate").between(ts_lit(AS_OF.day(-30)), ts_lit(AS_OF.today))
    )
    customers = _read(spark, sf_dir, "customer", "c_custkey AS o_custkey", "c_nationkey")
    columns = {f"p{name[0]}": [name] for name in PRIORITIES}
    return (
        orders.join(customers, "o_custkey")
        .groupBy("c_nationkey")
        .agg(*pivot_counts(c("o_orderpriority"), columns), F.count("*").alias("orders"))
    )


def local_hour_buckets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Errors by local hour bucket; the zone depends on the row."""
    zone = F.when(c("user_id") % 2 == 0, "Europe/Helsinki").when(
        c("user_id") % 3 == 0, "America/New_York"
    )
    hour = F.hour(to_zone(c("ts"), zone))
    return (
        _read(spark, sf_dir, "events", "user_id", "event_type", "ts")
        .groupBy("event_type")
        .agg(
            count_where(hour <= 15).alias("before_16"),
            count_where(hour.between(16, 17)).alias("between_16_18"),
            count_where(hour >= 18).alias("after_18"),
            F.count("*").alias("events"),
        )
    )


def order_counts_with_total(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers by number of orders in 12 months per region, plus all."""
    orders = _read(spark, sf_dir, "orders", "o_custkey", "o_orderdate").where(
        c("o_orderdate").between(ts_lit(AS_OF.day(months=-12)), ts_lit(AS_OF.today))
    )
    customers = _read(spark, sf_dir, "customer", "c_custkey AS o_custkey", "c_nationkey")
    nations = _read(spark, sf_dir, "nation", "n_nationkey AS c_nationkey", "n_regionkey")
    regions = _read(spark, sf_dir, "region", "r_regionkey AS n_regionkey", "r_name AS region")
    counts = (
        orders.groupBy("o_custkey")
        .agg(F.count("*").alias("n"))
        .join(customers, "o_custkey")
        .join(nations, "c_nationkey")
        .join(regions, "n_regionkey")
        .select("o_custkey", "region", "n")
    )
    whole = F.count("*")
    return (
        with_total(counts, "o_custkey", "region", "n", "All")
        .groupBy("region")
        .agg(
            whole.alias("customers"),
            count_where(c("n") == 1).alias("one_order"),
            count_where(c("n") >= 3).alias("three_or_more"),
            ratio(count_where(c("n") == 1), whole, 100).alias("one_order_percent"),
        )
    )


def brand_types(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distinct part types of each brand as one ordered text."""
    return concat_distinct(
        _read(spark, sf_dir, "part", "p_brand", "p_type"), ["p_brand"], ["p_type"], LIST_SEPARATOR
    )


def quantity_spread(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Mean and population deviation per flag and status."""
    quantity = c("l_quantity")
    return (
        _read(spark, sf_dir, "lineitem", "l_returnflag", "l_linestatus", "l_quantity")
        .groupBy("l_returnflag", "l_linestatus")
        .agg(
            F.round(F.avg(quantity), 6).alias("avg_quantity"),
            F.round(F.stddev_pop(quantity), 6).alias("std_quantity"),
            F.sum(quantity).alias("sum_quantity"),
            count_where((quantity < 5) | (quantity > 45)).alias("outliers"),
            F.count("*").alias("lines"),
        )
    )


def branches_distinct(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two tagged branches appended, duplicates removed, then counted."""
    lines = _shipped(
        spark, sf_dir, AS_OF.day(-7), AS_OF.today, "l_orderkey", "l_partkey", "l_returnflag"
    ).select("l_orderkey", "l_partkey", "l_returnflag")
    box = lines.where(c("l_returnflag") == "R").withColumn("delivery_type", F.lit("Box"))
    home = lines.where(c("l_returnflag") != "R").withColumn("delivery_type", F.lit("Home"))
    return (
        home.unionByName(box)
        .distinct()
        .groupBy("delivery_type", "l_returnflag")
        .agg(F.count("*").alias("parcels"))
    )


def signups_clamped_by_month(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders per month, older than 12 months folded into the first one."""
    day = clamp_before(F.to_date("o_orderdate"), F.lit(AS_OF.day(months=-12)))
    return (
        _read(spark, sf_dir, "orders", "o_orderkey", "o_orderdate")
        .withColumn("day", day)
        .groupBy(F.year("day").alias("year"), F.month("day").alias("month"))
        .agg(F.count("o_orderkey").alias("orders"), F.min("day").alias("date"))
    )


# Time, text, JSON, points ---------------------------------------------------


def ship_calendar(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Calendar parts and week labels of every ship date."""
    day = c("day")
    return (
        _read(spark, sf_dir, "lineitem", "l_shipdate")
        .groupBy(F.to_date("l_shipdate").alias("day"))
        .agg(F.count("*").alias("lines"))
        .withColumn("weekday", F.upper(day_name(day)))
        .withColumn("week", week_label(day))
        .withColumn("iso_week", iso_week_label(day))
        .withColumn("month_before", F.add_months(day, -1))
        .withColumn("year", F.year(day))
    )


def local_event_times(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Local clock time by country code, cut-off arithmetic, seconds of day."""
    codes = F.array(*[F.lit(code) for code in ("SE", "NL", "FI", "DK", "BE", "US")])
    country = F.get(codes, (c("user_id") % 6).cast("int"))
    local = to_country_time(c("ts"), country)
    cutoff = c("ts") - F.make_dt_interval(secs=F.floor("value"))
    return (
        _read(spark, sf_dir, "events", "event_id", "user_id", "event_type", "ts", "value")
        .withColumn("country", country)
        .groupBy("event_type", "country")
        .agg(
            F.max(cutoff).alias("latest_cutoff"),
            F.min(clock_text(local)).alias("first_clock"),
            F.max(seconds_of_day(local)).alias("last_second"),
            F.count_distinct(F.to_date(local)).alias("local_days"),
        )
    )


def json_presence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events whose JSON path is set, by type."""
    value = F.get_json_object("props", "$.k").cast("int")
    return (
        _read(spark, sf_dir, "events", "event_type", "props")
        .groupBy("event_type")
        .agg(
            count_where(json_path_set(c("props"), "$.k")).alias("with_k"),
            count_where(json_path_set(c("props"), "$.missing")).alias("with_missing"),
            count_where(json_path_set(c("props"), "$.k") & (value < 50)).alias("small_k"),
        )
    )


def plate_folding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Normalize two texts, compare them, keep the smallest result per part."""
    lines = _read(spark, sf_dir, "lineitem", "l_partkey AS p_partkey", "l_suppkey")
    suppliers = _read(spark, sf_dir, "supplier", "s_suppkey AS l_suppkey", "s_name")
    seen = joined("", F.lit(" br-and #"), (c("l_suppkey") % 25).cast("string"))
    # Distinct pairs first: repeated lines of a pair compare equal.
    pairs = lines.distinct().join(suppliers, "l_suppkey")
    return (
        _read(spark, sf_dir, "part", "p_partkey", "p_brand")
        .join(pairs, "p_partkey")
        .groupBy("p_partkey")
        .agg(
            F.min(compare_text(comparable_plate(c("p_brand")), comparable_plate(seen))).alias(
                "valid"
            ),
            F.max(comparable_plate(c("p_brand"))).alias("plate"),
            F.min("s_name").alias("first_supplier"),
        )
    )


def embedding_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Points of vectors, y before x."""
    point = "named_struct('x', CAST(embedding[0] AS DOUBLE), 'y', CAST(embedding[1] AS DOUBLE))"
    return _read(spark, sf_dir, "embeddings", "vec_id", f"{point} AS coordinate").select(
        "vec_id", c("coordinate.y").alias("y"), c("coordinate.x").alias("x")
    )


# Windows and change logs ------------------------------------------------------


def _numbered_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events with a whole-second position, the order of a user's events."""
    return _read(spark, sf_dir, "events", "event_id", "user_id", "event_type", "ts").withColumn(
        "second", epoch_seconds(c("ts"))
    )


def previous_event(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every event with its user's event before it."""
    rows = previous_row(
        _numbered_events(spark, sf_dir),
        keys=["user_id"],
        order="second",
        tie_breaks=["ts", "event_id"],
        carry=["event_id", "ts", "event_type"],
        width=6 * 3600,
    )
    return rows.select(
        "event_id",
        "user_id",
        c("previous.event_id").alias("prev_event_id"),
        c("previous.ts").alias("prev_ts"),
        c("previous.event_type").alias("prev_type"),
    )


def arrival_differences(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Time of day against the previous event's, within three hours."""
    rows = previous_row(
        _numbered_events(spark, sf_dir),
        keys=["user_id"],
        order="second",
        tie_breaks=["ts", "event_id"],
        carry=["ts"],
        width=6 * 3600,
    )
    difference = seconds_of_day(c("ts")) - seconds_of_day(c("previous.ts"))
    return (
        rows.withColumn("late", difference)
        .where(F.abs("late") < 3 * 3600)
        .groupBy(F.to_date("ts").alias("day"), "event_type")
        .agg(
            F.round(F.avg("late") / 60, 6).alias("avg_minutes"),
            F.round(F.stddev_pop("late") / 60, 6).alias("std_minutes"),
            count_where(F.abs("late") > 1800).alias("count_fail"),
            F.count("late").alias("count_all"),
        )
    )


def slot_misses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Last purchase of a user's day against a slot six hours after its start."""
    window = F.expr("INTERVAL '6' HOUR"), F.expr("INTERVAL '12' HOUR")
    per_day = (
        _read(spark, sf_dir, "events", "user_id", "event_type", "ts")
        .groupBy("user_id", F.to_date("ts").alias("day"))
        .agg(
            F.min("ts").alias("first"),
            F.max(F.when(c("event_type") == "purchase", c("ts"))).alias("delivered"),
        )
    )
    missed = outside_window(
        c("delivered"), c("first") + window[0], c("first") + window[1], minutes=15
    )
    return per_day.groupBy("day").agg(
        count_where(missed).alias("not_ok"), F.count("*").alias("slots")
    )


def replicate_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Current state of a change log keyed by user; errors act as deletes."""
    return newest_changes(
        _read(spark, sf_dir, "events", "event_id", "user_id", "event_type", "ts", "value"),
        keys=["user_id"],
        order=["ts", "event_id"],
        deleted=c("event_type") == "error",
    )


def merge_change_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Old state plus a later change batch, then only the live rows."""
    log = _read(spark, sf_dir, "events", "event_id", "user_id", "event_type", "ts").withColumn(
        "gone", c("event_type") == "error"
    )
    cut = ts_lit(datetime(2024, 1, 15))
    keys, order = ["user_id"], ["ts", "event_id"]
    state = apply_changes(log.where(F.lit(False)), log.where(c("ts") < cut), keys, order)
    merged = apply_changes(state, log.where(c("ts") >= cut), keys, order)
    return live_rows(merged, "gone").drop("gone")


def replicate_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two tables of one manifest entry, replicated in batches that come out of order.

    Changes of a batch may be older than the state; marks are missing on some.
    """
    events = _read(spark, sf_dir, "events", "event_id", "user_id", "event_type", "ts")
    gone = F.when(c("event_type") == "error", True).when(c("event_type") != "signup", False)
    log = events.withColumn("gone", gone)
    parity = {"even_events": 0, "odd_events": 1}
    manifest = parse_manifest(["even_events:odd_events"], keys=("user_id",), order=("ts", "event_id"))
    folder = fresh_folder(spark, "replicated")
    paths: dict[str, str] = {}
    for batch in range(3):
        arrived = log.where(F.pmod(F.col("event_id") * 7, F.lit(3)) == batch)
        stored = dict(paths)

        def store(name: str, df: DataFrame, batch=batch) -> None:
            paths[name] = f"{folder}/{name}-{batch}"
            df.write.parquet(paths[name])

        replicate(
            manifest,
            lambda name, stored=stored: spark.read.parquet(stored[name]) if name in stored else None,
            lambda name, arrived=arrived: arrived.where(c("event_id") % 2 == parity[name]),
            store,
        )
    tables = [
        live_rows(spark.read.parquet(path), "gone").drop("gone").withColumn("table_name", F.lit(name))
        for name, path in paths.items()
    ]
    return tables[0].unionByName(tables[1])


QUERIES = {
    query.__name__: query
    for query in (
        whole_table,
        recent_key_bounds,
        range_split_counts,
        equal_share_reads,
        day_limits,
        text_predicates,
        page_prefixes,
        booked_lines_by_nation_day,
        cross_nation_lines,
        latest_line_per_part,
        customers_without_events,
        orders_never_returned,
        customer_event_flags,
        late_events_after_signup,
        cancellation_rate_by_ship_day,
        event_type_pivot,
        priority_pivot_by_nation,
        local_hour_buckets,
        order_counts_with_total,
        brand_types,
        quantity_spread,
        branches_distinct,
        signups_clamped_by_month,
        ship_calendar,
        local_event_times,
        json_presence,
        plate_folding,
        embedding_points,
        previous_event,
        arrival_differences,
        slot_misses,
        replicate_latest,
        replicate_manifest,
        merge_change_batch,
    )
}
