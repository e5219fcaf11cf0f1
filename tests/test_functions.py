"""Column functions and clock arithmetic."""

from datetime import date, datetime

from pyspark.sql import functions as F

from parcelmart.functions.clock import AsOf, shift_months, ts_lit
from parcelmart.functions.predicates import billable, json_path_set, like_any_case, same_text
from parcelmart.functions.text import comparable_plate, compare_text, joined
from parcelmart.functions.timeparts import (
    clamp_before,
    clock_text,
    day_name,
    iso_week_label,
    micros_text,
    outside_window,
    seconds_of_day,
    to_country_time,
    to_zone,
    week_label,
)


def column(spark, values, kind, expression):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {kind}")
    return [row[0] for row in df.orderBy("i").select(expression(F.col("v"))).collect()]


def test_business_day_keeps_a_late_shift_on_the_day_before():
    assert AsOf(datetime(2024, 3, 5, 0, 30)).business_day() == date(2024, 3, 4)
    assert AsOf(datetime(2024, 3, 5, 9, 59)).business_day() == date(2024, 3, 4)
    assert AsOf(datetime(2024, 3, 5, 10, 30)).business_day() == date(2024, 3, 5)


def test_month_shift_clamps_to_the_last_day():
    assert shift_months(date(2024, 3, 31), -1) == date(2024, 2, 29)
    assert shift_months(date(2023, 1, 15), -12) == date(2022, 1, 15)
    assert AsOf(datetime(2024, 5, 31, 8)).day(days=1, months=-2) == date(2024, 4, 1)


def test_billable_is_strictly_after_the_deadline(spark):
    deadline = ts_lit(datetime(2024, 1, 1, 12))
    values = [
        datetime(2024, 1, 1, 11),
        datetime(2024, 1, 1, 12),
        datetime(2024, 1, 1, 12, 0, 1),
        None,
    ]
    plain = column(spark, values, "timestamp_ntz", lambda v: billable(v, deadline))
    assert plain == [False, False, True, True]
    kinds = ["LATE", "OTHER", None]
    after = ts_lit(datetime(2024, 1, 2))
    by_kind = column(
        spark,
        kinds,
        "string",
        lambda v: F.coalesce(billable(after, deadline, v, ["LATE"]), F.lit(False)),
    )
    assert by_kind == [True, False, False]


def test_local_hours_follow_daylight_saving(spark):
    values = [datetime(2024, 1, 10, 14, 59), datetime(2024, 7, 10, 14, 0)]
    hours = column(
        spark, values, "timestamp_ntz", lambda v: F.hour(to_zone(v, "Europe/Stockholm"))
    )
    assert hours == [15, 16]
    country = column(
        spark, ["SE", "FI", "US", None], "string",
        lambda v: F.hour(to_country_time(ts_lit(datetime(2024, 1, 10, 12)), v)),
    )
    assert country == [13, 14, 12, 12]


def test_week_labels_at_the_turn_of_the_year(spark):
    days = [date(2021, 1, 1), date(2024, 12, 30), date(2024, 6, 3)]
    assert column(spark, days, "date", week_label) == ["2020-W53", "2024-W1", "2024-W23"]
    assert column(spark, days, "date", iso_week_label) == ["2020-W53", "2025-W1", "2024-W23"]


def test_weekday_and_clock_texts(spark):
    assert column(spark, [date(2024, 6, 3)], "date", day_name) == ["Monday"]
    times = [datetime(2024, 6, 3, 7, 5, 9), datetime(2024, 6, 3, 23, 59, 59, 120)]
    assert column(spark, times, "timestamp_ntz", clock_text) == ["07:05", "23:59"]
    assert column(spark, times, "timestamp_ntz", seconds_of_day) == [25509, 86399]
    assert column(spark, times, "timestamp_ntz", micros_text) == [
        "2024-06-03 07:05:09.000000",
        "2024-06-03 23:59:59.000120",
    ]


def test_times_do_not_depend_on_the_session_zone(spark):
    gap = [datetime(2024, 3, 10, 2, 30)]
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        assert column(spark, gap, "timestamp_ntz", clock_text) == ["02:30"]
        assert column(spark, gap, "timestamp_ntz", micros_text) == ["2024-03-10 02:30:00.000000"]
        assert column(spark, gap, "timestamp_ntz", seconds_of_day) == [9000]
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_slot_tolerance_is_fifteen_minutes(spark):
    start, stop = ts_lit(datetime(2024, 1, 1, 10)), ts_lit(datetime(2024, 1, 1, 12))
    values = [
        datetime(2024, 1, 1, 9, 44),
        datetime(2024, 1, 1, 9, 46),
        datetime(2024, 1, 1, 12, 15),
        datetime(2024, 1, 1, 12, 16),
        None,
    ]
    assert column(
        spark, values, "timestamp_ntz", lambda v: outside_window(v, start, stop, 15)
    ) == [True, False, False, True, None]


def test_old_and_missing_days_are_clamped(spark):
    floor = F.lit(date(2024, 1, 1))
    values = [None, date(2020, 5, 1), date(2024, 1, 1), date(2024, 2, 2)]
    assert column(spark, values, "date", lambda v: clamp_before(v, floor)) == [
        date(2024, 1, 1),
        date(2024, 1, 1),
        date(2024, 1, 1),
        date(2024, 2, 2),
    ]


def test_json_path_null_missing_set_and_invalid(spark):
    values = ['{"a": {"b": null}}', '{"a": {}}', '{"a": {"b": 1}}', "{a", None]
    assert column(spark, values, "string", lambda v: json_path_set(v, "$.a.b")) == [
        False,
        False,
        True,
        False,
        False,
    ]


def test_text_comparisons(spark):
    values = ["Distribution", "DISTRIBUTION", "LOCKER", None]
    assert column(spark, values, "string", lambda v: same_text(v, "distribution")) == [
        True,
        True,
        False,
        None,
    ]
    names = ["Box Merchant 1", "box merchant", "Shop"]
    assert column(spark, names, "string", lambda v: like_any_case(v, "%BOX MERCHANT%")) == [
        True,
        True,
        False,
    ]


def test_plates_fold_blanks_dashes_and_zero(spark):
    values = [" ab-0 12 ", "ABO12", "AAA", "XYZ", None]
    planned = F.lit("AB012")
    assert column(
        spark, values, "string", lambda v: compare_text(comparable_plate(planned), comparable_plate(v))
    ) == [0, 0, 1, -1, None]


def test_joined_text_is_null_with_a_null_part(spark):
    assert column(spark, ["x", None], "string", lambda v: joined(" ", F.lit("a"), v)) == ["a x", None]
