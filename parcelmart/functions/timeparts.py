"""Calendar and clock parts of date and timestamp columns."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column
from pyspark.sql import functions as F

from parcelmart.functions.vocabulary import COUNTRY_ZONES


def day_name(value: Column) -> Column:
    """Full English weekday name, e.g. ``Monday``."""
    return F.date_format(value, "EEEE")


def seconds_of_day(value: Column) -> Column:
    return F.hour(value) * 3600 + F.minute(value) * 60 + F.second(value)


def epoch_seconds(value: Column) -> Column:
    """Whole seconds since 1970 of a zone-free UTC time."""
    days = F.datediff(value, F.lit(date(1970, 1, 1))).cast("bigint")
    return days * 86400 + seconds_of_day(value)


def utc_of(seconds: Column) -> Column:
    """Zone-free UTC time of whole seconds since 1970."""
    return F.expr("TIMESTAMP_NTZ '1970-01-01 00:00:00'") + F.make_dt_interval(secs=seconds)


def clock_of_seconds(seconds: Column) -> Column:
    """``HH:mm`` of a number of seconds since midnight."""
    hours = F.floor(seconds / 3600).cast("string")
    minutes = F.floor((seconds % 3600) / 60).cast("string")
    return F.concat(F.lpad(hours, 2, "0"), F.lit(":"), F.lpad(minutes, 2, "0"))


def clock_text(value: Column) -> Column:
    """``HH:mm`` of a timestamp, whatever the session's time zone."""
    return clock_of_seconds(seconds_of_day(value))


def micros_text(value: Column) -> Column:
    """Timestamp with all six decimals, whatever the session's time zone."""
    text = value.cast("string")
    whole = F.when(F.length(text) == 19, F.concat(text, F.lit("."))).otherwise(text)
    return F.rpad(whole, 26, "0")


def to_zone(value: Column, zone: Column | str) -> Column:
    """UTC wall time to local wall time; a NULL zone gives NULL."""
    zone = F.lit(zone) if isinstance(zone, str) else zone
    return F.convert_timezone(F.lit("UTC"), zone, value)


def to_country_time(value: Column, country: Column) -> Column:
    """Local time by country code; countries without a zone stay in UTC."""
    zone = F.lit("UTC")
    for code, name in COUNTRY_ZONES.items():
        zone = F.when(country == code, name).otherwise(zone)
    return to_zone(value, zone)


def week_label(value: Column) -> Column:
    """``2021-W53`` style label: ISO week, year moved back for early January.

    Days of late December that belong to ISO week 1 keep their own year.
    """
    week = F.weekofyear(value)
    spill = (F.month(value) == 1) & (week > 5)
    return F.concat(
        (F.year(value) - F.when(spill, 1).otherwise(0)).cast("string"),
        F.lit("-W"),
        week.cast("string"),
    )


def iso_week_label(value: Column) -> Column:
    """The same label with the true ISO week-numbering year."""
    return F.concat(
        F.extract(F.lit("YEAROFWEEK"), value).cast("string"),
        F.lit("-W"),
        F.weekofyear(value).cast("string"),
    )


def week_year_label(value: Column) -> Column:
    """``W35-1998``: ISO week and plain calendar year."""
    return F.concat(
        F.lit("W"),
        F.weekofyear(value).cast("string"),
        F.lit("-"),
        F.year(value).cast("string"),
    )


def clamp_before(value: Column, floor: Column) -> Column:
    """Values before the floor (and missing ones) become the floor."""
    return F.when(value < floor, floor).otherwise(F.coalesce(value, floor))


def outside_window(value: Column, start: Column, stop: Column, minutes: int) -> Column:
    """True when more than ``minutes`` early or late; NULL when unknown."""
    slack = F.make_dt_interval(mins=F.lit(minutes))
    return (value > stop + slack) | (value < start - slack)
