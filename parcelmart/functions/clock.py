"""One explicit "now" per run, turned into literals the scans can push down."""

from __future__ import annotations

import calendar
from dataclasses import dataclass
from datetime import date, datetime, time, timedelta

from pyspark.sql import Column
from pyspark.sql import functions as F


def ts_lit(value: datetime | date) -> Column:
    """Zone-free timestamp literal; a date means its midnight."""
    if not isinstance(value, datetime):
        value = datetime.combine(value, time.min)
    return F.expr(f"TIMESTAMP_NTZ '{value.isoformat(sep=' ')}'")


def shift_months(day: date, months: int) -> date:
    """Calendar month shift; the day is clamped to the month's end."""
    index = day.year * 12 + day.month - 1 + months
    year, month = divmod(index, 12)
    month += 1
    return date(year, month, min(day.day, calendar.monthrange(year, month)[1]))


@dataclass(frozen=True)
class AsOf:
    """The UTC instant a mart is computed for."""

    now: datetime

    @property
    def today(self) -> date:
        return self.now.date()

    def day(self, days: int = 0, months: int = 0) -> date:
        return shift_months(self.today, months) + timedelta(days=days)

    def shift(self, **delta: float) -> datetime:
        return self.now + timedelta(**delta)

    def business_day(self, hours: int = 10) -> date:
        """A shift that runs past midnight still belongs to the day it began."""
        return self.shift(hours=-hours).date()
