"""Day and month forms of a date, and the half-open window every load is bound to."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

Day = dt.date | str


def as_day(value: Day) -> dt.date:
    """A plain date from a date, a datetime or ISO text."""
    if isinstance(value, dt.datetime):
        return value.date()
    if isinstance(value, dt.date):
        return value
    return dt.date.fromisoformat(value)


def next_day(day: Day) -> dt.date:
    return as_day(day) + dt.timedelta(days=1)


def month_window(month: int) -> tuple[dt.date, dt.date]:
    """First day of a month, given as 202501, and first day of the next."""
    year, number = divmod(month, 100)
    return dt.date(year, number, 1), dt.date(year + number // 12, number % 12 + 1, 1)


def in_window(column: Column, start: Day, end: Day) -> Column:
    """``start <= column < end``; works alike for dates and timestamps and reaches the scan."""
    return (column >= F.lit(as_day(start))) & (column < F.lit(as_day(end)))


def iso_day(date: Column) -> Column:
    """``yyyy-MM-dd``; the text form of a date, which takes no detour over a time zone."""
    return F.to_date(date).cast("string")


def yyyymm(date: Column) -> Column:
    return F.year(date) * F.lit(100) + F.month(date)
