"""Date helpers that stay on DATE / TIMESTAMP_NTZ, independent of the session time zone."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def month_start(day: Column) -> Column:
    return F.trunc(day, "month")


def month_index(day: Column) -> Column:
    """Months since year 0, so that a difference of two is a number of months."""
    return F.year(day) * 12 + F.month(day)


def days_between(start: Column, end: Column) -> Column:
    """Whole calendar days from `start` to `end`; NULL if either is missing."""
    return F.datediff(end.cast("date"), start.cast("date"))


def date_key(day: Column) -> Column:
    """YYYYMMDD as INT."""
    return F.year(day) * 10_000 + F.month(day) * 100 + F.dayofmonth(day)
