"""Date windows and calendars."""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def as_date(value: date | str) -> date:
    return value if isinstance(value, date) else date.fromisoformat(value)


def minus_days(value: date | str, n: int) -> date:
    return as_date(value) - timedelta(days=n)


def lookback(run_date: date | str, period: int) -> tuple[date, date]:
    """The ``period`` days that end the day before ``run_date``, both ends inclusive."""
    return minus_days(run_date, period), minus_days(run_date, 1)


def date_range(start: Column, end: Column) -> Column:
    """Array of every calendar day from start to end, both included."""
    return F.sequence(start, end, F.expr("interval 1 day"))


def in_days(col: Column, start: date | str, end: date | str, closed: bool = True) -> Column:
    """Day filter on a DATE column; ``closed=False`` leaves out the last day."""
    upper = col <= F.lit(as_date(end)) if closed else col < F.lit(as_date(end))
    return (col >= F.lit(as_date(start))) & upper


def in_days_ts(col: Column, start: date | str, end: date | str, closed: bool = True) -> Column:
    """Day filter on a TIMESTAMP column, written on the raw column so that scans can prune."""
    last = as_date(end) + timedelta(days=1 if closed else 0)
    return (col >= F.lit(as_date(start))) & (col < F.lit(last))


def calendar(bounds: DataFrame, start: str, end: str, day: str = "day") -> DataFrame:
    """One row per calendar day between the two date columns of each row of ``bounds``."""
    return bounds.withColumn(day, F.explode(date_range(F.col(start), F.col(end))))
