"""Calendar arithmetic as column expressions."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MS_PER_DAY = 86_400_000
EPOCH = dt.date(1970, 1, 1)

DateLike = "dt.date | str | Column"


def as_date(value) -> Column:
    """A date column from a Python date, an ISO string or a column."""
    if isinstance(value, Column):
        return value
    return F.lit(value).cast("date")


def latest(df: DataFrame, column: str = "date") -> Column:
    """The maximum of ``column`` as a scalar subquery: one row, computed once per query."""
    return df.agg(F.max(column)).scalar()


def resolve_as_of(as_of, df: DataFrame, column: str = "date") -> Column:
    """``as_of`` if given, else the latest date in ``df``."""
    return latest(df, column) if as_of is None else as_date(as_of)


def millis_to_date(ms: Column) -> Column:
    """UTC calendar date of epoch milliseconds, whatever the session time zone is."""
    return F.date_add(F.lit(EPOCH), F.floor(ms / F.lit(MS_PER_DAY)).cast("int"))


def date_id(date: Column) -> Column:
    """yyyymmdd as a long."""
    return (F.year(date) * 10000 + F.month(date) * 100 + F.day(date)).cast("long")


def date_of(date_id: Column) -> Column:
    """The date of a yyyymmdd number."""
    return F.make_date(F.floor(date_id / 10000).cast("int"), F.floor(date_id / 100).cast("int") % 100, (date_id % 100).cast("int"))


def in_dates(rows: DataFrame, first=None, last=None) -> DataFrame:
    """Rows whose ``date_id`` lies between two dates (both included, either may be None): a range of numbers that scans take."""
    if first is not None:
        rows = rows.where(F.col("date_id") >= date_id(as_date(first)))
    if last is not None:
        rows = rows.where(F.col("date_id") <= date_id(as_date(last)))
    return rows


def sunday_zero_dow(date: Column) -> Column:
    """Day of week with Sunday = 0."""
    return F.dayofweek(date) - 1


def month_index(date: Column) -> Column:
    """Months since year 0; differences are whole calendar months."""
    return F.year(date) * 12 + F.month(date)


def monthly_target(start: Column, offset: Column, day_of_month: int) -> Column:
    """``day_of_month`` of the month ``offset`` months after ``start`` (may precede start)."""
    if not 1 <= day_of_month <= 28:
        raise ValueError("day_of_month must be 1..28 so that it exists in every month")
    return F.date_add(F.add_months(F.trunc(start, "MM"), offset), day_of_month - 1)


def spine(start, end) -> Column:
    """Array of all calendar days from ``start`` to ``end``."""
    return F.sequence(as_date(start), as_date(end), F.expr("interval 1 day"))
