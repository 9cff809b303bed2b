"""Dates and reporting periods."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

GRAINS = {"day": "DD", "week": "WEEK", "month": "MM", "year": "YEAR"}


def parse_date(c: Column, pattern: str = "yyyy/MM/dd") -> Column:
    """Date from text; null when it does not parse."""
    return F.try_to_date(c, pattern)


def month_key(c: Column) -> Column:
    return F.date_format(c, "yyyy-MM")


def padded_month(year: Column, month: Column) -> Column:
    """`yyyy-MM` from two numbers."""
    return F.concat_ws("-", year.cast("string"), F.lpad(month.cast("string"), 2, "0"))


def period_start(c: Column, grain: str) -> Column:
    """First day of the period. Grouping on a date is cheaper than on formatted text."""
    if grain not in GRAINS:
        raise ValueError(f"grain must be one of {sorted(GRAINS)}")
    return c.cast("date") if grain == "day" else F.trunc(c, GRAINS[grain])


def in_years(c: Column, first: int, last: int) -> Column:
    """Year text or number within bounds; unparsable years are not in it."""
    return F.coalesce(c.try_cast("int").between(first, last), F.lit(False))


def in_dates(c: Column, first: dt.date, last: dt.date) -> Column:
    """Both days included. Half-open bounds keep the whole last day of a timestamp and push down."""
    return (c >= F.lit(first)) & (c < F.lit(last + dt.timedelta(days=1)))


def month_bounds(year: int, first_month: int, last_month: int) -> tuple[dt.date, dt.date]:
    """First and last day of a run of months in one year."""
    after = dt.date(year + last_month // 12, last_month % 12 + 1, 1)
    return dt.date(year, first_month, 1), after - dt.timedelta(days=1)


def in_season(c: Column, first_month: int, last_month: int, years: Sequence[int]) -> Column:
    """The same run of months in each given year.

    Written as date ranges so that it prunes row groups; `month(c)` would not reach the scan.
    """
    ranges = [in_dates(c, *month_bounds(year, first_month, last_month)) for year in years]
    return reduce(lambda a, b: a | b, ranges)
