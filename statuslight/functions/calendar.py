"""Months, whole days and fixed time formats."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

SECONDS = "yyyy-MM-dd HH:mm:ss"
MICROS = "yyyy-MM-dd HH:mm:ss.SSSSSS"


def month_of(value: Column) -> Column:
    """First day of the month of a date or timestamp, as a date."""
    return F.trunc(F.to_date(value), "month")


def as_of_date(as_of: dt.date | None) -> Column:
    return F.current_date() if as_of is None else F.lit(as_of)


def as_of_time(as_of: dt.date | None) -> Column:
    """Midnight at the start of ``as_of``, or now."""
    return F.localtimestamp() if as_of is None else F.lit(as_of).cast("timestamp_ntz")


def months_between_dates(first: Column, last: Column) -> Column:
    """Every month start from ``first`` to ``last``; NULL when the range is empty or open."""
    return F.when(first <= last, F.sequence(first, last, F.expr("INTERVAL 1 MONTH")))


def whole_days(start: Column, end: Column) -> Column:
    """Completed 24-hour periods from ``start`` to ``end``."""
    return F.timestamp_diff("DAY", start, end)


def seconds_text(value: Column) -> Column:
    return F.date_format(value, SECONDS)
