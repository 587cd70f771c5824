"""Date expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def days_before(moment: Column, days: int | Column) -> Column:
    if isinstance(days, int):
        return moment - F.expr(f"INTERVAL {days} DAYS")
    return moment - F.make_dt_interval(days=days)


def whole_days_between(start: Column, end: Column) -> Column:
    """Completed 24-hour days, so 23:00 to 01:00 the next day is 0."""
    return F.timestamp_diff("DAY", start, end).cast("int")
