"""Number expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def round_half_even(col: Column, digits: int) -> Column:
    """Round the scaled value half to even (``round`` and ``bround`` go by the decimal text instead)."""
    scale = float(10**digits)
    return F.rint(col * F.lit(scale)) / F.lit(scale)


def number_or_zero(col: Column) -> Column:
    """Number, or 0.0 for null and for text that is no number."""
    return F.coalesce(col.try_cast("double"), F.lit(0.0))


def ratio(numerator: Column, denominator: Column) -> Column:
    """Division that gives null for a zero denominator."""
    return F.when(denominator != 0, numerator / denominator)


def money_sum(col: Column) -> Column:
    """Sum of a money column that does not depend on the order of the rows."""
    return F.sum(col.cast("decimal(18,2)")).cast("double")
