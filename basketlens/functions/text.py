"""Text expressions."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from basketlens.constants import CAMEL_BOUNDARY, CANCELLATION_PREFIX, MISSING_INVOICE_TEXT


def snake_name(name: str) -> str:
    return re.sub(CAMEL_BOUNDARY, "_", name).lower()


def snake_text(col: Column) -> Column:
    """The same rule for values: ``CamelCase`` to ``camel_case``."""
    return F.lower(F.regexp_replace(col, CAMEL_BOUNDARY, "_"))


def invoice_text(col: Column) -> Column:
    return F.coalesce(col.cast("string"), F.lit(MISSING_INVOICE_TEXT))


def is_cancellation(invoice_no: Column) -> Column:
    return F.coalesce(F.startswith(invoice_no, F.lit(CANCELLATION_PREFIX)), F.lit(False))


def differs_ignoring_case(left: Column, right: Column) -> Column:
    """True unless both are the same text; a null counts as different from any text."""
    return ~F.lower(left).eqNullSafe(F.lower(right))


def money_text(col: Column) -> Column:
    return F.format_string("%.2f", col)


def percent_text(col: Column) -> Column:
    return F.format_string("%.1f%%", col * 100)
