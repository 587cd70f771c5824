"""Per-customer state over all batches of a feed.

A micro-batch adds partial sums per customer; what they add up to is put
together when it is read (and by compaction), so state is a table, not memory,
and the order of arrival does not matter.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from basketlens.constants import DEFAULT_SHOPPING_HOUR
from basketlens.functions.text import is_cancellation

_HOURS = [f"hour_{hour:02d}" for hour in range(24)]
_MONEY = "decimal(38,6)"


def customer_sums(lines: DataFrame) -> DataFrame:
    """Last date, rows, cancelled rows, sales value and rows per hour of one batch's customers.

    Merged per partition before the shuffle, so a busy customer costs one row per partition.
    """
    value = F.col("quantity").cast("decimal(12,0)") * F.col("unit_price").cast("decimal(20,6)")
    hour = F.hour("invoice_date")
    return (
        lines.where(F.col("customer_id").isNotNull())
        .groupBy("customer_id")
        .agg(
            F.max("invoice_date").alias("last_seen"),
            F.count(F.lit(1)).alias("rows"),
            F.count_if(is_cancellation(F.col("invoice_no"))).alias("cancelled"),
            F.sum(F.when(F.col("quantity") > 0, value)).cast(_MONEY).alias("monetary"),
            *[F.count_if(hour == index).alias(name) for index, name in enumerate(_HOURS)],
        )
    )


def combined_sums(sums: DataFrame) -> DataFrame:
    return sums.groupBy("customer_id").agg(
        F.max("last_seen").alias("last_seen"),
        F.sum("rows").alias("rows"),
        F.sum("cancelled").alias("cancelled"),
        F.sum("monetary").cast(_MONEY).alias("monetary"),
        *[F.sum(name).alias(name) for name in _HOURS],
    )


def _busiest() -> Column:
    counts = F.array(*[F.col(name) for name in _HOURS])
    most = F.array_max(counts)
    return F.coalesce(F.when(most > 0, F.array_position(counts, most) - 1), F.lit(DEFAULT_SHOPPING_HOUR)).cast("int")


def customer_totals(sums: DataFrame) -> DataFrame:
    """State per customer over all batches; the value is rounded to cents once, at the end."""
    return combined_sums(sums).select(
        "customer_id",
        "last_seen",
        "rows",
        "cancelled",
        F.coalesce(F.round("monetary", 2), F.lit(0)).cast("double").alias("monetary"),
        _busiest().alias("preferred_shopping_hour"),
    )


def sale_invoices(lines: DataFrame) -> DataFrame:
    """Distinct sale invoices of one batch's customers."""
    sales = lines.where((F.col("quantity") > 0) & F.col("customer_id").isNotNull())
    return sales.select("customer_id", "invoice_no").distinct()


def customer_frequency(invoices: DataFrame) -> DataFrame:
    """Exact number of distinct sale invoices per customer over all batches."""
    distinct = invoices.select("customer_id", "invoice_no").distinct()
    return distinct.groupBy("customer_id").agg(F.count(F.lit(1)).alias("frequency"))
