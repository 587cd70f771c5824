"""Drift monitors over event-time windows.

A micro-batch adds its counts per window; the counts of all batches are summed
when the monitor is read. No row is too late, so there is no watermark, and none
is left out: rows without a date are counted as a window of their own.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from basketlens.constants import BASELINE_CANCEL_RATE, DRIFT_CANCEL_RATE
from basketlens.functions.numeric import round_half_even
from basketlens.functions.text import is_cancellation

# Half way between the usual and the drifting share of cancellations.
ALERT_ABOVE = (BASELINE_CANCEL_RATE + DRIFT_CANCEL_RATE) / 2


def cancellation_counts(lines: DataFrame, width: str = "1 day") -> DataFrame:
    """Rows and cancelled rows of one batch per tumbling window; those without a date are the window without a start."""
    cancelled = F.count_if(is_cancellation(F.col("invoice_no")))
    return _per_window(lines, F.window("invoice_date", width), [F.count(F.lit(1)).alias("rows"), cancelled.alias("cancelled")])


def _per_window(lines: DataFrame, window: Column, sums: list[Column]) -> DataFrame:
    """Sums per window, and of the rows that lie in none because they have no date, if there are any."""
    dated = lines.groupBy(window.alias("window")).agg(*sums).withColumn("window_start", F.col("window.start")).drop("window")
    undated = lines.where(F.col("invoice_date").isNull()).groupBy(F.lit(None).cast("timestamp").alias("window_start")).agg(*sums)
    return dated.unionByName(undated.withColumn("window_start", F.col("window_start").cast(dated.schema["window_start"].dataType)))


def combined_counts(counts: DataFrame) -> DataFrame:
    return counts.groupBy("window_start").agg(F.sum("rows").alias("rows"), F.sum("cancelled").alias("cancelled"))


def cancellation_rate(counts: DataFrame, alert_above: float = ALERT_ABOVE) -> DataFrame:
    """Share of cancelled rows per window over all batches, with an alert flag."""
    rate = F.col("cancelled") / F.col("rows")
    return combined_counts(counts).select(
        "window_start",
        "rows",
        "cancelled",
        round_half_even(rate, 4).alias("cancellation_rate"),
        (rate > alert_above).alias("alert"),
    )


def sales_sums(lines: DataFrame, width: str = "7 days", slide: str = "1 day") -> DataFrame:
    """Sums over the sales of one batch per sliding window; prices are summed as decimals."""
    price = F.col("unit_price").cast("decimal(20,6)")
    sums = [
        F.count(F.lit(1)).alias("sales"),
        F.sum("quantity").alias("units"),
        F.max("quantity").alias("largest"),
        F.sum(price).cast("decimal(38,6)").alias("price_sum"),
        F.max(price).alias("highest"),
    ]
    return _per_window(lines.where(F.col("quantity") > 0), F.window("invoice_date", width, slide), sums)


def combined_sums(sums: DataFrame) -> DataFrame:
    return sums.groupBy("window_start").agg(
        F.sum("sales").alias("sales"),
        F.sum("units").alias("units"),
        F.max("largest").alias("largest"),
        F.sum("price_sum").cast("decimal(38,6)").alias("price_sum"),
        F.max("highest").alias("highest"),
    )


def volume_drift(sums: DataFrame) -> DataFrame:
    """Size and price of sales per window over all batches."""
    return combined_sums(sums).select(
        "window_start",
        "sales",
        round_half_even(F.col("units") / F.col("sales"), 4).alias("mean_quantity"),
        F.col("largest").alias("max_quantity"),
        round_half_even(F.col("price_sum").cast("double") / F.col("sales"), 4).alias("mean_price"),
        F.col("highest").cast("double").alias("max_price"),
    )
