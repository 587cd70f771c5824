"""Churn labels and training frames from a temporal cutoff."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from basketlens.constants import CHURN_FEATURES, CUTOFF_DAYS
from basketlens.functions.temporal import days_before
from basketlens.operators import rfm


def cutoff_date(transactions: DataFrame, days: int = CUTOFF_DAYS) -> Column:
    return days_before(rfm.latest_date(transactions), days)


def split_at_cutoff(transactions: DataFrame, days: int = CUTOFF_DAYS) -> tuple[DataFrame, DataFrame]:
    """Rows before the cutoff, and rows at or after it."""
    cutoff = cutoff_date(transactions, days)
    moment = F.col("invoice_date")
    return transactions.where(moment < cutoff), transactions.where(moment >= cutoff)


def customers(df: DataFrame) -> DataFrame:
    return df.select("customer_id").where(F.col("customer_id").isNotNull()).distinct()


def churn_target(past: DataFrame, future: DataFrame) -> DataFrame:
    """1 for a past customer without a future row, for two frames of any origin."""
    active = customers(future).withColumn("active", F.lit(True))
    return (
        customers(past)
        .join(active, "customer_id", "left")
        .select("customer_id", F.col("active").isNull().cast("int").alias("churn"))
    )


def retained_customers(past: DataFrame, future: DataFrame) -> DataFrame:
    return customers(past).join(customers(future), "customer_id", "left_semi")


def churned_customers(past: DataFrame, future: DataFrame) -> DataFrame:
    return customers(past).join(customers(future), "customer_id", "left_anti")


def churn_target_at(transactions: DataFrame, days: int = CUTOFF_DAYS) -> DataFrame:
    """The same label for a cutoff in one table: first and last date decide, so no join."""
    dates = rfm.customer_dates(transactions)
    return (
        dates.where(F.col("customer_id").isNotNull())
        .withColumn("cutoff", days_before(rfm.latest_of(dates), days))
        .where(F.col("first_seen") < F.col("cutoff"))
        .select("customer_id", (F.col("last_seen") < F.col("cutoff")).cast("int").alias("churn"))
    )


def training_frames(transactions: DataFrame, cutoffs: Sequence[int] = (CUTOFF_DAYS,)) -> DataFrame:
    """Features before each cutoff with the churn label after it, all cutoffs in one scan.

    Recency and the trailing windows look back from the last row before the
    cutoff, not from the cutoff itself. Label and features share one aggregate:
    a customer with a row before the cutoff has churned when its last row of
    all is before the cutoff too.

    The lines are summed up and stored once; the dates and every cutoff are
    then worked out from the stored invoices.
    """
    moment = F.col("invoice_date")
    moments = rfm.stored_moments(transactions)
    latest = rfm.latest_date(moments)
    anchors = (
        moments.agg(
            F.struct(
                *[
                    F.max(F.when(moment < days_before(latest, days), moment)).alias(f"past_{days}")
                    for days in cutoffs
                ]
            ).alias("anchors")
        )
        .scalar()
    )
    windows = F.array(
        *[
            F.struct(
                F.lit(days).alias("cutoff_days"),
                days_before(F.col("latest"), days).alias("cutoff"),
                F.col("anchors").getField(f"past_{days}").alias("anchor_date"),
            )
            for days in cutoffs
        ]
    )
    rows = (
        moments.where(F.col("customer_id").isNotNull())
        .withColumns({"latest": latest, "anchors": anchors})
        .select(*moments.columns, F.inline(windows))
        .withColumn("past", moment < F.col("cutoff"))
    )
    keys = ["cutoff_days", "cutoff", "customer_id"]
    wide = rfm.wide_measures(rows, keys, F.col("anchor_date"), F.col("past"))
    wide = wide.where(F.col("last_seen").isNotNull())
    return rfm.finish_features(wide).select(
        "cutoff_days",
        "customer_id",
        *CHURN_FEATURES,
        (F.col("last_any") < F.col("cutoff")).cast("int").alias("churn"),
    )


def training_frame(transactions: DataFrame, days: int = CUTOFF_DAYS) -> DataFrame:
    return training_frames(transactions, [days]).drop("cutoff_days")


def features_with_target(features: DataFrame, target: DataFrame) -> DataFrame:
    return features.join(target, "customer_id", "inner")
