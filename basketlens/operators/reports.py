"""Reporting queries over transactions, features and prediction logs."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from basketlens.functions.numeric import round_half_even
from basketlens.operators.quantiles import exact_quantiles, to_long
from basketlens.operators.rfm import sales_metrics

# --- prediction logs --------------------------------------------------------


def total_rows(log: DataFrame, name: str = "total") -> DataFrame:
    return log.agg(F.count(F.lit(1)).alias(name))


def average_response_time(log: DataFrame) -> DataFrame:
    """Whole milliseconds, cut off rather than rounded; 0 for an empty log."""
    return log.agg(
        F.coalesce(F.avg("response_time_ms").cast("int"), F.lit(0)).alias("avg_response_time")
    )


def average_churn_probability(log: DataFrame) -> DataFrame:
    return log.agg(F.coalesce(F.avg("churn_probability"), F.lit(0.0)).alias("avg_churn_probability"))


def predictions_by_version(log: DataFrame) -> DataFrame:
    """Ordered by the number in the version; versions without one come last, by text."""
    return (
        log.groupBy("model_version")
        .agg(F.count(F.lit(1)).alias("predictions"))
        .orderBy(F.col("model_version").try_cast("int").asc_nulls_last(), "model_version")
    )


def segment_distribution(log: DataFrame) -> DataFrame:
    """Rows per label with their share of all rows."""
    counts = log.groupBy("label").agg(F.count(F.lit(1)).alias("count"))
    total = counts.agg(F.sum("count").alias("total")).scalar()
    return counts.select("label", "count", (F.col("count") / total).alias("share")).orderBy(
        F.desc("count"), "label"
    )


def latest_rows(log: DataFrame, n: int = 10) -> DataFrame:
    return log.orderBy(F.desc("created_at"), "request_id").limit(n)


def distinct_labels(log: DataFrame) -> DataFrame:
    return log.select("label").dropna().distinct().orderBy("label")


def in_segment(df: DataFrame, segment: str, column: str = "label") -> DataFrame:
    return df if segment == "All" else df.where(F.col(column) == segment)


# --- transactions -----------------------------------------------------------


def revenue_by_country(transactions: DataFrame, n: int = 10) -> DataFrame:
    return (
        transactions.groupBy("country")
        .agg(F.sum("order_value").alias("revenue"))
        .orderBy(F.desc("revenue"), "country")
        .limit(n)
    )


def revenue_by_month(transactions: DataFrame) -> DataFrame:
    return (
        transactions.groupBy("invoice_month")
        .agg(F.sum("order_value").alias("revenue"))
        .orderBy("invoice_month")
    )


def top_customers(transactions: DataFrame, n: int = 10) -> DataFrame:
    return (
        sales_metrics(transactions)
        .select("customer_id", F.col("monetary").alias("total_spend"))
        .orderBy(F.desc("total_spend"), "customer_id")
        .limit(n)
    )


def top_buyers(transactions: DataFrame, n: int = 10) -> DataFrame:
    """The ``n`` customers with the most spent on sales, with their invoices; sums of decimals, rounded once."""
    sales = transactions.where((F.col("quantity") > 0) & F.col("customer_id").isNotNull())
    value = F.col("quantity").cast("decimal(12,0)") * F.col("unit_price").cast("decimal(20,6)")
    invoices = sales.groupBy("customer_id", "invoice_no").agg(F.sum(value).alias("value"))
    return (
        invoices.groupBy("customer_id")
        .agg(F.round(F.sum("value"), 2).cast("double").alias("spend"), F.count(F.lit(1)).alias("invoices"))
        .orderBy(F.desc("spend"), "customer_id")
        .limit(n)
    )


def product_rollup(transactions: DataFrame) -> DataFrame:
    """Per described product: largest stock code (as text), largest price, sales lines."""
    return (
        transactions.where(F.col("description").isNotNull())
        .groupBy("description")
        .agg(
            F.max("stock_code").alias("stock_code"),
            F.max("unit_price").alias("unit_price"),
            F.count(F.lit(1)).alias("sales_volume"),
        )
    )


def cleaning_counts(transactions: DataFrame) -> DataFrame:
    """Rows before and after each cleaning step, in one aggregate."""
    known = F.col("customer_id").isNotNull()
    return transactions.agg(
        F.count(F.lit(1)).alias("loaded"),
        F.count_if(known).alias("with_customer"),
        F.count_if(known & F.coalesce(F.col("quantity") > 0, F.lit(False))).alias("clean"),
    )


def observed(df: DataFrame, name: str) -> tuple[DataFrame, Observation]:
    """Count rows as a side effect of whatever action runs over the frame later."""
    observation = Observation(name)
    return df.observe(observation, F.count(F.lit(1)).alias("rows")), observation


# --- features ---------------------------------------------------------------


def churn_shares(target: DataFrame) -> DataFrame:
    """Customers and share per class; the share of class 1 is the churn rate."""
    counts = target.groupBy("churn").agg(F.count(F.lit(1)).alias("customers"))
    total = counts.agg(F.sum("customers").alias("total")).scalar()
    return counts.select("churn", "customers", (F.col("customers") / total).alias("share"))


def feature_means(training: DataFrame, features: Sequence[str], by: str = "churn") -> DataFrame:
    return training.groupBy(by).agg(*[F.avg(name).alias(f"mean_{name}") for name in features])


def describe_features(df: DataFrame, features: Sequence[str]) -> DataFrame:
    """Count, mean, sample deviation, minimum, quartiles and maximum, one row per feature."""
    long = to_long(df, [], features)
    moments = long.groupBy("feature").agg(
        F.count("value").alias("count"),
        F.avg("value").alias("mean"),
        F.stddev_samp("value").alias("std"),
        F.min("value").alias("min"),
        F.max("value").alias("max"),
    )
    quartiles = exact_quantiles(long, ["feature"], [0.25, 0.5, 0.75])
    found = F.col("quantiles")
    return moments.join(quartiles, "feature", "left").select(
        "feature", "count", "mean", "std", "min",
        found[0].alias("q25"), found[1].alias("q50"), found[2].alias("q75"), "max",
    )


def _bin_of(value: Column, low: Column, width: Column, bins: int) -> Column:
    return F.least(F.lit(bins - 1), F.floor((value - low) / width)).cast("int")


def histogram(df: DataFrame, column: str, bins: int = 50) -> DataFrame:
    """Equal-width bins from minimum to maximum, empty bins included."""
    values = df.select(F.col(column).cast("double").alias("value")).where(F.col("value").isNotNull())
    edges = values.agg(
        F.struct(F.min("value").alias("low"), F.max("value").alias("high")).alias("edges")
    ).scalar()
    flat = F.col("edges.low") == F.col("edges.high")  # one value: a unit-wide range around it
    low = F.when(flat, F.col("edges.low") - 0.5).otherwise(F.col("edges.low"))
    width = F.when(flat, F.lit(1.0 / bins)).otherwise((F.col("edges.high") - F.col("edges.low")) / bins)
    counts = (
        values.withColumn("edges", edges)
        .groupBy(_bin_of(F.col("value"), low, width, bins).alias("bin"))
        .agg(F.count(F.lit(1)).alias("count"))
    )
    all_bins = df.sparkSession.range(bins).select(F.col("id").cast("int").alias("bin")).withColumn("edges", edges)
    return all_bins.join(F.broadcast(counts), "bin", "left").select(
        "bin",
        (low + F.col("bin") * width).alias("lower"),
        (low + (F.col("bin") + 1) * width).alias("upper"),
        F.coalesce("count", F.lit(0)).alias("count"),
    )


def box_stats(df: DataFrame, by: str, features: Sequence[str]) -> DataFrame:
    """Quartiles, whisker ends (within 1.5 interquartile ranges) and outliers per class and feature."""
    long = to_long(df, [by], features)
    found = F.col("quantiles")
    quartiles = exact_quantiles(long, [by, "feature"], [0.25, 0.5, 0.75]).select(
        by, "feature", found[0].alias("q1"), found[1].alias("median"), found[2].alias("q3")
    )
    reach = 1.5 * (F.col("q3") - F.col("q1"))
    low, high = F.col("q1") - reach, F.col("q3") + reach
    value = F.col("value")
    inside = (value >= low) & (value <= high)
    return (
        long.join(quartiles, [by, "feature"])
        .groupBy(by, "feature", "q1", "median", "q3")
        .agg(
            F.min(F.when(inside, value)).alias("whisker_low"),
            F.max(F.when(inside, value)).alias("whisker_high"),
            F.count_if(~inside).alias("outliers"),
        )
    )


def rounded(df: DataFrame, digits: int, *columns: str) -> DataFrame:
    return df.withColumns({name: round_half_even(F.col(name), digits) for name in columns})
