"""Retail transactions as a view over a star schema of order tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from basketlens.schemas import RAW_TRANSACTIONS, TRANSACTIONS


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")


def retail_transactions(spark: SparkSession, folder: str) -> DataFrame:
    """One row per order line.

    No join carries a hint: Spark broadcasts a dimension only when its size is
    under the broadcast threshold and sort-merges it (with skew splitting)
    beyond that. Line items meet parts first, on a key of their own, so that
    only the last join needs the order key.
    """
    lines = table(spark, folder, "lineitem").select(
        "l_orderkey", "l_partkey", "l_linenumber", "l_quantity", "l_returnflag"
    )
    parts = table(spark, folder, "part").select("p_partkey", "p_name", "p_size")
    buyers = (
        table(spark, folder, "customer")
        .join(table(spark, folder, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
        .select("c_custkey", "n_name")
    )
    orders = (
        table(spark, folder, "orders")
        .select("o_orderkey", "o_custkey", "o_orderdate")
        .join(buyers, F.col("o_custkey") == F.col("c_custkey"))
    )
    returned = (F.col("l_returnflag") == "R") & (F.col("l_linenumber") <= 2)
    order_text = F.col("l_orderkey").cast("string")
    return (
        lines.join(parts, F.col("l_partkey") == F.col("p_partkey"))
        .join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
        .select(
            F.when(returned, F.concat(F.lit("C"), order_text)).otherwise(order_text).alias("invoice_no"),
            F.col("l_partkey").cast("string").alias("stock_code"),
            F.when(F.col("l_partkey") % 50 != 0, F.col("p_name")).alias("description"),
            F.when(returned, -F.col("l_quantity"))
            .otherwise(F.col("l_quantity"))
            .cast("int")
            .alias("quantity"),
            F.timestamp_add(
                "HOUR", (F.col("o_orderkey") % 12 + 8).cast("int"), F.col("o_orderdate")
            ).alias("invoice_date"),
            (F.col("p_size") * F.lit(0.25)).alias("unit_price"),
            F.when(F.col("o_custkey") % 25 != 0, F.col("o_custkey").cast("string")).alias("customer_id"),
            F.col("n_name").alias("country"),
        )
    )


def raw_retail_transactions(spark: SparkSession, folder: str) -> DataFrame:
    """The same rows under the raw column names of a retail export."""
    named = retail_transactions(spark, folder)
    return named.select(
        *[
            F.col(field.name).alias(raw.name)
            for field, raw in zip(TRANSACTIONS.fields, RAW_TRANSACTIONS.fields)
        ]
    )


def purchase_events(events: DataFrame) -> DataFrame:
    """Read an event feed as transactions: ``purchase`` is a sale, ``error`` a cancellation.

    Works on a static and on a streaming frame. The event time becomes a
    zoned timestamp because watermarks accept no other kind.
    """
    cancelled = F.col("event_type") == "error"
    number = F.col("event_id").cast("string")
    return events.where(F.col("event_type").isin("purchase", "error")).select(
        F.when(cancelled, F.concat(F.lit("C"), number)).otherwise(number).alias("invoice_no"),
        F.col("event_type").alias("stock_code"),
        F.col("event_type").alias("description"),
        F.when(cancelled, -1).otherwise(1).alias("quantity"),
        F.col("ts").cast("timestamp").alias("invoice_date"),
        F.col("value").alias("unit_price"),
        F.col("user_id").cast("string").alias("customer_id"),
        F.lit("online").alias("country"),
    )
