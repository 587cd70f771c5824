"""Cluster profiles, rule labels and their attachment to rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from basketlens.constants import (
    DEFAULT_CLUSTER_LABELS,
    FREQUENT,
    FREQUENT_OVER,
    HIGH_VALUE,
    HIGH_VALUE_OVER,
    INACTIVE,
    INACTIVE_RECENCY_OVER,
    MEDIUM,
    UNKNOWN_SEGMENT,
)
from basketlens.functions.numeric import money_sum, round_half_even


def rule_label(recency: Column, frequency: Column, value: Column) -> Column:
    """First rule that holds wins."""
    return (
        F.when(recency > INACTIVE_RECENCY_OVER, F.lit(INACTIVE))
        .when(frequency > FREQUENT_OVER, F.lit(FREQUENT))
        .when(value > HIGH_VALUE_OVER, F.lit(HIGH_VALUE))
        .otherwise(F.lit(MEDIUM))
    )


def rule_cluster(rfm: DataFrame) -> DataFrame:
    """Cluster every customer by the rules themselves: 0 to 3 in rule order."""
    label = rule_label(F.col("recency"), F.col("frequency"), F.col("avg_order_value"))
    number = (
        F.when(label == INACTIVE, 0).when(label == FREQUENT, 1).when(label == HIGH_VALUE, 2).otherwise(3)
    )
    return rfm.withColumn("cluster", number)


def cluster_profile(clustered: DataFrame) -> DataFrame:
    """Size and rounded means per cluster."""
    value = money_sum(F.col("avg_order_value")) / F.count("avg_order_value")
    return clustered.groupBy("cluster").agg(
        F.count("customer_id").alias("customers"),
        round_half_even(F.avg("recency"), 2).alias("avg_recency"),
        round_half_even(F.avg("frequency"), 2).alias("avg_frequency"),
        round_half_even(value, 2).alias("avg_order_value"),
    )


def label_profile(profile: DataFrame) -> DataFrame:
    """The rules are applied to the rounded means of the profile."""
    label = rule_label(F.col("avg_recency"), F.col("avg_frequency"), F.col("avg_order_value"))
    return profile.withColumn("segment", label)


def with_segment(clustered: DataFrame, labelled: DataFrame) -> DataFrame:
    return clustered.join(labelled.select("cluster", "segment"), "cluster", "left")


def segment_customers(clustered: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rows with their segment, and the labelled profile behind it."""
    profile = label_profile(cluster_profile(clustered))
    return with_segment(clustered, profile), profile


def default_labels(spark) -> DataFrame:
    return spark.createDataFrame(list(DEFAULT_CLUSTER_LABELS.items()), "cluster int, segment string")


def label_predictions(predictions: DataFrame, labels: DataFrame | None = None) -> DataFrame:
    """Label predicted clusters; one without a label is ``Unknown``."""
    labels = default_labels(predictions.sparkSession) if labels is None else labels
    joined = predictions.join(labels.select("cluster", "segment"), "cluster", "left")
    return joined.select(
        *predictions.columns, F.coalesce("segment", F.lit(UNKNOWN_SEGMENT)).alias("label")
    )


def cluster_sizes(clustered: DataFrame) -> DataFrame:
    return clustered.groupBy("cluster").agg(F.count(F.lit(1)).alias("customers")).orderBy(
        F.desc("customers"), "cluster"
    )
