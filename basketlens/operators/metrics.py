"""Evaluation of labels: accuracy, classification report, silhouette, promotion gate."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from basketlens.functions.numeric import ratio


def accuracy(df: DataFrame, label: str, prediction: str) -> DataFrame:
    return df.agg(F.avg((F.col(label) == F.col(prediction)).cast("int")).alias("accuracy"))


def _safe(numerator: Column, denominator: Column) -> Column:
    return F.coalesce(ratio(numerator, denominator), F.lit(0.0))


def _f1(precision: Column, recall: Column) -> Column:
    return _safe(2 * precision * recall, precision + recall)


def class_scores(df: DataFrame, label: str, prediction: str) -> DataFrame:
    """Precision, recall, F1 and support per class from the confusion counts.

    The pair counts are aggregated first, so what follows works on at most
    classes x classes rows.
    """
    pairs = df.groupBy(F.col(label).alias("label"), F.col(prediction).alias("prediction")).agg(
        F.count(F.lit(1)).alias("rows")
    )
    sides = F.array(
        F.struct(F.col("label").alias("class"), F.col("rows").alias("actual"), F.lit(0).cast("long").alias("predicted")),
        F.struct(F.col("prediction").alias("class"), F.lit(0).cast("long").alias("actual"), F.col("rows").alias("predicted")),
    )
    hit = F.when(F.col("label") == F.col("prediction"), F.col("actual")).otherwise(0)
    totals = (
        pairs.select("label", "prediction", F.inline(sides))
        .groupBy("class")
        .agg(F.sum(hit).alias("hits"), F.sum("predicted").alias("predicted"), F.sum("actual").alias("support"))
    )
    precision, recall = _safe(F.col("hits"), F.col("predicted")), _safe(F.col("hits"), F.col("support"))
    return totals.select(
        "class",
        "hits",
        precision.alias("precision"),
        recall.alias("recall"),
        _f1(precision, recall).alias("f1"),
        "support",
    )


def classification_report(df: DataFrame, label: str, prediction: str) -> DataFrame:
    """One row per class, then ``accuracy``, ``macro avg`` and ``weighted avg``.

    The accuracy row carries the accuracy in all three score columns.
    """
    scores = class_scores(df, label, prediction)
    names = ("precision", "recall", "f1")
    support = F.sum("support")
    hits = F.sum("hits") / support
    summary = scores.agg(
        F.array(
            F.struct(F.lit("accuracy").alias("row"), *[hits.alias(n) for n in names], support.alias("support")),
            F.struct(F.lit("macro avg").alias("row"), *[F.avg(n).alias(n) for n in names], support.alias("support")),
            F.struct(
                F.lit("weighted avg").alias("row"),
                *[(F.sum(F.col(n) * F.col("support")) / support).alias(n) for n in names],
                support.alias("support"),
            ),
        ).alias("rows")
    ).select(F.inline("rows"))
    per_class = scores.select(F.col("class").cast("string").alias("row"), *names, "support")
    return per_class.unionByName(summary)


def binary_scores(df: DataFrame, keys: Sequence[str], label: str = "churn", prediction: str = "prediction") -> DataFrame:
    """Accuracy and class-1 scores per key, the columns of a model metrics table."""
    actual, predicted = F.col(label) == 1, F.col(prediction) == 1
    counts = df.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if(actual == predicted).alias("right"),
        F.count_if(actual & predicted).alias("hits"),
        F.count_if(predicted).alias("predicted"),
        F.count_if(actual).alias("actual"),
    )
    precision, recall = _safe(F.col("hits"), F.col("predicted")), _safe(F.col("hits"), F.col("actual"))
    return counts.select(
        *keys,
        (F.col("right") / F.col("n")).alias("accuracy"),
        precision.alias("churn_precision"),
        recall.alias("churn_recall"),
        _f1(precision, recall).alias("churn_f1"),
        (F.col("actual") / F.col("n")).alias("churn_rate"),
    )


def promotion_gate(metrics: DataFrame, order: str, score: str = "churn_f1", active: float = 0.0) -> DataFrame:
    """Flag every candidate whose score is at least that of the model active before it.

    A metrics table has a row per trained model, so one window over it is small.
    """
    earlier = Window.orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    in_use = F.greatest(F.lit(active), F.max(score).over(earlier))
    return (
        metrics.withColumn("active_score", F.coalesce(in_use, F.lit(active)))
        .withColumn("promoted", F.col(score) >= F.col("active_score"))
        .withColumn("in_production", _last_promoted(order))
    )


def _last_promoted(order: str) -> Column:
    everything = Window.partitionBy()
    return F.col(order) == F.max(F.when(F.col("promoted"), F.col(order))).over(everything)


# --- silhouette -------------------------------------------------------------


def silhouette_squared(points: DataFrame, features: Sequence[str], cluster: str = "cluster") -> DataFrame:
    """Mean silhouette under squared Euclidean distance, in linear time.

    The mean squared distance of x to a cluster is |x|^2 + E|y|^2 - 2 x.E[y],
    so a point needs only the sums of each cluster, not the other points. A
    cluster of one point scores 0. The cluster table has one row per cluster.
    """
    square = sum((F.col(name) * F.col(name) for name in features), F.lit(0.0))
    sums = points.groupBy(F.col(cluster).alias("cluster")).agg(
        F.count(F.lit(1)).alias("n"),
        F.avg(square).alias("mean_square"),
        F.array(*[F.avg(name) for name in features]).alias("centre"),
    )
    table = sums.agg(F.collect_list(F.struct("cluster", "n", "mean_square", "centre")).alias("t")).scalar()
    frame = points.select(F.col(cluster).alias("own"), *features).withColumn("clusters", table)

    def mean_distance(item: Column) -> Column:
        cross = sum(
            (F.col(name) * item.getField("centre")[index] for index, name in enumerate(features)), F.lit(0.0)
        )
        return square + item.getField("mean_square") - 2 * cross

    mine = F.filter("clusters", lambda item: item.getField("cluster") == F.col("own"))[0]
    size = mine.getField("n")
    inner = ratio(mean_distance(mine) * size, size - 1)  # without the point itself
    others = F.filter("clusters", lambda item: item.getField("cluster") != F.col("own"))
    outer = F.array_min(F.transform(others, mean_distance))
    scored = frame.select(inner.alias("a"), outer.alias("b"))
    value = _safe(F.col("b") - F.col("a"), F.greatest("a", "b"))
    return scored.agg(F.avg(F.when(F.col("a").isNull(), 0.0).otherwise(value)).alias("silhouette"))
