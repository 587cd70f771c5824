"""Exact quantiles without gathering a column in one task.

A sketch brackets each quantile first; its rank error is bounded. The second
pass joins the brackets to the rows before anything is moved: rows below and
above a bracket become a count and the value next to it, one row per task, and
only the distinct values inside, a small, fixed share, are shuffled. The result
is the linear interpolation between order statistics; an order statistic that a
bracket does not hold is an error, never a guess.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

_ACCURACY = 10_000  # sketch ranks are off by at most n / _ACCURACY
_SLACK = 3 / _ACCURACY


def to_long(df: DataFrame, keys: Sequence[str], features: Sequence[str]) -> DataFrame:
    """One row per key and feature, with the value as a double."""
    doubles = [F.col(name).cast("double").alias(name) for name in features]
    return df.select(*keys, *doubles).unpivot(list(keys), list(features), "feature", "value")


def exact_quantiles(long: DataFrame, keys: Sequence[str], probs: Sequence[float]) -> DataFrame:
    """Per key: row count ``n`` and ``quantiles``, an array in the order of ``probs``.

    Any number of keys; every key has one bracket per probability.
    """
    keys = list(keys)
    present = long.where(F.col("value").isNotNull()).select(*keys, "value")
    brackets = _brackets(present, keys, probs)
    side = F.when(F.col("value") < F.col("low"), -1).when(F.col("value") > F.col("high"), 1).otherwise(0)
    point = F.when(F.col("side") == 0, F.col("value"))
    counted = (
        present.join(brackets, keys)
        .withColumn("side", side)
        .groupBy(*keys, "item", "prob", "n", "side", point.alias("point"))
        .agg(F.count(F.lit(1)).alias("weight"), F.min("value").alias("least"), F.max("value").alias("most"))
        .withColumn("value", F.when(F.col("side") == -1, F.col("most")).otherwise(F.col("least")))
    )
    upto = Window.partitionBy(*keys, "item").orderBy("value")
    position = (F.col("n") - 1) * F.col("prob")
    ranked = counted.withColumn("upto", F.sum("weight").over(upto))

    def at(rank: Column) -> Column:
        # of the rows outside, only the one next to the bracket is known by value
        known = (
            (F.col("side") == 0)
            | (F.col("side") == -1) & (rank == F.col("upto") - 1)
            | (F.col("side") == 1) & (rank == F.col("upto") - F.col("weight"))
        )
        first = F.min(F.when(F.col("upto") > rank, F.struct("upto", "value", known.alias("known"))))
        return F.when(first["known"], first["value"]).otherwise(F.raise_error(F.lit("a quantile lies outside its bracket")))

    picked = ranked.groupBy(*keys, "item", "prob", "n").agg(
        at(F.floor(position)).alias("lower"), at(F.ceil(position)).alias("upper")
    )
    share = position - F.floor(position)
    value = F.col("lower") + (F.col("upper") - F.col("lower")) * share
    listed = picked.groupBy(*keys, "n").agg(
        F.sort_array(F.collect_list(F.struct("item", value.alias("value")))).alias("items")
    )
    return listed.select(*keys, "n", F.col("items.value").alias("quantiles"))


def _brackets(present: DataFrame, keys: list[str], probs: Sequence[float]) -> DataFrame:
    lows = F.array(*[F.lit(max(p - _SLACK, 0.0)) for p in probs])
    highs = F.array(*[F.lit(min(p + _SLACK, 1.0)) for p in probs])
    summary = present.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n"),
        F.percentile_approx("value", lows, _ACCURACY).alias("lows"),
        F.percentile_approx("value", highs, _ACCURACY).alias("highs"),
    )
    items = F.array(
        *[
            F.struct(
                F.lit(index).alias("item"),
                F.lit(float(prob)).alias("prob"),
                F.col("lows")[index].alias("low"),
                F.col("highs")[index].alias("high"),
            )
            for index, prob in enumerate(probs)
        ]
    )
    return summary.select(*keys, "n", F.inline(items))
