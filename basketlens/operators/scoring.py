"""Quartile scores per customer and the segments read off them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from basketlens.operators.quantiles import exact_quantiles, to_long
from basketlens.operators.ranking import global_row_number

QUARTILES = [0.25, 0.5, 0.75]


def _bin(value: Column, edges: list[Column]) -> Column:
    """1 to 4, bins closed on the right."""
    score = F.lit(1)
    for edge in edges:
        score = score + (value > edge).cast("int")
    return score


def frequency_rank(rfm: DataFrame) -> DataFrame:
    """Rank by frequency where equal values keep the order of the customer ids."""
    return global_row_number(rfm, ["frequency", "customer_id"], "frequency_rank")


def quartile_scores(rfm_wide: DataFrame, strict: bool = False) -> DataFrame:
    """``r_score`` (4 is the most recent), ``f_score`` (on the rank) and ``m_score``.

    With ``strict`` equal quartile edges raise an error, as there are then fewer
    than four bins; otherwise the empty bins are left out.
    """
    columns = ["customer_id", "recency", "frequency", "monetary"]
    ranked = frequency_rank(rfm_wide.select(*columns))
    edges = exact_quantiles(to_long(ranked, [], ["recency", "monetary"]), ["feature"], QUARTILES)
    of = {
        name: F.max(F.when(F.col("feature") == name, F.col("quantiles"))).alias(name)
        for name in ("recency", "monetary")
    }
    one_row = edges.agg(F.struct(*of.values(), F.max("n").alias("n")).alias("edges")).scalar()
    frame = ranked.withColumn("edges", one_row)

    def values(name: str) -> list[Column]:
        found = F.col("edges").getField(name)
        if strict:
            repeated = F.size(F.array_distinct(found)) < len(QUARTILES)
            found = F.when(repeated, F.raise_error(F.lit(f"{name}: quartile edges are not distinct"))).otherwise(found)
        return [found[index] for index in range(len(QUARTILES))]

    last = F.col("edges").getField("n") - 1
    rank_edges = [1 + last * F.lit(prob) for prob in QUARTILES]
    return frame.select(
        *columns,
        "frequency_rank",
        (5 - _bin(F.col("recency").cast("double"), values("recency"))).alias("r_score"),
        _bin(F.col("frequency_rank").cast("double"), rank_edges).alias("f_score"),
        _bin(F.col("monetary"), values("monetary")).alias("m_score"),
    )


def with_rfm_score(scores: DataFrame) -> DataFrame:
    text = [F.col(name).cast("string") for name in ("r_score", "f_score", "m_score")]
    return scores.withColumn("rfm_score", F.concat(*text))


def with_score_segment(scored: DataFrame, champions_last: bool = False) -> DataFrame:
    """Segment by score.

    The rules are assignments made one after the other and the frequency rules
    cover every row, so by default they hide ``champions`` and ``regular``.
    ``champions_last`` assigns champions after them.
    """
    top = F.col("rfm_score") == "444"
    by_frequency = F.when(F.col("f_score") >= 3, F.lit("loyal")).when(F.col("f_score") <= 2, F.lit("at_risk"))
    if champions_last:
        segment = F.when(top, F.lit("champions")).otherwise(by_frequency)
    else:
        segment = F.coalesce(by_frequency, F.when(top, F.lit("champions")))
    return scored.withColumn("segment", F.coalesce(segment, F.lit("regular")))
