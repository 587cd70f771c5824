"""Connected components of a table of links, by alternating star contractions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basketlens.session import materialize


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``node, component``: every linked node with the smallest node it can reach.

    Each round ties neighbours to the smallest node around (large star, then
    small star) and is written out; rounds grow with the logarithm of the
    longest path. Minima are taken per task before rows are moved.
    """
    edges = links.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).where("u <> v").distinct()
    edges = materialize(edges, "links")
    state = _state(edges)
    while state[0]:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.col("u"), F.min("v")).alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        large = materialize(large, "large")
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        joined = large.join(least, "u")
        small = joined.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(joined.select("u", F.col("m").alias("v")))
        edges = materialize(small.where("u <> v").distinct(), "links")
        after = _state(edges)
        if after == state:
            break
        state = after
    labels = edges.select(F.col("u").alias("node"), F.col("v").alias("component"))
    return labels.unionByName(edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v"))).first())
