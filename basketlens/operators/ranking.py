"""Global ranks without a single-partition window."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from basketlens.session import materialize

_ROW_BITS = 33  # monotonically_increasing_id keeps the row number in its low 33 bits


def global_row_number(df: DataFrame, order: Sequence[str | Column], name: str = "rank") -> DataFrame:
    """1-based position of every row in the total order ``order``.

    Range partitions are sorted one by one; a row's position is its place in
    its partition plus the sizes of the partitions before. The placed rows are
    written out first, because a re-run task could otherwise place rows
    differently. ``order`` must be a total order for a repeatable result; as no
    two rows tie, a frequent first key is split over partitions like any other.
    """
    placed = (
        df.repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .withColumn("_place", F.monotonically_increasing_id())
    )
    stored = materialize(placed, "ranked")
    part = F.shiftright("_place", _ROW_BITS)
    within = F.col("_place").bitwiseAND(F.lit((1 << _ROW_BITS) - 1))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (  # one row per partition
        stored.groupBy(part.alias("_part"))
        .agg(F.count(F.lit(1)).alias("_rows"))
        .select("_part", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_offset"))
    )
    return (
        stored.withColumn("_part", part)
        .join(F.broadcast(offsets), "_part")
        .withColumn(name, F.col("_offset") + within + 1)
        .drop("_part", "_place", "_offset")
    )


def latest_per_key(
    df: DataFrame, keys: Sequence[str], newest: Sequence[str], keep: Sequence[str]
) -> DataFrame:
    """``keep`` columns of the row with the largest ``newest`` per key.

    An aggregate rather than a window: every partition sends at most one row
    per key, however many rows a key has.
    """
    best = F.max_by(F.struct(*keep), F.struct(*newest)).alias("_best")
    return df.groupBy(*keys).agg(best).select(*keys, "_best.*")
