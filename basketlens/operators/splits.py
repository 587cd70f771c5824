"""Repeatable random splits.

A row's place is decided by ``md5(customer_id|seed)``, never by where the row
is stored, so the split is the same for any partitioning.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from basketlens.constants import SPLIT_SEED, TEST_FRACTION

_PREFIX = 4  # hex digits of a histogram: at most 65,536 counts per class
_FEW = 1000  # rows, at most, among which the last one is picked by sorting


def _draw(seed: int) -> Column:
    return F.md5(F.concat(F.col("customer_id"), F.lit(f"|{seed}")))


def threshold_split(
    df: DataFrame, test_fraction: float = TEST_FRACTION, seed: int = SPLIT_SEED
) -> DataFrame:
    """Add ``is_test``: row-local, no shuffle; the fraction holds on average."""
    limit = f"{int(test_fraction * 0xFFFFFFFF):08x}"
    return df.withColumn("is_test", F.substring(_draw(seed), 1, 8) < limit)


def exact_split(
    df: DataFrame,
    test_fraction: float = TEST_FRACTION,
    seed: int = SPLIT_SEED,
    stratify: str | Sequence[str] | None = None,
) -> DataFrame:
    """Add ``is_test`` for exactly ``ceil(test_fraction * n)`` rows, per class if ``stratify`` is given.

    The rows with the smallest draws are the test rows, a customer's rows of a class on one side. The
    last draw that is in is found by counting alone: a histogram of the draws' first digits, then of
    the next ones within the digits where the quota ends, until few rows are left there. Rows are then
    flagged where they are; none is moved or sorted. ``df`` is read a few times, so store it first.
    """
    classes = [stratify] if isinstance(stratify, str) else list(stratify or [])
    drawn = df.select(*classes, "customer_id", _draw(seed).alias("_draw"))
    ends = F.broadcast(_last_drawn(drawn, classes, test_fraction))  # one row per class
    same = [df[name].eqNullSafe(ends[f"_class_{name}"]) for name in classes] or [F.lit(True)]
    condition = same[0]
    for part in same[1:]:
        condition = condition & part
    own = F.struct(_draw(seed).alias("draw"), F.col("customer_id").alias("id"))
    inside = own <= F.struct(F.col("_last_draw").alias("draw"), F.col("_last_id").alias("id"))
    return df.join(ends, condition).withColumn("is_test", inside).select(*df.columns, "is_test")


def _last_drawn(drawn: DataFrame, classes: Sequence[str], fraction: float) -> DataFrame:
    """``_class_*, _last_draw, _last_id``: the last row of each class that is within its quota."""
    spark = drawn.sparkSession
    keys = [drawn.schema[name].dataType.simpleString() for name in classes]
    names = [f"_class_{name}" for name in classes]
    digits, found = 0, {}  # class -> (draw so far, rows still wanted, rows there)
    while True:
        width = digits + _PREFIX
        part = F.substring("_draw", 1, width).alias("_part")
        counts = _inside(drawn, classes, found, names, keys) if found else drawn
        counts = counts.groupBy(*classes, part).agg(F.count(F.lit(1)).alias("_rows"))
        before = Window.partitionBy(*classes).orderBy("_part").rowsBetween(Window.unboundedPreceding, Window.currentRow)
        whole = Window.partitionBy(*classes)
        running = counts.select(  # at most 65,536 rows per class
            *classes, "_part", "_rows", F.sum("_rows").over(before).alias("_upto"), F.sum("_rows").over(whole).alias("_all")
        )
        wanted = _quota(running, classes, found, names, keys, fraction)
        ends = running.join(F.broadcast(wanted), _matched(running, wanted, classes, names)).where(
            (F.col("_upto") >= F.col("_wanted")) & (F.col("_upto") - F.col("_rows") < F.col("_wanted"))
        )
        rows = ends.select(*classes, "_part", (F.col("_wanted") - F.col("_upto") + F.col("_rows")).alias("_left"), "_rows").collect()
        found = {tuple(row[: len(classes)]): (row["_part"], row["_left"], row["_rows"]) for row in rows}
        digits = width
        if digits >= 32 or all(size <= _FEW for _, _, size in found.values()):
            break
    last = _inside(drawn, classes, found, names, keys, also="_left")
    listed = last.groupBy(*classes).agg(
        F.array_sort(F.collect_set(F.struct("_draw", "customer_id"))).alias("_rows"), F.first("_left").alias("_left")
    )
    item = F.get("_rows", F.least(F.col("_left"), F.size("_rows")).cast("int") - 1)
    last = listed.select(
        *[F.col(name).alias(alias) for name, alias in zip(classes, names)],
        item["_draw"].alias("_last_draw"),
        item["customer_id"].alias("_last_id"),
    )
    return spark.createDataFrame(last.collect(), last.schema)


def _matched(left: DataFrame, right: DataFrame, classes: Sequence[str], names: Sequence[str]) -> Column:
    condition = F.lit(True)
    for name, alias in zip(classes, names):
        condition = condition & left[name].eqNullSafe(right[alias])
    return condition


def _table(spark, found: dict, names: Sequence[str], keys: Sequence[str]) -> DataFrame:
    schema = ", ".join([f"{name} {kind}" for name, kind in zip(names, keys)] + ["_start string", "_left long"])
    return spark.createDataFrame([(*key, part, left) for key, (part, left, _) in found.items()], schema)


def _inside(drawn: DataFrame, classes, found: dict, names, keys, also: str | None = None) -> DataFrame:
    """The rows of each class whose draw begins with the digits found so far."""
    table = F.broadcast(_table(drawn.sparkSession, found, names, keys))
    rows = drawn.join(table, _matched(drawn, table, classes, names)).where(F.startswith("_draw", "_start"))
    return rows.select(*drawn.columns, *([also] if also else []))


def _quota(running: DataFrame, classes, found: dict, names, keys, fraction: float) -> DataFrame:
    """``_class_*, _wanted``: rows wanted of each class, within the digits found so far."""
    if found:
        return _table(running.sparkSession, found, names, keys).select(*names, F.col("_left").alias("_wanted"))
    sizes = running.groupBy(*classes).agg(F.max("_all").alias("_all"))
    return sizes.select(
        *[F.col(name).alias(alias) for name, alias in zip(classes, names)], F.ceil(F.col("_all") * F.lit(fraction)).alias("_wanted")
    )


def train_test(split: DataFrame) -> tuple[DataFrame, DataFrame]:
    return split.where(~F.col("is_test")).drop("is_test"), split.where("is_test").drop("is_test")


def first_rows(df: DataFrame, order: str, n: int = 5) -> DataFrame:
    return df.orderBy(order).limit(n)
