"""Mixing sources to target weights by entropy balancing, without Python on the rows.

Of all rates between 0 and ``MOST`` copies per document that give every source
its target of words, the ones closest to the rates before (one copy each, in
relative entropy) are tilted exponentially by a document's words:
``rate = MOST / (1 + exp(-(b + lambda_s * words / mean_s)))``. The multipliers
``lambda_s`` solve the convex dual; each is found by Newton steps whose sums are
taken in Spark, and a bracket keeps a step from leaving the range that is left.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from basketlens.llm.frames import n_words
from basketlens.operators.ranking import global_row_number
from basketlens.session import materialize

MOST = 3  # copies of a document at most
WEIGHTS = (5, 2, 1)

_BASE = -math.log(MOST - 1)  # a rate of one copy
_REACH = 1e6  # of the multipliers
_STEPS = 60
_CLOSE = 1e-4  # of a target


def sizes(docs: DataFrame, key: str = "doc_id", text: str = "text", source: str = "source") -> DataFrame:
    """``doc_id, source, size, _mark``; size is the words of the text, null has none."""
    return docs.select(
        F.col(key).alias("doc_id"),
        F.col(source).alias("source"),
        n_words(F.col(text)).alias("size"),
        F.xxhash64(F.col(key), F.col(text)).alias("_mark"),
    )


def source_targets(rows: DataFrame, weights: tuple[int, ...] = WEIGHTS) -> DataFrame:
    """``source, source_size, target`` per source, null being a source.

    Sources in code point order, null last, have the weights in turn. Together
    the targets are all words; a target stops at ``MOST`` times its source's
    size and what is over goes to the others by weight until none is above.
    """
    totals = rows.groupBy("source").agg(F.sum("size").alias("source_size"))
    place = global_row_number(totals, [F.col("source").asc_nulls_last()], "rank")
    weight = F.element_at(F.array(*[F.lit(w) for w in weights]), ((F.col("rank") - 1) % len(weights) + 1).cast("int"))
    sources = materialize(place.select("source", "source_size", weight.alias("weight")), "sources")
    most, level, known = F.col("source_size") * MOST, 0.0, None
    total = sources.agg(F.sum("source_size")).first()[0] or 0
    while True:  # each round caps at least one more source, or ends
        full = most <= F.col("weight") * F.lit(level)
        row = sources.agg(
            F.sum(F.when(full, most).otherwise(0)).alias("capped"),
            F.sum(F.when(full, 0).otherwise(F.col("weight"))).alias("open"),
            F.sum(full.cast("long")).alias("n"),
        ).first()
        if row["n"] == known or not row["open"]:
            break
        known, level = row["n"], (total - row["capped"]) / row["open"]
    target = F.least(most.cast("double"), F.col("weight") * F.lit(float(level)))
    return sources.select("source", "source_size", F.when(F.lit(row["open"] or 0) == 0, most.cast("double")).otherwise(target).alias("target"))


def _share(tilt: Column) -> Column:
    return 1 / (1 + F.exp(-(F.lit(_BASE) + tilt)))


def multipliers(rows: DataFrame, targets: DataFrame) -> DataFrame:
    """``source, target, source_size, mean, tilt`` with the dual's solution per source.

    The sums of a step depend on source and size alone, so rows are counted by
    both first; a source with a third of all rows is a few thousand counts.
    """
    cells = materialize(rows.where("size > 0").groupBy("source", "size").agg(F.count(F.lit(1)).alias("n")), "cells")
    means = cells.groupBy("source").agg((F.sum(F.col("size") * F.col("n")) / F.sum("n")).alias("mean"))
    state = materialize(
        targets.join(means, targets["source"].eqNullSafe(means["source"]), "left")
        .drop(means["source"])
        .withColumns({"tilt": F.lit(0.0), "low": F.lit(-_REACH), "high": F.lit(_REACH), "open": F.col("target") < F.col("source_size") * MOST * (1 - 1e-9)}),
        "tilts",
    )
    for _ in range(_STEPS):
        if state.where("open").isEmpty():
            break
        unit = F.col("size") / F.col("mean")
        share = _share(F.col("tilt") * unit)
        live = state.where("open").select(F.col("source").alias("_source"), "mean", "tilt")
        sums = (
            cells.join(live, F.col("source").eqNullSafe(F.col("_source")))
            .groupBy("_source")
            .agg(
                F.sum(MOST * share * F.col("size") * F.col("n")).alias("words"),
                F.sum(MOST * share * (1 - share) * unit * F.col("size") * F.col("n")).alias("slope"),
            )
        )
        miss = F.col("words") - F.col("target")
        low = F.when(miss < 0, F.col("tilt")).otherwise(F.col("low"))
        high = F.when(miss > 0, F.col("tilt")).otherwise(F.col("high"))
        newton = F.col("tilt") - miss / F.greatest(F.col("slope"), F.lit(1e-9))
        # outside the bracket: its middle, or a doubled step while a side is still unknown
        middle = (
            F.when(F.col("_high") >= _REACH, F.greatest(F.col("_low") * 2, F.lit(1.0)))
            .when(F.col("_low") <= -_REACH, F.least(F.col("_high") * 2, F.lit(-1.0)))
            .otherwise((F.col("_low") + F.col("_high")) / 2)
        )
        done = F.abs(miss) <= F.col("target") * _CLOSE
        stepped = (
            state.join(sums, F.col("source").eqNullSafe(F.col("_source")), "left")
            .withColumns({"_low": low, "_high": high, "_newton": newton})
            .withColumn("_next", F.when((F.col("_newton") > F.col("_low")) & (F.col("_newton") < F.col("_high")), F.col("_newton")).otherwise(middle))
            .withColumn("_more", F.col("open") & F.col("_source").isNotNull() & ~done | F.col("open") & F.col("source").isNull() & F.col("words").isNotNull() & ~done)
        )
        state = materialize(
            stepped.select(
                "source", "source_size", "target", "mean",
                F.when(F.col("_more"), F.round("_next", 9)).otherwise(F.col("tilt")).alias("tilt"),
                F.when(F.col("_more"), F.col("_low")).otherwise(F.col("low")).alias("low"),
                F.when(F.col("_more"), F.col("_high")).otherwise(F.col("high")).alias("high"),
                F.coalesce("_more", F.lit(False)).alias("open"),
            ),
            "tilts",
        )
    return state


def rated(rows: DataFrame, weights: tuple[int, ...] = WEIGHTS) -> DataFrame:
    """``rows`` with ``source_size``, ``target`` and ``rate``, the expected copies."""
    state = multipliers(rows, source_targets(rows, weights)).withColumnRenamed("source", "_source")
    full = F.col("target") >= F.col("source_size") * MOST * (1 - 1e-9)
    rate = F.when(F.col("size") == 0, 0.0).when(full, float(MOST)).otherwise(MOST * _share(F.col("tilt") * F.col("size") / F.col("mean")))
    return (
        rows.join(state, F.col("source").eqNullSafe(F.col("_source")))
        .withColumn("rate", rate)
        .drop("_source", "mean", "tilt", "low", "high", "open")
    )


def _extras(classes: DataFrame) -> DataFrame:
    """``source, _class, _extra, _can``: how many rows of a size class get one more copy.

    From the largest class of a source to its smallest, the words wanted plus
    those carried from the classes before are turned into copies of the class's
    mean size; what does not divide is carried on. A source has some hundred classes.
    """
    start = F.struct(F.lit(0.0).alias("carry"), F.array().cast("array<bigint>").alias("taken"))

    def step(state: Column, one: Column) -> Column:
        want = one["want"] + state["carry"]
        count = F.least(F.greatest(F.rint(want / one["mean"]), F.lit(0.0)), one["can"].cast("double"))
        count = F.coalesce(count, F.lit(0.0))
        return F.struct(
            (want - count * F.coalesce(one["mean"], F.lit(0.0))).alias("carry"),
            F.concat(state["taken"], F.array(count.cast("bigint"))).alias("taken"),
        )

    listed = classes.groupBy("source").agg(
        F.sort_array(F.collect_list(F.struct((-F.col("_class")).alias("order"), "want", "can", "mean"))).alias("_all")
    )
    taken = F.aggregate("_all", start, step, lambda state: state["taken"])
    return listed.select("source", F.inline(F.arrays_zip("_all", taken.alias("_n")))).select(
        "source", (-F.col("_all.order")).alias("_class"), F.col("_n").alias("_extra"), F.col("_all.can").alias("_can_all")
    )


def copies(rows: DataFrame, weights: tuple[int, ...] = WEIGHTS) -> DataFrame:
    """``rows`` with ``source_size``, ``target`` and the whole number of ``copies`` of every row.

    A rate's whole part is taken as it is. The rest is made up per source and
    size class by one more copy for rows evenly spaced in the class. Classes are
    counted per hash part first, so no task holds a source or a class. Documents
    without words have no copies. Equal rows may be swapped.
    """
    spark = rows.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    group = ["source", "_class", "_part"]
    whole = F.floor("rate")
    placed = materialize(
        rated(rows, weights).withColumns(
            {
                "_class": F.floor(F.log2(F.col("size") + 1) * 8).cast("int"),
                "_part": F.pmod(F.xxhash64("doc_id", "_mark"), F.lit(parts)),
                "_whole": whole,
                "_rest": (F.col("rate") - whole) * F.col("size"),
                "_can": ((whole < MOST) & (F.col("size") > 0)).cast("long"),
            }
        ),
        "rated",
    )
    counted = materialize(
        placed.groupBy(*group).agg(
            F.sum("_rest").alias("want"), F.sum("_can").alias("can"), F.sum(F.col("_can") * F.col("size")).alias("words")
        ),
        "classes",
    )
    classes = counted.groupBy("source", "_class").agg(
        F.sum("want").alias("want"), F.sum("can").alias("can"), F.try_divide(F.sum("words"), F.sum("can")).alias("mean")
    )
    before = Window.partitionBy("source", "_class").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counted.select(*group, F.coalesce(F.sum("can").over(before), F.lit(0)).alias("_offset"))
    extras = _extras(classes).withColumnsRenamed({"source": "_s", "_class": "_c"})
    plan = (
        offsets.join(extras, F.col("source").eqNullSafe(F.col("_s")) & (F.col("_class") == F.col("_c")))
        .select(F.col("source").alias("_s"), F.col("_class").alias("_c"), F.col("_part").alias("_p"), "_offset", "_extra", "_can_all")
    )
    same = F.col("source").eqNullSafe(F.col("_s")) & (F.col("_class") == F.col("_c")) & (F.col("_part") == F.col("_p"))
    within = Window.partitionBy(*group).orderBy("size", "_mark", "doc_id").rowsBetween(Window.unboundedPreceding, 0)
    upto = F.expr("(_offset + _running) * _extra div _can_all")
    without = F.expr("(_offset + _running - 1) * _extra div _can_all")
    more = F.when(F.col("_can") == 1, upto - without).otherwise(0)
    return (
        placed.withColumn("_running", F.sum("_can").over(within))
        .join(plan, same)
        .withColumn("copies", (F.col("_whole") + more).cast("long"))
        .select(*rows.columns, "source_size", "target", "copies")
    )


def mixed(docs: DataFrame, key: str = "doc_id", text: str = "text", source: str = "source", weights: tuple[int, ...] = WEIGHTS) -> DataFrame:
    """The rows of ``docs``, each as often as the mix takes it, with the columns of ``docs``.

    Texts are moved once, to meet their copies by key and text; rows that are
    equal in both share their copies in turn.
    """
    counted = copies(materialize(sizes(docs, key, text, source), "sizes"), weights)
    taken = counted.groupBy(F.col("doc_id").alias("_id"), F.col("_mark").alias("_same")).agg(F.collect_list("copies").alias("_copies"))
    mark = F.xxhash64(F.col(key), F.col(text))
    each = Window.partitionBy("_key", "_mark").orderBy("_mark")
    named = docs.select(F.struct(*docs.columns).alias("_row"), F.col(key).alias("_key"), mark.alias("_mark"))
    return (
        named.withColumn("_turn", F.row_number().over(each))
        .join(taken, F.col("_key").eqNullSafe(F.col("_id")) & (F.col("_mark") == F.col("_same")))
        .withColumn("_times", F.element_at("_copies", F.col("_turn")))
        .where("_times > 0")
        .select("_row", F.explode(F.sequence(F.lit(1), F.col("_times").cast("int"))).alias("_time"))
        .select("_row.*")
    )
