"""Resampling of documents towards a target corpus by importance weights with a random draw.

Words are hashed to a bounded number of buckets, whose counts in both corpora give one gain
per bucket; the gains are an array that every task gets. A document's score is the floored mean
of its gains plus noise of its id, so taking the highest scores is a draw without replacement.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from basketlens.llm.frames import ascii_lower, map_batches
from basketlens.operators.ranking import global_row_number
from basketlens.session import materialize

BUCKETS = 10_000  # also the bound of the gains
LONGEST = 1  # words of the longest feature
MIN_WORDS = 20  # shorter documents are not drawn
PERCENT = 10  # drawn, of the documents long enough
SEED = 2024
PROBES = 15  # thresholds counted in one job, so that an interval shrinks to a sixteenth

_BREAKS = "[\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+"  # ASCII but digits and letters


def _buckets(text: Column, longest: int, buckets: int) -> tuple[Column, Column]:
    """Number of words, and the bucket of every run of 1 to ``longest`` words, repeats included."""
    words = F.transform(F.filter(F.split(F.coalesce(text, F.lit("")), _BREAKS), lambda word: word != ""), ascii_lower)

    def hashed(feature: Column) -> Column:
        return F.pmod(F.crc32(feature.cast("binary")), F.lit(buckets)).cast("int")

    def runs(width: int) -> Column:
        starts = F.when(F.size(words) >= width, F.sequence(F.lit(1), F.size(words) - (width - 1))).otherwise(F.array().cast("array<int>"))
        return F.transform(starts, lambda at: hashed(F.array_join(F.slice(words, at, F.lit(width)), " ")))

    found = F.transform(words, hashed)
    return F.size(words), F.concat(found, *[runs(width) for width in range(2, longest + 1)]) if longest > 1 else found


def featured(docs: DataFrame, longest: int = LONGEST, buckets: int = BUCKETS) -> DataFrame:
    """``doc_id, n_words, buckets`` of every row, and ``mark``, a hash of the text."""
    n_words, found = _buckets(F.col("text"), longest, buckets)
    return docs.select("doc_id", F.xxhash64("text").alias("mark"), n_words.alias("n_words"), found.alias("buckets"))


def bucket_gains(source: DataFrame, target: DataFrame, buckets: int = BUCKETS) -> np.ndarray:
    """One gain per bucket from the counts of all features of both corpora."""
    spark = source.sparkSession

    def counts(found: DataFrame, name: str) -> DataFrame:
        return found.select(F.explode("buckets").alias("bucket")).groupBy("bucket").agg(F.count(F.lit(1)).alias(name))

    both = (
        spark.range(buckets)
        .select(F.col("id").cast("int").alias("bucket"))
        .join(counts(source, "s"), "bucket", "left")
        .join(counts(target, "t"), "bucket", "left")
        .fillna(0, ["s", "t"])
    )
    sums = both.agg(F.sum("s").cast("double").alias("all_s"), F.sum("t").cast("double").alias("all_t"))
    s, t, size = F.col("s").cast("double"), F.col("t").cast("double"), F.lit(float(buckets))
    share = ((t + 1) * (F.col("all_s") + size)) / ((s + 1) * (F.col("all_t") + size))
    rows = both.join(F.broadcast(sums)).select("bucket", F.floor(F.lit(1000.0) * F.ln(share)).alias("gain"))  # one row of sums
    gains = np.zeros(buckets, np.int64)
    for row in rows.collect():  # one per bucket
        gains[row["bucket"]] = row["gain"]
    return gains


def scored(found: DataFrame, gains: np.ndarray, seed: int = SEED) -> DataFrame:
    """``doc_id, mark, n_words, n_features, weight, score`` of every row of ``featured``."""

    def weigh(batch: pa.RecordBatch):
        lists = batch.column("buckets")
        values, ends = np.asarray(lists.flatten()), np.cumsum(np.asarray(lists.value_lengths(), np.int64))
        sizes = np.diff(ends, prepend=0)
        sums = np.diff(np.concatenate([[0], np.cumsum(gains[values])])[ends], prepend=0)
        yield {
            "doc_id": batch.column("doc_id"),
            "mark": batch.column("mark"),
            "n_words": batch.column("n_words"),
            "n_features": sizes,
            "weight": np.where(sizes > 0, sums // np.maximum(sizes, 1), 0),
        }

    weighed = map_batches(found, weigh, "doc_id long, mark long, n_words integer, n_features long, weight long")
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))), 256)
    h = F.conv(F.substring(digest, 1, 8), 16, 10).cast("double")
    noise = F.floor(F.lit(-1000.0) * F.ln(-F.ln((h + 0.5) / F.lit(4294967296.0))))
    return weighed.withColumn("score", F.col("weight") + noise)


def _least(rows: DataFrame, reaches: Callable[[int], Column], wanted: int, low: int, high: int) -> int:
    """Smallest integer whose rows, ``reaches(value)``, are ``wanted`` or more; that of ``high`` are.

    Bisection with exact counts over all rows; one job counts ``PROBES`` thresholds.
    """
    while low < high:
        probes = sorted({low + (high - low) * part // (PROBES + 1) for part in range(1, PROBES + 1)} | {low})
        counts = rows.agg(*[F.count_if(reaches(value)).alias(f"c{at}") for at, value in enumerate(probes)]).first()
        enough = [value for at, value in enumerate(probes) if counts[at] >= wanted]
        short = [value for at, value in enumerate(probes) if counts[at] < wanted]
        high = min([high, *enough])
        low = max([low, *[value + 1 for value in short]])
    return high


def cutoff(rows: DataFrame, wanted: int) -> Column:
    """Condition that holds for the first ``wanted`` rows by score, then ``doc_id`` (null last), and for rows equal to the last.

    ``rows`` is a stored table with ``score`` and ``doc_id``; some ``wanted`` rows, one at least, must be there.
    """
    low, high = rows.agg(F.min("score"), F.max("score")).first()
    least = -_least(rows, lambda value: F.col("score") >= -value, wanted, -high, -low)
    above = rows.where(F.col("score") > least).count()
    tied = rows.where(F.col("score") == least)
    known, low, high = tied.agg(F.count("doc_id"), F.min("doc_id"), F.max("doc_id")).first()
    if known < wanted - above:
        return F.col("score") >= least
    last = _least(tied, lambda value: F.col("doc_id") <= value, wanted - above, low, high)
    return (F.col("score") > least) | ((F.col("score") == least) & F.coalesce(F.col("doc_id") <= last, F.lit(False)))


def resampled(
    docs: DataFrame,
    target: DataFrame,
    percent: int = PERCENT,
    min_words: int = MIN_WORDS,
    longest: int = LONGEST,
    buckets: int = BUCKETS,
    seed: int = SEED,
) -> DataFrame:
    """``doc_id, n_features, weight, score, rank`` of every row of ``docs``; ``rank`` is null for rows not drawn.

    Of the rows with ``min_words`` words or more, ``percent`` of a hundred are drawn, rounded down: the highest
    scores, ties to the smaller ``doc_id``, a null one last, then to the smaller hash of the text. Null and empty
    texts have no features, weight 0 and are never drawn. Repeated rows compete apart and tie; which of them is
    drawn makes no difference. A null ``doc_id`` has the noise of an empty id. Empty tables give no rows, and an
    empty target gains that prefer rare words.

    The scores are written once; the cut-off is found by counting over them, and only the drawn rows are sorted,
    in ranges.
    """
    found = materialize(featured(docs.select("doc_id", "text"), longest, buckets), "features")
    gains = bucket_gains(found, featured(target.select(F.lit(None).cast("long").alias("doc_id"), "text"), longest, buckets), buckets)
    scores = materialize(scored(found, gains, seed).withColumn("line", F.monotonically_increasing_id()), "scores")
    long_enough = scores.where(F.col("n_words") >= min_words)
    wanted = long_enough.count() * percent // 100
    names = ["doc_id", "n_features", "weight", "score"]
    if not wanted:
        return scores.select(*names, F.lit(None).cast("long").alias("rank"))
    drawn = (F.col("n_words") >= min_words) & cutoff(long_enough.select("doc_id", "score"), wanted)
    order = [F.desc("score"), F.asc_nulls_last("doc_id"), F.asc("mark"), F.asc("line")]
    ranked = global_row_number(scores.where(drawn).select(*names, "mark", "line"), order)
    place = F.when(F.col("rank") <= wanted, F.col("rank")).cast("long")
    rest = scores.where(~drawn).select(*names, F.lit(None).cast("long").alias("rank"))
    return ranked.select(*names, place.alias("rank")).unionByName(rest)
