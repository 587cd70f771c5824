"""Bottom-k fingerprints of word shingles, as column expressions only.

A fingerprint is the ``k`` smallest distinct 64-bit hashes of a text's shingles,
sorted. Fingerprints of parts merge into the fingerprint of the whole, and two
of them estimate resemblance, containment and numbers of distinct shingles; with
fewer than ``k`` shingles everything is exact.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from basketlens.llm.frames import SPACES

K = 128
WIDTH = 5
_SPLITS = 64  # splits are looked up in two steps of this many


def shingle_hashes(text: Column, width: int = WIDTH) -> Column:
    """Hashes of all runs of ``width`` words of the lower-case text, in order.

    A text with fewer words has the run of all of them; without words, or null, none.
    """
    trimmed = F.trim(F.coalesce(F.lower(text), F.lit("")), F.lit(SPACES))
    words = F.transform(F.split(trimmed, "[ \\t-\\r]+"), lambda w: F.xxhash64(w))

    def runs(w: Column) -> Column:
        n = F.size(w)
        whole = F.array(F.aggregate(w, F.lit(42).cast("long"), lambda seed, x: F.xxhash64(seed, x)))
        each = F.transform(
            F.sequence(F.lit(0), F.greatest(n - width, F.lit(0))),
            lambda i: F.xxhash64(*[F.get(w, i + j) for j in range(width)]),
        )
        return F.when(n < width, whole).otherwise(each)

    # the one-element array binds the words, so that they are split once
    found = F.element_at(F.transform(F.array(words), runs), 1)
    return F.when(trimmed == "", F.array().cast("array<bigint>")).otherwise(found)


def smallest(hashes: Column, k: int = K) -> Column:
    return F.slice(F.sort_array(F.array_distinct(hashes)), 1, k)


def fingerprint(text: Column, k: int = K, width: int = WIDTH) -> Column:
    return smallest(shingle_hashes(text, width), k)


def merge(a: Column, b: Column, k: int = K) -> Column:
    """Fingerprint of the union of two sets of shingles."""
    return smallest(F.concat(a, b), k)


def merged(parts: DataFrame, keys: list[str], sketch: str, k: int = K) -> DataFrame:
    """Fingerprint of all parts with the same keys, as column ``sketch``; keys without hashes have none.

    Every task keeps its ``k`` smallest hashes per key before rows are moved.
    """
    each = parts.select(*keys, F.explode_outer(sketch).alias("_h"))
    place = F.row_number().over(Window.partitionBy(*keys).orderBy("_h"))
    first = each.dropDuplicates([*keys, "_h"]).withColumn("_place", place).where(F.col("_place") <= k + 1)
    return first.groupBy(*keys).agg(smallest(F.collect_list("_h"), k).alias(sketch))


def resemblance(a: Column, b: Column, k: int = K) -> Column:
    """Estimated shared part of the union; 1 for two empty sets."""
    union = merge(a, b, k)
    shared = F.size(F.array_intersect(F.array_intersect(a, b), union))
    return F.when(F.size(union) == 0, 1.0).otherwise(shared / F.greatest(F.size(union), F.lit(1)))


def distinct_count(a: Column, k: int = K) -> Column:
    """Estimated number of distinct shingles; exact below ``k``."""
    place = F.element_at(a, -1).cast("double") / 2.0**64 + 0.5  # of the k-th hash among all
    return F.when(F.size(a) < k, F.size(a).cast("double")).otherwise((k - 1) / place)


def containment(a: Column, b: Column, k: int = K) -> Column:
    """Estimated part of the shingles of ``a`` that ``b`` has; 1 for an empty ``a``."""
    shared = resemblance(a, b, k) * distinct_count(merge(a, b, k), k)
    return F.when(F.size(a) == 0, 1.0).otherwise(F.least(F.lit(1.0), shared / F.greatest(distinct_count(a, k), F.lit(1.0))))


def as_text(sketch: Column) -> Column:
    """A fingerprint as a string: its hashes as hexadecimal numbers of 16 digits."""
    return F.array_join(F.transform(sketch, lambda h: F.lpad(F.hex(h), 16, "0")), "")


def _bucket(key: Column, splits: list[float]) -> Column:
    """How many of the sorted ``splits`` are at most ``key``."""
    if not splits:
        return F.lit(0)
    every = F.array(*[F.lit(s) for s in splits])
    coarse = F.array(*[F.lit(s) for s in splits[_SPLITS - 1 :: _SPLITS]]) if len(splits) >= _SPLITS else F.array().cast("array<double>")
    skip = F.size(F.filter(coarse, lambda s: s <= key)) * _SPLITS
    return skip + F.size(F.filter(F.slice(every, skip + 1, _SPLITS), lambda s: s <= key))


def with_next(docs: DataFrame, key: str, columns: list[str], buckets: int) -> DataFrame:
    """``docs`` with ``next_<column>`` of the row that follows in order of ``key``; the first follows the last.

    Rows go to ``buckets`` ranges of the key, each range with a copy of the row
    that begins the next one, so texts are moved once and no task sees more than
    its range. Equal keys follow each other by ``_mark``, a hash of the row's
    columns; null keys come last. ``docs`` needs a ``_mark`` column.
    """
    shares = [i / buckets for i in range(1, buckets)]
    splits = sorted(set(docs.stat.approxQuantile(key, shares, 1 / (8 * buckets)) if shares else []))
    number = F.col(key).cast("double")
    placed = docs.withColumn("_bucket", F.when(number.isNull(), len(splits) + 1).otherwise(_bucket(number, splits)))
    # one row per range comes to the driver
    order = F.struct(F.col(key).isNull().alias("last"), F.col(key).alias("key"), F.col("_mark").alias("mark"))
    firsts = placed.groupBy("_bucket").agg(F.min(order).alias("first")).orderBy("_bucket").collect()
    before = [firsts[i - 1]["_bucket"] for i in range(len(firsts))]
    heads = docs.sparkSession.createDataFrame(
        [(r["first"]["key"], r["first"]["mark"], b) for r, b in zip(firsts, before)], f"_k {docs.schema[key].dataType.simpleString()}, _m bigint, _before int"
    )
    copied = placed.join(F.broadcast(heads), F.col(key).eqNullSafe(F.col("_k")) & (F.col("_mark") == F.col("_m")), "left")
    here = F.struct(F.col("_bucket").alias("bucket"), F.lit(False).alias("head"))
    there = F.struct(F.col("_before").cast("int").alias("bucket"), F.lit(True).alias("head"))
    both = F.when(F.col("_before").isNull(), F.array(here)).otherwise(F.array(here, there))
    spread = copied.withColumn("_to", F.explode(both)).select(*docs.columns, F.col("_to.bucket").alias("_bucket"), F.col("_to.head").alias("_head"))
    row = Window.partitionBy("_bucket").orderBy("_head", F.col(key).asc_nulls_last(), "_mark")
    led = spread.withColumns({f"next_{c}": F.lead(c).over(row) for c in columns})
    return led.where(~F.col("_head")).drop("_bucket", "_head")


def edited_pairs(docs: DataFrame, key: str = "doc_id", text: str = "text", k: int = K) -> DataFrame:
    """Per row of ``docs``: ``doc_id, n_chars, edited, sketch, edited_sketch, next_sketch``.

    The edited text has its last half replaced by the beginning of the next
    document's text. A null text is empty. Works for any number of rows; a
    single document is its own next one, and an empty table gives no rows.
    """
    partitions = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    body = F.coalesce(F.col(text), F.lit(""))
    base = docs.select(F.col(key).alias("doc_id"), body.alias("text"), F.xxhash64(body).alias("_mark")).withColumn(
        "sketch", fingerprint(F.col("text"), k)
    )
    pairs = with_next(base, "doc_id", ["text", "sketch"], min(4 * partitions, 4096))
    n = F.length("text")
    half = F.floor(n / 2).cast("int")
    edited = F.concat(F.substring(F.col("text"), F.lit(1), n - half), F.substring(F.col("next_text"), F.lit(1), half))
    return pairs.select(
        "doc_id", n.cast("long").alias("n_chars"), edited.alias("edited"), "sketch", F.col("next_sketch")
    ).withColumn("edited_sketch", fingerprint(F.col("edited"), k))
