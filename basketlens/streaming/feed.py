"""Transaction feed: file source, ingest, removal of replayed rows."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from basketlens.operators.cleaning import clean_keep_returns
from basketlens.session import remove_folder, working_path
from basketlens.streaming import changelog
from basketlens.streaming.changelog import write_batch

SALTS = 16
DAY = "invoice_day"
COMPACT_EVERY = 16  # batches
_HASHES = ["_line_h", "_line_g"]

# Fields that tell two sales lines apart; the feed has no row ids of its own.
LINE_KEYS = ["invoice_no", "stock_code", "customer_id", "invoice_date", "quantity", "unit_price"]


def read_stream(
    spark: SparkSession, folder: str, schema: T.StructType, pattern: str = "*.parquet", files_per_batch: int = 1000
) -> DataFrame:
    """Files that appear in ``folder``, a bounded number of them per micro-batch."""
    return (
        spark.readStream.schema(schema)
        .option("maxFilesPerTrigger", files_per_batch)
        .option("pathGlobFilter", pattern)
        .parquet(folder)
    )


def ingest(stream: DataFrame) -> DataFrame:
    """Rows as they are appended to the transactions table: named, with a customer, returns kept."""
    return clean_keep_returns(stream)


def _without_copies(lines: DataFrame) -> DataFrame:
    """One row per line, in two steps: copies are reduced in each part first, so they need not all meet."""
    salted = lines.withColumn("_salt", F.spark_partition_id() % SALTS)
    return salted.dropDuplicates([*LINE_KEYS, "_salt"]).drop("_salt").dropDuplicates(LINE_KEYS)


def without_replays(
    base: str, compact_every: int = COMPACT_EVERY, grace: dt.timedelta = dt.timedelta(hours=1)
) -> Callable[[DataFrame, int], None]:
    """Batch writer: lines that were not stored before go to ``base/lines``.

    ``base/index`` has the day and a 128-bit hash of every stored line, sorted by day. A batch compares
    its own hashes with those of its days, however long ago they came, so nothing is dropped for being
    late; only on a hit are the stored lines of the days in question read, and compared by value. Lines
    and index are tables of batches that are combined every ``compact_every`` batches; what was combined
    is removed after ``grace``, so a batch lists and opens a bounded number of files. Lines without a date can not be compared and go to ``base/quarantine``.
    ``base/counts`` has, per batch, the rows that came, were kept, were repeated and were set aside.
    """

    def write(lines: DataFrame, batch: int) -> None:
        spark = lines.sparkSession
        if batch <= changelog.combined_upto(spark, f"{base}/index"):
            return  # run again after it was combined, which is done only when all its tables are written
        lines.persist()
        dated = lines.where(F.col("invoice_date").isNotNull()).withColumn(DAY, F.to_date("invoice_date"))
        working = working_path(spark, "fresh")
        once = _without_copies(dated).withColumns(_hashes())
        once.write.parquet(working)
        fresh = spark.read.schema(once.schema).parquet(working)
        kept, joined = _new_lines(spark, base, fresh, batch), working_path(spark, "new")
        if kept is not fresh:  # written twice below, so the comparison with the stored lines runs once
            kept.write.parquet(joined)
            kept = spark.read.schema(once.schema).parquet(joined)
        write_batch(kept.drop(*_HASHES).sortWithinPartitions(DAY), batch, f"{base}/lines")
        write_batch(kept.select(DAY, *_HASHES).sortWithinPartitions(DAY, *_HASHES), batch, f"{base}/index")
        write_batch(lines.where(F.col("invoice_date").isNull()), batch, f"{base}/quarantine")
        stored = spark.read.parquet(f"{base}/index").where(F.col(changelog.BATCH) == batch).count()
        total, aside = lines.agg(F.count(F.lit(1)), F.count_if(F.col("invoice_date").isNull())).first()
        counts = spark.createDataFrame(
            [(total, stored, total - stored - aside, aside)], "rows long, kept long, repeated long, aside long"
        )
        write_batch(counts, batch, f"{base}/counts")
        lines.unpersist()
        remove_folder(spark, working)
        remove_folder(spark, joined)
        if batch % compact_every == compact_every - 1:
            for table in ("lines", "index"):  # the index last: it says which batches are final
                changelog.compact(spark, f"{base}/{table}", _by_day)
                changelog.clean(spark, f"{base}/{table}", grace)

    return write


def _hashes() -> dict[str, Column]:
    """Two hashes over the fields that tell lines apart and over which of them are null."""
    absent = [F.col(name).isNull() for name in LINE_KEYS]
    return {name: F.xxhash64(F.lit(seed), *LINE_KEYS, *absent) for seed, name in enumerate(_HASHES)}


def _by_day(rows: DataFrame) -> DataFrame:
    """Rows in ranges of days, so that a read of some days skips the rest by the files' own statistics."""
    order = [DAY, *(name for name in _HASHES if name in rows.columns)]
    return rows.repartitionByRange(*order).sortWithinPartitions(*order)


def _new_lines(spark: SparkSession, base: str, fresh: DataFrame, batch: int) -> DataFrame:
    """The lines of ``fresh`` that no batch before has stored."""
    index = _before(spark, f"{base}/index", batch)
    span = fresh.agg(F.min(DAY), F.max(DAY)).first()
    if index is None or span[0] is None:
        return fresh
    known = index.where(F.col(DAY).between(*span))
    days = [row[0] for row in fresh.join(known, [DAY, *_HASHES], "left_semi").select(DAY).distinct().collect()]
    if not days:
        return fresh
    stored = _before(spark, f"{base}/lines", batch).where(F.col(DAY).isin(days))
    stored = stored.select(*[F.col(name).alias(f"_{name}") for name in LINE_KEYS])
    same = [F.col(name).eqNullSafe(F.col(f"_{name}")) for name in LINE_KEYS]
    return fresh.join(stored, reduce(and_, same), "left_anti")


def _before(spark: SparkSession, path: str, batch: int) -> DataFrame | None:
    """Rows of the batches before ``batch``; None if there is none."""
    try:
        return changelog.read_partials(spark, path, before=batch)
    except ValueError:  # the first batch
        return None


def stored_lines(spark: SparkSession, base: str) -> DataFrame:
    return changelog.read_partials(spark, f"{base}/lines").drop(DAY)
