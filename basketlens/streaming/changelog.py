"""Sinks that can take the same micro-batch twice.

Every batch owns the folder ``batch_id=<n>`` of a Parquet table and writes it
with dynamic partition overwrite, so a batch that is run again after a failure
replaces its own rows and nothing else. Batches are combined into runs, beside
the table, whose list is a log of versions.
"""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Callable, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from basketlens import manifest
from basketlens.session import remove_folder, subfolders

BATCH = "batch_id"
FANOUT = 4  # runs of one level that are combined into one of the next
FILE_ROWS = 1_000_000  # rows that go into a file of a run, about


def write_batch(rows: DataFrame, batch: int, path: str) -> None:
    (
        rows.withColumn(BATCH, F.lit(batch).cast("long"))
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(BATCH)
        .parquet(path)
    )


def start(
    stream: DataFrame,
    checkpoint: str,
    write: Callable[[DataFrame, int], None],
    mode: str = "append",
) -> StreamingQuery:
    """Process what is available and stop; run again to take up new files."""
    return (
        stream.writeStream.outputMode(mode)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .foreachBatch(write)
        .start()
    )


def append_to(path: str) -> Callable[[DataFrame, int], None]:
    return lambda rows, batch: write_batch(rows, batch, path)


def run(stream: DataFrame, base: str, mode: str = "append") -> str:
    """Run a stream to its end into the table ``base/rows``."""
    path = f"{base}/rows"
    start(stream, f"{base}/checkpoint", append_to(path), mode).awaitTermination()
    return path


def collect(stream: DataFrame, base: str, partial: Callable[[DataFrame], DataFrame]) -> str:
    """Run a stream to its end into ``base/rows``: every batch adds its own partial sums.

    Sums are put together when they are read, so a row counts in whatever order
    it comes, and a batch costs what it brings, not what came before.
    """
    path = f"{base}/rows"
    start(stream, f"{base}/checkpoint", lambda rows, batch: write_batch(partial(rows), batch, path)).awaitTermination()
    return path


def compact(spark: SparkSession, path: str, combine: Callable[[DataFrame], DataFrame]) -> None:
    """Combine the batches since the last time into one run; runs of one level, when they are many, into one of the next.

    ``combine`` may be applied again to what it returned. Runs are new folders, and the list of those in
    use is switched at once, so a reader has every row once, before and after. The files a read opens are
    bounded by the logarithm of the batches; ``clean`` removes what is not in use any more.
    """
    log = f"{path}-log"
    version, runs = manifest.current(spark, log)
    known = sorted((Run(*(row[name] for name in Run.__annotations__)) for row in runs), key=lambda run: run.low)
    upto = known[-1].high if known else -1
    fresh = _batches(spark, path, upto)
    last = fresh.agg(F.max(BATCH)).first()[0] if fresh is not None else None
    if last is None:
        return
    level, some = 0, []
    while len(known) >= FANOUT - 1 and all(run.level == level for run in known[1 - FANOUT :]):
        some = known[1 - FANOUT :] + some
        del known[1 - FANOUT :]
        level += 1
    parts = _union([*(spark.read.parquet(run.folder) for run in some), fresh.where(F.col(BATCH) <= last).drop(BATCH)])
    files = max(1, -(-parts.count() // FILE_ROWS))
    known.append(_written(combine(parts).coalesce(files), path, some[0].low if some else upto + 1, last, level))
    stamped = [(*vars(run).values(), dt.datetime.now(dt.timezone.utc)) for run in known]
    manifest.commit(spark.createDataFrame(stamped, f"{_RUN}, written timestamp"), log, version)


@dataclass
class Run:
    """Combined batches ``low`` to ``high`` in a folder of their own."""

    folder: str
    low: int
    high: int
    level: int


_RUN = "folder string, low long, high long, level int"


def _written(rows: DataFrame, path: str, low: int, high: int, level: int) -> Run:
    folder = f"{path}-runs/{low}-{high}-{uuid.uuid4().hex}"
    rows.write.parquet(folder)
    return Run(folder, low, high, level)


def _union(frames: Sequence[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b), frames)


def _batches(spark: SparkSession, path: str, after: int) -> DataFrame | None:
    """Rows of the batches after ``after``, with their batch; None if no batch folder is there."""
    try:
        return spark.read.parquet(path).where(F.col(BATCH) > after)
    except AnalysisException:  # no batch so far, or all were combined and removed
        return None


def combined_upto(spark: SparkSession, path: str) -> int:
    """The last batch that is part of a run, -1 if none is; such a batch is final."""
    return max((row["high"] for row in manifest.current(spark, f"{path}-log")[1]), default=-1)


def read_partials(spark: SparkSession, path: str, before: int | None = None) -> DataFrame:
    """Partial sums of all batches: the runs in use and the batches after them, up to the one before ``before``.

    The files are fixed when this is called; runs that are combined later are not missed, as long as
    ``clean`` grants the reader its time.
    """
    _, runs = manifest.current(spark, f"{path}-log")
    later = _batches(spark, path, max((run["high"] for run in runs), default=-1))
    frames = [spark.read.parquet(run["folder"]) for run in sorted(runs, key=lambda run: run["low"])]
    if later is not None:
        frames.append((later if before is None else later.where(F.col(BATCH) < before)).drop(BATCH))
    if not frames:
        raise ValueError(f"no batch in {path}")
    return _union(frames)


def clean(spark: SparkSession, path: str, grace: dt.timedelta = dt.timedelta(hours=1)) -> None:
    """Remove batches and runs that no reader can need who began within ``grace``.

    Kept are all versions of the list younger than ``grace``, the latest one before them, which a reader may have
    seen at the start of that time, and what they name.
    """
    log = f"{path}-log"
    table = manifest.history(spark, log)
    if table is None:
        return
    rows = table.collect()  # a few per version that is kept
    limit = dt.datetime.now() - grace
    versions = {row[manifest.VERSION]: row["written"] for row in rows}
    old = [number for number, written in versions.items() if written <= limit]
    first = max(old) if old else min(versions)
    kept = [row for row in rows if row[manifest.VERSION] >= first]
    gone = {row["folder"] for row in rows} - {row["folder"] for row in kept}
    for folder in sorted(gone):
        remove_folder(spark, folder)
    final = min(max(row["high"] for row in kept if row[manifest.VERSION] == number) for number in versions if number >= first)
    if old:
        for name in subfolders(spark, path):
            number = name.removeprefix(f"{BATCH}=")
            if number != name and number.isdigit() and int(number) <= final:
                remove_folder(spark, f"{path}/{name}")
    manifest.forget(spark, log, first)


def read_rows(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path).drop(BATCH)


def read_current(spark: SparkSession, path: str, keys: Sequence[str]) -> DataFrame:
    """Last version of each key of a table of updates."""
    table = spark.read.parquet(path)
    values = [name for name in table.columns if name not in (*keys, BATCH)]
    newest = F.max_by(F.struct(*values), BATCH).alias("_newest")
    return table.groupBy(*keys).agg(newest).select(*keys, "_newest.*")
