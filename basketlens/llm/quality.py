"""Quality rules per document, and verdicts on whole hosts from their documents' failures."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from basketlens.llm.arrays import mix, shingles_of, words_of
from basketlens.llm.frames import RUN_BYTES, SPACES, map_batches, runs
from basketlens.session import materialize

SYMBOLS = b"#*$%&|<>"
WIDTH = 5  # words in a repeated window

FEATURES = "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long"

# A host's rate lies between its own rate and that of all hosts. The weight of
# the latter, in documents, is kept within these bounds.
PRIOR_DOCUMENTS = (10.0, 10_000.0)
MAX_HOST_RATE = 0.5


def few_words() -> Column:
    return F.col("n_words") < 10


def repeated_words() -> Column:
    return 100 * F.col("n_repeat_words") > 20 * F.col("n_words")


def many_symbols() -> Column:
    return 100 * F.col("n_symbols") > 30 * F.col("word_chars")


# Failures that are counted per host: each has its own prior and verdict.
HOST_RULES: dict[str, Callable[[], Column]] = {
    "few_words": few_words,
    "repeated_words": repeated_words,
    "many_symbols": many_symbols,
}


def _duplicate_lines(text: str | None) -> int:
    lines = [line for line in (text or "").split("\n") if line.strip(SPACES)]
    return len(lines) - len(set(lines))


def _repeated_words(hashes: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Per row, the words that lie in a run of ``WIDTH`` words found twice or more in the row."""
    n_rows, n = len(starts) - 1, len(hashes)
    row = np.repeat(np.arange(n_rows), np.diff(starts))
    first = np.arange(n)
    full = first + WIDTH <= np.repeat(starts[1:], np.diff(starts))
    if not full.any():
        return np.zeros(n_rows, np.int64)
    runs_of = np.zeros(n, np.uint64)
    for j in range(WIDTH):
        runs_of = runs_of * np.uint64(0xD6E8FEB86659FD93) + hashes[np.minimum(first + j, n - 1)]
    first = first[full]
    key = mix(runs_of[full] + mix(row[full].astype(np.uint64)))
    order = np.argsort(key)
    same = key[order][1:] == key[order][:-1]
    twice = np.zeros(len(first), bool)
    twice[order[1:][same]] = True
    twice[order[:-1][same]] = True
    change = np.zeros(n + 1, np.int64)
    change[first[twice]] += 1
    change[first[twice] + WIDTH] -= 1
    covered = np.concatenate([[0], np.cumsum(np.cumsum(change[:-1]) > 0)])
    return covered[starts[1:]] - covered[starts[:-1]]


def document_features(docs: DataFrame, text: str = "text", keep: tuple[str, ...] = ("doc_id", "source")) -> DataFrame:
    """``keep`` and the counts the rules are made of, one row per row of ``docs``.

    ``n_words``; ``word_chars``, code points in words; ``n_symbols``;
    ``n_dup_lines``, lines with a word that equal an earlier line;
    ``n_repeat_words``, words in runs of five words found twice or more. A null
    or empty text has zeros. Whole texts are read; other columns are not looked
    at, so columns of any name may be there.
    """
    base = docs.select(*[F.col(c).alias(f"_k{i}") for i, c in enumerate(keep)], F.col(text).alias("_text"))
    keys = [f"_k{i}" for i in range(len(keep))]
    kinds = ", ".join(f"{k} {docs.schema[c].dataType.simpleString()}" for k, c in zip(keys, keep))

    def features(batch: pa.RecordBatch):
        column = batch.column("_text")
        lengths = pa.compute.fill_null(pa.compute.binary_length(column), 0).to_pylist()
        for low, high in runs(lengths, RUN_BYTES):
            part = column.slice(low, high - low)
            words = words_of(part, marks=SYMBOLS)
            yield {
                **{k: batch.column(k).slice(low, high - low) for k in keys},
                "n_words": np.diff(words.starts),
                "word_chars": words.characters,
                "n_symbols": words.marked,
                "n_dup_lines": [_duplicate_lines(t) for t in part.to_pylist()],
                "n_repeat_words": _repeated_words(words.hashes, words.starts),
            }

    counted = map_batches(base, features, f"{kinds}, {FEATURES}")
    return counted.select(*[F.col(k).alias(c) for k, c in zip(keys, keep)], *[f.split()[0] for f in FEATURES.split(", ")])


def host_rates(documents: DataFrame, host: str, failures: dict[str, Column]) -> DataFrame:
    """One row per non-null host: documents, failures of each rule, and the shrunken rates.

    The prior of a rule is a beta distribution with the mean and the variance
    that the hosts' own rates have, weighted by documents; ``PRIOR_DOCUMENTS``
    bounds its weight. Counts are summed per task before they are shuffled, so
    a host with most of the rows costs no more than any other.
    """
    sums = [F.sum(failed.cast("long")).alias(f"{name}_failed") for name, failed in failures.items()]
    hosts = materialize(
        documents.where(F.col(host).isNotNull()).groupBy(host).agg(F.count(F.lit(1)).alias("host_docs"), *sums),
        "hosts",
    )
    moments = [F.sum("host_docs").cast("double").alias("docs")]
    for name in failures:
        failed = F.col(f"{name}_failed").cast("double")
        moments.append(F.sum(failed).alias(f"{name}_sum"))
        moments.append(F.sum(failed * failed / F.col("host_docs")).alias(f"{name}_squares"))
    total = hosts.agg(*moments).first()  # one row of sums
    columns = {}
    for name in failures:
        docs = total["docs"] or 1.0
        mean = (total[f"{name}_sum"] or 0.0) / docs
        variance = (total[f"{name}_squares"] or 0.0) / docs - mean * mean
        low, high = PRIOR_DOCUMENTS
        weight = min(max(mean * (1 - mean) / variance - 1, low), high) if variance > 1e-12 else high
        columns[f"{name}_rate"] = (F.col(f"{name}_failed") + mean * weight) / (F.col("host_docs") + weight)
    return hosts.withColumns(columns)


def judge(features: DataFrame, host: str = "source", max_rate: float = MAX_HOST_RATE) -> DataFrame:
    """``features`` with ``base_failed``, ``host_failed`` and ``kept``.

    A host fails when one of its shrunken failure rates is over ``max_rate``;
    all its documents then go. Rows without a host are judged by their own
    counts alone. An empty table gives an empty table.
    """
    stored = materialize(features, "features")
    rates = host_rates(stored, host, {name: rule() for name, rule in HOST_RULES.items()})
    bad = rates.where(F.greatest(*[F.col(f"{name}_rate") for name in HOST_RULES]) > max_rate)
    verdicts = bad.select(F.col(host), F.lit(True).alias("host_failed"))
    failed = few_words() | repeated_words()
    return (
        stored.join(verdicts, host, "left")
        .withColumn("base_failed", failed)
        .withColumn("host_failed", F.coalesce("host_failed", F.lit(False)))
        .withColumn("kept", ~(F.col("base_failed") | F.col("host_failed")))
    )
