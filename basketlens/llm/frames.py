"""Small Spark helpers the text operators share."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Word separators of every contract: space and the ASCII controls 9 to 13.
SPACES = " \t\n\x0b\x0c\r"

# Rows of a mapped batch are handled in runs of about this many bytes, so that
# working arrays stay small whatever the batch size.
RUN_BYTES = 1 << 20


def documents(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/documents.parquet")


def map_batches(
    df: DataFrame, function: Callable[[pa.RecordBatch], Iterable[dict[str, object]]], schema: str
) -> DataFrame:
    """``mapInArrow`` over a function from a record batch to column dictionaries.

    The function gets slices with about ``RUN_BYTES`` of text, so what it builds
    from them is bounded; only a longer row makes a larger slice.
    """
    names = df.sparkSession.createDataFrame([], schema).schema
    fields = pa.schema([(f.name, _arrow_type(f.dataType.typeName(), f.dataType)) for f in names])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low, high in runs(_lengths(batch)):
                for columns in function(batch.slice(low, high - low)):
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(columns[f.name], f.type) for f in fields], schema=fields
                    )

    return df.mapInArrow(run, schema)


def _lengths(batch: pa.RecordBatch) -> list[int]:
    """Bytes of text and binary values of every row, and a little for the row itself."""
    total = pa.array([16] * len(batch), pa.int64())
    for column in batch.columns:
        if pa.types.is_string(column.type) or pa.types.is_binary(column.type):
            total = pc.add(total, pc.fill_null(pc.cast(pc.binary_length(column), pa.int64()), 0))
    return total.to_pylist()


def _arrow_type(name: str, kind) -> pa.DataType:
    if name == "array":
        return pa.list_(_arrow_type(kind.elementType.typeName(), kind.elementType))
    return {
        "long": pa.int64(),
        "integer": pa.int32(),
        "double": pa.float64(),
        "boolean": pa.bool_(),
        "string": pa.string(),
        "binary": pa.binary(),
    }[name]


def runs(lengths: Iterable[int], limit: int = RUN_BYTES) -> Iterator[tuple[int, int]]:
    """Consecutive row ranges of about ``limit`` bytes, never empty; a longer row is alone."""
    start, total, at = 0, 0, -1
    for at, length in enumerate(lengths):
        if at > start and total + length > limit:
            yield start, at
            start, total = at, 0
        total += length
    if at >= start:
        yield start, at + 1


_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def ascii_lower(text: Column) -> Column:
    """``text`` with A-Z lower-cased and all else as it is; texts of ASCII alone take a fast path."""
    return F.when(F.octet_length(text) == F.length(text), F.lower(text)).otherwise(F.translate(text, _UPPER, _UPPER.lower()))


def n_words(text: Column) -> Column:
    """Number of runs of characters that are no word separators; null counts as none."""
    parts = F.split(F.trim(F.coalesce(text, F.lit("")), F.lit(SPACES)), "[ \\t-\\r]+")
    return F.when(F.trim(text, F.lit(SPACES)) != "", F.size(parts)).otherwise(0).cast("long")
