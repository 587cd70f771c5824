"""Feature matrices: selection, log scaling, standard scaling, vectors, nearest centre."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def select_columns(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.select(*columns)


def log_scaled(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``log1p`` of the listed columns that the frame has; the others are skipped."""
    present = [name for name in columns if name in df.columns]
    return df.withColumns({name: F.log1p(F.col(name)) for name in present}) if present else df


def to_vectors(df: DataFrame, columns: Sequence[str], output: str = "features") -> DataFrame:
    """One dense vector per row; a null in any column is an error."""
    return VectorAssembler(inputCols=list(columns), outputCol=output, handleInvalid="error").transform(df)


def column_stats(df: DataFrame, columns: Sequence[str]) -> Column:
    """Mean and population deviation of each column as one struct scalar."""
    parts = [
        F.struct(F.avg(name).alias("mean"), F.stddev_pop(name).alias("deviation")).alias(name)
        for name in columns
    ]
    return df.agg(F.struct(*parts).alias("stats")).scalar()


def standard_scaled(df: DataFrame, columns: Sequence[str], fit_on: DataFrame | None = None) -> DataFrame:
    """Centre and divide by the population deviation; a constant column becomes 0."""
    stats = column_stats(df if fit_on is None else fit_on, columns)
    frame = df.withColumn("_stats", stats)

    def scaled(name: str) -> Column:
        entry = F.col("_stats").getField(name)
        centred = F.col(name) - entry.getField("mean")
        deviation = entry.getField("deviation")
        return F.when(deviation == 0, F.lit(0.0)).otherwise(centred / deviation)

    return frame.withColumns({name: scaled(name) for name in columns}).drop("_stats")


def nearest_centre(df: DataFrame, centres: DataFrame, features: Sequence[str]) -> DataFrame:
    """Assign the cluster whose centre is nearest, the lowest number on ties.

    ``centres`` has ``cluster`` and the feature columns, one row per cluster;
    it travels as one array value next to each row.
    """
    listed = centres.agg(
        F.array_sort(F.collect_list(F.struct("cluster", *features))).alias("c")
    ).scalar()
    frame = df.withColumn("_centres", listed)

    def distance(centre: Column) -> Column:
        parts = (
            (F.col(name) - centre.getField(name)) * (F.col(name) - centre.getField(name)) for name in features
        )
        return F.struct(sum(parts, F.lit(0.0)).alias("distance"), centre.getField("cluster").alias("cluster"))

    nearest = F.array_min(F.transform("_centres", distance))
    return frame.withColumn("cluster", nearest.getField("cluster")).drop("_centres")
