"""Silhouette under plain Euclidean distance, with a bound of its error, in linear time.

The mean distance of a row to a cluster needs all pairs. Here the rows of a cluster are summed up in
cells of a tree of ever finer grids: count n, mean c and mean squared distance v to the mean. By
Jensen's inequality the mean distance of x to the rows of a cell lies between |x - c| and
sqrt(|x - c|^2 + v), so every row has bounds of its distance to each cluster and of its silhouette.
A cell is opened into finer ones only if its n * v is large, as that is what the bounds lose.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basketlens.plans.lloyd import distances, summed
from basketlens.session import materialize

LEVELS = 12  # halvings of a side down to the finest cells, whose side is RANGE / 2**LEVELS
STEP = 2  # halvings at once when a cell is opened
RANGE = 16.0  # deviations covered; rows beyond lie in the outermost cells
CELLS = 2_000  # cells opened of a level are at most so many; fewer rows are told apart as far as the finest cells do
_HELD = 1 << 21  # distances held at once


Settings = Sequence[np.ndarray] | None


def _owned(chunk: np.ndarray, settings: Settings) -> tuple[np.ndarray, list[np.ndarray]]:
    """Values of the rows, and their cluster in every setting; without settings the last value is the cluster."""
    if settings is None:
        return chunk[:, :-1], [chunk[:, -1].astype(np.int64)]
    return chunk, [distances(chunk, centres).argmin(axis=1) for centres in settings]


def _finest(rows: DataFrame, settings: Settings, width: int) -> DataFrame:
    """Sums of the rows of every (setting, cluster, finest cell), stored.

    Rows are summed up per batch before they leave a task.
    """
    side = RANGE / 2**LEVELS

    def run(batches):
        import pandas as pd

        for batch in batches:
            column = batch.column(0)
            if not len(column):
                continue
            values, owners = _owned(np.asarray(column.flatten()).reshape(len(column), -1), settings)
            cells = np.clip(np.floor((values + RANGE / 2) / side), 0, 2**LEVELS - 1).astype(np.int64)
            for at, own in enumerate(owners):
                frame = pd.DataFrame(np.column_stack([own, cells]), columns=["cluster", *[f"i{j}" for j in range(width)]])
                names = list(frame.columns)
                for j in range(width):
                    frame[f"s{j}"] = values[:, j]
                frame["square"] = (values**2).sum(axis=1)
                frame["n"] = 1
                total = frame.groupby(names, as_index=False).sum()
                total.insert(0, "setting", at)
                yield pa.RecordBatch.from_pandas(total, preserve_index=False)

    indexes, sums = [f"i{j}" for j in range(width)], [f"s{j}" for j in range(width)]
    schema = "setting long, cluster long, " + ", ".join([f"{i} long" for i in indexes] + [f"{s} double" for s in sums]) + ", square double, n long"
    keys = ["setting", "cluster", *indexes]
    return materialize(rows.mapInArrow(run, schema).groupBy(*keys).agg(*[F.sum(c).alias(c) for c in [*sums, "square", "n"]]), "cells")


def _frontier(finest: DataFrame, width: int) -> dict[int, np.ndarray]:
    """Per setting, ``cluster, n, c.., v`` of the cells that are not opened further; at most a few times ``CELLS``.

    Going down a level, n * v never grows in total; so at most ``CELLS`` cells of a level exceed a limit that
    divides the whole by ``CELLS``, and every other cell stands for the rows below it. The limit falls to 0 as
    the rows get as few as the cells, so a small table is not summed up at all.
    """
    indexes, sums = [f"i{j}" for j in range(width)], [f"s{j}" for j in range(width)]
    spread = F.col("square") - sum((F.col(s) * F.col(s) for s in sums), F.lit(0.0)) / F.col("n")
    total = finest.groupBy("setting", "cluster").agg(*[F.sum(c).alias(c) for c in [*sums, "square", "n"]])
    crowded = 1 - F.least(F.lit(1.0), F.lit(CELLS) / F.sum("n"))
    limits = total.groupBy("setting").agg((F.sum(spread) / CELLS * crowded).alias("limit"))
    limits = F.broadcast(limits)  # one row per setting
    found, rest = [], finest.join(limits, "setting")
    for level in range(0, LEVELS + 1, STEP):
        shift = LEVELS - level
        cell = [F.shiftright(F.col(i), shift).alias(f"p{j}") for j, i in enumerate(indexes)]
        groups = rest.groupBy("setting", "cluster", "limit", *cell).agg(*[F.sum(c).alias(c) for c in [*sums, "square", "n"]])
        groups = materialize(groups.withColumn("spread", F.greatest(spread, F.lit(0.0))), "level")
        groups = groups.withColumn("open", (F.col("spread") > F.col("limit")) & (F.col("n") > 1) & F.lit(level < LEVELS))
        closed = groups.where("NOT open")
        found += closed.select("setting", "cluster", "n", *sums, "spread").collect()
        opened = groups.where("open")
        if opened.isEmpty():
            break
        names = ["setting", "cluster"]
        marks = opened.select(*names, *[F.col(f"p{j}").alias(f"q{j}") for j in range(width)])
        inside = [rest[n] == marks[n] for n in names] + [F.shiftright(rest[i], shift) == marks[f"q{j}"] for j, i in enumerate(indexes)]
        condition = inside[0]
        for part in inside[1:]:
            condition = condition & part
        rest = rest.join(F.broadcast(marks), condition, "left_semi")  # at most CELLS per setting
    table: dict[int, list] = {}
    for row in found:
        n = row["n"]
        table.setdefault(row["setting"], []).append([row["cluster"], n, *[row[s] / n for s in sums], row["spread"] / n])
    return {at: np.array(sorted(cells)) for at, cells in table.items()}


def euclidean(rows: DataFrame, settings: Settings) -> list[tuple[float, float]]:
    """(silhouette, bound) of every setting: the plain mean silhouette is within ``bound`` of the value.

    ``rows`` is a stored frame of points, ``settings`` are arrays of centres; a row belongs to the nearest one.
    Without settings there is one, and the last value of a point is the number of its cluster.
    Fewer than two clusters with rows score -1; a cluster of one row scores 0. Costs a pass that makes cells,
    and one that compares each row with about ``CELLS`` cells, whatever the number of rows.
    """
    if settings is None:
        width, number = rows.select(F.size("x")).first()[0] - 1, 1
    else:
        width, number = settings[0].shape[1], len(settings)
    cells = _frontier(_finest(rows, settings, width), width)

    def work(chunk: np.ndarray) -> np.ndarray:
        values, owners = _owned(chunk, settings)
        out = np.zeros((number, 3))
        for at, own in enumerate(owners):
            table = cells[at]
            step = max(1, _HELD // len(table))
            for low in range(0, len(values), step):
                out[at] += _bounded(values[low : low + step], own[low : low + step], table)
        return out

    found = summed(rows, work, (number, 3))
    return [
        (float(low + high) / 2 / float(n), float(high - low) / 2 / float(n)) if len(set(cells[at][:, 0])) > 1 else (-1.0, 0.0)
        for at, (low, high, n) in enumerate(found)
    ]


def of_labels(points: DataFrame, features: Sequence[str], cluster: str = "cluster") -> tuple[float, float]:
    """(silhouette, bound) of rows with a column of cluster numbers."""
    values = [F.col(name).cast("double") for name in [*features, cluster]]
    return euclidean(materialize(points.select(F.array(*values).alias("x")), "points"), None)[0]


def _bounded(values: np.ndarray, own: np.ndarray, table: np.ndarray) -> np.ndarray:
    """Sum of lower and of upper bounds of the rows' silhouettes, and their number."""
    n, middle, spread = table[:, 1], table[:, 2:-1], table[:, -1]
    squares = distances(values, middle)
    starts = np.flatnonzero(np.diff(table[:, 0], prepend=-1))
    clusters = table[starts, 0].astype(int)
    sizes = np.add.reduceat(n, starts)
    least = np.add.reduceat(np.sqrt(squares) * n, starts, axis=1)
    most = np.add.reduceat(np.sqrt(squares + spread) * n, starts, axis=1)
    every, place = np.arange(len(values)), np.searchsorted(clusters, own)
    size = sizes[place]
    others = np.maximum(size - 1, 1)
    a_low, a_high = least[every, place] / others, most[every, place] / others  # a row is at no distance from itself
    least, most = least / sizes, most / sizes
    least[every, place] = most[every, place] = np.inf
    b_low, b_high = least.min(axis=1), most.min(axis=1)
    alone = size <= 1

    def score(a: np.ndarray, b: np.ndarray) -> float:
        with np.errstate(invalid="ignore", divide="ignore"):
            values = (b - a) / np.maximum(a, b)
        return float(np.where(alone | ~np.isfinite(values), 0.0, values).sum())

    return np.array([score(a_high, b_low), score(a_low, b_high), len(values)])
