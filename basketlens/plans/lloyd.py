"""KMeans for many settings at once: every pass over the rows serves all starts and all numbers of clusters.

Rows are seeded by oversampling: a few hundred rows drawn by their distance to the ones drawn before,
each with the number of rows nearest to it. Starts are worked out on those; the passes over all
rows then move the centres of all settings together until none of a setting moves any more. A pass
is one job that returns a count, a sum and a cost per centre.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml import Transformer
from pyspark.ml.functions import vector_to_array
from pyspark.ml.param import Param, Params
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from basketlens.plans.scaling import VECTOR

MAX_PASSES = 300
TOLERANCE = 0.01  # a setting is done when none of its centres moves further, in deviations of a feature
DRAWN = 200  # rows that a seeding round draws, on average
ROUNDS = 2
_MOST_DRAWN = 20 * DRAWN  # no round returns more, whatever the draws

_CHUNK = 1 << 14  # rows that are worked on at once, at most
_CELLS = 1 << 18  # distances of rows to centres that are held at once


@dataclass
class Fit:
    k: int
    seed: int
    centres: np.ndarray
    cost: float  # sum of squared distances of all rows to these centres
    passes: int
    counts: np.ndarray  # rows nearest to each centre
    sums: np.ndarray  # and their sums

    def squares(self) -> float:
        """Squared length of all rows, put together from the cost and the clusters' means."""
        sizes = np.maximum(self.counts, 1)[:, None]
        means = np.where(self.counts[:, None] > 0, self.sums / sizes, self.centres)
        moved, lengths = ((means - self.centres) ** 2).sum(axis=1), (means**2).sum(axis=1)
        return self.cost + float(self.counts @ (lengths - moved))


class NearestCentre(Transformer, DefaultParamsReadable, DefaultParamsWritable):
    """Saved stage that adds ``cluster``, the number of the nearest centre, the lower one on ties.

    Plain expressions over the scaled vector, so assignment stays in generated code.
    """

    centres = Param(Params._dummy(), "centres", "list of centres, each a list of numbers")

    def __init__(self, centres: Sequence[Sequence[float]] | None = None):
        super().__init__()
        if centres is not None:
            self._set(centres=[[float(x) for x in centre] for centre in centres])

    def clusterCenters(self) -> list[np.ndarray]:
        return [np.array(centre) for centre in self.getOrDefault(self.centres)]

    def getK(self) -> int:
        return len(self.getOrDefault(self.centres))

    def _transform(self, dataset: DataFrame) -> DataFrame:
        names = [f"{self.uid}_{i}" for i in range(len(self.getOrDefault(self.centres)[0]))]
        values = [F.col(name) for name in names]
        rows = dataset.withColumn(self.uid, vector_to_array(VECTOR))
        rows = rows.withColumns({name: F.get(self.uid, F.lit(i)) for i, name in enumerate(names)})
        near = F.array_min(
            F.array(
                *[
                    F.struct(squared_distance(values, centre).alias("d"), F.lit(number).alias("cluster"))
                    for number, centre in enumerate(self.getOrDefault(self.centres))
                ]
            )
        )
        return rows.withColumn("cluster", near["cluster"]).drop(self.uid, *names)


def squared_distance(values: Sequence[Column], centre: Sequence[float]) -> Column:
    """Sum of squared differences, in the order of the features."""
    total = F.lit(0.0)
    for value, x in zip(values, centre):
        total = total + (value - F.lit(float(x))) * (value - F.lit(float(x)))
    return total


def points(scaled: DataFrame) -> DataFrame:
    """The scaled vectors as one array column ``x``, which is all that the passes read."""
    return scaled.select(vector_to_array(VECTOR).alias("x"))


def _matrix(batch: pa.RecordBatch) -> np.ndarray:
    """Rows of a batch of arrays of one length as a matrix."""
    column = batch.column(0)
    return np.asarray(column.flatten()).reshape(len(column), -1) if len(column) else np.zeros((0, 1))


def _step(centres: int) -> int:
    """Rows whose distances to so many centres are held at once."""
    return max(1, min(_CHUNK, _CELLS // max(1, centres)))


def _chunks(batches: Iterator[pa.RecordBatch], centres: int = 1) -> Iterator[np.ndarray]:
    for batch in batches:
        rows = _matrix(batch)
        for at in range(0, len(rows), _step(centres)):
            yield rows[at : at + _step(centres)]


def distances(rows: np.ndarray, centres: np.ndarray) -> np.ndarray:
    """Squared distances of rows to centres."""
    total = np.zeros((len(rows), len(centres)))
    for j in range(rows.shape[1]):
        total += (rows[:, j, None] - centres[None, :, j]) ** 2
    return total


def summed(rows: DataFrame, work: Callable[[np.ndarray], np.ndarray], shape: tuple[int, int], centres: int = 1) -> np.ndarray:
    """Sum over all rows of a matrix that ``work`` makes of a chunk of them; one matrix leaves each task.

    ``centres`` is how many distances ``work`` holds per row: chunks are so small that memory does not depend on it.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(shape)
        for chunk in _chunks(batches, centres):
            total += work(chunk)
        yield pa.RecordBatch.from_pydict({"at": np.arange(shape[0]), "values": pa.array(list(total), pa.list_(pa.float64()))})

    parts = rows.mapInArrow(run, "at long, values array<double>")
    columns = [F.sum(F.get("values", F.lit(i))).alias(f"v{i}") for i in range(shape[1])]
    found = np.zeros(shape)
    for row in parts.groupBy("at").agg(*columns).collect():  # one row per centre
        found[row["at"]] = row[1:]
    return found


# --- seeding --------------------------------------------------------------------------------


def _drawn(rows: DataFrame, near: np.ndarray | None, cost: float, seed: int) -> np.ndarray:
    """About ``DRAWN`` rows, each with a chance in proportion to its squared distance to ``near``.

    The draw is a hash of the row's values, so it is the same for any partitioning.
    """
    step = _step(len(near))
    known = rows.withColumn("u", (F.pmod(F.xxhash64("x", F.lit(seed)), F.lit(1 << 40)) / float(1 << 40)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values, draw = _matrix(batch), np.asarray(batch.column(1))
            far = np.empty(len(values))
            for at in range(0, len(values), step):
                far[at : at + step] = distances(values[at : at + step], near).min(axis=1)
            taken = draw * cost < DRAWN * far
            yield pa.RecordBatch.from_pydict({"x": pa.array(list(values[taken]), pa.list_(pa.float64())), "u": draw[taken]})

    found = known.mapInArrow(run, "x array<double>, u double").dropDuplicates().orderBy("u").limit(_MOST_DRAWN)
    return np.array([row["x"] for row in found.collect()])


def candidates(rows: DataFrame, seed: int = 0) -> tuple[np.ndarray, np.ndarray]:
    """Seeding rows and how many rows are nearest to each. ``rows`` are centred, so the first is the origin."""
    first = rows.select(F.size("x").alias("n")).first()
    if first is None:
        raise ValueError("no rows to cluster")
    near = np.zeros((1, first["n"]))
    for number in range(ROUNDS):
        centres = near
        cost = summed(rows, lambda chunk: np.array([[distances(chunk, centres).min(axis=1).sum()]]), (1, 1), len(centres))[0, 0]
        if cost <= 0:
            break
        more = _drawn(rows, centres, cost, seed + number)
        if len(more):
            near = np.vstack([near, more])
    centres = near

    def count(chunk: np.ndarray) -> np.ndarray:
        return np.bincount(distances(chunk, centres).argmin(axis=1), minlength=len(centres))[:, None].astype(float)

    return near, summed(rows, count, (len(near), 1), len(centres))[:, 0]


def start(near: np.ndarray, weights: np.ndarray, k: int, seed: int) -> np.ndarray:
    """Centres for one start from the weighted seeding rows: drawn by distance, then moved to rest among them."""
    pick = np.random.default_rng([seed, k])
    centres = near[pick.choice(len(near), 1, p=weights / weights.sum())]
    while len(centres) < k:
        far = distances(near, centres).min(axis=1) * weights
        share = far / far.sum() if far.sum() > 0 else np.full(len(near), 1 / len(near))
        centres = np.vstack([centres, near[pick.choice(len(near), 1, p=share)]])
    for _ in range(MAX_PASSES):
        own = distances(near, centres).argmin(axis=1)
        mass = np.bincount(own, weights, k)
        sums = np.stack([np.bincount(own, weights * near[:, j], k) for j in range(near.shape[1])], axis=1)
        moved = np.where(mass[:, None] > 0, sums / np.maximum(mass, 1e-300)[:, None], centres)
        if np.allclose(moved, centres, atol=1e-9):
            break
        centres = moved
    return centres


# --- all settings together ---------------------------------------------------------------------


def one_pass(rows: DataFrame, settings: Sequence[np.ndarray]) -> list[np.ndarray]:
    """Per setting, a row per centre: rows nearest to it, their sums, and their squared distances to it."""
    edges = np.cumsum([0, *(len(centres) for centres in settings)])
    width = settings[0].shape[1]

    def work(chunk: np.ndarray) -> np.ndarray:
        far = distances(chunk, np.vstack(settings))
        out = np.zeros((edges[-1], width + 2))
        for low, high in zip(edges[:-1], edges[1:]):
            own = far[:, low:high].argmin(axis=1)
            out[low:high, 0] = np.bincount(own, minlength=high - low)
            for j in range(width):
                out[low:high, 1 + j] = np.bincount(own, chunk[:, j], high - low)
            out[low:high, -1] = np.bincount(own, far[np.arange(len(chunk)), low + own], high - low)
        return out

    found = summed(rows, work, (int(edges[-1]), width + 2), int(edges[-1]))
    return [found[low:high] for low, high in zip(edges[:-1], edges[1:])]


def fit_all(rows: DataFrame, settings: Sequence[tuple[int, int]]) -> list[Fit]:
    """A fit for every (k, seed), in order. ``rows`` is a stored frame of ``points``.

    A setting's centres depend on no other setting. The cost belongs to the centres returned.
    """
    near, weights = candidates(rows)
    state = {at: start(near, weights, *pair) for at, pair in enumerate(settings)}
    done: dict[int, Fit] = {}
    for number in range(1, MAX_PASSES + 1):
        for at, found in zip(list(state), one_pass(rows, list(state.values()))):
            counts, sums, cost = found[:, 0], found[:, 1:-1], float(found[:, -1].sum())
            centres = state[at]
            moved = np.where(counts[:, None] > 0, sums / np.maximum(counts, 1)[:, None], centres)
            if number == MAX_PASSES or ((moved - centres) ** 2).sum(axis=1).max() <= TOLERANCE**2:
                done[at] = Fit(*settings[at], centres, cost, number, counts, sums)
                del state[at]
            else:
                state[at] = moved
        if not state:
            break
    return [done[at] for at in range(len(settings))]


def best_by_k(fits: Sequence[Fit]) -> dict[int, Fit]:
    """The fit of least cost for every k, the first on ties."""
    best: dict[int, Fit] = {}
    for fit in fits:
        if fit.k not in best or fit.cost < best[fit.k].cost:
            best[fit.k] = fit
    return best


# --- silhouettes of all settings ------------------------------------------------------------------


def silhouettes(rows: DataFrame, settings: Sequence[np.ndarray]) -> list[float]:
    """Mean silhouette under squared distance of every setting, in two passes for all of them.

    The mean squared distance of a row to a cluster follows from the cluster's count, mean and mean
    square. A setting with fewer than two clusters that have rows scores -1; a cluster of one row scores 0.
    """
    parts = one_pass(rows, settings)
    counts = [part[:, 0] for part in parts]
    means = [part[:, 1:-1] / np.maximum(part[:, :1], 1) for part in parts]
    # squared distances to the centre, moved to the mean
    spread = [part[:, -1] / np.maximum(part[:, 0], 1) - ((m - c) ** 2).sum(axis=1) for part, m, c in zip(parts, means, settings)]

    def work(chunk: np.ndarray) -> np.ndarray:
        out = np.zeros((len(settings), 1))
        every = np.arange(len(chunk))
        for at, centres in enumerate(settings):
            own = distances(chunk, centres).argmin(axis=1)
            mean = distances(chunk, means[at]) + spread[at][None, :]
            size = counts[at][own]
            inner = mean[every, own] * size / np.maximum(size - 1, 1)
            mean[every, own] = np.inf
            mean[:, counts[at] == 0] = np.inf
            outer = mean.min(axis=1)
            largest = np.maximum(inner, outer)
            with np.errstate(invalid="ignore"):
                out[at] = np.where((size > 1) & (largest > 0), (outer - inner) / np.where(largest > 0, largest, 1), 0).sum()
        return out

    totals = summed(rows, work, (len(settings), 1), max(len(centres) for centres in settings))[:, 0]
    return [float(total / count.sum()) if (count > 0).sum() > 1 else -1.0 for total, count in zip(totals, counts)]
