"""Gradient boosting of shallow trees for the logistic loss, with the rows where they are.

Rows are kept as bins, packed in blocks. A level of a tree is one job: every task adds up the residuals
of its blocks per open node, feature and bin, and the driver sees one sum of these small tables. The rules
are those of Spark ML's boosting (variance as impurity, all features, the first tree on the labels).
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark import RDD, StorageLevel
from pyspark.ml import Transformer
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.linalg import DenseVector
from pyspark.ml.param import Param, Params
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basketlens.plans.forest import _LEAF, _OPEN, BINS, Tree, _bins, _matrix, _reach, cut_points
from basketlens.plans.scaling import VECTOR
from basketlens.session import materialize

LEAST_ROWS, TASK_ROWS = 1 << 13, 1 << 17  # rows of a task, about, up to a task for each core and beyond that
KEPT_TREES = 10  # margins are kept with the rows after so many trees
FEW_PARTS = 64  # sums of so many tasks go straight to the driver


def _margins(x: np.ndarray, trees: Iterable[Tree]) -> np.ndarray:
    """Sum of the trees' values, which have the step in them."""
    total = np.zeros(len(x))
    for tree in trees:
        total += np.array(tree.vote)[_reach(tree, x)]
    return total


# --- fit ---------------------------------------------------------------------------------------


def _blocks(binned: DataFrame, width: int) -> DataFrame:
    """``x, y, n``: bins and labels of the rows of an Arrow batch as bytes, and their number."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x, y = _matrix(batch.column(0), width), batch.column(1)
            if y.null_count or not np.isin(np.asarray(y), (0, 1)).all():
                raise ValueError("labels must be 0 or 1")
            packed = {"x": x.astype(np.int8).tobytes(), "y": np.asarray(y).astype(np.int8).tobytes()}
            yield pa.RecordBatch.from_pydict(
                {name: pa.array([value], pa.binary()) for name, value in packed.items()} | {"n": pa.array([len(y)], pa.int64())}
            )

    return binned.mapInArrow(pack, "x binary, y binary, n bigint")


def _with_margins(blocks: RDD, trees: Sequence[Tree], width: int) -> RDD:
    """Blocks as ``(bins, signs of the labels, margins)``."""

    def unpack(block) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        x = np.frombuffer(bytes(block[0]), np.int8).reshape(-1, width)
        return x, np.frombuffer(bytes(block[1]), np.int8) * 2 - 1, _margins(x, trees)

    return blocks.map(unpack).persist(StorageLevel.MEMORY_AND_DISK)


def _summed(state: RDD, later: Sequence[Tree], tree: Tree, opened: Sequence[int], first: bool, width: int) -> np.ndarray:
    """Rows and sum of residuals per open node, feature and bin."""

    def add(blocks: Iterable[tuple[np.ndarray, np.ndarray, np.ndarray]]) -> Iterator[np.ndarray]:
        sums = np.zeros((width, len(opened) * BINS, 2))
        place = np.full(len(tree.feature), -1)
        place[opened] = np.arange(len(opened))
        for x, sign, margin in blocks:
            at = place[_reach(tree, x)]
            keep = np.flatnonzero(at >= 0)
            x, sign, margin, at = x[keep], sign[keep].astype(float), margin[keep], at[keep]
            residual = sign if first else 4 * sign / (1 + np.exp(2 * sign * (margin + _margins(x, later))))
            for j in range(width):
                cell = at * BINS + x[:, j]
                sums[j, :, 0] += np.bincount(cell, minlength=len(opened) * BINS)
                sums[j, :, 1] += np.bincount(cell, residual, len(opened) * BINS)
        yield sums

    parts = state.mapPartitions(add)
    total = parts.reduce(np.add) if parts.getNumPartitions() <= FEW_PARTS else parts.treeReduce(np.add)
    return total.reshape(width, len(opened), BINS, 2).swapaxes(0, 1)


def _split(sums: np.ndarray) -> tuple[float, int, int, np.ndarray, np.ndarray]:
    """Gain, feature and bin of a node's best split (a gain of 0: none), rows and sum on its left, and of all."""
    total, left = sums[0].sum(axis=0), sums.cumsum(axis=1)
    right = total - left
    inner = (left[..., 0] > 0) & (right[..., 0] > 0)
    count = np.where(inner[..., None], np.stack([left[..., 0], right[..., 0]], axis=-1), 1.0)
    gain = left[..., 1] ** 2 / count[..., 0] + right[..., 1] ** 2 / count[..., 1] - total[1] ** 2 / total[0]
    gain = np.where(inner & (gain > 1e-9), gain, 0.0)
    feature, cut = np.unravel_index(gain.argmax(), gain.shape)
    return float(gain[feature, cut]), int(feature), int(cut), left[feature, cut], total


def _tree(state: RDD, later: Sequence[Tree], depth: int, step: float, first: bool, gains: np.ndarray) -> Tree:
    """The next tree, a job per level; ``gains`` has the fall of the squared error added per feature."""
    tree, width = Tree(), len(gains)
    opened = [tree.add(0.0)]
    for level in range(depth):
        following = []
        for node, sums in zip(opened, _summed(state, later, tree, opened, first, width)):
            gain, feature, cut, left, total = _split(sums)
            tree.vote[node] = step * float(total[1] / total[0])
            tree.feature[node] = _LEAF
            if gain > 0:
                gains[feature] += gain
                tree.feature[node], tree.cut[node], tree.left[node] = feature, cut, len(tree.vote)
                following += [tree.add(step * float(rows[1] / rows[0])) for rows in (left, total - left)]
        opened = following
        if not opened:
            break
    for node in opened:
        tree.feature[node] = _LEAF
    return tree


def fit_boosting(scaled: DataFrame, width: int, trees: int = 100, depth: int = 3, step: float = 0.1, label: str = "churn") -> BoostingModel:
    """``trees`` regression trees of ``depth`` levels; the first fits the labels as -1 and 1, each later one the residuals."""
    values = scaled.select(vector_to_array(VECTOR).alias("x"), F.col(label).alias("y"))
    limits = cut_points(values, width)
    stored = materialize(_blocks(values.select(_bins(F.col("x"), limits).alias("x"), "y"), width), "blocks")
    known = stored.agg(F.count("n").alias("blocks"), F.sum("n").alias("rows")).first()
    if not known["rows"]:
        raise ValueError("no rows to fit")
    cores = stored.sparkSession.sparkContext.defaultParallelism
    tasks = max(min(cores, 1 + known["rows"] // LEAST_ROWS), known["rows"] // TASK_ROWS)
    blocks = stored.select("x", "y").repartition(min(tasks, known["blocks"])).rdd.persist(StorageLevel.MEMORY_AND_DISK)
    state, grown, later, gains = _with_margins(blocks, [], width), [], [], np.zeros(width)
    for number in range(trees):
        if len(later) == KEPT_TREES:
            state.unpersist()
            state, later = _with_margins(blocks, list(grown), width), []
        tree = _tree(state, later, depth, step if number else 1.0, not number, gains)
        grown.append(tree)
        later.append(tree)
    for kept in (state, blocks):
        kept.unpersist()
    return BoostingModel(limits, grown, (gains / gains.sum() if gains.sum() > 0 else gains).tolist())


# --- the model ------------------------------------------------------------------------------------


class BoostingModel(Transformer, DefaultParamsReadable, DefaultParamsWritable):
    """Saved stage that adds ``probability`` (a vector of both classes) and ``prediction`` from the sum of the trees."""

    limits = Param(Params._dummy(), "limits", "per feature, the limits of its bins")
    trees = Param(Params._dummy(), "trees", "feature, cut, left and value of the nodes of each tree")
    importances = Param(Params._dummy(), "importances", "share of each feature in the fall of the squared error")

    def __init__(self, limits: list[list[float]] | None = None, trees: Sequence[Tree] = (), importances: list[float] | None = None):
        super().__init__()
        if limits is not None:
            nodes = [[tree.feature, tree.cut, tree.left, tree.vote] for tree in trees]
            self._set(limits=limits, trees=nodes, importances=importances)

    @property
    def featureImportances(self) -> DenseVector:
        return DenseVector(self.getOrDefault(self.importances))

    def _transform(self, dataset: DataFrame) -> DataFrame:
        limits, trees, m = self.getOrDefault(self.limits), [Tree(*nodes) for nodes in self.getOrDefault(self.trees)], f"{self.uid}_m"
        width = len(limits)

        @F.arrow_udf("double")
        def margin(bins: pa.Array) -> pa.Array:
            return pa.array(_margins(_matrix(bins, width), trees))

        rows = dataset.withColumn(m, margin(_bins(vector_to_array(VECTOR), limits)))
        share = 1 / (1 + F.exp(-2 * F.col(m)))
        return rows.withColumns(
            {"probability": array_to_vector(F.array(1 - share, share)), "prediction": (F.col(m) > 0).cast("double")}
        ).drop(m)
