"""Random forest of deep trees, grown where the rows are.

A deep tree has about as many nodes as rows, so neither the fit nor a prediction gathers trees on the
driver. The first levels of all trees come from histograms: the tasks count, Spark adds the counts up
and picks each node's best split, and the driver sees one row per open node. A node of at most
``LEAF_ROWS`` rows is sent, with the rows it holds, to a group of its own, which finishes it below.
Finished parts are stored as one row each; a prediction meets each part with the rows that reach it.
"""

from __future__ import annotations

import json
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.ml import Transformer
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.linalg import DenseVector
from pyspark.ml.util import DefaultParamsReader, DefaultParamsWriter, MLReadable, MLReader, MLWritable, MLWriter
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from basketlens.plans.scaling import VECTOR
from basketlens.session import materialize

BINS = 32  # values of a feature are told apart by this many quantiles
LEAF_ROWS = 1 << 15  # rows, in the mean, of a node that one group finishes
BLOCK_ROWS = 1 << 16  # rows that one group predicts, about; a part meets more of them in blocks
_ONE = 1 << 40  # votes are added as whole numbers, so their order does not matter
_LEAF, _OPEN = -1, -2  # marks in place of a split's feature

_PART = "tree int, part int, feature binary, cut binary, left binary, vote binary, importance array<double>"


@dataclass
class Tree:
    """Nodes of a tree, or of a part of one; children are ``left`` and ``left + 1``, rows up to ``cut`` go left."""

    feature: list[int] = field(default_factory=list)
    cut: list[int] = field(default_factory=list)
    left: list[int] = field(default_factory=list)
    vote: list[float] = field(default_factory=list)  # share of the label 1

    def add(self, vote: float) -> int:
        for values, value in ((self.feature, _OPEN), (self.cut, 0), (self.left, 0), (self.vote, vote)):
            values.append(value)
        return len(self.vote) - 1


# --- bins -------------------------------------------------------------------------------------


def cut_points(rows: DataFrame, width: int) -> list[list[float]]:
    """Per feature, at most ``BINS - 1`` ascending limits: all its values if they are few, else quantiles."""
    names = [f"x{i}" for i in range(width)]
    values = rows.select(*[F.get("x", F.lit(i)).alias(name) for i, name in enumerate(names)])
    shares = [i / BINS for i in range(1, BINS)]
    found = values.agg(
        *[F.percentile_approx(name, shares, 10_000).alias(name) for name in names],
        *[F.approx_count_distinct(name, 0.02).alias(f"n_{name}") for name in names],
        *[F.max(name).alias(f"top_{name}") for name in names],
    ).first()
    few = [name for name in names if found[f"n_{name}"] <= BINS + BINS // 4]
    every = values.agg(*[F.collect_set(name).alias(name) for name in few]).first() if few else {}
    limits = []
    for name in names:
        known = sorted(every[name]) if name in few and len(every[name]) <= BINS else sorted(set(found[name] or []))
        limits.append([float(value) for value in known if value < found[f"top_{name}"]])
    return limits


def _bin(value: Column, limits: Sequence[float]) -> Column:
    """How many limits lie below a value."""
    return F.size(F.filter(F.array(*[F.lit(x) for x in limits]).cast("array<double>"), lambda x: x < value)).cast("tinyint")


def _bins(values: Column, limits: Sequence[Sequence[float]]) -> Column:
    """The bin of each feature, as an array of small numbers."""
    return F.array(*[_bin(F.get(values, F.lit(i)), some) for i, some in enumerate(limits)])


def _matrix(column: pa.Array | pa.ChunkedArray, width: int) -> np.ndarray:
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return np.asarray(column.flatten()).reshape(-1, width)


# --- draws --------------------------------------------------------------------------------------

# chances of drawing a row 0, 1, 2, .. times with replacement
_DRAWN = np.cumsum(np.exp(-1.0) / np.cumprod([1.0, *range(1, 12)]))


def _mixed(values: np.ndarray) -> np.ndarray:
    """A hash of 64-bit numbers."""
    with np.errstate(over="ignore"):
        for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
            values = (values ^ (values >> np.uint64(shift))) * np.uint64(factor)
        return values ^ (values >> np.uint64(31))


def _times(ids: np.ndarray, tree: int, seed: int) -> np.ndarray:
    """How often each row is in the bootstrap sample of a tree: decided by the row's own number."""
    key = _mixed(np.array([seed * 1_000_003 + tree + 1], dtype=np.uint64))
    share = (_mixed(_mixed(ids.astype(np.uint64)) ^ key) >> np.uint64(11)) / float(1 << 53)
    return np.searchsorted(_DRAWN, share, side="right")


def _subsets(nodes: int, width: int, tries: int, seed: Sequence[int]) -> np.ndarray:
    """Features that each node may split by."""
    order = np.random.default_rng([abs(x) for x in seed]).random((nodes, width)).argsort(axis=1)
    return np.sort(order[:, :tries], axis=1)


# --- splits ---------------------------------------------------------------------------------------


def _gain(l0, l1, t0, t1):
    """Fall of Gini impurity times the rows of the node; the same formula for arrays and columns."""
    left, total = l0 + l1, t0 + t1
    right = total - left
    r0, r1 = t0 - l0, t1 - l1
    return (l0 * l0 + l1 * l1) / left + (r0 * r0 + r1 * r1) / right - (t0 * t0 + t1 * t1) / total


def _reach(tree: Tree, rows: np.ndarray) -> np.ndarray:
    """The node at which each row ends."""
    feature, cut, left = (np.array(x, dtype=np.int64) for x in (tree.feature, tree.cut, tree.left))
    at, every = np.zeros(len(rows), dtype=np.int64), np.arange(len(rows))
    while True:
        every = every[feature[at[every]] >= 0]
        if not len(every):
            return at
        here = at[every]
        at[every] = left[here] + (rows[every, feature[here]] > cut[here])


def _finished(rows: np.ndarray, label: np.ndarray, times: np.ndarray, depth: int, tries: int, seed: Sequence[int]):
    """Grow a node to its end: (feature, cut, left, vote) of its nodes, and the gain of every feature.

    All open nodes of a level are split together; counts are kept only for bins that have rows.
    """
    width, at = rows.shape[1], np.zeros(len(rows), dtype=np.int64)
    feature, cut, left, vote = [], [], [], []
    gains, first = np.zeros(width), 0
    nodes = 1  # open nodes of this level; they are numbered from ``first``
    for level in range(depth + 1):
        totals = np.bincount(at * 2 + label, times, nodes * 2).reshape(-1, 2)
        best, where, split = np.zeros(nodes), np.zeros(nodes, dtype=np.int64), np.full(nodes, _LEAF)
        if level < depth:
            allowed = _subsets(nodes, width, tries, [*seed, level])
            for place in range(tries):
                mine = allowed[:, place]
                cell = at * BINS + rows[np.arange(len(rows)), mine[at]]
                counts = np.bincount(cell * 2 + label, times, nodes * BINS * 2).reshape(-1, 2)
                used = np.flatnonzero(counts.any(axis=1))
                node, counts = used // BINS, counts[used]
                upto = counts.cumsum(axis=0)
                start = np.searchsorted(node, np.arange(nodes))
                upto -= np.where(start[node, None] > 0, upto[start[node] - 1], 0.0)
                inner = np.append(node[1:] == node[:-1], False)  # rows remain on the right
                if not inner.any():
                    continue
                node, upto, bins = node[inner], upto[inner], used[inner] % BINS
                gain = _gain(upto[:, 0], upto[:, 1], totals[node, 0], totals[node, 1])
                order = np.lexsort((bins, -gain, node))
                node, gain, bins = node[order], gain[order], bins[order]
                top = np.append(True, node[1:] != node[:-1])
                node, gain, bins = node[top], gain[top], bins[top]
                better = gain > np.maximum(best[node] * (1 + 1e-12), 1e-9)
                node, gain, bins = node[better], gain[better], bins[better]
                best[node], where[node], split[node] = gain, bins, mine[node]
        parted = split >= 0
        number = np.cumsum(parted) - 1  # place among the nodes that are split
        following = first + nodes
        feature.append(split)
        cut.append(where)
        left.append(np.where(parted, following + 2 * number, 0))
        vote.append(totals[:, 1] / totals.sum(axis=1))
        np.add.at(gains, split[parted], best[parted])
        keep = parted[at]
        rows, label, times, at = rows[keep], label[keep], times[keep], at[keep]
        if not len(rows):
            break
        right = rows[np.arange(len(rows)), split[at]] > where[at]
        at = 2 * number[at] + right
        first, nodes = following, 2 * int(parted.sum())
    return [np.concatenate(x) for x in (feature, cut, left, vote)], gains


# --- fit -------------------------------------------------------------------------------------------


def _counted(rows: DataFrame, trees: list[Tree], allowed: dict[tuple[int, int], list[int]], seed: int, width: int) -> DataFrame:
    """``tree, node, feature, bin, n0, n1`` of the open nodes, from the tasks' own counts."""
    opened = [np.flatnonzero(np.array(tree.feature) == _OPEN) for tree in trees]

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = {}
        for batch in batches:
            ids, x, y = np.asarray(batch.column(0)), _matrix(batch.column(1), width), np.asarray(batch.column(2)).astype(np.int64)
            for number, nodes in enumerate(opened):
                if not len(nodes):
                    continue
                place = np.full(len(trees[number].feature), -1)
                place[nodes] = np.arange(len(nodes))
                at, times = place[_reach(trees[number], x)], _times(ids, number, seed)
                keep = np.flatnonzero((at >= 0) & (times > 0))
                at, times = at[keep], times[keep]
                some = np.array([allowed[number, int(node)] for node in nodes])
                for j in range(some.shape[1]):
                    cell = (at * BINS + x[keep, some[at, j]]) * 2 + y[keep]
                    found = np.bincount(cell, times, len(nodes) * BINS * 2).reshape(-1, 2).astype(float)
                    sums[number, j] = sums.get((number, j), 0) + found
        for (number, j), found in sums.items():
            used, nodes = np.flatnonzero(found.any(axis=1)), opened[number]
            node = nodes[used // BINS]
            yield pa.RecordBatch.from_pydict(
                {
                    "tree": pa.array(np.full(len(used), number), pa.int32()),
                    "node": pa.array(node, pa.int32()),
                    "feature": pa.array([allowed[number, int(n)][j] for n in node], pa.int32()),
                    "bin": pa.array(used % BINS, pa.int32()),
                    "n0": pa.array(found[used, 0], pa.float64()),
                    "n1": pa.array(found[used, 1], pa.float64()),
                }
            )

    parts = rows.mapInArrow(count, "tree int, node int, feature int, bin int, n0 double, n1 double")
    return parts.groupBy("tree", "node", "feature", "bin").agg(F.sum("n0").alias("n0"), F.sum("n1").alias("n1"))


def _best_splits(counts: DataFrame) -> DataFrame:
    """One row per node: its counts, and the feature, bin and left side of its best split (a gain of 0: none)."""
    whole = Window.partitionBy("tree", "node", "feature")  # at most one row per bin
    before = whole.orderBy("bin").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    summed = counts.select(
        "tree", "node", "feature", "bin",
        *[F.sum(n).over(before).alias(f"l{n[1]}") for n in ("n0", "n1")],
        *[F.sum(n).over(whole).alias(f"t{n[1]}") for n in ("n0", "n1")],
    )
    l0, l1, t0, t1 = (F.col(name) for name in ("l0", "l1", "t0", "t1"))
    gain = F.when(l0 + l1 < t0 + t1, _gain(l0, l1, t0, t1)).otherwise(0.0)
    rows = summed.withColumn("gain", F.when(gain > 1e-9, gain).otherwise(0.0))
    order = F.struct("gain", -F.col("feature"), -F.col("bin"))
    return rows.groupBy("tree", "node").agg(F.max_by(F.struct("gain", "feature", "bin", "l0", "l1", "t0", "t1"), order).alias("best")).select("tree", "node", "best.*")


def fit_forest(scaled: DataFrame, width: int, trees: int = 100, depth: int = 30, seed: int = 0, label: str = "churn", leaf_rows: int = LEAF_ROWS) -> ForestModel:
    """``trees`` trees of at most ``depth`` levels on bootstrap samples, each split by the best of sqrt(width) features."""
    tries = int(np.ceil(np.sqrt(width)))
    values = scaled.select(vector_to_array(VECTOR).alias("x"), F.col(label).cast("tinyint").alias("y"))
    limits = cut_points(values, width)
    binned = values.select(F.monotonically_increasing_id().alias("id"), _bins(F.col("x"), limits).alias("x"), "y")
    rows = materialize(binned, "binned")
    count = rows.count()
    if not count:
        raise ValueError("no rows to fit")
    grown, gains = [Tree() for _ in range(trees)], np.zeros((trees, width))
    levels = {(number, tree.add(0.0)): 0 for number, tree in enumerate(grown)}  # open nodes of more rows, and their level
    parts = {}  # (tree, node) that a group finishes -> its level
    if count <= leaf_rows:
        parts, levels = levels, {}
    while levels:
        by_tree = {}
        for number, node in levels:
            by_tree.setdefault(number, []).append(node)
        allowed = {}
        for number, nodes in by_tree.items():
            some = _subsets(len(nodes), width, tries, [seed, number, nodes[0], 1])
            allowed |= {(number, node): subset.tolist() for node, subset in zip(nodes, some)}
        marked = [Tree(list(tree.feature), tree.cut, tree.left, tree.vote) for tree in grown]
        for number, node in parts:
            marked[number].feature[node] = _LEAF  # not counted again
        found = _best_splits(_counted(rows, marked, allowed, seed, width)).orderBy("tree", "node").collect()  # a row per open node
        after = {}
        for row in found:
            number, node, tree = row["tree"], row["node"], grown[row["tree"]]
            level = levels[number, node]
            tree.vote[node] = row["t1"] / (row["t0"] + row["t1"])
            if row["gain"] <= 0 or level >= depth:
                tree.feature[node] = _LEAF
                continue
            gains[number, row["feature"]] += row["gain"]
            tree.feature[node], tree.cut[node], tree.left[node] = row["feature"], row["bin"], len(tree.vote)
            for c0, c1 in ((row["l0"], row["l1"]), (row["t0"] - row["l0"], row["t1"] - row["l1"])):
                child = tree.add(c1 / (c0 + c1))
                if min(c0, c1) <= 0 or level + 1 >= depth:
                    tree.feature[child] = _LEAF
                else:
                    (after if c0 + c1 > leaf_rows else parts)[number, child] = level + 1
        missing = set(levels) - {(row["tree"], row["node"]) for row in found}  # no row was drawn for the tree
        for number, node in missing:
            grown[number].feature[node] = _LEAF
        levels = after
    stored = materialize(_finish(rows, grown, parts, depth, tries, seed, width), "forest")
    summed = stored.groupBy("tree").agg(*[F.sum(F.get("importance", F.lit(i))).alias(f"g{i}") for i in range(width)])
    for row in summed.collect():  # one row per tree
        gains[row["tree"]] += np.array(row[1:])
    shares = gains / np.maximum(gains.sum(axis=1, keepdims=True), 1e-300)
    total = shares.sum()
    return ForestModel(limits, grown, (shares.sum(axis=0) / total if total > 0 else shares.sum(axis=0)).tolist(), stored)


def _finish(rows: DataFrame, grown: list[Tree], parts: dict[tuple[int, int], int], depth: int, tries: int, seed: int, width: int) -> DataFrame:
    """The rows of every part, once per time drawn, meet in its group and are grown to the end."""
    drawn = _routed(rows, grown, width, lambda ids, number: _times(ids, number, seed))
    schema = pa.schema(
        [("tree", pa.int32()), ("part", pa.int32()), *[(name, pa.binary()) for name in ("feature", "cut", "left", "vote")], ("importance", pa.list_(pa.float64()))]
    )

    def grow(table: pa.Table) -> pa.Table:
        number, part = table["tree"][0].as_py(), table["part"][0].as_py()
        x, y, times = _matrix(table["x"], width).astype(np.int64), np.asarray(table["y"]).astype(np.int64), np.asarray(table["times"])
        nodes, gains = _finished(x, y, times, depth - parts[number, part], tries, [seed, number, part, 2])
        kinds = (np.int8, np.int8, np.int32, np.float64)
        packed = [[values.astype(kind).tobytes()] for values, kind in zip(nodes, kinds)]
        return pa.table([pa.array([number], pa.int32()), pa.array([part], pa.int32()), *[pa.array(v, pa.binary()) for v in packed], pa.array([gains.tolist()], pa.list_(pa.float64()))], schema=schema)

    return drawn.groupBy("tree", "part").applyInArrow(grow, _PART)


def _routed(rows: DataFrame, grown: list[Tree], width: int, times=None, votes: bool = False) -> DataFrame:
    """``tree, part`` and the row, for every tree in which it reaches an open node.

    With ``votes``, a row that ends at a leaf of the first levels stays too, without a part, and ``vote``.
    """
    names = [field.name for field in rows.schema if field.name != "x"]
    kept = ", ".join(f"{field.name} {field.dataType.simpleString()}" for field in rows.schema if field.name != "x")
    schema = f"tree int, part int, {kept}, x array<tinyint>" + (", vote bigint" if votes else ", times bigint")

    def route(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, x = np.asarray(batch.column("id")), _matrix(batch.column("x"), width)
            for number, tree in enumerate(grown):
                at, feature = _reach(tree, x), np.array(tree.feature)
                inner = feature[at] == _OPEN
                drawn = None if votes else times(ids, number)
                keep = np.arange(len(x)) if votes else np.flatnonzero(inner & (drawn > 0))
                taken = batch.take(pa.array(keep))
                found = {"tree": pa.array(np.full(len(keep), number), pa.int32()), "part": pa.array(np.where(inner, at, -1)[keep], pa.int32())}
                found |= {name: taken.column(name) for name in names} | {"x": taken.column("x")}
                if votes:
                    known = np.round(np.array(tree.vote)[at] * _ONE).astype(np.int64)
                    found["vote"] = pa.array(known, pa.int64(), mask=inner)
                else:
                    found["times"] = pa.array(drawn[keep], pa.int64())
                yield pa.RecordBatch.from_pydict(found)

    return rows.mapInArrow(route, schema)


def _crowded(rows: DataFrame, grown: list[Tree], width: int) -> DataFrame:
    """``tree, part, blocks`` of the parts that more than ``BLOCK_ROWS`` rows reach."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = [np.zeros(len(tree.feature), dtype=np.int64) for tree in grown]
        for batch in batches:
            x = _matrix(batch.column(0), width)
            for number, tree in enumerate(grown):
                sums[number] += np.bincount(_reach(tree, x), minlength=len(sums[number]))
        for number, tree in enumerate(grown):
            nodes = np.flatnonzero((np.array(tree.feature) == _OPEN) & (sums[number] > 0))
            found = {"tree": pa.array(np.full(len(nodes), number), pa.int32()), "part": pa.array(nodes, pa.int32())}
            yield pa.RecordBatch.from_pydict(found | {"n": pa.array(sums[number][nodes], pa.int64())})

    reached = rows.select("x").mapInArrow(count, "tree int, part int, n bigint").groupBy("tree", "part").agg(F.sum("n").alias("n"))
    return reached.where(F.col("n") > BLOCK_ROWS).select("tree", "part", F.ceil(F.col("n") / BLOCK_ROWS).alias("blocks"))


# --- the model ----------------------------------------------------------------------------------------


class ForestModel(Transformer, MLWritable, MLReadable):
    """Saved stage that adds ``probability`` (a vector of both classes) and ``prediction``: the mean vote of the trees."""

    def __init__(self, limits: list[list[float]], grown: list[Tree], importances: list[float], parts: DataFrame):
        super().__init__()
        self.limits, self.grown, self.importances, self.parts = limits, grown, importances, parts

    @property
    def featureImportances(self) -> DenseVector:
        return DenseVector(self.importances)

    def _transform(self, dataset: DataFrame) -> DataFrame:
        key, share = f"{self.uid}_bins", f"{self.uid}_share"
        binned = dataset.withColumn(key, _bins(vector_to_array(VECTOR), self.limits))
        shares = self._shares(binned.select(F.col(key).alias("x")).distinct()).withColumnsRenamed({"x": key, "share": share})
        return (
            binned.join(shares, key, "left")
            .withColumns({"probability": array_to_vector(F.array(1 - F.col(share), F.col(share))), "prediction": (F.col(share) > 0.5).cast("double")})
            .drop(key, share)
        )

    def _shares(self, distinct: DataFrame) -> DataFrame:
        """``x, share`` of distinct rows of bins. A part meets the rows that reach it in blocks, so no group grows with
        the rows, and is copied only for as many blocks as these rows fill."""
        width = len(self.limits)
        rows = materialize(distinct.select(F.monotonically_increasing_id().alias("id"), "x"), "asked")
        routed = _routed(rows, self.grown, width, votes=True)
        reaching, parts, blocks = routed.where("part >= 0"), self.parts, F.lit(1).cast("bigint")
        if rows.count() > BLOCK_ROWS:
            crowded = F.broadcast(materialize(_crowded(rows, self.grown, width), "crowded"))  # at most a row per full block
            reaching, parts = (frame.join(crowded, ["tree", "part"], "left") for frame in (reaching, parts))
            blocks = F.coalesce("blocks", blocks)
        asked = reaching.select("tree", "part", F.pmod(F.xxhash64("id"), blocks).alias("block"), "id", "x")
        known = parts.select("tree", "part", F.explode(F.sequence(F.lit(0).cast("bigint"), blocks - 1)).alias("block"), "feature", "cut", "left", "vote")

        def vote(left: pa.Table, right: pa.Table) -> pa.Table:
            if not left.num_rows or not right.num_rows:
                return pa.table({"id": pa.array([], pa.int64()), "vote": pa.array([], pa.int64())})
            values = [np.frombuffer(right[name][0].as_py(), kind) for name, kind in (("feature", np.int8), ("cut", np.int8), ("left", np.int32), ("vote", np.float64))]
            at = _reach(Tree(*values), _matrix(left["x"], width))
            return pa.table({"id": left["id"], "vote": pa.array(np.round(values[3][at] * _ONE).astype(np.int64))})

        keys = ["tree", "part", "block"]
        below = asked.groupBy(*keys).cogroup(known.groupBy(*keys)).applyInArrow(vote, "id bigint, vote bigint")
        above = routed.where("part < 0").select("id", "vote")
        votes = below.unionByName(above).groupBy("id").agg((F.sum("vote") / float(_ONE * len(self.grown))).alias("share"))
        return materialize(rows.join(votes, "id").select("x", "share"), "votes")

    def write(self) -> MLWriter:
        return _Writer(self)

    @classmethod
    def read(cls) -> MLReader:
        return _Reader()


class _Writer(MLWriter):
    def __init__(self, model: ForestModel):
        super().__init__()
        self.model = model

    def saveImpl(self, path: str) -> None:
        model = self.model
        trees = [[tree.feature, tree.cut, tree.left, tree.vote] for tree in model.grown]
        text = json.dumps({"limits": model.limits, "trees": trees, "importances": model.importances})
        DefaultParamsWriter.saveMetadata(model, path, self.sparkSession, extraMetadata={"forest": text})
        model.parts.write.parquet(f"{path}/parts")


class _Reader(MLReader):
    def load(self, path: str) -> ForestModel:
        spark = SparkSession.active()
        metadata = DefaultParamsReader.loadMetadata(path, spark)
        known = json.loads(metadata["forest"])
        model = ForestModel(known["limits"], [Tree(*values) for values in known["trees"]], known["importances"], spark.read.parquet(f"{path}/parts"))
        model._resetUid(metadata["uid"])
        return model
