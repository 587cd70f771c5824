"""Near-duplicate texts by an LSH forest, with every link confirmed on the full shingle sets.

Texts with equal sets are one class. A class has a MinHash signature; every
tree of the forest is the list of all classes sorted by its own stretch of the
signature. Neighbours in a sorted list share the longest prefixes, so a dense
region is compared deep down the tree and a sparse one near its top, without a
bucket size to choose. A candidate is a pair among the next ``NEAR`` rows with a
common prefix of at least ``LEAST`` hashes.

A region with more rows than neighbours looked at, in which classes are still in
different components afterwards, is finished exactly: classes with similarity
t share one of the ``floor((1 - t) * n) + 1`` hashes that come first in a common order.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from basketlens.llm.arrays import distinct, mix, shingles_of, words_of
from basketlens.llm.frames import RUN_BYTES, map_batches, runs
from basketlens.llm.graph import components
from basketlens.session import materialize

TREES = 24
DEPTH = 6  # hashes of a tree's sort key
LEAST = 3  # hashes two neighbours share at least: a pair at 0.75 is missed by all trees once in 500,000
NEAR = 4  # rows a row is compared with, after it in the sorted list
SIMILAR = (75, 100)  # shared part of the union, as a fraction
ESTIMATE = 0.58  # of equal signature hashes, below which a pair is not compared: 4.5 standard deviations

_HASHES = TREES * DEPTH
_FACTORS = (mix(np.arange(1, _HASHES + 1, dtype=np.uint64)) | np.uint64(1)).astype(np.uint32)
_SHIFTS = mix(np.arange(1001, _HASHES + 1001, dtype=np.uint64)).astype(np.uint32)


def _slices(column: pa.Array) -> Iterator[tuple[int, int]]:
    return runs(pa.compute.fill_null(pa.compute.binary_length(column), 0).to_pylist(), RUN_BYTES)


def _sets(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    return distinct(*shingles_of(words_of(column, lower=True)))


def _signatures(hashes: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Minima of ``_HASHES`` hash functions per non-empty row."""
    rows = np.flatnonzero(np.diff(starts))
    low = hashes.astype(np.uint32)
    out = np.empty((len(rows), _HASHES), np.uint32)
    for i in range(_HASHES):
        if len(rows):
            out[:, i] = np.minimum.reduceat(low * _FACTORS[i] + _SHIFTS[i], starts[:-1][rows])
    return out


def _sums(values: np.ndarray, starts: np.ndarray) -> np.ndarray:
    running = np.concatenate([[np.uint64(0)], np.cumsum(values)])
    return running[starts[1:]] - running[starts[:-1]]


def prints(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, n_shingles, k1, k2, signature``; k1 and k2 are a 128-bit hash of the set.

    A text without words, or null, has no shingles and no signature.
    """
    base = docs.select(F.col(key).cast("long").alias("doc_id"), F.col(text).alias("_text"))

    def one(batch: pa.RecordBatch):
        for low, high in _slices(batch.column("_text")):
            hashes, starts = _sets(batch.column("_text").slice(low, high - low))
            counts = np.diff(starts)
            signed = _signatures(hashes, starts).astype(">u4")
            each = iter(signed)
            yield {
                "doc_id": batch.column("doc_id").slice(low, high - low),
                "n_shingles": counts,
                "k1": _sums(mix(hashes), starts).astype(np.int64),
                "k2": _sums(mix(hashes ^ np.uint64(0x5DEECE66D)), starts).astype(np.int64),
                "signature": [next(each).tobytes() if n else None for n in counts],
            }

    return map_batches(base, one, "doc_id bigint, n_shingles bigint, k1 bigint, k2 bigint, signature binary")


def _classes(printed: DataFrame) -> DataFrame:
    """``k1, k2, node, signature``: one row per distinct set; the node is its smallest doc_id."""
    return printed.where("n_shingles > 0 and doc_id is not null").groupBy("k1", "k2").agg(
        F.min("doc_id").alias("node"), F.first("signature").alias("signature")
    )


def _neighbours(classes: DataFrame) -> DataFrame:
    """``a, b, depth``: pairs of the forest's sorted lists that share at least ``LEAST`` hashes."""
    size = 4 * DEPTH
    rows = classes.select("node", "signature", F.explode(F.sequence(F.lit(0), F.lit(TREES - 1))).alias("tree")).select(
        "tree", F.expr(f"substring(signature, tree * {size} + 1, {size})").alias("key"), "node"
    )
    partitions = int(classes.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = rows.repartitionByRange(partitions, "tree", "key", "node").sortWithinPartitions("tree", "key", "node")
    schema = "a bigint, b bigint, depth int, part int, tree int, key binary"

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        kept = (np.zeros(0, np.int32), np.zeros((0, DEPTH), np.uint32), np.zeros(0, np.int64))
        headed = 0
        for batch in batches:
            n = len(batch)
            if not n:
                continue
            tree = batch.column("tree").to_numpy().astype(np.int32)
            keys = np.frombuffer(b"".join(batch.column("key").to_pylist()), ">u4").reshape(n, DEPTH)
            node = batch.column("node").to_numpy()
            if headed < NEAR:
                yield edges(part, tree[: NEAR - headed], keys[: NEAR - headed], node[: NEAR - headed])
                headed += min(n, NEAR - headed)
            old = len(kept[0])
            tree, keys, node = (np.concatenate(x) for x in zip(kept, (tree, keys, node)))
            for back in range(1, NEAR + 1):
                later = np.arange(max(old, back), old + n)
                depth = np.cumprod(keys[later] == keys[later - back], axis=1).sum(axis=1)
                hit = (tree[later] == tree[later - back]) & (depth >= LEAST) & (node[later] != node[later - back])
                x, y = node[later[hit]], node[later[hit] - back]
                yield table(a=np.minimum(x, y), b=np.maximum(x, y), depth=depth[hit].astype(np.int32))
            kept = tree[-NEAR:], keys[-NEAR:], node[-NEAR:]
        yield edges(part, *kept)

    fields = pa.schema([("a", pa.int64()), ("b", pa.int64()), ("depth", pa.int32()), ("part", pa.int32()), ("tree", pa.int32()), ("key", pa.binary())])

    def table(**columns) -> pa.RecordBatch:
        n = len(next(iter(columns.values())))
        return pa.RecordBatch.from_arrays(
            [pa.array(columns[f.name], f.type) if f.name in columns else pa.nulls(n, f.type) for f in fields], schema=fields
        )

    def edges(part: int, tree: np.ndarray, keys: np.ndarray, node: np.ndarray) -> pa.RecordBatch:
        return table(a=node, part=np.full(len(node), part), tree=tree, key=[k.astype(">u4").tobytes() for k in keys])

    found = materialize(dealt.mapInArrow(scan, schema), "forest")
    # first and last rows of all partitions: a few per partition
    ends = found.where(F.col("part").isNotNull()).select("a", "part", "tree", "key").distinct()
    order = Window.orderBy("tree", "key", "a")
    across = []
    for ahead in range(1, NEAR + 1):
        then = F.lead(F.struct("a", "part", "tree", "key"), ahead).over(order)
        near = ends.withColumn("then", then).where("then.tree = tree and then.part <> part and then.a <> a")
        depth = sum(
            (F.substring("key", 1, 4 * d) == F.substring(F.col("then.key"), 1, 4 * d)).cast("int") for d in range(1, DEPTH + 1)
        )
        across.append(near.select(F.least("a", "then.a").alias("a"), F.greatest("a", "then.a").alias("b"), depth.alias("depth")))
    pairs = found.where(F.col("b").isNotNull()).select("a", "b", "depth")
    for more in across:
        pairs = pairs.unionByName(more.where(F.col("depth") >= LEAST))
    return pairs.groupBy("a", "b").agg(F.sum("depth").alias("depth"))


def _compared(pairs: DataFrame, bodies: DataFrame) -> DataFrame:
    """``a, b`` of the pairs whose full sets are similar enough."""
    left = bodies.select(F.col("node").alias("a"), F.col("text").alias("_one"))
    right = bodies.select(F.col("node").alias("b"), F.col("text").alias("_two"))
    both = pairs.select("a", "b").join(right, "b").join(left, "a")

    def similar(batch: pa.RecordBatch):
        lengths = np.add(*[pa.compute.binary_length(batch.column(c)).to_numpy() for c in ("_one", "_two")])
        for low, high in runs(lengths.tolist(), RUN_BYTES):
            part = batch.slice(low, high - low)
            (one, from_one), (two, from_two) = _sets(part.column("_one")), _sets(part.column("_two"))
            n_one, n_two = np.diff(from_one), np.diff(from_two)
            row = np.concatenate([np.repeat(np.arange(len(part)), n) for n in (n_one, n_two)])
            every = np.concatenate([one, two])
            order = np.lexsort((every, row))
            every, row = every[order], row[order]
            same = (every[1:] == every[:-1]) & (row[1:] == row[:-1])
            shared = np.bincount(row[1:][same], minlength=len(part))
            ok = SIMILAR[1] * shared >= SIMILAR[0] * (n_one + n_two - shared)
            yield {"a": part.column("a").filter(pa.array(ok)), "b": part.column("b").filter(pa.array(ok))}

    return map_batches(both.select("a", "b", "_one", "_two"), similar, "a bigint, b bigint").distinct()


def _likely(pairs: DataFrame, classes: DataFrame) -> DataFrame:
    """``a, b`` of the pairs whose signatures agree often enough to be worth comparing."""
    one = classes.select(F.col("node").alias("a"), F.col("signature").alias("_one"))
    two = classes.select(F.col("node").alias("b"), F.col("signature").alias("_two"))

    def agree(batch: pa.RecordBatch):
        one, two = (
            np.frombuffer(b"".join(batch.column(c).to_pylist()), ">u4").reshape(-1, _HASHES) for c in ("_one", "_two")
        )
        ok = pa.array((one == two).mean(axis=1) >= ESTIMATE)
        yield {"a": batch.column("a").filter(ok), "b": batch.column("b").filter(ok)}

    both = pairs.select("a", "b").join(one, "a").join(two, "b").select("a", "b", "_one", "_two")
    return map_batches(both, agree, "a bigint, b bigint").distinct()


def _apart(pairs: DataFrame, labels: DataFrame) -> DataFrame:
    """Pairs whose ends are not in one component."""
    one = labels.select(F.col("node").alias("a"), F.col("component").alias("_one"))
    two = labels.select(F.col("node").alias("b"), F.col("component").alias("_two"))
    joined = pairs.join(one, "a", "left").join(two, "b", "left")
    return joined.where(F.coalesce("_one", "a") != F.coalesce("_two", "b")).drop("_one", "_two")


def _crowded(pairs: DataFrame, classes: DataFrame, labels: DataFrame) -> DataFrame:
    """Nodes of regions with more rows than were compared and with more than one component."""
    nodes = pairs.select(F.col("a").alias("node")).unionByName(pairs.select(F.col("b").alias("node"))).distinct()
    size = 4 * DEPTH
    rows = (
        classes.join(nodes, "node", "left_semi")
        .join(labels, "node", "left")
        .select("node", F.coalesce("component", "node").alias("component"), "signature", F.explode(F.sequence(F.lit(0), F.lit(TREES - 1))).alias("tree"))
        .select("node", "component", "tree", F.expr(f"substring(signature, tree * {size} + 1, {4 * LEAST})").alias("prefix"))
    )
    rows = materialize(rows, "regions")
    full = (
        rows.groupBy("tree", "prefix")
        .agg(F.count(F.lit(1)).alias("n"), F.min("component").alias("low"), F.max("component").alias("high"))
        .where((F.col("n") > NEAR + 1) & (F.col("low") != F.col("high")))
    )
    return rows.join(full, ["tree", "prefix"], "left_semi").select("node", "component").distinct()


def _rest(crowded: DataFrame, bodies: DataFrame) -> DataFrame:
    """``a, b``: all pairs of crowded nodes in different components that can be similar enough.

    A node's hashes are ordered by how many crowded nodes have them. Two similar
    sets share one of their first hashes in any common order; in this one, what
    only one of two copies has comes first, so unlike pairs fail on the place of
    the first hash they share and are never made.
    """
    base = crowded.join(bodies, "node").select("node", "component", F.col("text").alias("_text"))

    def hashed(batch: pa.RecordBatch):
        hashes, starts = _sets(batch.column("_text"))
        n = np.diff(starts)
        row = np.repeat(np.arange(len(batch)), n)
        yield {
            "node": batch.column("node").to_numpy()[row],
            "component": batch.column("component").to_numpy()[row],
            "hash": hashes.astype(np.int64),
            "n": n[row],
        }

    rows = materialize(map_batches(base, hashed, "node bigint, component bigint, hash bigint, n bigint"), "hashes")
    seen = rows.groupBy("hash").agg(
        F.count(F.lit(1)).alias("seen"), F.min("component").alias("low"), F.max("component").alias("high")
    )
    order = Window.partitionBy("node").orderBy("seen", "hash")
    first = (
        rows.join(seen, "hash")
        .withColumn("place", F.row_number().over(order) - 1)
        .where(F.col("place") <= F.col("n") - F.ceil(F.col("n") * SIMILAR[0] / SIMILAR[1]))
        .where("low <> high")
        .select("hash", "node", "component", "n", "place")
    )
    first = materialize(first, "prefixes")
    one, two = (first.select("hash", *[F.col(c).alias(f"{c}_{s}") for c in ("node", "component", "n", "place")]) for s in ("a", "b"))
    # a shared hash at these places leaves at most what follows it to be shared
    most = F.least(F.col("n_a") - F.col("place_a"), F.col("n_b") - F.col("place_b"))
    enough = (SIMILAR[0] + SIMILAR[1]) * most >= SIMILAR[0] * (F.col("n_a") + F.col("n_b"))
    return (
        one.join(two, "hash")
        .where((F.col("node_a") < F.col("node_b")) & (F.col("component_a") != F.col("component_b")) & enough)
        .select(F.col("node_a").alias("a"), F.col("node_b").alias("b"))
        .distinct()
    )


def groups(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, n_shingles, component_id, kept`` of every row of ``docs``.

    Rows are linked when their sets of distinct 5-word shingles (lower-case A-Z;
    with fewer words the whole sequence) share at least ``SIMILAR`` of their
    union. ``component_id`` is the smallest doc_id that links reach and ``kept``
    marks it. A text without words, or null, is linked with nothing. Rows with
    one doc_id count as one document; a row without doc_id has no component and
    is not kept. Equal sets meet as one class, so a hot group of copies is one
    row; an empty table gives an empty result.
    """
    printed = materialize(prints(docs, key, text), "prints")
    classes = materialize(_classes(printed), "classes")
    pairs = materialize(_neighbours(classes), "pairs")
    nodes = pairs.select(F.col("a").alias("node")).unionByName(pairs.select(F.col("b").alias("node"))).distinct()
    nodes = materialize(nodes, "nodes")
    named = docs.select(F.col(key).cast("long").alias("node"), F.col(text).alias("text")).where(F.col("text").isNotNull())
    bodies = materialize(named.join(nodes, "node", "left_semi"), "bodies")

    # the best smaller neighbour of every node first: it ties most groups together
    best = F.max_by("a", F.struct("depth", -F.col("a"))).alias("a")
    first = materialize(pairs.groupBy("b").agg(best), "first")
    links = materialize(_compared(first, bodies), "links")
    labels = materialize(components(links), "labels")
    open_pairs = _apart(pairs.join(first, ["a", "b"], "left_anti"), labels)
    likely = materialize(_likely(open_pairs, classes), "likely")
    links = materialize(links.unionByName(_compared(likely, bodies)), "links")
    labels = materialize(components(links), "labels")

    crowded = materialize(_crowded(pairs, classes, labels), "crowded")
    if not crowded.isEmpty():
        left = _rest(crowded, bodies).join(likely.unionByName(first.select("a", "b")), ["a", "b"], "left_anti")
        left = materialize(_likely(left, classes), "left")
        more = materialize(_compared(left, bodies), "links")
        if not more.isEmpty():
            labels = materialize(components(links.unionByName(more)), "labels")

    named_classes = classes.select("k1", "k2", "node").join(labels, "node", "left")
    named_classes = named_classes.select("k1", "k2", F.coalesce("component", "node").alias("_component"))
    own = F.when(F.col("n_shingles") > 0, F.col("_component")).otherwise(F.col("doc_id"))
    return (
        printed.drop("signature")
        .join(named_classes, ["k1", "k2"], "left")
        .withColumn("component_id", F.when(F.col("doc_id").isNotNull(), own))
        .select("doc_id", "n_shingles", "component_id", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(False)).alias("kept"))
    )


def first_of_groups(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of ``docs`` with one document of every group, with the columns of ``docs``.

    The smallest doc_id of a group stays. Of several rows with one doc_id one
    stays; rows without doc_id stay.
    """
    found = materialize(groups(docs, key, text).where(F.col("doc_id").isNotNull()), "groups")
    gone = materialize(found.where(~F.col("kept")).select(F.col("doc_id").alias("_gone")).distinct(), "gone")
    left = docs.join(gone, F.col(key).cast("long") == F.col("_gone"), "left_anti")
    again = found.where("kept").groupBy(F.col("doc_id").alias("_again")).agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    again = materialize(again.select("_again"), "again")
    if again.isEmpty():
        return left
    same = F.col(key).cast("long") == F.col("_again")
    order = Window.partitionBy(F.col(key)).orderBy(F.xxhash64(*docs.columns))
    one = left.join(again, same, "left_semi").select(F.struct(*docs.columns).alias("_row"), F.row_number().over(order).alias("_place"))
    return left.join(again, same, "left_anti").unionByName(one.where("_place = 1").select("_row.*"))
