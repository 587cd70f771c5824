"""Shards of near equal bytes from a k-d tree over document metadata, without Python on the rows.

The tree is grown level by level on a narrow table of sizes and metadata: every
node is split at the weighted median of its widest dimension until each leaf has
its target of bytes. Medians come from histograms of sums that are refined
around the place searched for, so a level moves some thousand sums and no rows.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from basketlens.session import materialize

_TIE_BITS = 32  # low bits of a dimension's key: a hash, so that equal values can be split
_VALUE_BITS = 16
_STEP_BITS = 12  # a histogram has 2**12 bins per node
_CLOSE = 1e-4  # of a node's bytes: a bin this small needs no finer cut


@dataclass
class Node:
    leaves: int
    first: int  # number of its first leaf
    dimension: str | None = None
    threshold: int | None = None
    sides: tuple[Node, Node] | None = None


def _code(value: Column) -> Column:
    """A category as a number of 16 bits; null is 0."""
    hashed = F.pmod(F.xxhash64(value), F.lit((1 << _VALUE_BITS) - 1)) + 1
    return F.when(value.isNull(), F.lit(0)).otherwise(hashed)


def metadata(docs: DataFrame, key: str = "doc_id", text: str = "text", categories: tuple[str, ...] = ("source", "lang")) -> DataFrame:
    """``doc_id, size, text_crc32`` and one key per dimension: text length and every category."""
    body = F.coalesce(F.col(text), F.lit(""))
    narrow = docs.select(
        F.col(key).alias("doc_id"),
        (F.octet_length(body) + 1).cast("long").alias("size"),
        F.crc32(body.cast("binary")).alias("text_crc32"),
        *[_code(F.col(c)).alias(f"_c{i}") for i, c in enumerate(categories)],
    )
    tie = F.pmod(F.xxhash64("doc_id", "text_crc32", "size"), F.lit(1 << _TIE_BITS))
    length = F.floor(F.log2(F.col("size")) * 1024)
    dimensions = [length, *[F.col(f"_c{i}") for i in range(len(categories))]]
    return narrow.select(
        "doc_id", "size", "text_crc32",
        *[(F.shiftleft(d.cast("long"), _TIE_BITS) + tie).alias(f"d{i}") for i, d in enumerate(dimensions)],
    )


def _place(node: Node, of) -> Column:
    if node.sides is None:
        return of(node)
    low, high = node.sides
    return F.when(F.col(node.dimension) <= F.lit(node.threshold), _place(low, of)).otherwise(_place(high, of))


def _open(node: Node) -> list[Node]:
    if node.sides is not None:
        return _open(node.sides[0]) + _open(node.sides[1])
    return [node] if node.leaves > 1 else []


def grow(rows: DataFrame, dimensions: list[str], shards: int) -> Node:
    """The tree over ``rows``; a few sums per node come to the driver, never rows."""
    root = Node(shards, 0)
    spread: dict[str, int] = {}
    while _open(root):
        nodes = {node.first: node for node in _open(root)}
        at = _place(root, lambda node: F.lit(node.first))
        here = rows.withColumn("_node", at).where(F.col("_node").isin([*nodes]))
        value = {d: F.shiftright(d, _TIE_BITS) for d in dimensions}
        stats = {
            r["_node"]: r
            for r in here.groupBy("_node")
            .agg(
                F.sum("size").alias("bytes"),
                *[(F.max(v) - F.min(v)).alias(d) for d, v in value.items()],
            )
            .collect()
        }
        if not spread:
            spread = {d: max((stats[0][d] if stats else 0) or 0, 1) for d in dimensions}
        for first, node in nodes.items():
            found = stats.get(first)
            node.dimension = max(dimensions, key=lambda d: found[d] / spread[d]) if found else dimensions[0]
        goals = {first: (stats[first]["bytes"] if first in stats else 0) * (n.leaves // 2) / n.leaves for first, n in nodes.items()}
        limits = {first: _CLOSE * (stats[first]["bytes"] if first in stats else 0) for first in nodes}
        _thresholds(here, nodes, goals, limits)
        for node in nodes.values():
            half = node.leaves // 2
            node.sides = Node(half, node.first), Node(node.leaves - half, node.first + half)
    return root


def _thresholds(here: DataFrame, nodes: dict[int, Node], goals: dict[int, float], limits: dict[int, float]) -> None:
    """Sets every node's threshold: the last key of the side that comes closest to its goal."""
    key = F.coalesce(*[F.when(F.col("_node") == f, F.col(n.dimension)) for f, n in nodes.items()])
    keyed = here.select("_node", "size", key.alias("_key"))
    shift = _TIE_BITS + _VALUE_BITS
    prefix = dict.fromkeys(nodes, 0)  # the high bits of the threshold, as far as known
    below = dict.fromkeys(nodes, 0)  # bytes of keys with smaller high bits
    searching = set(nodes)
    while searching:
        step = min(_STEP_BITS, shift)
        inside = F.coalesce(
            *[F.when(F.col("_node") == f, F.shiftright("_key", shift) == F.lit(prefix[f])) for f in sorted(searching)],
            F.lit(False),
        )
        shift -= step
        bins = (
            keyed.where(inside)
            .groupBy("_node", F.shiftright("_key", shift).alias("_bin"))
            .agg(F.sum("size").alias("bytes"))
            .collect()
        )
        for first in sorted(searching):
            mine = sorted((r["_bin"], r["bytes"]) for r in bins if r["_node"] == first)
            total, last = below[first], None
            for number, weight in mine:
                last = number, weight
                if total + weight >= goals[first]:
                    break
                total += weight
            number, weight = last if last else (prefix[first] << step, 0)
            end = ((number + 1) << shift) - 1
            if shift == 0 or weight <= limits[first]:
                nearer = abs(total + weight - goals[first]) <= abs(total - goals[first])
                nodes[first].threshold = end if nearer else end - (1 << shift)
                searching.discard(first)
            else:
                prefix[first], below[first] = number, total


def shards_by_bytes(docs: DataFrame, shards: int = 16, key: str = "doc_id", text: str = "text", categories: tuple[str, ...] = ("source", "lang")) -> DataFrame:
    """``doc_id, size, text_crc32, shard, slot`` of every row of ``docs``.

    ``size`` is the bytes of the text plus one; a null text has none. Shards
    differ by about one document and ``_CLOSE`` of their bytes. Equal rows are
    told apart by nothing and may be in any order; rows with equal metadata are
    split by a hash. ``slot`` counts from 0 in every shard without a gap. No
    text is moved; an empty table gives an empty result.
    """
    spark = docs.sparkSession
    rows = materialize(metadata(docs, key, text, categories), "metadata")
    dimensions = [c for c in rows.columns if c.startswith("d") and c[1:].isdigit()]
    tree = grow(rows, dimensions, shards)
    placed = rows.select(
        "doc_id", "size", "text_crc32", _place(tree, lambda node: F.lit(node.first)).alias("shard")
    ).withColumn("_part", F.pmod(F.xxhash64("doc_id", "text_crc32"), F.lit(int(spark.conf.get("spark.sql.shuffle.partitions")))))
    # one row per shard and part: the slots that the parts before take
    before = Window.partitionBy("shard").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        placed.groupBy("shard", "_part")
        .agg(F.count(F.lit(1)).alias("_n"))
        .select("shard", "_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_offset"))
    )
    within = Window.partitionBy("shard", "_part").orderBy("doc_id", "text_crc32", "size")
    return (
        placed.withColumn("_place", F.row_number().over(within) - 1)
        .join(F.broadcast(offsets), ["shard", "_part"])  # shards times partitions rows
        .select("doc_id", "size", "text_crc32", "shard", (F.col("_offset") + F.col("_place")).alias("slot"))
    )
