"""Repair of conversations: the cheapest edits that leave ``(system?) user assistant user assistant ...``.

A conversation is a string of symbols, one per row: the role's initial, and whether the row must go or
is truncated. Equal neighbours collapse to runs; a run advances the costs by the binary powers of its
symbol's 4 x 4 min-plus matrix, which are kept per worker. Rows are handled in blocks of bounded size in
the order of all conversations: a conversation that spreads over blocks is put together from one matrix
per block, so none is ever collected. Texts take no part until the edits are known and move once.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence
from functools import lru_cache
from itertools import groupby

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from basketlens.llm.frames import SPACES
from basketlens.operators.ranking import global_row_number
from basketlens.session import materialize

BLOCK_ROWS = 16_384  # rows of one group
OUT_ROWS = 1_000  # rows of a batch of repaired texts

REROLE, DELETE, INSERT, TRUNCATED = 1, 2, 5, 5  # costs; keeping is free

# --- the automaton and its min-plus matrices -----------------------------------------

_START, _SYSTEM, _USER, _ASSISTANT = range(4)
_STATES = range(4)
_NEXT = ({"s": _SYSTEM, "u": _USER}, {"u": _USER}, {"a": _ASSISTANT}, {"u": _USER})
_WANTED = "uuau"  # by state, the role of an inserted or reroled row
_ROLES = {"u": "user", "a": "assistant"}
_NEVER = 1 << 60
_GONE = "x"  # symbol of a row that must be deleted

Costs = tuple[int, ...]


def _after(state: int) -> int:
    return _NEXT[state][_WANTED[state]]


def _edits(symbol: str, state: int) -> list[tuple[str, int, int]]:
    """(initial, cost, next state) of the edits of one row, in ASCII order of the initials."""
    found = [("D", DELETE, state)]
    if symbol != _GONE:
        extra = TRUNCATED if symbol.isupper() else 0
        if symbol.lower() in _NEXT[state]:
            found.append(("K", extra, _NEXT[state][symbol.lower()]))
        found.append(("R", REROLE + extra, _after(state)))
    return found


def _times(a: Sequence[Costs], b: Sequence[Costs]) -> tuple[Costs, ...]:
    return tuple(tuple(min(min(x + b[k][j] for k, x in enumerate(row)), _NEVER) for j in _STATES) for row in a)


def _apply(matrix: Sequence[Costs], costs: Costs) -> Costs:
    return tuple(min(min(x + y for x, y in zip(row, costs)), _NEVER) for row in matrix)


def _inserts() -> tuple[Costs, ...]:
    """Cheapest way between states by inserted rows alone."""
    step = tuple(tuple(0 if p == q else INSERT if q == _after(p) else _NEVER for q in _STATES) for p in _STATES)
    return _times(step, step)  # no state is more than two away


_INSERTS = _inserts()
_END = _apply(_INSERTS, (0, _NEVER, _NEVER, 0))  # cost to end a conversation, by state


@lru_cache(maxsize=None)
def _power(symbol: str, k: int) -> tuple[Costs, ...]:
    """Matrix of ``2 ** k`` rows of one symbol, inserted rows before each included."""
    if k:
        half = _power(symbol, k - 1)
        return _times(half, half)
    row = [[_NEVER] * 4 for _ in _STATES]
    for state in _STATES:
        for _, cost, to in _edits(symbol, state):
            row[state][to] = min(row[state][to], cost)
    return _times(_INSERTS, row)


def _advance(symbol: str, count: int, costs: Costs) -> Costs:
    """Costs before a run from the costs behind it."""
    for k in range(count.bit_length()):
        if count >> k & 1:
            costs = _apply(_power(symbol, k), costs)
    return costs


def _runs(parts: Sequence[tuple[str, int]]) -> list[tuple[str, int]]:
    """(symbol, count) with equal neighbours put together."""
    return [(symbol, sum(count for _, count in run)) for symbol, run in groupby(parts, key=lambda part: part[0])]


def _choose(symbol: str, state: int, here: Costs, behind: Costs) -> tuple[str, int]:
    """ASCII-least cheapest edits up to one row's own, and the state after it."""
    edits = ""
    while True:
        options = _edits(symbol, state)
        (_, cost, _), *others = options
        if cost + behind[state] == here[state]:
            return edits + "D", state
        if INSERT + here[_after(state)] == here[state]:
            edits, state = edits + "I", _after(state)
            continue
        for initial, cost, to in others:
            if cost + behind[to] == here[state]:
                return edits + initial, to


def unrolled(parts: Sequence[tuple[str, int]], state: int, behind: Costs, closed: bool = True) -> tuple[list[str], int]:
    """Edits of all rows, as one string per run, and the state at the end.

    ``behind`` has the cost of what follows for every state; unless ``closed``, rows may not be inserted at
    the very end, so the last row is a run of its own. A deleted row is deleted as early as possible, for D
    is the least initial; therefore a run that must go costs no search.
    """
    runs = _runs(parts)
    if not closed and runs and runs[-1][1] > 1:
        symbol, count = runs.pop()
        runs += [(symbol, count - 1), (symbol, 1)]
    costs = [behind]
    for symbol, count in reversed(runs):
        costs.append(_advance(symbol, count, costs[-1]))
    costs.reverse()
    found = []
    for at, (symbol, count) in enumerate(runs):
        if symbol == _GONE and (closed or at + 1 < len(runs)):
            found.append("D" * count)
            continue
        inside = [costs[at + 1]]
        for _ in range(count - 1):
            inside.append(_apply(_power(symbol, 0), inside[-1]))
        here, edits = costs[at], []
        for after in reversed(inside):
            chosen, state = _choose(symbol, state, here, after)
            edits.append(chosen)
            here = after
        found.append("".join(edits))
    return found, state


@lru_cache(maxsize=20_000)
def _remembered(parts: tuple[tuple[str, int], ...], state: int, behind: Costs) -> tuple[str, int]:
    found, state = unrolled(parts, state, behind)
    return "".join(found), state


def _decided(parts: Sequence[tuple[str, int]], state: int, behind: Costs) -> tuple[str, int]:
    """As ``unrolled``; the many short conversations with the same symbols are solved once a worker."""
    if len(parts) <= 64:
        return _remembered(tuple(parts), state, behind)
    found, state = unrolled(parts, state, behind)
    return "".join(found), state


# --- symbols ---------------------------------------------------------------------------

_KEY = ["conv", "turn", "role", "h", "g"]


def _text_rows(rows: DataFrame) -> DataFrame:
    """``conv, turn, role, h, g, text``: a conversation by a text that is never null, a text by two hashes."""
    number = F.col("conv_id").cast("string")
    text = F.coalesce("text", F.lit(" "))
    return rows.select(
        F.when(number.isNull(), "").otherwise(F.concat(F.lit("="), number)).alias("conv"),
        F.col("turn").cast("long").alias("turn"),
        F.coalesce("role", F.lit(" ")).alias("role"),
        F.xxhash64(text).alias("h"),
        F.xxhash64(F.lit(1), text).alias("g"),
        text.alias("text"),
    )


def _symbol() -> Column:
    """Lower-case class of a row's role, upper-case if its text is truncated, blank texts apart."""
    trimmed = F.rtrim(F.col("text"), F.lit(SPACES))
    initial = F.substring("role", 1, 1)
    kind = F.when(initial.isin("s", "u", "a"), initial).otherwise("o")
    whole = F.substring(trimmed, -1, 1).isin(".", "!", "?")
    return F.when(trimmed == "", "b").when(whole, kind).otherwise(F.upper(kind))


def symbols(rows: DataFrame) -> DataFrame:
    """Distinct rows in order: key, ``symbol``, how many are equal (``m``), whether the first of its role and text, ``row``.

    Equal rows are counted before they are moved; of a role and text the row with the least turn comes first.
    """
    counted = _text_rows(rows).withColumn("symbol", _symbol()).groupBy(*_KEY, "symbol").agg(F.count(F.lit(1)).alias("m"))
    counted = materialize(counted, "turns")
    same = ["conv", "role", "h", "g"]
    least = counted.groupBy(*same).agg(F.min(F.struct("turn")).alias("least"))
    seen = counted.join(least, same).withColumn("first", F.struct("turn") == F.col("least")).drop("least")
    return global_row_number(seen, _KEY, "row").withColumn("block", F.floor((F.col("row") - 1) / BLOCK_ROWS).cast("long"))


def _parts(symbol: str, m: int, first: bool) -> list[tuple[str, int]]:
    """The run or two runs that ``m`` equal rows make: only the first of all may stay."""
    if symbol == "b" or not first:
        return [(_GONE, m)]
    return [(symbol, 1), (_GONE, m - 1)] if m > 1 else [(symbol, 1)]


def _segments(table: pa.Table) -> Iterator[tuple[str, int, int]]:
    """(conversation, first row, last row + 1) of a block in order."""
    at = 0
    for conv, run in groupby(table.column("conv").to_pylist()):
        size = sum(1 for _ in run)
        yield conv, at, at + size
        at += size


def _segment_parts(table: pa.Table, low: int, high: int) -> list[list[tuple[str, int]]]:
    part = table.slice(low, high - low)
    return [_parts(*row) for row in zip(*(part.column(name).to_pylist() for name in ("symbol", "m", "first")))]


# --- conversations over several blocks ---------------------------------------------------

_EDGES = "conv string, block long, costs array<long>, places array<int>, opens string, closes string"
_PLANS = "conv string, block long, state int, behind array<long>, before string, last boolean"


def _edges(table: pa.Table) -> pa.Table:
    """Costs between all states for the first and the last conversation of a block, which other blocks may share.

    ``places`` orders, for each first state, the last states by their edits, so equal costs are decided as in one piece.
    """
    table = table.sort_by("row")
    rows = []
    segments = list(_segments(table))
    for conv, low, high in {segments[0], segments[-1]}:
        parts = [part for row in _segment_parts(table, low, high) for part in row]
        columns, words = [], []
        for to in _STATES:
            behind = tuple(0 if q == to else _NEVER for q in _STATES)
            costs = behind
            for symbol, count in reversed(_runs(parts)):
                costs = _advance(symbol, count, costs)
            columns.append(costs)
            words.append(["".join(unrolled(parts, p, behind, False)[0]) if costs[p] < _NEVER else None for p in _STATES])
        order = []
        for p in _STATES:
            ranked = sorted((w[p] is None, w[p] or "", to) for to, w in enumerate(words))
            order += [[to for *_, to in ranked].index(q) for q in _STATES]
        roles = table.column("role")
        rows.append(
            {
                "conv": conv,
                "block": table.column("block")[0].as_py(),
                "costs": [columns[q][p] for p in _STATES for q in _STATES],
                "places": order,
                "opens": roles[low].as_py()[:1],
                "closes": roles[high - 1].as_py()[:1],
            }
        )
    return pa.Table.from_pylist(rows, _arrow_schema(_EDGES))


def _plans(edges: pd.DataFrame) -> pd.DataFrame:
    """First state, cost of the rest and role before, for every block of one conversation."""
    edges = edges.sort_values("block")
    behind, rest = [], _END
    for costs in reversed(list(edges["costs"])):
        behind.append(rest)
        rest = _apply([tuple(int(c) for c in costs[4 * p : 4 * p + 4]) for p in _STATES], rest)
    behind.reverse()
    state, before, rows = _START, None, []
    for at, edge in enumerate(edges.itertuples(index=False)):
        rows.append((edge.conv, edge.block, state, list(behind[at]), before, at + 1 == len(edges)))
        state = min(_STATES, key=lambda q: (int(edge.costs[4 * state + q]) + behind[at][q], edge.places[4 * state + q]))
        before = edge.closes
    return pd.DataFrame(rows, columns=["conv", "block", "state", "behind", "before", "last"])


def _arrow_schema(text: str) -> pa.Schema:
    kinds = {"long": pa.int64(), "int": pa.int32(), "string": pa.string(), "boolean": pa.bool_(), "array<long>": pa.list_(pa.int64()), "array<int>": pa.list_(pa.int32())}
    return pa.schema([(name, kinds[kind]) for name, kind in (column.split(" ") for column in text.split(", "))])


# --- decisions ---------------------------------------------------------------------------

_DECISIONS = (
    "conv string, turn long, role string, h long, g long, row long, edit string, into string, ahead string, behind string, "
    "audit string, cost long, illegal long"
)
_LEGAL = {"su", "ua", "au"}


def _decide(table: pa.Table, plans: pa.Table) -> pa.Table:
    """Edits of all rows of a block; the first row of a conversation has what is summed up for it."""
    table = table.sort_by("row")
    size = table.num_rows
    known = {row["conv"]: row for row in plans.to_pylist()}
    edit, into, ahead, behind, audit, cost, illegal = ([None] * size for _ in range(7))
    roles, counts = table.column("role").to_pylist(), table.column("m").to_pylist()
    for conv, low, high in _segments(table):
        plan = known.get(conv) or {"state": _START, "behind": _END, "before": None, "last": True}
        rows = _segment_parts(table, low, high)
        edits, _ = _decided([part for row in rows for part in row], plan["state"], tuple(plan["behind"]))
        state, at, total, odd, before = plan["state"], 0, 0, 0, plan["before"]
        for i, row in zip(range(low, high), rows):
            ahead[i] = ""
            while edits[at] == "I":
                ahead[i], state, at = ahead[i] + _WANTED[state], _after(state), at + 1
            symbol, own = row[0][0], edits[at]
            paid, to = next((c, q) for e, c, q in _edits(symbol, state) if e == own)
            edit[i], into[i] = own, _ROLES[_WANTED[state]] if own == "R" else None
            state, at = to, at + counts[i]  # equal rows after the first are deleted
            total += INSERT * len(ahead[i]) + paid + DELETE * (counts[i] - 1)
            initial = roles[i][:1]
            odd += (before is not None and before + initial not in _LEGAL) + counts[i] - 1
            before = initial
        behind[high - 1] = ""
        while plan["last"] and _END[state]:
            behind[high - 1], state = behind[high - 1] + _WANTED[state], _after(state)
        tail = len(behind[high - 1])
        audit[low], cost[low], illegal[low] = edits + "I" * tail, total + INSERT * tail, odd
    made = {"edit": edit, "into": into, "ahead": ahead, "behind": behind, "audit": audit, "cost": cost, "illegal": illegal}
    schema = _arrow_schema(_DECISIONS)
    return pa.table([table.column(f.name) if f.name not in made else pa.array(made[f.name], f.type) for f in schema], schema=schema)


def decisions(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The ordered rows with their symbols, and their edits (both stored, without texts)."""
    ordered = symbols(rows)
    edges = ordered.groupBy("block").applyInArrow(_edges, _EDGES)
    plans = edges.groupBy("conv").applyInPandas(_plans, _PLANS)
    decided = ordered.groupBy("block").cogroup(plans.groupBy("block")).applyInArrow(_decide, _DECISIONS)
    return ordered, materialize(decided, "edits")


# --- repaired rows ------------------------------------------------------------------------

_REPAIRED = "conv string, position long, role string, text string"


def _stream(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Repaired rows of sorted decisions and texts: a decision comes right before the texts of its key.

    Only the batch at hand and one decision are held, however long a conversation is.
    """
    out: list[tuple] = []
    conv, position, pending = None, 0, None
    schema = _arrow_schema(_REPAIRED)

    def batch() -> pa.RecordBatch:
        columns = list(zip(*out)) or [()] * 4
        out.clear()
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)

    def put(role: str, text: str) -> None:
        nonlocal position
        out.append((conv, position, role, text))
        position += 1

    for incoming in batches:
        for row in zip(*(incoming.column(i).to_pylist() for i in range(incoming.num_columns))):
            key, (kind, text, edit, into, ahead, behind) = row[:5], row[5:]
            if key[0] != conv:
                conv, position = key[0], 0
            if kind == 0:
                for initial in ahead:
                    put(_ROLES[initial], "")
                pending = (key, into or key[2], behind or "")
                if edit == "D":
                    for initial in behind or "":
                        put(_ROLES[initial], "")
                    pending = None
            elif pending and pending[0] == key:
                put(pending[1], text)
                for initial in pending[2]:
                    put(_ROLES[initial], "")
                pending = None
            if len(out) >= OUT_ROWS:
                yield batch()
    yield batch()


def repaired(rows: DataFrame, decided: DataFrame) -> DataFrame:
    """``conv, position, role, text`` of the conversations after their edits, in order within a partition.

    Decisions and texts meet in one exchange by conversation and one sort.
    """
    plans = decided.where("edit <> 'D' OR ahead <> '' OR behind <> ''").select(
        *_KEY, F.lit(0).alias("kind"), F.lit(None).cast("string").alias("text"), "edit", "into", "ahead", "behind"
    )
    nothing = F.lit(None).cast("string")
    texts = _text_rows(rows).select(*_KEY, F.lit(1).alias("kind"), "text", *[nothing.alias(n) for n in ("edit", "into", "ahead", "behind")])
    both = plans.unionByName(texts).repartition("conv").sortWithinPartitions(*_KEY, "kind")
    return both.mapInArrow(_stream, _REPAIRED)


def _digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema = _arrow_schema("conv string, repaired_sha256 string")
    conv, running = None, None
    for incoming in batches:
        done = []
        for key, position, role, text in zip(*(incoming.column(i).to_pylist() for i in range(4))):
            if key != conv:
                if running:
                    done.append((conv, running.hexdigest()))
                conv, running = key, hashlib.sha256()
            running.update(("\n" if position else "").encode() + f"{role}:{text}".encode())
        columns = list(zip(*done)) or [(), ()]
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.string()) for c in columns], schema=schema)
    if running:
        yield pa.RecordBatch.from_arrays([pa.array([conv]), pa.array([running.hexdigest()])], schema=schema)


def digests(fixed: DataFrame) -> DataFrame:
    """``conv, repaired_sha256``: SHA-256 of ``role:text`` joined by newlines, for rows as ``repaired`` gives them.

    The digest runs along with the rows of a conversation, which a partition has in order.
    """
    return fixed.mapInArrow(_digest, "conv string, repaired_sha256 string")


def conversation_ids(fixed: DataFrame, kind: T.DataType) -> Column:
    """The conversation number of the rows of this module."""
    return F.when(F.col("conv") != "", F.substring("conv", 2, 1 << 30)).cast(kind)


def reports(original: DataFrame, rows: DataFrame) -> DataFrame:
    """One row per conversation of ``original``: counts of faults, cost, audit and digest of the repaired ``rows``.

    ``rows`` are those of ``original`` after whatever happened to them: ``conv_id, turn, role, text``; other columns
    are not read. They are taken by turn (null first), then role and text; equal rows stand together. A null role or
    text counts as one space, a null ``conv_id`` is a conversation of its own. Each row's first fault counts: blank,
    a repeat of an earlier role and text, or no ``. ! ?`` at its end. A conversation without rows has zeros, an
    empty audit and the digest of nothing; an empty table gives no rows. Very long conversations are cut into blocks,
    very long texts are only hashed.
    """
    ordered, decided = decisions(rows)
    known = ordered.groupBy("conv", "turn").agg(*_faults())
    totals = known.groupBy("conv").agg(
        (F.max("turn") - F.min("turn") + 1 - F.count("turn")).alias("gaps"),
        *[F.sum(name).alias(name) for name in ("blank", "duplicate", "truncated")],
    )
    pieces = decided.where(F.col("audit").isNotNull()).groupBy("conv").agg(
        F.sum("cost").alias("cost"),
        F.sum("illegal").alias("illegal"),
        F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("row", "audit"))), lambda x: x["audit"]), "").alias("audit"),
    )
    every = _text_rows(original).select("conv").distinct()
    found = digests(repaired(rows, decided))
    parts = [every, totals, pieces, found]
    together = parts[0]
    for part in parts[1:]:
        together = together.unionByName(part, allowMissingColumns=True)
    names = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]
    summed = together.groupBy("conv").agg(*[F.max(name).alias(name) for name in [*names, "audit", "repaired_sha256"]])
    return summed.select(
        conversation_ids(summed, original.schema["conv_id"].dataType).alias("conv_id"),
        *[F.coalesce(name, F.lit(0)).cast("long").alias(name) for name in names],
        F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("repaired_sha256", F.lit(hashlib.sha256().hexdigest())).alias("repaired_sha256"),
    )


def _faults() -> list[Column]:
    blank, first = F.col("symbol") == "b", F.col("first")
    return [
        F.sum(F.when(blank, F.col("m"))).alias("blank"),
        F.sum(F.when(~blank, F.col("m") - F.col("first").cast("long"))).alias("duplicate"),
        F.count_if(~blank & first & F.col("symbol").rlike("^[A-Z]")).alias("truncated"),
    ]


def damaged(conversations: DataFrame) -> DataFrame:
    """Rows with faults put in by a hash of ``conv_id:turn``, for the check of the repair; nulls are one space."""
    texts = {name: F.coalesce(F.col(name).cast("string"), F.lit(" ")) for name in ("conv_id", "turn", "role", "text")}
    fault = F.pmod(F.crc32(F.concat(texts["conv_id"], F.lit(":"), texts["turn"]).cast("binary")), F.lit(20))
    text = F.when(fault == 1, "").when(fault == 2, F.translate(texts["text"], ".!?", "")).otherwise(texts["text"])
    return (
        conversations.where(fault != 0)
        .select("conv_id", "turn", F.when(fault == 4, "user").otherwise(texts["role"]).alias("role"), text.alias("text"),
                F.explode(F.array_repeat(F.lit(0), F.when(fault == 3, 2).otherwise(1))).alias("copy"))
        .drop("copy")
    )
