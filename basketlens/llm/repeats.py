"""Byte strings that repeat across documents, from suffix arrays over content anchors.

Every window of ``WINDOW`` bytes has an anchor: its ``GRAM`` bytes with the
smallest hash. Equal windows have the same anchor at the same place, so windows
can be dealt out by their anchor's hash, and the windows of one anchor travel
together as one short context. A task builds the enhanced suffix array of the
contexts of a bucket, with the longest common prefixes of neighbours, scans it
with a stack for the intervals of its common-prefix tree, and keeps those whose
suffixes are preceded by different bytes: the maximal repeats, each with all its
occurrences. A repeat longer than a context comes as a chain of overlapping ones.

Contexts that are equal as a whole are collapsed before they are moved and again
where they meet; only the one in the smallest document goes on.

Most text repeats nothing, so hashes go first: every window also has a marker,
the smallest hash of its ``MARKER`` byte strings, and equal windows have equal
markers. Documents learn which of their markers another document has, and only
windows with such a marker are sent as contexts. A false hit of a hash costs a
context; no window is left out.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basketlens.llm.arrays import POWERS, byte_rows, mix
from basketlens.llm.frames import RUN_BYTES, map_batches

WINDOW = 50
GRAM = 12
MARKER = 26
_PIECE = 1 << 19  # windows of a document that are handled at once
_FLUSH = 16 << 20  # bytes of text whose contexts a task collapses and sends together
_LEVEL = 6  # of compression: contexts are most of what is shuffled
_GROUPED = 20_000  # contexts whose windows are compared at once; those of one anchor stay together
_SUFFIXES = 200_000  # suffixes sorted at once; those that begin with the same window stay together
_VALUES = mix(np.arange(5001, 5257, dtype=np.uint64))
_LAST = np.iinfo(np.int64).max  # stands for a missing doc_id: after all others


def _range_sums(data: np.ndarray) -> np.ndarray:
    up, _ = POWERS.upto(len(data))
    return np.concatenate([[np.uint64(0)], np.cumsum(_VALUES[data] * up[: len(data)])])


def _range_hash(sums: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    _, down = POWERS.upto(len(sums))
    return mix((sums[end] - sums[start]) * down[start] + (end - start).astype(np.uint64))


def _chunks(length: np.ndarray) -> Iterator[tuple[int, int]]:
    """Row ranges of about ``RUN_BYTES`` in all, so that working arrays stay small."""
    ends = np.cumsum(length)
    low = 0
    while low < len(length):
        done = ends[low - 1] if low else 0
        high = max(int(np.searchsorted(ends, done + RUN_BYTES, side="right")), low + 1)
        yield low, high
        low = high


def _gather(data: np.ndarray, start: np.ndarray, length: np.ndarray) -> np.ndarray:
    """The bytes of all ranges, end to end."""
    out = np.empty(int(length.sum()), np.uint8)
    at = 0
    for low, high in _chunks(length):
        some = length[low:high]
        ends = np.cumsum(some)
        place = np.arange(ends[-1])
        out[at : at + ends[-1]] = data[place + np.repeat(start[low:high] - (ends - some), some)]
        at += int(ends[-1])
    return out


def _hashes(body: np.ndarray, at: np.ndarray, length: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Hash of ``body[begin:end]`` within each of the consecutive ranges (``at``, ``length``)."""
    out = np.empty(len(at), np.uint64)
    for low, high in _chunks(length):
        first = at[low]
        sums = _range_sums(body[first : at[high - 1] + length[high - 1]])
        out[low:high] = _range_hash(sums, begin[low:high] - first, end[low:high] - first)
    return out


def _least(values: np.ndarray, count: int) -> np.ndarray:
    """Minima of all runs of ``count`` values."""
    reach = 1
    while reach < count:  # runs of 2, 4, ... and at last ``count``
        step = min(reach, count - reach)
        values = np.minimum(values[:-step], values[step:])
        reach += step
    return values


def _pieces(data: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(place of the first window, bytes, sums for range hashes) of overlapping parts: every window is in one."""
    for low in range(0, len(data) - WINDOW + 1, _PIECE):
        part = data[low : low + _PIECE + WINDOW - 1]
        yield low, part, _range_sums(part)


def _markers(part: np.ndarray, sums: np.ndarray) -> np.ndarray:
    """Marker of every window of a part."""
    first = np.arange(len(part) - MARKER + 1)
    return _least(_range_hash(sums, first, first + MARKER), WINDOW - MARKER + 1)


def _runs(values: np.ndarray) -> np.ndarray:
    """Places where a run of equal values begins."""
    return np.concatenate([[0], np.flatnonzero(values[1:] != values[:-1]) + 1])


def _contexts(data: np.ndarray, shared: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, length, place of the anchor) of the contexts of one text.

    Every window is in exactly one, or in none if its marker is not ``shared``.
    """
    out = []
    for low, part, sums in _pieces(data):
        first = np.arange(len(part) - GRAM + 1)
        hashes = _range_hash(sums, first, first + GRAM)
        # hash and place in one number, so that the leftmost of equal ones is the minimum
        placed = (hashes & ~np.uint64((1 << 20) - 1)) | first.astype(np.uint64)
        anchor = (_least(placed, WINDOW - GRAM + 1) & np.uint64((1 << 20) - 1)).astype(np.int64)
        group = 2 * anchor
        if shared is not None:
            marker = _markers(part, sums)
            begin = _runs(marker)
            known = np.isin(mix(marker[begin]).astype(np.uint32), shared)
            group += np.repeat(known, np.diff(np.append(begin, len(marker))))
        begin = _runs(group)
        end = np.append(begin[1:], len(group)) - 1 + WINDOW
        if shared is not None:
            sent = group[begin] % 2 == 1
            begin, end = begin[sent], end[sent]
        out.append((begin + low, end - begin, anchor[begin] - begin))
    if not out:
        return (np.zeros(0, np.int64),) * 3
    return tuple(np.concatenate(x) for x in zip(*out))


_TABLE = [("doc", np.int64), ("mark", np.int64), ("start", np.int64), ("length", np.uint8), ("gram", np.uint8)]


class Entries:
    """Contexts as columns: document, mark of its text, start, length, place of the anchor, and bytes."""

    def __init__(self, columns: list[np.ndarray], body: np.ndarray):
        self.columns, self.body = [np.asarray(c, kind) for c, (_, kind) in zip(columns, _TABLE)], body
        self.doc, self.mark, self.start, length, gram = self.columns
        self.length, self.gram = length.astype(np.int64), gram.astype(np.int64)
        self.at = np.cumsum(self.length) - self.length

    def __len__(self) -> int:
        return len(self.doc)

    def take(self, rows: np.ndarray) -> Entries:
        return Entries([c[rows] for c in self.columns], _gather(self.body, self.at[rows], self.length[rows]))

    def anchors(self) -> np.ndarray:
        begin = self.at + self.gram
        return _hashes(self.body, self.at, self.length, begin, begin + GRAM)

    def whole(self) -> np.ndarray:
        whole = _hashes(self.body, self.at, self.length, self.at, self.at + self.length)
        return mix(whole + self.gram.astype(np.uint64))

    def windows(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(entry, offset, hash) of every window of every context."""
        count = self.length - WINDOW + 1
        entry = np.repeat(np.arange(len(self)), count)
        offset = np.arange(len(entry)) - np.repeat(np.cumsum(count) - count, count)
        hashes = [np.zeros(0, np.uint64)]
        for low, high in _chunks(self.length):
            first = self.at[low]
            sums = _range_sums(self.body[first : self.at[high - 1] + self.length[high - 1]])
            some = slice(*np.searchsorted(entry, (low, high)))
            begin = self.at[entry[some]] + offset[some] - first
            hashes.append(_range_hash(sums, begin, begin + WINDOW))
        return entry, offset, np.concatenate(hashes)

    def packed(self) -> bytes:
        """Columns one after the other; numbers of documents and starts as differences of a sorted table."""
        order = np.lexsort((self.mark, self.doc))
        doc, mark = self.doc[order], self.mark[order]
        new = np.ones(len(order), bool)
        new[1:] = (doc[1:] != doc[:-1]) | (mark[1:] != mark[:-1])
        which = np.empty(len(order), np.uint32)
        which[order] = np.cumsum(new) - 1
        head = np.array([new.sum(), len(self)], np.int64)
        parts = [head, np.diff(doc[new], prepend=0), mark[new], which, self.start.astype(np.uint32)]
        return zstandard.compress(b"".join(x.tobytes() for x in (*parts, *self.columns[3:], self.body)), _LEVEL)

    @staticmethod
    def unpacked(packed: bytes) -> tuple[list[np.ndarray], np.ndarray]:
        raw = zstandard.decompress(packed)
        n_docs, n = np.frombuffer(raw, np.int64, 2)
        at, columns = 16, []
        for kind, count in ((np.int64, n_docs), (np.int64, n_docs), (np.uint32, n), (np.uint32, n), (np.uint8, n), (np.uint8, n)):
            columns.append(np.frombuffer(raw, kind, count, at))
            at += columns[-1].nbytes
        gaps, marks, which, start, length, gram = columns
        return [np.cumsum(gaps)[which], marks[which], start, length, gram], np.frombuffer(raw, np.uint8, offset=at)


def _joined(parts: list[tuple[list[np.ndarray], np.ndarray]]) -> Entries:
    columns = [np.concatenate(x) for x in zip(*(c for c, _ in parts))] if parts else [np.zeros(0, k) for _, k in _TABLE]
    return Entries(columns, np.concatenate([b for _, b in parts]) if parts else np.zeros(0, np.uint8))


def _collapse(entries: Entries) -> tuple[np.ndarray, np.ndarray]:
    """(rows to keep, rows that repeat a whole context of a smaller document)."""
    key = entries.whole()
    order = np.argsort(key, kind="stable")
    new = np.ones(len(order), bool)
    new[1:] = key[order][1:] != key[order][:-1]
    group = np.cumsum(new) - 1
    least = np.minimum.reduceat(entries.doc[order], np.flatnonzero(new)) if len(order) else entries.doc
    repeated = entries.doc[order] > least[group]
    return order[~repeated], order[repeated]


def _repeated_windows(entries: Entries) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(entry, offset) of all windows with a byte string that another window has, too.

    They come in lists of about ``_SUFFIXES`` that keep equal windows together,
    and with them all suffixes with a common prefix of a window or more.
    """
    entry, offset, key = entries.windows()
    order = np.argsort(key)
    same = key[order][1:] == key[order][:-1]
    order = order[np.append(same, False) | np.append(False, same)] if len(order) else order
    for some in _together(order, key[order], _SUFFIXES):
        some = np.sort(some)
        yield entry[some], offset[some]


def _suffix_array(entries: Entries, entry: np.ndarray, offset: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(order, common prefix with the suffix before) of suffixes that run to their context's end."""
    left = entries.length[entry] - offset
    width = int(left.max())
    place = np.arange(width)
    inside = place < left[:, None]
    table = np.zeros((len(entry), width), np.uint8)
    table[inside] = _gather(entries.body, entries.at[entry] + offset, left)
    order = np.argsort(table.view(f"S{width}").ravel(), kind="stable")
    table, left = table[order], left[order]
    both = np.minimum(left[1:], left[:-1])
    differ = (table[1:] != table[:-1]) | (place >= both[:, None])
    common = np.where(differ.any(axis=1), differ.argmax(axis=1), width)
    return order, np.concatenate([[0], common])


def _intervals(common: np.ndarray, doc: np.ndarray, before: np.ndarray) -> list[tuple[int, int, int, int]]:
    """(first, end, length, smallest document) of the maximal repeats of ``WINDOW`` bytes or more.

    Scans the suffix array once. The stack holds the open intervals of the
    common-prefix tree with their smallest document and their only preceding
    byte, or -1 where these differ; ``before`` is -1 where a context begins.
    """
    found = []
    stack: list[list[int]] = []  # length, first, smallest document, preceding byte
    docs, bytes_before, lengths = doc.tolist(), before.tolist(), common.tolist()
    for at in range(1, len(docs) + 1):
        length = lengths[at] if at < len(docs) else 0
        first, least, byte = at - 1, docs[at - 1], bytes_before[at - 1]
        while stack and stack[-1][0] > length:
            top = stack.pop()
            least = min(least, top[2])
            byte = byte if byte == top[3] else -1
            first = top[1]
            if byte == -1:
                found.append((first, at, top[0], least))
        if length >= WINDOW:
            if stack and stack[-1][0] == length:
                top = stack[-1]
                top[2], top[3] = min(top[2], least), byte if byte == top[3] else -1
            else:
                stack.append([length, first, least, byte])
    return found


def _maximal(entries: Entries) -> Iterator[tuple[np.ndarray, np.ndarray, int, int]]:
    """(entries, offsets, length, smallest document) of every maximal repeat, with all occurrences."""
    for entry, offset in _repeated_windows(entries):
        order, common = _suffix_array(entries, entry, offset)
        entry, offset = entry[order], offset[order]
        byte = np.where(offset > 0, entries.body[np.maximum(entries.at[entry] + offset - 1, 0)].astype(np.int64), -1)
        for first, end, length, least in _intervals(common, entries.doc[entry], byte):
            yield entry[first:end], offset[first:end], length, least


def _covered(entries: Entries) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(entry, start, length) of the ranges that repeat bytes of a smaller document."""
    keep, repeated = _collapse(entries)
    out = [(repeated, entries.start[repeated], entries.length[repeated])]
    kept = entries.take(keep)
    anchor = kept.anchors()
    order = np.argsort(anchor)
    same = anchor[order][1:] == anchor[order][:-1]
    shared = np.zeros(len(anchor), bool)
    shared[order[1:][same]] = True
    shared[order[:-1][same]] = True
    order = order[shared[order]]
    for group in _together(order, anchor[order], _GROUPED):
        rows = keep[group]
        some = entries.take(rows)
        low, high = np.full(len(some), _LAST), np.full(len(some), -1)
        for entry, offset, length, least in _maximal(some):
            later = some.doc[entry] > least
            np.minimum.at(low, entry[later], offset[later])
            np.maximum.at(high, entry[later], offset[later] + length)
        hit = np.flatnonzero(high >= 0)  # all windows of a context share its anchor, so the ranges form one
        out.append((rows[hit], some.start[hit] + low[hit], high[hit] - low[hit]))
    return tuple(np.concatenate(x) for x in zip(*out))


def _together(rows: np.ndarray, key: np.ndarray, size: int) -> Iterator[np.ndarray]:
    """``rows``, sorted by their keys, in lists of about ``size`` that keep equal keys together."""
    low = 0
    while low < len(rows):
        high = low + size
        if high < len(rows):
            high = int(np.searchsorted(key, key[high - 1], side="right"))
        yield rows[low:high]
        low = high


def _merged(doc: np.ndarray, mark: np.ndarray, start: np.ndarray, length: np.ndarray) -> dict[str, np.ndarray]:
    """Overlapping and touching ranges of a text as one."""
    order = np.lexsort((start, mark, doc))
    doc, mark, start, end = doc[order], mark[order], start[order], (start + length)[order]
    text = np.ones(len(doc), bool)
    text[1:] = (doc[1:] != doc[:-1]) | (mark[1:] != mark[:-1])
    group = np.cumsum(text) - 1
    lift = group * np.int64(1 << 40)  # keeps the running maximum within a text
    reach = np.maximum.accumulate(end + lift) - lift
    new = text.copy()
    new[1:] |= start[1:] > reach[:-1]
    first = np.flatnonzero(new)
    last = np.concatenate([first[1:], [len(doc)]]) - 1 if len(first) else first
    return {"doc": doc[first], "mark": mark[first], "start": start[first], "length": reach[last] - start[first]}


_RANGES = "doc bigint, mark bigint, start bigint, length bigint"
_SENT = f"bucket int, packed binary, {_RANGES}"
_SENT_FIELDS = pa.schema(
    [("bucket", pa.int32()), ("packed", pa.binary()), ("doc", pa.int64()), ("mark", pa.int64()), ("start", pa.int64()), ("length", pa.int64())]
)


def _batch(fields: pa.Schema, **columns) -> pa.RecordBatch:
    n = len(next(iter(columns.values())))
    return pa.RecordBatch.from_arrays([pa.array(columns[f.name], f.type) if f.name in columns else pa.nulls(n, f.type) for f in fields], schema=fields)


def _dealt(hashes: np.ndarray, buckets: int) -> Iterator[tuple[int, np.ndarray]]:
    """(bucket, rows) by the upper bits of scrambled hashes."""
    bucket = ((hashes >> np.uint64(32)) * np.uint64(buckets) >> np.uint64(32)).astype(np.int64)
    order = np.argsort(bucket, kind="stable")
    cuts = np.searchsorted(bucket[order], np.arange(buckets + 1))
    for number in np.flatnonzero(np.diff(cuts)):
        yield int(number), order[cuts[number] : cuts[number + 1]]


def _flushed(batches: Iterator[pa.RecordBatch], take, flush) -> Iterator[pa.RecordBatch]:
    """``flush`` of what ``take`` makes of rows, as often as ``_FLUSH`` bytes of text have been taken."""
    parts, size = [], 0
    for batch in batches:
        data, offsets = byte_rows(batch.column("text"))
        for row in range(len(batch)):
            body = data[offsets[row] : offsets[row + 1]]
            parts += take(batch, row, body)
            size += len(body)
            if size >= _FLUSH:
                yield from flush(parts)
                parts, size = [], 0
    if parts:
        yield from flush(parts)


def _sent(docs: DataFrame, buckets: int, collapse: bool) -> DataFrame:
    """Rows of packed contexts per bucket, and of ranges that are decided within a task.

    With a column ``shared`` only contexts of those markers are sent.
    """

    def take(batch: pa.RecordBatch, row: int, body: np.ndarray) -> list:
        shared = None
        if "shared" in batch.schema.names:
            shared = batch.column("shared")[row].values.to_numpy().view(np.uint32)
        start, length, gram = _contexts(body, shared)
        n = len(start)
        if not n:
            return []
        doc, mark = batch.column("doc")[row].as_py(), batch.column("mark")[row].as_py()
        return [([np.full(n, doc), np.full(n, mark), start, length, gram], _gather(body, start, length))]

    def flush(parts: list) -> Iterator[pa.RecordBatch]:
        entries = _joined(parts)
        if collapse:
            keep, repeated = _collapse(entries)
            ranges = _merged(*(x[repeated] for x in (entries.doc, entries.mark, entries.start, entries.length)))
            yield _batch(_SENT_FIELDS, bucket=ranges["doc"] % buckets, **ranges)
            entries = entries.take(keep)
        # scrambled again: anchors are minima, so their own hashes are small
        for number, rows in _dealt(mix(entries.anchors()), buckets):
            yield _batch(_SENT_FIELDS, bucket=[number], packed=[entries.take(rows).packed()])

    return docs.mapInArrow(lambda batches: _flushed(batches, take, flush), _SENT)


_SHARED_FIELDS = pa.schema([("bucket", pa.int32()), ("packed", pa.binary()), ("id", pa.int64()), ("marker", pa.int32())])


def _packed_markers(ids: np.ndarray, hashes: np.ndarray) -> bytes:
    """Distinct ids, how often each comes, and 40 bits of every hash; the bucket holds the other bits."""
    order = np.argsort(ids, kind="stable")
    ids, hashes = ids[order], hashes[order]
    begin = _runs(ids)
    counts = np.diff(np.append(begin, len(ids)))
    parts = [np.array([len(begin), len(ids)], np.int64), np.diff(ids[begin], prepend=0), counts.astype(np.uint32)]
    parts += [hashes.astype(np.uint32), (hashes >> np.uint64(32)).astype(np.uint8)]
    return zstandard.compress(b"".join(x.tobytes() for x in parts), 1)


def _unpacked_markers(packed: bytes) -> tuple[np.ndarray, np.ndarray]:
    raw = zstandard.decompress(packed)
    n_ids, n = np.frombuffer(raw, np.int64, 2)
    gaps = np.frombuffer(raw, np.int64, n_ids, 16)
    counts = np.frombuffer(raw, np.uint32, n_ids, 16 + 8 * n_ids)
    low = np.frombuffer(raw, np.uint32, n, 16 + 12 * n_ids)
    high = np.frombuffer(raw, np.uint8, offset=16 + 12 * n_ids + 4 * n)
    return np.repeat(np.cumsum(gaps), counts), high.astype(np.uint64) << np.uint64(32) | low


def _in_two(ids: np.ndarray, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(ids, hashes) of those that two ids have, then one (id, hash) of every hash."""
    order = np.lexsort((ids, hashes))
    ids, hashes = ids[order], hashes[order]
    new = np.ones(len(ids), bool)
    new[1:] = (ids[1:] != ids[:-1]) | (hashes[1:] != hashes[:-1])
    ids, hashes = ids[new], hashes[new]
    begin = _runs(hashes)
    counts = np.diff(np.append(begin, len(hashes)))
    twice = np.repeat(counts > 1, counts)
    return ids[twice], hashes[twice], ids[begin], hashes[begin]


def _shared(named: DataFrame, partitions: int, buckets: int) -> DataFrame:
    """``id, shared``: lower 32 bits of the markers of a document that another one has, too.

    A task counts what its own texts share and sends each hash once, so a
    passage of many documents does not crowd its bucket.
    """

    def take(batch: pa.RecordBatch, row: int, body: np.ndarray) -> list:
        found = [_markers(part, sums) for _, part, sums in _pieces(body)]
        if not found:
            return []
        hashes = np.unique(np.concatenate([m[_runs(m)] for m in found]))
        return [(np.full(len(hashes), batch.column("id")[row].as_py()), mix(hashes))]

    def flush(parts: list) -> Iterator[pa.RecordBatch]:
        ids, hashes, one, once = _in_two(*(np.concatenate(x) for x in zip(*parts)))
        yield _batch(_SHARED_FIELDS, bucket=ids % buckets, id=ids, marker=hashes.astype(np.uint32).view(np.int32))
        for number, rows in _dealt(once, buckets):
            yield _batch(_SHARED_FIELDS, bucket=[number], packed=[_packed_markers(one[rows], once[rows])])

    fields = pa.schema([(f.name, f.type) for f in _SHARED_FIELDS][2:])

    def met(packed: list[bytes]) -> Iterator[pa.RecordBatch]:
        ids, hashes, _, _ = _in_two(*(np.concatenate(x) for x in zip(*map(_unpacked_markers, packed))))
        order = np.argsort(ids, kind="stable")
        yield _batch(fields, id=ids[order], marker=hashes[order].astype(np.uint32).view(np.int32))

    sent = named.select("id", "text").mapInArrow(lambda b: _flushed(b, take, flush), "bucket int, packed binary, id bigint, marker int")
    return _by_bucket(sent, partitions, met, fields, "id bigint, marker int").groupBy("id").agg(F.collect_list("marker").alias("shared"))


def _by_bucket(sent: DataFrame, partitions: int, function, fields: pa.Schema, schema: str) -> DataFrame:
    """``function`` over all packed rows of a bucket, one bucket at a time; decided rows pass through."""

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, parts = None, []
        for batch in batches:
            decided = batch.column("packed").is_null()
            if pa.compute.any(decided).as_py():
                yield batch.filter(decided).select(fields.names)
                batch = batch.filter(pa.compute.invert(decided))
            for bucket, packed in zip(batch.column("bucket").to_pylist(), batch.column("packed").to_pylist()):
                if bucket != number and parts:
                    yield from function(parts)
                    parts = []
                number = bucket
                parts.append(packed)
        if parts:
            yield from function(parts)

    dealt = sent.repartition(partitions, "bucket")
    return dealt.sortWithinPartitions("bucket").mapInArrow(meet, schema)


def _named(docs: DataFrame, key: str, text: str) -> DataFrame:
    body = F.coalesce(F.col(text), F.lit(""))
    doc, mark = F.col(key).cast("bigint"), F.xxhash64(body)
    # texts without a doc_id have their mark for an id, so that they are spread
    columns = {"id": F.coalesce(doc, mark), "doc": F.coalesce(doc, F.lit(_LAST)), "mark": mark, "text": body}
    return docs.select(*(c.alias(name) for name, c in columns.items()))


def _sizes(docs: DataFrame) -> tuple[int, int]:
    partitions = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return partitions, 8 * partitions


def repeat_groups(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``repeat, length, doc, start``: every maximal repeat of ``WINDOW`` bytes or more with all occurrences.

    ``repeat`` names the byte string; a longer one than a context is reported as
    a chain of overlapping repeats. Occurrences within one document count, too,
    and so do those in repeated rows. Null and short texts have none.
    """
    partitions, buckets = _sizes(docs)
    fields = pa.schema([("repeat", pa.int64()), ("length", pa.int64()), ("doc", pa.int64()), ("start", pa.int64())])

    def found(packed: list[bytes]) -> Iterator[pa.RecordBatch]:
        entries = _joined([Entries.unpacked(p) for p in packed])
        for entry, offset, length, _ in _maximal(entries):
            begin = entries.at[entry[0]] + offset[0]
            name = int.from_bytes(hashlib.sha256(entries.body[begin : begin + length]).digest()[:8], "big", signed=True)
            n = len(entry)
            yield _batch(fields, repeat=[name] * n, length=[length] * n, doc=entries.doc[entry], start=entries.start[entry] + offset)

    sent = _sent(_named(docs, key, text), buckets, collapse=False)
    return _by_bucket(sent, partitions, found, fields, "repeat bigint, length bigint, doc bigint, start bigint")


def without_repeats(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, n_bytes, starts, lengths, kept``: texts without bytes that repeat a smaller document.

    A byte goes when a string of ``WINDOW`` bytes around it also starts in a
    document with a smaller doc_id; ``starts`` and ``lengths`` are the removed
    runs and ``kept`` the other bytes. A null text is empty, texts shorter than a
    window stay, rows with one doc_id do not remove each other's bytes, and a
    row without doc_id counts as the last. Every row gives one row.
    """
    named = _named(docs, key, text)
    partitions, buckets = _sizes(docs)
    # both joins are on the id alone, so that texts move once
    known = named.join(_shared(named, partitions, buckets), "id")
    sent = _sent(known, buckets, collapse=True)
    fields = pa.schema([(f.name, f.type) for f in _SENT_FIELDS][2:])

    def ranges(packed: list[bytes]) -> Iterator[pa.RecordBatch]:
        entries = _joined([Entries.unpacked(p) for p in packed])
        row, start, length = _covered(entries)
        yield _batch(fields, **_merged(entries.doc[row], entries.mark[row], start, length))

    met = _by_bucket(sent, partitions, ranges, fields, _RANGES)
    lists = met.groupBy(F.when(F.col("doc") == _LAST, F.col("mark")).otherwise(F.col("doc")).alias("id")).agg(
        *(F.collect_list(name).alias(name + "s") for name in ("mark", "start", "length"))
    )
    joined = named.join(lists, "id", "left")

    def cut(batch: pa.RecordBatch):
        data, offsets = byte_rows(batch.column("text"))
        marks, lists = batch.column("mark").to_numpy(), [batch.column(name) for name in ("marks", "starts", "lengths")]
        out: dict[str, list] = {"n_bytes": [], "starts": [], "lengths": [], "kept": []}
        for row in range(len(batch)):
            body = data[offsets[row] : offsets[row + 1]]
            of, start, length = (np.array([], np.int64) if x[row].values is None else x[row].values.to_numpy() for x in lists)
            own = of == marks[row]  # rows with one doc_id may have different texts
            one = _merged(of[own], of[own], start[own], length[own])
            keep = np.ones(len(body), bool)
            for a, b in zip(one["start"], one["length"]):
                keep[a : a + b] = False
            out["n_bytes"].append(len(body))
            out["starts"].append(one["start"])
            out["lengths"].append(one["length"])
            out["kept"].append(body[keep].tobytes())
        yield {"doc_id": batch.column("doc"), **out}

    schema = "doc_id bigint, n_bytes bigint, starts array<bigint>, lengths array<bigint>, kept binary"
    result = map_batches(joined.select("doc", "mark", "text", "marks", "starts", "lengths"), cut, schema)
    return result.withColumn("doc_id", F.when(F.col("doc_id") != _LAST, F.col("doc_id")))
