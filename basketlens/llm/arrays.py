"""Words and word shingles of a column of texts as flat numpy arrays of 64-bit hashes.

Two words, or two shingles, count as equal when their 64-bit hashes are equal.
Only arithmetic on fixed constants is used, so every task of every executor
gives the same hash for the same word.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from basketlens.llm.frames import RUN_BYTES, runs

_BASE = np.uint64(0x9E3779B97F4A7C15)
_STEP = np.uint64(0xD6E8FEB86659FD93)


def mix(x: np.ndarray) -> np.ndarray:
    """Bijective scrambling of 64-bit integers (two multiply-shift rounds)."""
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(29))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(32))


_VALUES = mix(np.arange(1, 257, dtype=np.uint64))  # one random value per byte
_LOWER = np.arange(256)
_LOWER[65:91] += 32
_LOWER_VALUES = _VALUES[_LOWER]
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_CHARACTER = (np.arange(256) & 0xC0) != 0x80  # bytes that begin a code point


class Powers:
    """Powers of an odd base and of its inverse, modulo 2**64, as far as asked for."""

    def __init__(self, base: np.uint64 = _BASE):
        self.base, self.size = base, 0

    def upto(self, size: int) -> tuple[np.ndarray, np.ndarray]:
        if size > self.size:
            self.size = max(size, RUN_BYTES + 1)
            inverse = np.uint64(pow(int(self.base), -1, 1 << 64))
            self.up, self.down = (
                np.cumprod(np.concatenate([[np.uint64(1)], np.full(self.size, b, np.uint64)]))
                for b in (self.base, inverse)
            )
        return self.up, self.down


POWERS = Powers()


def byte_rows(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All UTF-8 bytes of a string column and the offsets of its rows; nulls are empty."""
    filled = pc.fill_null(column.cast(pa.large_string()), "")
    _, offsets, data = filled.buffers()
    bounds = np.frombuffer(offsets, np.int64)[filled.offset : filled.offset + len(filled) + 1]
    body = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return body[bounds[0] : bounds[-1]], bounds - bounds[0]


@dataclass
class Words:
    """Word hashes of all rows end to end; row r has ``hashes[starts[r]:starts[r + 1]]``."""

    hashes: np.ndarray
    starts: np.ndarray
    characters: np.ndarray  # code points in words, per row
    marked: np.ndarray  # bytes found in ``marks``, per row


def words_of(column: pa.Array, lower: bool = False, marks: bytes = b"") -> Words:
    """Hashed words of every row, in pieces of bounded size; long rows are cut between words."""
    data, offsets = byte_rows(column)
    n_rows = len(offsets) - 1
    cuts, rows = _pieces(data, offsets)
    values = _LOWER_VALUES if lower else _VALUES
    mark = np.isin(np.arange(256), list(marks))
    characters, marked, counts = (np.zeros(n_rows, np.int64) for _ in range(3))
    found = [np.zeros(0, np.uint64)]
    for first, last in runs(np.diff(cuts)) if len(rows) else ():
        part = data[cuts[first] : cuts[last]]
        if not len(part):
            continue
        edges = cuts[first : last + 1] - cuts[first]
        begins = np.zeros(len(part) + 1, bool)
        begins[edges] = True
        space = _SPACE[part]
        word = ~space
        starts = np.flatnonzero(word & (np.concatenate([[True], space[:-1]]) | begins[:-1]))
        ends = np.flatnonzero(word & (np.concatenate([space[1:], [True]]) | begins[1:])) + 1
        up, down = POWERS.upto(len(part))
        sums = np.concatenate([[np.uint64(0)], np.cumsum(values[part] * up[: len(part)])])
        found.append(mix((sums[ends] - sums[starts]) * down[starts] + (ends - starts).astype(np.uint64)))
        for total, hits in ((characters, word & _CHARACTER[part]), (marked, mark[part])):
            running = np.concatenate([[0], np.cumsum(hits)])
            np.add.at(total, rows[first:last], np.diff(running[edges]))
        np.add.at(counts, rows[first:last], np.diff(np.searchsorted(starts, edges)))
    return Words(np.concatenate(found), np.concatenate([[0], np.cumsum(counts)]), characters, marked)


def _pieces(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Offsets of the rows with those over ``RUN_BYTES`` cut at separators, and each piece's row."""
    lengths = np.diff(offsets)
    if not (lengths > RUN_BYTES).any():
        return offsets, np.arange(len(lengths))
    cuts, rows = [], []
    for row, (start, end) in enumerate(zip(offsets[:-1], offsets[1:])):
        cuts.append(start)
        rows.append(row)
        near = start + RUN_BYTES
        while near < end:
            space = _SPACE[data[near : min(near + RUN_BYTES, end)]]
            if space.any():
                cuts.append(near + int(space.argmax()))
                rows.append(row)
                near = cuts[-1] + RUN_BYTES
            else:  # inside a word of a million bytes: look further
                near += RUN_BYTES
    return np.array([*cuts, offsets[-1]]), np.array(rows)


def shingles_of(words: Words, width: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all runs of ``width`` words of every row, in order, and the rows' starts.

    A row with fewer words, but at least one, has the run of all its words.
    """
    counts = np.diff(words.starts)
    has = np.where(counts >= width, counts - width + 1, np.minimum(counts, 1))
    starts = np.concatenate([[0], np.cumsum(has)])
    # position of each shingle's first word
    first = np.arange(starts[-1]) + np.repeat(words.starts[:-1] - starts[:-1], has)
    size = np.repeat(np.minimum(counts, width), has)
    hashes = size.astype(np.uint64)
    last = len(words.hashes) - 1
    for j in range(width):
        reach = np.minimum(first + j, last)
        hashes = np.where(j < size, hashes * _STEP + words.hashes[reach], hashes)
    return mix(hashes), starts


def distinct(hashes: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct hashes of each row, and the rows' new starts."""
    row = np.repeat(np.arange(len(starts) - 1), np.diff(starts))
    order = np.lexsort((hashes, row))
    hashes, row = hashes[order], row[order]
    new = np.ones(len(hashes), bool)
    new[1:] = (hashes[1:] != hashes[:-1]) | (row[1:] != row[:-1])
    counts = np.bincount(row[new], minlength=len(starts) - 1)
    return hashes[new], np.concatenate([[0], np.cumsum(counts)])
