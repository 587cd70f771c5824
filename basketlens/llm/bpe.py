"""Byte-level BPE of texts of any length, by tree concatenation.

A text is cut where the pre-tokenizer is sure to cut as well. A stretch without
such a place (a long run of one class of characters) is cut in the middle of the
run, where both halves of the pre-token are known for certain; parts are encoded
in parallel and neighbours are joined two by two. A join concerns only the last
pre-token of the left part and the first one of the right: tokens around it are
encoded again as one piece, in growing windows, until the window's first and last
token are tokens of the left and the right side. A sequence of tokens is the
encoding of a pre-token if every adjacent pair is, and then every adjacent pair
lies in one of three encodings: left, window or right. So the join is exact.
"""

from __future__ import annotations

import base64
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basketlens.llm.frames import map_batches

# Code points from which a text is cut, and the size of the parts.
PART = 1 << 15

# First window: tokens on each side of a join. It doubles until both sides agree.
WINDOW = 16

# Fixed value: the split pattern of the vocabulary.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""

_SURE = regex.compile(  # a place before white space after other text, or between letters, numbers and the rest
    r"(?<=\S)(?=\s)|(?<=\p{L})(?=[^\s\p{L}])|(?<=\p{N})(?=[^\s\p{N}])|(?<=[^\s\p{L}\p{N}'])(?=[\p{L}\p{N}])"
)


# The middle of eight characters of one class. Contractions have three letters at most, an apostrophe before
# another one begins none, and of white space only the last character may go with what follows.
_SAME = regex.compile(
    r"(?<=\s{4})(?=\s{4})|(?<=\p{L}{4})(?=\p{L}{4})|(?<=\p{N}{4})(?=\p{N}{4})|(?<=[^\s\p{L}\p{N}]{4})(?=[^\s\p{L}\p{N}]{4})"
)
_NEAR = 64  # characters before the size wanted in which a place inside a run is looked for first
_PIECES = regex.compile(PATTERN)


@dataclass
class Part:
    """Tokens of a part, how many of them its first and its last pre-token have, and whether its start is a sure boundary."""

    ids: list[int]
    head: int
    tail: int
    sure: bool


class Codec:
    """Encoder over ranked byte strings, with a decoder and named special tokens."""

    def __init__(self, ranks_file: str, tokenizer_file: str):
        import tiktoken
        from tokenizers import Tokenizer

        with open(ranks_file, "rb") as lines:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        self.fast = tiktoken.Encoding("bpe", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.whole = Tokenizer.from_file(tokenizer_file)
        self.special = {
            token.content: number for number, token in self.whole.get_added_tokens_decoder().items() if token.special
        }
        self.named = {number: token.encode() for token, number in self.special.items()}
        names = "|".join(regex.escape(s) for s in sorted(self.special, key=len, reverse=True))
        self.split = regex.compile(f"({names})") if names else None

    def encode(self, text: str) -> list[int]:
        if self.split is None or not any(s in text for s in self.special):
            return self.fast.encode_ordinary(text)
        ids: list[int] = []
        for part in self.split.split(text):
            if part in self.special:
                ids.append(self.special[part])
            elif part:
                ids += self.fast.encode_ordinary(part)
        return ids

    def decode(self, ids: list[list[int]]) -> list[str]:
        return self.whole.decode_batch(ids, skip_special_tokens=False)

    def piece(self, body: bytes) -> list[int]:
        """Tokens of bytes that lie within one pre-token."""
        return self.fast._encode_single_piece(body)

    def part(self, text: str, sure: bool) -> Part:
        ids = self.encode(text)
        pieces = [t for t in (self.split.split(text) if self.split else [text]) if t]
        if not pieces:
            return Part(ids, 0, 0, sure)
        first = pieces[0] if pieces[0] in self.special else _PIECES.match(pieces[0]).group()
        last = pieces[-1]
        if last not in self.special:
            for found in _PIECES.finditer(last):
                pass
            last = found.group()
        return Part(ids, self._upto(ids, first), self._upto(ids[::-1], last), sure)

    def _upto(self, ids: list[int], text: str) -> int:
        """How many of the tokens hold the bytes of ``text``, which end with one of them."""
        left, count = len(text.encode()), 0
        while left > 0:
            left -= len(self.bytes_of(ids[count : count + 1])[0])
            count += 1
        if left:
            raise ValueError("tokens and pre-tokens do not end together")
        return count

    def bytes_of(self, ids: list[int]) -> list[bytes]:
        return [self.named[i] if i in self.named else self.fast.decode_single_token_bytes(i) for i in ids]


@lru_cache(maxsize=2)
def codec(ranks_file: str, tokenizer_file: str) -> Codec:
    """Loaded once per worker process."""
    return Codec(ranks_file, tokenizer_file)


def cut(text: str, special: tuple[str, ...] = (), size: int = PART) -> list[tuple[str, bool]]:
    """Parts of about ``size`` code points, each with whether its start is a sure boundary.

    A part is longer only if no place near allows a cut.
    """
    parts, at, sure = [], 0, True
    while len(text) - at > size:
        place, next_sure = _place(text, at + size // 2, at + size)
        kept = _outside(text, special, place)
        if kept <= at < place:  # a special token longer than half a part
            kept = at + len(next(t for t in special if text.startswith(t, at)))
        if kept >= len(text):
            break
        parts.append((text[at:kept], sure))
        at, sure = kept, next_sure or kept != place
    parts.append((text[at:], sure))
    return parts


def _place(text: str, low: int, near: int) -> tuple[int, bool]:
    """A place to cut and whether the pre-tokenizer cuts there: the last one up to ``near``, else the next one after it."""
    sound = [m.start() for m in _SURE.finditer(text, low, near + 1) if m.start() <= near]
    if sound:
        return sound[-1], True
    for at in range(near, max(low, near - _NEAR), -1):
        if _SAME.match(text, at):
            return at, False
    found = [(m.start(), pattern is _SURE) for pattern in (_SURE, _SAME) if (m := pattern.search(text, near))]
    return min(found, default=(len(text), True), key=lambda pair: pair[0])


def _outside(text: str, special: tuple[str, ...], place: int) -> int:
    """``place``, or the start of the special token it lies in."""
    for token in special:
        start = text.find(token, max(0, place - len(token) + 1), place + len(token) - 1)
        if 0 <= start < place:
            return start
    return place


def merged(encoder: Codec, left: list[int], right: list[int]) -> list[int]:
    """Tokens of the pre-token whose halves have the tokens ``left`` and ``right``."""
    width = WINDOW
    while True:
        a, b = left[-width:], right[:width]
        seen = encoder.piece(b"".join(encoder.bytes_of(a + b)))
        whole = width >= len(left), width >= len(right)
        ends = whole[0] or seen[0] == a[0], whole[1] or seen[-1] == b[-1]
        if all(whole) or (all(ends) and len(seen) >= 2):
            return left[: len(left) - len(a)] + seen + right[len(b) :]
        width *= 2


def join(encoder: Codec, left: Part, right: Part) -> Part:
    """The part that two neighbours make."""
    if not left.ids or not right.ids:
        return Part(left.ids + right.ids, left.head or right.head, right.tail or left.tail, left.sure)
    if right.sure:
        return Part(left.ids + right.ids, left.head, right.tail, left.sure)
    piece = merged(encoder, left.ids[-left.tail :], right.ids[: right.head])
    ids = left.ids[: -left.tail] + piece + right.ids[right.head :]
    head = len(piece) if left.head == len(left.ids) else left.head
    tail = len(piece) if right.tail == len(right.ids) else right.tail
    return Part(ids, head, tail, left.sure)


def tree(encoder: Codec, parts: list[Part]) -> list[int]:
    """Concatenates neighbours two by two, level by level."""
    while len(parts) > 1:
        pairs = [join(encoder, a, b) for a, b in zip(parts[::2], parts[1::2])]
        parts = pairs + ([parts[-1]] if len(parts) % 2 else [])
    return parts[0].ids if parts else []


def encode(docs: DataFrame, ranks_file: str, tokenizer_file: str, text: str = "text", key: str = "doc_id") -> DataFrame:
    """``key``, ``ids`` (32-bit little-endian integers as binary) and ``n_tokens`` of every row.

    A null text counts as empty and has no tokens. Rows with the same key stay
    separate. Texts longer than ``PART`` become rows of parts that any task may
    encode, equal texts once for all their rows; the parts of one text then meet
    in one task, which holds the tokens of that text only.
    """
    base = docs.select(F.col(key).alias("_key"), F.coalesce(F.col(text), F.lit("")).alias("_text"))
    kind = docs.schema[key].dataType.simpleString()
    long = F.length("_text") > PART

    def short_ids(batch: pa.RecordBatch):
        encoder = codec(ranks_file, tokenizer_file)
        ids = [encoder.encode(t) for t in batch.column("_text").to_pylist()]
        yield {
            "_key": batch.column("_key"),
            "ids": [np.array(i, "<u4").tobytes() for i in ids],
            "n_tokens": [len(i) for i in ids],
        }

    def cut_texts(batch: pa.RecordBatch):
        special = tuple(codec(ranks_file, tokenizer_file).special)
        for row, t in zip(*(batch.column(c).to_pylist() for c in ("_row", "_text"))):
            parts = cut(t, special)
            for low in range(0, len(parts), 64):
                some = parts[low : low + 64]
                yield {
                    "_row": [row] * len(some),
                    "part": list(range(low, low + len(some))),
                    "sure": [sure for _, sure in some],
                    "_text": [body for body, _ in some],
                }

    def part_ids(batch: pa.RecordBatch):
        encoder = codec(ranks_file, tokenizer_file)
        found = [encoder.part(t, sure) for t, sure in zip(*(batch.column(c).to_pylist() for c in ("_text", "sure")))]
        yield {
            **{c: batch.column(c) for c in ("_row", "part", "sure")},
            "head": [one.head for one in found],
            "tail": [one.tail for one in found],
            "ids": [np.array(one.ids, "<u4").tobytes() for one in found],
        }

    def joined(batch: pa.RecordBatch):
        encoder = codec(ranks_file, tokenizer_file)
        for at in range(len(batch)):
            rows = batch.column("parts").slice(at, 1).to_pylist()[0]
            parts = [Part(np.frombuffer(r["ids"], "<u4").tolist(), r["head"], r["tail"], r["sure"]) for r in rows]
            ids = tree(encoder, parts)
            yield {"_row": batch.column("_row").slice(at, 1), "ids": [np.array(ids, "<u4").tobytes()], "n_tokens": [len(ids)]}

    short = map_batches(base.where(~long), short_ids, f"_key {kind}, ids binary, n_tokens bigint")
    rows = base.where(long).withColumn("_row", F.sha2("_text", 256))
    parts = map_batches(rows.select("_row", "_text"), cut_texts, "_row string, part int, sure boolean, _text string")
    once = parts.dropDuplicates(["_row", "part"])  # deals parts out to all tasks
    encoded = map_batches(once, part_ids, "_row string, part int, sure boolean, head int, tail int, ids binary")
    grouped = encoded.groupBy("_row").agg(
        F.array_sort(F.collect_list(F.struct("part", "sure", "head", "tail", "ids"))).alias("parts")
    )
    long_ids = map_batches(grouped, joined, "_row string, ids binary, n_tokens bigint")
    found = rows.select("_key", "_row").join(long_ids, "_row").select("_key", "ids", "n_tokens")
    return short.unionByName(found).withColumnRenamed("_key", key)


def decode(encoded: DataFrame, ranks_file: str, tokenizer_file: str, key: str = "doc_id") -> DataFrame:
    """``encoded`` with ``decoded``, the text its ids stand for."""
    kept = [c for c in encoded.columns if c != "decoded"]
    schema = ", ".join(f"`{c}` {encoded.schema[c].dataType.simpleString()}" for c in kept)

    def texts(batch: pa.RecordBatch):
        encoder = codec(ranks_file, tokenizer_file)
        ids = [np.frombuffer(b, "<u4").tolist() for b in batch.column("ids").to_pylist()]
        yield {**{c: batch.column(c) for c in kept}, "decoded": encoder.decode(ids)}

    return map_batches(encoded.select(*kept), texts, f"{schema}, decoded string")
