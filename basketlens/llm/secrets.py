"""Secrets in text: three fixed patterns, and values in a credential context that are hard to guess.

The second kind is found by a guess-cost search: a value is cut into words,
dates, repeats, keyboard walks and brute-force spans so that the number of
guesses for the whole is smallest (dynamic programming over its positions).
``password: example`` is cheap to guess and is left alone; a random value is not.
Words are ranked by the documents of the corpus that have them (``frequent_words``).
"""

from __future__ import annotations

import math
import re
import string
from bisect import bisect_right
from collections.abc import Iterable, Iterator
from functools import lru_cache
from itertools import accumulate

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basketlens.llm.frames import map_batches
from basketlens.session import materialize

KINDS = ("assign", "access", "hex", "guess")

# Fixed patterns. A run that is too short is skipped as a whole, which for the
# last two is the same as asking for the length in the pattern.
_ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
    re.IGNORECASE | re.ASCII,
)
_ACCESS = re.compile(r"AKIA[A-Z0-9]{16,}")
_HEX = re.compile(r"[0-9a-f]{24,}")
_MIN_ASSIGNED = 6

# A value in a credential context: an identifier with a naming word in it, a
# separator or "is" (after "bearer" blanks alone will do), a value. The pieces
# are matched one after the other, each in time that is linear in its length.
_NAME = re.compile(
    r"pass(?:word|wd|phrase|code)?|pwd|pin|secret|token|credentials?|(?:api|private|access|client|auth)[_ -]?key|bearer"
)  # in lower case
_IDENTIFIER = re.compile(r"[A-Za-z0-9_-]*+")
_SEPARATOR = re.compile(
    r"""["']?(?:[\x20\t]*+(?::=|=>|[:=])[\x20\t]*+|[\x20\t]++is[\x20\t]++)["']?""", re.IGNORECASE | re.ASCII
)
_BLANKS = re.compile(r"""["']?[\x20\t]++["']?""")
_VALUE = re.compile(r"""[^\s"'<>,;]{6,}+""", re.ASCII)
_IDENTIFIERS = string.ascii_letters + string.digits + "_-"

# Guesses, as a power of ten, from which a value in a credential context is a secret.
MIN_GUESSES = 10.0

# Characters of a value that are searched at once.
PIECE = 128

# Frequent words of passwords, by falling frequency.
COMMON_WORDS = (
    "password qwerty letmein welcome admin monkey dragon login princess sunshine master shadow football baseball "
    "superman batman trustno iloveyou charlie michael jordan hunter ranger buster soccer hockey killer george andrew "
    "michelle jessica pepper daniel access joshua maggie starwars silver william dallas yankees hello freedom whatever "
    "cheese computer internet secret summer winter spring autumn flower orange purple yellow ginger cookie banana "
    "matrix mustang thunder tigger test user root guest default changeme example sample dummy placeholder your here "
    "value none null string token apikey pass key demo foobar love home work office server database system the and for"
).split()

# Words of the corpus in the table that is broadcast to the scan, and letters of the longest.
WORDS = 50_000
WORD_LENGTH = 40

# What punctuation leaves around a word of a sentence.
_MARKS = ".,;:!?()[]{}<>\"'`*_…“”„‘’«»"

# Rows of a keyboard.
KEYBOARD = ("1234567890", "qwertyuiop", "asdfghjkl", "zxcvbnm")

_DATES = re.compile(
    r"(?:19|20)\d\d[-/._]?(?:0[1-9]|1[0-2])[-/._]?(?:0[1-9]|[12]\d|3[01])"
    r"|(?:0[1-9]|[12]\d|3[01])[-/._]?(?:0[1-9]|1[0-2])[-/._]?(?:19|20)\d\d"
    r"|(?:19|20)\d\d"
)
_REPEAT = re.compile(r"(.{1,16}?)\1+")
_LEET = str.maketrans("@4310$5!7", "aaeiossit")


def _rank(words: Iterable[str]) -> dict[str, int]:
    return {word: place for place, word in enumerate(words, 1)}


def _alphabet(part: str) -> int:
    size = 0
    for test, count in ((str.islower, 26), (str.isupper, 26), (str.isdigit, 10)):
        size += count * any(test(c) for c in part)
    return size + 33 * any(not c.isalnum() for c in part) or 1


def _walk_ends(value: str, start: int) -> Iterable[int]:
    """Ends of keyboard or alphabet walks of three or more characters from ``start``; lower case."""
    low = value
    for row in (*KEYBOARD, "abcdefghijklmnopqrstuvwxyz"):
        at = row.find(low[start])
        for step in (1, -1) if at >= 0 else ():
            end, place = start + 1, at + step
            while end < len(low) and 0 <= place < len(row) and row[place] == low[end]:
                end, place = end + 1, place + step
                if end - start >= 3:
                    yield end


def guess_cost(value: str, words: dict[str, int] | None = None) -> float:
    """Smallest number of guesses for ``value`` over all segmentations, as a power of ten.

    Every segment multiplies the guesses: the rank of a word (times two for
    capitals, two for changed letters), the days of a date, the walks of a
    length, the repeated unit times its count, or the alphabet to the power of
    the length for a brute-force span. Each further segment also costs a factor
    of ten, so that a random value is not taken for a chain of short words.
    A value of more than ``PIECE`` characters is as hard as the hardest of its
    pieces of that length, so its cost is linear in its length.
    """
    return (_USUAL if words is None else Guesses(words)).cost(value)


class Guesses:
    """Guess costs with given ranks of words; the costs of recent pieces are kept."""

    def __init__(self, ranks: dict[str, int]):
        self.ranks, longest = ranks, max(map(len, ranks), default=0)
        self._piece = lru_cache(maxsize=4096)(lambda piece: _cost(piece, ranks, 3, longest))

    def cost(self, value: str) -> float:
        pieces = {value[at : at + PIECE] for at in range(0, len(value), PIECE)}
        return max(map(self._piece, pieces), default=0.0)

    def of_context(self, value: str) -> float:
        """The cost of a value that may be a word of a sentence, with its punctuation."""
        bare = value.strip(_MARKS)
        return self.cost(bare if bare.lower() in self.ranks else value)


def _cost(value: str, ranks: dict[str, int], depth: int, longest: int) -> float:
    n = len(value)
    best = [0.0] + [math.inf] * n
    low = value.lower() if len(value.lower()) == n else value  # lower case may change the length
    plain = low.translate(_LEET)
    each = math.log10(_alphabet(value))
    for start in range(n):
        here = best[start] + (1.0 if start else 0.0)

        def reach(end: int, cost: float, here: float = here) -> None:
            best[end] = min(best[end], here + cost)

        for end in range(start + 1, n + 1):  # brute force
            reach(end, each * (end - start))
        for end in range(start + 2, min(n, start + longest) + 1):  # words
            rank = ranks.get(plain[start:end])
            if rank:
                raw = value[start:end]
                changed = (raw != low[start:end]) + (low[start:end] != plain[start:end])
                reach(end, math.log10(rank + 1) + changed * math.log10(2))
        date = _DATES.match(value, start)
        if date:
            reach(date.end(), math.log10(365 * 120 if date.end() - start > 4 else 120))
        for end in _walk_ends(low, start):
            reach(end, math.log10(100 * (end - start)))
        repeat = _REPEAT.match(value, start) if depth else None
        if repeat and repeat.end() - start >= 3:
            unit = repeat.group(1)
            reach(repeat.end(), _cost(unit, ranks, depth - 1, longest) + math.log10((repeat.end() - start) // len(unit)))
    return best[n]


_USUAL = Guesses(_rank(COMMON_WORDS))


def _context_values(text: str) -> Iterator[tuple[int, int]]:
    """(start, end) of the value of every credential context, by start.

    The last identifier of a value may name the next one, as in
    ``token: Bearer ...``, so the search goes on from there. Contexts further
    inside a value end with it and are easier to guess than the whole.
    """
    low, at = text.lower(), 0
    if len(low) != len(text):
        low = "".join(c.lower() if c.isascii() else c for c in text)
    while name := _NAME.search(low, at):
        at = _IDENTIFIER.match(text, name.end()).end()
        bearer = low.endswith("bearer", 0, at)
        separator = _SEPARATOR.match(text, at) or (bearer and _BLANKS.match(text, at))
        value = separator and _VALUE.match(text, separator.end())
        if value:
            yield value.span()
            stem = value.group().rstrip(":=>").rstrip(_IDENTIFIERS)
            at = value.start() + len(stem)
        else:
            at = max(name.end(), at - len("private"))  # of "pass-private key"


def _reaching(found: list[tuple[int, str, int]]) -> tuple[list[int], list[int]]:
    """Starts in order, and the furthest end of a span from there or before."""
    spans = sorted((start, end) for start, _, end in found)
    return [start for start, _ in spans], list(accumulate((end for _, end in spans), max))


def _covered(base: tuple[list[int], list[int]], start: int, end: int) -> bool:
    place = bisect_right(base[0], start)
    return place > 0 and base[1][place - 1] >= end


def secret_spans(
    text: str | None, min_guesses: float = MIN_GUESSES, guesses: Guesses = _USUAL
) -> list[tuple[int, str, int]]:
    """(start, kind, end) of every secret by start, then kind as in ``KINDS``; positions are code points.

    The three base kinds are leftmost, non-overlapping matches per kind. A
    ``guess`` span is the value of a credential context that costs at least
    ``min_guesses``, unless one base span has the whole of it; it may overlap
    base spans. Null and empty texts have none.
    """
    if not text:
        return []
    found = [
        (m.start(), "assign", m.end()) for m in _ASSIGN.finditer(text) if len(m.group(2)) >= _MIN_ASSIGNED
    ]
    found += [(m.start(), "access", m.end()) for m in _ACCESS.finditer(text)]
    found += [(m.start(), "hex", m.end()) for m in _HEX.finditer(text)]
    base = _reaching(found)
    for start, end in _context_values(text):
        if _covered(base, start, end):
            continue
        if guesses.of_context(text[start:end]) >= min_guesses:
            found.append((start, "guess", end))
    return sorted(found, key=lambda x: (x[0], KINDS.index(x[1])))


def redacted(text: str, spans: list[tuple[int, str, int]]) -> str:
    """``text`` with every span, overlapping ones as one, replaced by ``[SECRET]``."""
    out, at = [], 0
    for start, _, end in spans:
        if end <= at:
            continue
        if start >= at:
            out += [text[at:start], "[SECRET]"]
        at = end
    return "".join(out) + text[at:]


def _plain_words(text: str) -> set[str]:
    """Words of letters, with hyphens inside, in lower case; none from the values of credential contexts."""
    parts, at = [], 0
    for start, end in _context_values(text):
        parts.append(text[at:start])
        at = end
    tokens = {token.strip(_MARKS) for token in set(" ".join([*parts, text[at:]]).lower().split())}
    return {w for w in tokens if 2 <= len(w) <= WORD_LENGTH and w[0] != "-" != w[-1] and w.replace("-", "").isalpha()}


def frequent_words(docs: DataFrame, text: str = "text") -> list[str]:
    """Plain words of the corpus by falling number of documents, ``WORDS`` at most.

    A word counts where it is not the value of a credential context, and only if
    two different texts have it, so neither a secret nor copies of a text that
    tells it once more make it a word. If there are more words, those with the
    smallest number of documents that does not fit as a whole, or less, are left out.
    """

    def counted(batch: pa.RecordBatch):
        found: dict[str, list[int]] = {}
        for body, mark in zip(batch.column("_text").to_pylist(), batch.column("_mark").to_pylist()):
            for word in _plain_words(body):
                seen = found.get(word)
                if seen is None:
                    found[word] = [1, mark, mark]
                else:
                    seen[0] += 1
                    if mark < seen[1]:
                        seen[1] = mark
                    elif mark > seen[2]:
                        seen[2] = mark
        n, low, high = zip(*found.values()) if found else ((), (), ())
        yield {"word": list(found), "n": n, "low": low, "high": high}

    bodies = docs.where(F.col(text).isNotNull()).select(F.col(text).alias("_text"), F.xxhash64(text).alias("_mark"))
    parts = map_batches(bodies, counted, "word string, n bigint, low bigint, high bigint")
    words = parts.groupBy("word").agg(F.sum("n").alias("n"), F.min("low").alias("low"), F.max("high").alias("high"))
    words = materialize(words.where("low < high").select("word", "n"), "words")
    taken, least = 0, None
    for row in sorted(words.groupBy("n").agg(F.count(F.lit(1)).alias("words")).collect(), reverse=True):
        taken += row.words
        if taken > WORDS:
            break
        least = row.n
    rows = [] if least is None else words.where(F.col("n") >= least).collect()
    return [row.word for row in sorted(rows, key=lambda row: (-row.n, row.word))]


def _scanned(docs: DataFrame, text: str, keep: list[str]) -> DataFrame:
    """``keep`` as ``_k0``, ``_k1``, ... with ``kinds``, ``starts``, ``ends`` and ``redacted``."""
    keys = [f"_k{i}" for i in range(len(keep))]
    base = docs.select(*[F.col(c).alias(k) for k, c in zip(keys, keep)], F.col(text).alias("_text"))
    kinds = ", ".join(f"{k} {docs.schema[c].dataType.simpleString()}" for k, c in zip(keys, keep))

    ranks = _rank(dict.fromkeys((*COMMON_WORDS, *frequent_words(docs, text))))
    shared = docs.sparkSession.sparkContext.broadcast(ranks)

    def scanned(batch: pa.RecordBatch):
        guesses = Guesses(shared.value)
        texts = batch.column("_text").to_pylist()
        spans = [secret_spans(t, guesses=guesses) for t in texts]
        yield {
            **{k: batch.column(k) for k in keys},
            "kinds": [[kind for _, kind, _ in s] for s in spans],
            "starts": [[start for start, _, _ in s] for s in spans],
            "ends": [[end for _, _, end in s] for s in spans],
            "redacted": [t if not s else redacted(t, s) for t, s in zip(texts, spans)],
        }

    return map_batches(
        base, scanned, f"{kinds}, kinds array<string>, starts array<bigint>, ends array<bigint>, redacted string"
    )


def scan(docs: DataFrame, text: str = "text", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``keep`` and ``kinds``, ``starts``, ``ends`` (arrays) and ``redacted`` of every row.

    Every row gives one row; a null text stays null and has no spans. The texts
    are read twice, first for ``frequent_words``. No rows but the counts of words
    are moved, so a hot source or many equal texts make no difference.
    """
    found = _scanned(docs, text, list(keep))
    return found.select(*[F.col(f"_k{i}").alias(c) for i, c in enumerate(keep)], "kinds", "starts", "ends", "redacted")


def without_secrets(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with the secrets in ``text`` replaced, and the columns as they are."""
    found = _scanned(docs, text, docs.columns)
    return found.select(
        *[(F.col("redacted") if c == text else F.col(f"_k{i}")).alias(c) for i, c in enumerate(docs.columns)]
    )
