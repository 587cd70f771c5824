"""Language identification by words first, then by ever shorter character n-grams.

A word that any language knows scores the negative logarithm of its relative
frequency in each language, or a penalty where a language does not know it. A
word that no language knows is replaced by its character n-grams of the longest
length of which some are known, down to single characters. A text's score in a
language is the mean over its words; the smallest mean wins.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from functools import cached_property

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401  pa.compute
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from basketlens.llm.frames import map_batches

UNKNOWN = "und"

# Bounds of the model, per language: labelled documents it is fitted on (the
# expected size of a sample drawn by a hash of the text), words, and n-grams of
# each length. They bound what is collected and broadcast.
TRAIN_DOCUMENTS = 5_000
WORDS = 50_000
GRAMS = 10_000
LONGEST = 5
PENALTY = 7.0

# Words a text's confidence rests on at most.
CONFIDENT_WORDS = 10

_WORD = re.compile(r"[^\W\d_]+")
_PART = 1 << 20


def words_in(text: str | None) -> Iterator[list[str]]:
    """Lower-case letter runs of a whole text, in lists of bounded size."""
    at, end = 0, len(text or "")
    while at < end:
        stop = at + _PART
        if stop < end:
            space = re.compile(r"\s").search(text, stop)
            stop = space.start() if space else end
        yield _WORD.findall(text[at:stop].lower())
        at = stop


def has_letter(words: list[str]) -> bool:
    return any(c.isalpha() for w in words for c in w)


class Terms:
    """Terms as one packed Arrow array, with a row of scores for each."""

    def __init__(self, terms: pa.Array, scores: np.ndarray):
        self.terms, self.scores = terms, scores

    @cached_property
    def at(self) -> dict[str, int]:
        """Row of every term; built where texts are scored and never sent."""
        return {term: i for i, term in enumerate(self.terms.to_pylist())}

    def __getstate__(self) -> dict:
        return {"terms": self.terms, "scores": self.scores}


class Model:
    """Scores of words and n-grams in every language."""

    def __init__(self, languages: list[str], words: Terms, grams: Terms):
        self.languages, self.words, self.grams = languages, words, grams
        self.seen: dict[str, np.ndarray] = {}

    @property
    def word_at(self) -> dict[str, int]:
        return self.words.at

    @property
    def gram_at(self) -> dict[str, int]:
        return self.grams.at

    @property
    def word_scores(self) -> np.ndarray:
        return self.words.scores

    @property
    def gram_scores(self) -> np.ndarray:
        return self.grams.scores

    def unknown(self, word: str) -> np.ndarray:
        """Scores of a word that no language knows; the last ones are remembered."""
        found = self.seen.get(word)
        if found is None:
            if len(self.seen) >= 100_000:
                self.seen.clear()
            found = self.seen[word] = self._from_grams(f" {word} ")
        return found

    def _from_grams(self, padded: str) -> np.ndarray:
        for n in range(LONGEST, 0, -1):
            places = [self.gram_at.get(padded[i : i + n]) for i in range(len(padded) - n + 1)]
            known = [p for p in places if p is not None]
            if known:
                return self.gram_scores[known].mean(axis=0)
        return np.full(len(self.languages), PENALTY)

    def predict(self, text: str | None) -> tuple[str, float]:
        total, n, letters = np.zeros(len(self.languages)), 0, False
        for words in words_in(text):
            letters = letters or has_letter(words)
            n += len(words)
            if self.languages:
                total += self._sum(words)
        if not letters or not self.languages:
            return UNKNOWN, 0.0
        weight = np.log(10) * min(n, CONFIDENT_WORDS) / n
        odds = np.exp((total.min() - total) * weight)
        best = int(total.argmin())  # languages are sorted: of equal ones the first
        return self.languages[best], float(odds[best] / odds.sum())

    def _sum(self, words: list[str]) -> np.ndarray:
        get = self.word_at.get
        places = np.array([get(w, -1) for w in words], np.int64)
        total = self.word_scores[places[places >= 0]].sum(axis=0)
        for at in np.flatnonzero(places < 0):
            total = total + self.unknown(words[at])
        return total


def fit(labelled: DataFrame, text: str = "text", language: str = "lang") -> Model:
    """Model of the rows of ``labelled`` with a text and a language.

    At most about ``TRAIN_DOCUMENTS`` documents of a language are used, drawn by
    a hash of the text, so equal texts are drawn together and the draw repeats.
    Counting is distributed; only the bounded tables come to the driver.
    """
    base = labelled.select(F.col(text).alias("_text"), F.col(language).alias("_lang")).dropna()
    sizes = base.groupBy("_lang").agg(F.count(F.lit(1)).alias("_n"))
    share = F.lit(float(TRAIN_DOCUMENTS)) / F.col("_n")
    drawn = base.join(F.broadcast(sizes), "_lang").where(
        F.pmod(F.xxhash64("_text"), F.lit(1 << 30)) < share * float(1 << 30)
    )

    def count(batch: pa.RecordBatch):
        counts: Counter[tuple[str, str]] = Counter()
        for lang, body in zip(batch.column("_lang").to_pylist(), batch.column("_text").to_pylist()):
            for words in words_in(body):
                counts.update((lang, w) for w in words)
        pairs = list(counts)
        yield {"lang": [p[0] for p in pairs], "term": [p[1] for p in pairs], "n": list(counts.values())}

    counted = map_batches(drawn.select("_lang", "_text"), count, "lang string, term string, n bigint")
    words = counted.groupBy("lang", "term").agg(F.sum("n").alias("n"))
    padded = F.concat(F.lit(" "), "term", F.lit(" "))
    grams = words.select("lang", "n", padded.alias("_word")).select(
        "lang", "n", F.explode(F.concat(*[_grams(F.col("_word"), n) for n in range(1, LONGEST + 1)])).alias("term")
    )
    grams = grams.groupBy("lang", "term").agg(F.sum("n").alias("n"))
    word_rows = _largest(words, [], WORDS).toArrow()
    languages = sorted(word_rows.column("lang").unique().to_pylist())
    word_terms = _scores(word_rows, languages)
    del word_rows
    gram_rows = _largest(grams.where(F.trim("term") != ""), [F.length("term")], GRAMS).toArrow()
    return Model(languages, word_terms, _scores(gram_rows, languages))


def _grams(word: Column, n: int) -> Column:
    last = F.length(word) - (n - 1)
    return F.when(last >= 1, F.transform(F.sequence(F.lit(1), F.greatest(last, F.lit(1))), lambda i: F.substring(word, i, n))).otherwise(
        F.array().cast("array<string>")
    )


def _largest(counts: DataFrame, more: list[Column], most: int) -> DataFrame:
    """The ``most`` most frequent terms per language with the language's total count."""
    group = Window.partitionBy("lang", *more)
    ranked = counts.withColumn("total", F.sum("n").over(group)).withColumn(
        "place", F.row_number().over(group.orderBy(F.desc("n"), "term"))
    )
    return ranked.where(F.col("place") <= most).select("lang", "term", "n", "total")


def _scores(rows: pa.Table, languages: list[str]) -> Terms:
    """Scores from the counted terms, without a Python object per term."""
    coded = pa.compute.dictionary_encode(rows.column("term").combine_chunks())
    at = pa.compute.index_in(rows.column("lang"), pa.array(languages, rows.column("lang").type)).to_numpy()
    scores = np.full((len(coded.dictionary), len(languages)), PENALTY)
    share = rows.column("n").to_numpy() / rows.column("total").to_numpy()
    scores[coded.indices.to_numpy(), at] = np.minimum(PENALTY, -np.log10(share))
    return Terms(coded.dictionary, scores)


def _predicted(docs: DataFrame, model: Model, text: str, keep: list[str]) -> DataFrame:
    """``keep`` as ``_k0``, ``_k1``, ... with ``lang_pred`` and ``score``."""
    keys = [f"_k{i}" for i in range(len(keep))]
    base = docs.select(*[F.col(c).alias(k) for k, c in zip(keys, keep)], F.col(text).alias("_text"))
    kinds = ", ".join(f"{k} {docs.schema[c].dataType.simpleString()}" for k, c in zip(keys, keep))
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def predicted(batch: pa.RecordBatch):
        found = [shared.value.predict(t) for t in batch.column("_text").to_pylist()]
        yield {
            **{k: batch.column(k) for k in keys},
            "lang_pred": [lang for lang, _ in found],
            "score": [score for _, score in found],
        }

    return map_batches(base, predicted, f"{kinds}, lang_pred string, score double")


def identify(docs: DataFrame, model: Model, text: str = "text", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``keep``, ``lang_pred`` and ``score`` of every row; reads the text column alone.

    A null text, or one without a letter, is ``und`` with score 0, as is every
    text when the model has no language. Rows stay where they are.
    """
    found = _predicted(docs, model, text, list(keep))
    return found.select(*[F.col(f"_k{i}").alias(c) for i, c in enumerate(keep)], "lang_pred", "score")


def accepted(docs: DataFrame, model: Model, min_score: float, text: str = "text") -> DataFrame:
    """Rows of ``docs`` with a known language of at least ``min_score``, with the columns of ``docs``."""
    found = _predicted(docs, model, text, docs.columns).where((F.col("lang_pred") != UNKNOWN) & (F.col("score") >= min_score))
    return found.select(*[F.col(f"_k{i}").alias(c) for i, c in enumerate(docs.columns)])
