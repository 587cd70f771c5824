import random

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from basketlens.llm import bpe
from basketlens.llm.frames import documents
from tests.llm.helpers import frame, words

RANKS, FILE = public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.path("byte_bpe_50k.json")
TEXTS = [
    "a" * 5000, "ab" * 3000 + "漢字" * 2000, " " * 4000 + "x", "\n" * 3000, "漢" * 3000 + "é" * 3000 + "1" * 3000, "!?" * 3000 + "'s it's we'll" * 300,
    "'" * 2000 + "s" * 2000, "x" * 1499 + "<|endoftext|>" + "y" * 2000, "<|endoftext|>" * 400, " ".join(words(3, 2000)), "😀" * 2500, "it's " * 999, "\t \t" * 1500,
    "q'" * 2500, "''t" * 1500, "", "<|endoftext|> a", "a<|endo", "Zalgó́́" * 500,
]


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(FILE)


@pytest.mark.parametrize("size", [64, 1000])
def test_cut_and_joined_parts_equal_the_whole(library, size):
    encoder = bpe.codec(RANKS, FILE)
    for text in TEXTS:
        parts = bpe.cut(text, tuple(encoder.special), size)
        assert "".join(t for t, _ in parts) == text
        ids = bpe.tree(encoder, [encoder.part(t, sure) for t, sure in parts])
        assert ids == library.encode(text, add_special_tokens=False).ids, text[:40]


# a run that is cut, and white space after it that goes with different neighbours
SPACED = ["\u5b57" * 32768 + "\u6f22" * n + "\u2028 \u2028zend of text" for n in (9, 41)]


@pytest.mark.parametrize("text", SPACED + ["q" * 32766 + "'" * 9 + "s" * 40_000, " " * 32769 + "x" + "\n" * 70_000 + "y"])
def test_windows_at_the_default_size(library, text):
    encoder = bpe.codec(RANKS, FILE)
    parts = bpe.cut(text, tuple(encoder.special))
    assert len(parts) > 1
    assert bpe.tree(encoder, [encoder.part(t, sure) for t, sure in parts]) == library.encode(text, add_special_tokens=False).ids


def test_mixed_runs_at_random(library):
    """Runs of white space, letters, numbers, marks, apostrophes and special tokens of random lengths, at small sizes."""
    pick = random.Random(11)
    pieces = ["\u2028", "\u3000", "\u00a0", " ", "\u200b", "\n", "\t", "a", "Z", "\u5b57", "\u0e01", "1", "'", "'s", "'ll", "!", "<|endoftext|>", "\u0301", "\x1c"]
    encoder = bpe.codec(RANKS, FILE)
    for _ in range(1500):
        some = pick.sample(pieces, pick.randrange(1, 5))
        text = "".join(pick.choice(some) * pick.choice([1, 1, 2, 3, 9, 40, 90]) for _ in range(pick.randrange(2, 12)))
        for size in (16, 33, 100):
            parts = bpe.cut(text, tuple(encoder.special), size)
            assert "".join(t for t, _ in parts) == text
            ids = bpe.tree(encoder, [encoder.part(t, sure) for t, sure in parts])
            assert ids == library.encode(text, add_special_tokens=False).ids, (text, size)


def check(docs, library):
    texts = {}
    for r in docs.collect():
        texts.setdefault(r.doc_id, []).append(r.text or "")
    rows = bpe.decode(bpe.encode(docs, RANKS, FILE), RANKS, FILE).collect()
    assert len(rows) == docs.count()
    for row in rows:
        assert row.decoded in texts[row.doc_id]
        ids = np.frombuffer(row.ids, "<u4").tolist()
        assert len(ids) == row.n_tokens and ids == library.encode(row.decoded, add_special_tokens=False).ids


def test_documents(spark, folder, library):
    check(documents(spark, folder), library)


def test_long_parts_meet(spark, library, monkeypatch):
    monkeypatch.setattr(bpe, "PART", 512)
    rows = [(i, t, "en", "s") for i, t in enumerate(TEXTS)]
    check(frame(spark, rows + rows[:2]), library)


def test_edges(edge, nothing, library):
    check(edge, library)
    assert bpe.encode(nothing, RANKS, FILE).count() == 0
