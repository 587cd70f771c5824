import re

import numpy as np
import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st

from basketlens.llm import arrays, frames

TEXT = st.text(alphabet=st.sampled_from("abAB é😀\n\t\x0b,"), max_size=60)


def found(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


@settings(max_examples=60, deadline=None)
@given(st.lists(st.one_of(st.none(), TEXT), max_size=8))
def test_words_have_equal_hashes_when_they_are_equal(texts):
    got = arrays.words_of(pa.array(texts, pa.string()), lower=True, marks=b",")
    lower = str.maketrans("AB", "ab")
    wanted = [w.translate(lower) for t in texts for w in found(t)]
    assert np.diff(got.starts).tolist() == [len(found(t)) for t in texts]
    assert len(set(zip(wanted, got.hashes.tolist()))) == len(set(wanted)) == len(set(got.hashes.tolist()))
    assert got.characters.tolist() == [sum(map(len, found(t))) for t in texts]
    assert got.marked.tolist() == [(t or "").count(",") for t in texts]


def test_long_rows_are_cut_between_words(monkeypatch):
    monkeypatch.setattr(arrays, "RUN_BYTES", 64)
    texts = ["aa " * 100, "b" * 300, None, "x y " * 50 + "z" * 200]
    whole = arrays.words_of(pa.array(["aa", "x", "y", "b" * 300, "z" * 200]))
    got = arrays.words_of(pa.array(texts))
    assert np.diff(got.starts).tolist() == [100, 1, 0, 101]
    assert set(got.hashes.tolist()) == set(whole.hashes.tolist())


def test_shingles_and_distinct():
    texts = ["a b c d e f", "a b", "", "q q q q q q q", None, "a b c d e f"]
    hashes, starts = arrays.shingles_of(arrays.words_of(pa.array(texts)))
    assert np.diff(starts).tolist() == [2, 1, 0, 3, 0, 2]
    assert hashes[:2].tolist() == hashes[-2:].tolist()
    assert np.diff(arrays.distinct(hashes, starts)[1]).tolist() == [2, 1, 0, 1, 0, 2]


def test_runs_cover_all_rows():
    assert list(frames.runs([])) == []
    assert list(frames.runs([5, 5, 50, 1, 0], 10)) == [(0, 2), (2, 3), (3, 5)]
