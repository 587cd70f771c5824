import random
from collections import defaultdict

import pytest

from basketlens.llm import repeats
from tests.llm.helpers import frame, words


def brute(docs):
    """doc_id -> kept bytes, over (doc_id, text) with distinct ids."""
    first = {}
    for doc, text in sorted(docs):
        body = (text or "").encode()
        for i in range(len(body) - 49):
            first.setdefault(body[i : i + 50], doc)
    out = {}
    for doc, text in docs:
        body = (text or "").encode()
        gone = set()
        for i in range(len(body) - 49):
            if first[body[i : i + 50]] < doc:
                gone.update(range(i, i + 50))
        out[doc] = bytes(b for i, b in enumerate(body) if i not in gone)
    return out


def corpus(seed):
    pick = random.Random(seed)
    passages = [" ".join(words(900 + i, pick.randrange(8, 60))) for i in range(6)]
    docs = []
    for i in range(40):
        parts = [" ".join(words(seed * 100 + i, pick.randrange(0, 40)))]
        for _ in range(pick.randrange(3)):
            passage = pick.choice(passages)
            cut = pick.randrange(len(passage))
            parts += [passage[cut : cut + pick.randrange(30, 300)], " ".join(words(pick.random(), 7)), "ä" * pick.randrange(60)]
        docs.append((pick.randrange(1000) * 50 + i, " ".join(parts)))
    docs.append((7, docs[0][1]))
    docs += [(60_001, None), (60_002, ""), (60_003, "short"), (60_004, "a" * 700), (60_005, "ba" + "a" * 333 + "c")]
    return docs


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_against_brute_force(spark, seed):
    docs = corpus(seed)
    wanted = brute(docs)
    found = repeats.without_repeats(frame(spark, [(*d, "en", "s") for d in docs])).collect()
    assert len(found) == len(docs)
    for row in found:
        assert bytes(row.kept) == wanted[row.doc_id]
        assert row.n_bytes - sum(row.lengths) == len(row.kept)
        assert all(a + n < b for a, n, b in zip(row.starts, row.lengths, row.starts[1:]))  # maximal runs


def test_groups_have_all_occurrences(spark):
    docs = corpus(4)
    found = repeats.repeat_groups(frame(spark, [(*d, "en", "s") for d in docs])).collect()
    places = defaultdict(list)
    bodies = {d: (t or "").encode() for d, t in docs}
    for doc, body in bodies.items():
        for i in range(len(body) - 49):
            places[body[i : i + 50]].append((doc, i))
    groups = defaultdict(list)
    for r in found:
        groups[r["repeat"], r.length].append((r.doc, r.start))
    covered = set()
    for (_, length), members in groups.items():
        strings = {bodies[d][s : s + length] for d, s in members}
        assert len(strings) == 1 and len(members) > 1 and length >= 50
        covered.update((d, s + k) for d, s in members for k in range(length - 49))
    assert covered == {p for at in places.values() if len(at) > 1 for p in at}


def test_edges(edge, nothing):
    rows = repeats.without_repeats(edge).collect()
    assert len(rows) == edge.count()
    assert {bytes(r.kept) for r in rows if r.doc_id == 10} == {b""}  # document 9 has the same text
    assert all(r.n_bytes == len(r.kept) for r in rows if r.doc_id == 7)
    assert repeats.without_repeats(nothing).count() == 0


def test_rows_of_one_id_and_without_id(spark):
    a, b = " ".join(words(31, 40)), " ".join(words(32, 40))
    rows = [(5, a), (5, b), (5, b + " " + a), (5, a), (9, "x " + b), (None, a), (None, a + " y"), (None, "z " + b)]
    found = repeats.without_repeats(frame(spark, [(*r, "en", "s") for r in rows])).collect()
    kept = sorted(((r.doc_id is None, bytes(r.kept).decode()) for r in found))
    # texts of document 5 stay whole; the others lose what it has, rows without an id also the blank of document 9, and
    # nothing by one another
    assert kept == sorted([(False, a), (False, b), (False, b + " " + a), (False, a), (False, "x "), (True, ""), (True, " y"), (True, "z")])


def test_crowded_windows_in_small_lists():
    """The suffix arrays of a crowded anchor may be cut anywhere but within equal windows."""
    import numpy as np

    texts = [(" ".join(words(50 + i % 7, 30)) + " " + " ".join(words(90 + i % 3, 30))).encode() for i in range(40)]
    parts = []
    for doc, text in enumerate(texts):
        body = np.frombuffer(text, np.uint8)
        start, length, gram = repeats._contexts(body)
        n = len(start)
        parts.append(([np.full(n, doc), np.full(n, 1), start, length, gram], repeats._gather(body, start, length)))
    entries = repeats._joined(parts)

    def groups():
        found = repeats._maximal(entries)
        return sorted((n, least, tuple(sorted(zip(e.tolist(), o.tolist())))) for e, o, n, least in found)

    whole = groups()
    before = repeats._SUFFIXES
    try:
        repeats._SUFFIXES = 64
        assert groups() == whole and whole
    finally:
        repeats._SUFFIXES = before


def test_markers_of_equal_windows_are_equal():
    import numpy as np

    passage = " ".join(words(3, 30))
    one, other = (np.frombuffer((words(i, 9)[0] + passage + words(i + 1, 9)[0]).encode(), np.uint8) for i in (11, 21))
    sets = []
    for body in (one, other):
        places = {}
        for low, part, sums in repeats._pieces(body):
            for i, marker in enumerate(repeats._markers(part, sums).tolist()):
                places[body[low + i : low + i + 50].tobytes()] = marker
        sets.append(places)
    both = sets[0].keys() & sets[1].keys()
    assert len(both) >= len(passage) - 49 and all(sets[0][w] == sets[1][w] for w in both)
