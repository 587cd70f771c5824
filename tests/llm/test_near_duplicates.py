import random
import re

import pytest

from basketlens.llm import graph, neardup
from basketlens.llm.frames import documents
from tests.llm.helpers import frame, words


def shingles(text):
    lower = (text or "").translate({c: c + 32 for c in range(65, 91)})
    w = re.findall(r"[^\x20\x09-\x0D]+", lower)
    return frozenset(tuple(w[i : i + 5]) for i in range(len(w) - 4)) if len(w) >= 5 else frozenset([tuple(w)] if w else [])


def brute(docs):
    sets = {d: shingles(t) for d, t in docs}
    parent = {d: d for d in sets}

    def root(d):
        while parent[d] != d:
            d = parent[d]
        return d

    ids = sorted(sets)
    for i, a in enumerate(ids):
        for b in ids[:i]:
            x, y = sets[a], sets[b]
            if x and y and 3 * max(len(x), len(y)) <= 4 * min(len(x), len(y)):
                both = len(x & y)
                if 100 * both >= 75 * (len(x) + len(y) - both):
                    p, q = root(a), root(b)
                    parent[max(p, q)] = min(p, q)
    return {d: (len(sets[d]), root(d)) for d in ids}


def compare(df, docs):
    wanted = brute(docs)
    rows = neardup.groups(df).collect()
    assert len(rows) == len(docs)
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in rows} == wanted
    assert all(r.kept == (r.doc_id == r.component_id) for r in rows)


def test_documents_against_brute_force(spark, folder):
    docs = documents(spark, folder)
    compare(docs, [tuple(r) for r in docs.select("doc_id", "text").collect()])


def edited(base, changes, seed):
    pick, out = random.Random(seed), list(base)
    for _ in range(changes):
        out[pick.randrange(len(out))] = f"new{pick.randrange(10**6)}"
    return " ".join(out)


@pytest.mark.parametrize("changes", [2, 5, 9])
def test_a_dense_family(spark, changes):
    """Copies of one text around the threshold: with more of them than neighbours are looked at."""
    base = words(77, 150)
    docs = [(1000 - i, edited(base, changes + i % 3, i)) for i in range(120)]
    docs += [(2000 + i, " ".join(words(i, 80))) for i in range(40)] + [(3000 + i, docs[5][1]) for i in range(30)]
    docs += [(5000, "One two"), (5001, "one TWO"), (5002, "two one"), (5003, None), (5004, "")]
    compare(frame(spark, [(*d, "en", "s") for d in docs]), docs)


def test_edges(edge, nothing):
    rows = neardup.groups(edge).collect()
    assert len(rows) == edge.count()
    found = {r.doc_id: r.component_id for r in rows}
    assert (found[1], found[2], found[6], found[10], found[None]) == (1, 2, 5, 9, None)
    left = neardup.first_of_groups(edge)
    assert left.columns == edge.columns
    assert sorted(r.doc_id or 0 for r in left.collect()) == [0, 1, 2, 3, 4, 5, 7, 8, 9]
    assert neardup.groups(nothing).count() == 0 and neardup.first_of_groups(nothing).count() == 0


def test_components(spark):
    pick = random.Random(3)
    links = [(i, i + 1) for i in range(60)] + [(200, i) for i in range(201, 240)] + [(pick.randrange(300, 400), pick.randrange(300, 400)) for _ in range(60)]
    parent = {}

    def root(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        p, q = root(a), root(b)
        parent[max(p, q)] = min(p, q)
    found = {r.node: r.component for r in graph.components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert found == {x: root(x) for a, b in links for x in (a, b) if a != b}
    assert graph.components(spark.createDataFrame([], "a long, b long")).count() == 0
