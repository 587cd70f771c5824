import zlib
from collections import defaultdict

from basketlens.llm import mixing, sharding
from basketlens.llm.frames import documents
from tests.llm.helpers import frame, words


def test_shards(spark, folder):
    docs = documents(spark, folder)
    texts = dict(docs.select("doc_id", "text").collect())
    rows = sharding.shards_by_bytes(docs).collect()
    slots, sizes = defaultdict(list), defaultdict(int)
    for r in rows:
        body = (texts[r.doc_id] or "").encode()
        assert (r["size"], r.text_crc32) == (len(body) + 1, zlib.crc32(body))
        slots[r.shard].append(r.slot)
        sizes[r.shard] += r["size"]
    assert sorted(slots) == list(range(16))
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    largest = max(r["size"] for r in rows)
    assert max(sizes.values()) - min(sizes.values()) <= 2 * largest


def test_a_hot_source_is_split(spark):
    docs = frame(spark, [(i, "same text", "en", "hot") for i in range(3000)] + [(5000 + i, " ".join(words(i, 30)), "de", "b") for i in range(500)])
    sizes = defaultdict(int)
    for r in sharding.shards_by_bytes(docs, 7).collect():
        sizes[r.shard] += r["size"]
    assert sorted(sizes) == list(range(7)) and max(sizes.values()) - min(sizes.values()) < 0.03 * max(sizes.values())


def test_shards_of_edges(edge, nothing):
    assert sharding.shards_by_bytes(edge).count() == edge.count()
    assert sharding.shards_by_bytes(nothing).count() == 0


def targets(sizes):
    """Source -> target, by pouring out the excess again and again."""
    weights = dict(zip(sorted(sizes, key=lambda s: (s is None, (s or "").encode())), (5, 2, 1) * len(sizes)))
    total, full = sum(sizes.values()), set()
    while True:
        rest = total - sum(3 * sizes[s] for s in full)
        share = sum(w for s, w in weights.items() if s not in full)
        got = {s: 3 * sizes[s] if s in full else rest * weights[s] / share for s in sizes}
        over = {s for s in sizes if s not in full and got[s] > 3 * sizes[s]}
        if not over:
            return got
        full |= over


def test_mix(spark, folder):
    docs = documents(spark, folder).withColumnRenamed("lang", "mark")
    rows = mixing.sizes(docs)
    found = mixing.copies(rows).collect()
    sizes, taken = defaultdict(int), defaultdict(int)
    for r in found:
        sizes[r.source] += r["size"]
        taken[r.source] += r.copies * r["size"]
        assert 0 <= r.copies <= 3
    wanted = targets(sizes)
    for r in found:
        assert r.source_size == sizes[r.source] and abs(r.target - wanted[r.source]) < 1e-6 * wanted[r.source] + 1e-9
    assert sum(abs(taken[s] - wanted[s]) for s in sizes) < 0.03 * sum(sizes.values())
    again = {(r.doc_id, r.copies) for r in mixing.copies(mixing.sizes(docs.repartition(5))).collect()}
    assert again == {(r.doc_id, r.copies) for r in found}


def test_capped_and_null_sources(spark):
    rows = [(i, " ".join(words(i, 5)), "en", "a") for i in range(4)]
    rows += [(100 + i, " ".join(words(i, 50)), "en", None) for i in range(30)] + [(200 + i, " ".join(words(i, 40)), "en", "b") for i in range(40)]
    found = mixing.copies(mixing.sizes(frame(spark, rows))).collect()
    wanted = targets({"a": 20, None: 1500, "b": 1600})
    assert all(abs(r.target - wanted[r.source]) < 1e-6 for r in found)
    assert all(r.copies == 3 for r in found if r.source == "a")  # its target is its limit
    taken = sum(r.copies * r["size"] for r in found if r.source is None)
    assert abs(taken - wanted[None]) <= 50


def test_mix_of_edges(edge, nothing):
    counted = mixing.copies(mixing.sizes(edge))
    assert counted.count() == edge.count()
    assert all(r.copies == 0 for r in counted.collect() if r.doc_id in (1, 2, 3))
    mixed = mixing.mixed(edge)
    assert mixed.columns == edge.columns and mixed.count() == sum(r.copies for r in counted.collect())
    assert mixing.mixed(nothing).count() == 0 and mixing.copies(mixing.sizes(nothing)).count() == 0
