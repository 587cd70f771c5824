import re

from pyspark.sql import functions as F

from basketlens.llm import pii
from basketlens.llm.frames import documents
from tests.llm.helpers import frame, words

PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def valid(kind, value):
    digits = re.sub("[^0-9]", "", value)
    if kind == "ip":
        return all(int(p) <= 255 for p in value.split("."))
    if kind == "phone":
        return 9 <= len(digits) <= 15
    if kind == "card":
        total = sum(int(c) if i % 2 == 0 else sum(divmod(2 * int(c), 10)) for i, c in enumerate(reversed(digits)))
        return 12 <= len(digits) <= 19 and total % 10 == 0
    return True


def brute(text):
    kinds = list(PATTERNS)
    return sorted(
        (m.start(), kinds.index(k) + 1, m.end()) for k, p in PATTERNS.items() for m in re.finditer(p, text or "") if valid(k, m.group())
    )


def base_of(row):
    return [(s.start, s.place, s.end) for s in row.spans if s.kind != "term"]


def test_base_spans_against_brute_force(spark, folder):
    docs = documents(spark, folder)
    texts = dict(docs.select("doc_id", "text").collect())
    assert all(base_of(r) == brute(texts[r.doc_id]) for r in pii.find(docs).collect())


def test_awkward_matches(spark):
    texts = [
        "a@b.c_d@e.f x@y a@b.c@d.e", "é +1 (234) 567-8901, 1.2.3.4.5.6.7.8 256.1.1.1 0001.2.3.4", "4111 1111 1111 1111 4111-1111-1111-1112",
        "9" * 9000 + "." + "7" * 50, "aaaa" * 5000, "+5(((((((1", "😀a@b.co +123456789", None, "",
    ]
    docs = frame(spark, [(i, t, "en", "s") for i, t in enumerate(texts)])
    for row in pii.find(docs).collect():
        assert base_of(row) == brute(texts[row.doc_id]), texts[row.doc_id]


def test_terms_that_give_an_entity_away(spark):
    rows = [(i, " ".join(words(i, 60)) + f" contact Zebulon at zeb@corp.example the {i}", "en", "s") for i in range(6)]
    rows += [(100 + i, " ".join(words(50 + i, 60)) + f" contact the other{i} at o{i}@corp.example", "en", "s") for i in range(30)]
    rows += [(200 + i, " ".join(words(90 + i, 60)) + " contact the office", "en", "s") for i in range(60)]
    rows += [(300, "Zebulon, alone", "en", "s"), (301, "nobody here", "en", "s")]
    docs = frame(spark, rows)
    spans = {r.doc_id: [(s.start, s.end) for s in r.spans if s.kind == "term"] for r in pii.find(docs).collect()}
    texts = {r[0]: r[1] for r in rows}
    found = {texts[d][a:b] for d, s in spans.items() for a, b in s}
    assert found == {"Zebulon"} and all(spans[i] for i in range(6)) and spans[300] == [(0, 7)]
    clean = {r.doc_id: r.text for r in pii.sanitised(docs).collect()}
    assert "Zebulon" not in clean[300] and clean[301] == "nobody here" and "[EMAIL]" in clean[0] and "@" not in clean[0]
    assert clean[200] == texts[200]


def test_words_near_an_entity(spark):
    card = "4111 1111 1111 1111"
    far = "x" * 73
    texts = [
        "Zebulon wrote zeb@corp.example", "zeb@corp.example is Zebulon", f"John Smith, 12 High Street, card {card}", f"{card}, card of 99 John",
        f"cut {far} near ab@c.de near {far} cut", "one ab@c.de, two de@f.gh three", f"{'10 ' * 39}ab {card}",
        f"beyond {'7' * 79} ab@c.de", f"begin {'7' * 73} ab@c.de", f"egin {'7' * 74} ab@c.de {'7' * 74} stop",
    ]
    keyed = pii._keyed(frame(spark, [(i, t, "en", "s") for i, t in enumerate(texts)]), "doc_id", "text").cache()
    marks = {r.mark: r.doc_id for r in keyed.collect()}
    near = {}
    for row in pii._near(pii.entities(keyed)).collect():
        near.setdefault((marks[row.mark], row.entity), set()).add(row.term)
    assert near[0, "email:zeb@corp.example"] == {"zebulon", "wrote"} and near[1, "email:zeb@corp.example"] == {"is", "zebulon"}
    assert near[2, f"card:{card}"] == {"john", "smith", "12", "high", "street", "card"} and near[3, f"card:{card}"] == {"card", "of", "99", "john"}
    assert near[4, "email:ab@c.de"] == {far, "near"}
    assert near[5, "email:ab@c.de"] == {"one", "two", "three"} and near[5, "email:de@f.gh"] == {"one", "two", "three"}
    assert near[6, f"card:{card}"] == {"10", "ab"}
    assert near[7, "email:ab@c.de"] == {"7" * 79} and near[8, "email:ab@c.de"] == {"begin", "7" * 73}
    assert near[9, "email:ab@c.de"] == {"egin", "7" * 74, "stop"}


def test_edges(edge, nothing):
    assert pii.find(edge).count() == edge.count()
    clean = pii.sanitised(edge)
    assert clean.columns == edge.columns and clean.count() == edge.count()
    assert clean.where(F.col("doc_id") == 8).first().text == "naïve ünïcode 😀 text, mail [EMAIL] [IP]"
    assert pii.find(nothing).count() == 0
