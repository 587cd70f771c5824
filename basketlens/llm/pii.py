"""Personal data: fixed patterns, and terms whose company in the corpus gives an entity away.

A matched e-mail address, IP address, card or phone number is a protected
entity. A term near it discloses it when seeing the term tells nearly as much as
the entity itself: with counts of distinct texts, the pointwise mutual
information of term and entity over the entity's information content,

    log(n(e, t) * N / (n(e) * n(t))) / log(N / n(e)),

reaches a threshold. Such terms are removed, or generalised from a lower one.
Everything is column expressions, joins and aggregates; no Python on the rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from basketlens.llm.frames import SPACES
from basketlens.session import materialize

KINDS = ("email", "ip", "card", "phone")

# Fixed patterns. Possessive repeats and a match that begins where a run of its
# characters begins, or where the last match ended, find the same matches as
# plain repeats, in time that is linear in the text.
PATTERNS = {
    "email": r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:(?<![0-9])|\G)[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
_BYTE = r"0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9])"

CONTEXT = 80  # code points on each side of an entity
_MATCHES = CONTEXT // 2 + 1  # matches, of two code points at least, that are sure to reach beyond a context
_MASK = "\uffff"  # no character of a text
MIN_TEXTS = 3  # distinct texts in which term and entity stand together
GENERALISE = 0.8
REMOVE = 0.95
_EDGES = ".,;:!?()[]{}<>\"'|*#%&$"


def _possible(text: Column) -> dict[str, Column]:
    digits = text.rlike("[0-9]")
    return {"email": text.contains("@"), "ip": digits & text.contains("."), "card": digits, "phone": text.contains("+")}


def _places(text: Column, pattern: str, each) -> Column:
    """Array of ``each(i, gap, match, both)`` over the matches; a gap is the text before a match.

    ``both`` has all ``pieces`` of the text around the ``matches``.
    """
    both = F.struct(
        F.split(text, pattern, -1).alias("pieces"), F.regexp_extract_all(text, F.lit(pattern), F.lit(0)).alias("matches")
    )
    # the one-element array binds both, so that they are found once
    bound = F.transform(F.array(both), lambda b: F.transform(b["matches"], lambda m, i: each(i, F.get(b["pieces"], i), m, b)))
    return F.element_at(bound, 1)


def _beside(kind: str, pieces: Column, matches: Column, near) -> Column:
    """The text of ``pieces`` with ``matches`` between, ``near`` its end; valid matches are masked."""
    masked = lambda m: F.when(_valid(F.lit(kind), m), F.repeat(F.lit(_MASK), F.length(m))).otherwise(m)
    parts = F.zip_with(pieces, matches, lambda p, m: F.concat(near(p, F.lit(CONTEXT + 1)), F.coalesce(masked(m), F.lit(""))))
    return near(F.array_join(parts, ""), F.lit(CONTEXT + 1))


def _candidates(text: Column, kind: str) -> Column:
    """One code point more than the context is kept, which tells whether the text goes on and where its word ends."""

    def one(i: Column, gap: Column, match: Column, both: Column) -> Column:
        pieces, matches = both["pieces"], both["matches"]
        back = F.least(i, F.lit(_MATCHES))
        before = _beside(kind, F.slice(pieces, i - back + 1, back + 1), F.slice(matches, i - back + 1, back), F.right)
        after = _beside(kind, F.slice(pieces, i + 2, F.lit(_MATCHES + 1)), F.slice(matches, i + 2, F.lit(_MATCHES)), F.left)
        valid = _valid(F.lit(kind), match)
        return F.struct(
            F.lit(kind).alias("kind"), i.alias("i"), F.length(gap).alias("gap"), match.alias("value"),
            F.when(valid, before).alias("before"), F.when(valid, after).alias("after"),
        )

    return _places(text, PATTERNS[kind], one)


def _luhn(number: Column) -> Column:
    digits = F.reverse(F.regexp_replace(number, "[^0-9]", ""))

    def add(total: Column, i: Column) -> Column:
        digit = F.substring(digits, i + 1, F.lit(1)).cast("int")
        doubled = digit * 2
        return total + F.when(i % 2 == 0, digit).otherwise(doubled - F.when(doubled > 9, 9).otherwise(0))

    total = F.aggregate(F.sequence(F.lit(0), F.length(digits) - 1), F.lit(0), add)
    return total % 10 == 0


def _valid(kind: Column, value: Column) -> Column:
    digits = F.length(F.regexp_replace(value, "[^0-9]", ""))
    return (
        F.when(kind == "ip", value.rlike(rf"^{_BYTE}(?:\.{_BYTE}){{3}}$"))
        .when(kind == "card", F.when((digits >= 12) & (digits <= 19), _luhn(value)).otherwise(False))
        .when(kind == "phone", (digits >= 9) & (digits <= 15))
        .otherwise(True)
    )


def _keyed(docs: DataFrame, key: str, text: str) -> DataFrame:
    body = F.coalesce(F.col(text), F.lit(""))
    return docs.select(F.col(key).alias("doc_id"), body.alias("text"), F.xxhash64(body).alias("mark"))


def entities(keyed: DataFrame) -> DataFrame:
    """``doc_id, mark, kind, start, end, value, before, after`` of every valid match.

    Leftmost, non-overlapping matches per kind; positions are code points.
    Equal rows give their matches once.
    """
    text = F.col("text")
    none = _candidates(F.lit(""), "email")
    every = [F.when(test, _candidates(text, kind)).otherwise(none) for kind, test in _possible(text).items()]
    found = keyed.select("doc_id", "mark", F.explode(F.concat(*every)).alias("m")).select("doc_id", "mark", "m.*")
    row = Window.partitionBy("doc_id", "mark", "kind").orderBy("i").rowsBetween(Window.unboundedPreceding, 0)
    end = F.sum(F.col("gap") + F.length("value")).over(row)
    return (
        found.dropDuplicates(["doc_id", "mark", "kind", "i"])
        .withColumn("end", end)
        .withColumn("start", F.col("end") - F.length("value"))
        .where(_valid(F.col("kind"), F.col("value")))
        .select("doc_id", "mark", "kind", "start", "end", "value", "before", "after")
    )


def _term(word: Column) -> Column:
    return F.lower(F.trim(word, F.lit(_EDGES)))


def _words(text: Column) -> Column:
    return F.split(F.trim(text, F.lit(SPACES)), "[ \\t-\\r]+")


def _near(found: DataFrame) -> DataFrame:
    """``entity, term, mark``, distinct: terms within ``CONTEXT`` code points of an entity.

    A word that the context cuts, or that touches the entity or another one of
    its kind, is no term; the first and last word of the text are terms.
    """
    before = F.regexp_replace("before", r"[^ \t-\r]+$", "")
    before = F.when(F.length("before") > CONTEXT, F.regexp_replace(before, r"^[^ \t-\r]+", "")).otherwise(before)
    after = F.regexp_replace("after", r"^[^ \t-\r]+", "")
    after = F.when(F.length("after") > CONTEXT, F.regexp_replace(after, r"[^ \t-\r]+$", "")).otherwise(after)
    words = F.array_distinct(F.transform(_words(F.concat_ws(" ", before, after)), _term))
    return (
        found.select(F.concat_ws(":", "kind", F.lower("value")).alias("entity"), "mark", F.explode(words).alias("term"))
        .where((F.length("term") >= 2) & ~F.col("term").contains(_MASK))
        .distinct()
    )


def disclosing_terms(keyed: DataFrame, found: DataFrame) -> tuple[DataFrame, DataFrame] | None:
    """(``term, disclosure``; ``doc_id, mark, term``): terms over ``GENERALISE`` and the rows they occur in.

    Counts are of distinct texts, over all texts of the corpus. A term can only
    pass if few texts have it, so a first pass counts texts per term by sketches
    and leaves out terms at over twice the largest number that could pass, which
    is a hundred standard errors away; the others are counted exactly in a
    second one. None when no word stands near an entity in ``MIN_TEXTS`` texts.
    """
    near = materialize(_near(found), "near")
    together = near.groupBy("entity", "term").agg(F.count(F.lit(1)).alias("n_both")).where(F.col("n_both") >= MIN_TEXTS)
    alone = found.select(F.concat_ws(":", "kind", F.lower("value")).alias("entity"), "mark").distinct()
    alone = alone.groupBy("entity").agg(F.count(F.lit(1)).alias("n_entity"))
    together = materialize(together.join(alone, "entity"), "together")
    if together.isEmpty():
        return None
    texts = F.lit(float(keyed.select("mark").distinct().count()))
    most = F.max(F.col("n_both") * F.pow(texts / F.col("n_entity"), F.lit(1 - GENERALISE)))
    terms = materialize(together.groupBy("term").agg(most.alias("most")), "terms")
    each = keyed.select("doc_id", "mark", F.explode(F.array_distinct(F.transform(_words(F.col("text")), _term))).alias("term"))
    rough = each.join(terms, "term").groupBy("term", "most").agg(F.approx_count_distinct("mark", 0.01).alias("n"))
    rare = materialize(rough.where(F.col("n") <= 2 * F.col("most")).select("term"), "rare")
    where = materialize(each.join(rare, "term", "left_semi"), "occurrences")
    seen = where.select("mark", "term").distinct().groupBy("term").agg(F.count(F.lit(1)).alias("n_term"))
    share = F.log(F.col("n_both") * texts / (F.col("n_entity") * F.col("n_term")))
    told = (
        together.join(seen, "term")
        .where(F.col("n_entity") < texts)
        .groupBy("term")
        .agg(F.max(share / F.log(texts / F.col("n_entity"))).alias("disclosure"))
    )
    return told.where(F.col("disclosure") >= GENERALISE), where


def _term_spans(keyed: DataFrame, base: DataFrame, terms: DataFrame, where: DataFrame) -> DataFrame:
    """``doc_id, mark, kind, start, end, disclosure`` of disclosing terms outside the base spans."""
    rows = where.join(terms, "term").groupBy(F.col("doc_id").alias("_d"), F.col("mark").alias("_m")).agg(
        F.collect_list(F.struct("term", "disclosure")).alias("_terms")
    )
    rows = materialize(rows, "flagged")
    same = F.col("doc_id").eqNullSafe(F.col("_d")) & (F.col("mark") == F.col("_m"))
    flagged = keyed.join(rows, same).dropDuplicates(["doc_id", "mark"])

    def one(i: Column, gap: Column, word: Column, both: Column) -> Column:
        return F.struct(i.alias("i"), F.length(gap).alias("gap"), word.alias("word"))

    word = Window.partitionBy("doc_id", "mark").orderBy("i").rowsBetween(Window.unboundedPreceding, 0)
    placed = (
        flagged.select("doc_id", "mark", F.explode(_places(F.col("text"), r"[^\x20\x09-\x0D]+", one)).alias("w"))
        .select("doc_id", "mark", "w.*")
        .withColumn("stop", F.sum(F.col("gap") + F.length("word")).over(word))
        .withColumn("term", _term(F.col("word")))
        .join(terms, "term")
        .withColumn("start", F.col("stop") - F.length(F.ltrim("word", F.lit(_EDGES))))
        .withColumn("end", F.col("start") + F.length(F.trim("word", F.lit(_EDGES))))
    )
    taken = base.select(F.col("doc_id").alias("_d"), F.col("mark").alias("_m"), F.col("spans").alias("_base"))
    touches = F.exists("_base", lambda s: (s["start"] < F.col("end")) & (F.col("start") < s["end"]))
    return (
        placed.join(taken, same, "left")
        .where(~F.coalesce(touches, F.lit(False)))
        .select("doc_id", "mark", F.lit("term").alias("kind"), "start", "end", "disclosure")
    )


def _ordered(kind: Column, start: Column, end: Column, disclosure: Column) -> Column:
    place = F.array_position(F.array(*[F.lit(k) for k in (*KINDS, "term")]), kind)
    return F.struct(
        start.cast("long").alias("start"), place.alias("place"), end.cast("long").alias("end"), kind.alias("kind"), disclosure.alias("disclosure")
    )


def find(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, mark, spans`` of every row; ``spans`` is an array by start, then kind.

    A span has ``start, end, kind`` (one of ``KINDS``, or ``term``) and, for
    terms, ``disclosure``. A null or empty text has none; equal rows have equal
    spans; columns other than key and text are not looked at.
    """
    keyed = _keyed(docs, key, text)
    found = materialize(entities(keyed), "entities")
    grouped = [F.col("doc_id").alias("_d"), F.col("mark").alias("_m")]
    spans = _ordered(F.col("kind"), F.col("start"), F.col("end"), F.lit(None).cast("double"))
    base = materialize(found.groupBy("doc_id", "mark").agg(F.collect_list(spans).alias("spans")), "base")
    told = disclosing_terms(keyed, found)
    same = F.col("doc_id").eqNullSafe(F.col("_d")) & (F.col("mark") == F.col("_m"))
    out = keyed.select("doc_id", "mark").join(base.select(*grouped, F.col("spans").alias("_base")), same, "left").drop("_d", "_m")
    if told is None:
        out = out.withColumn("_added", F.array().cast(base.schema["spans"].dataType))
    else:
        terms = materialize(told[0], "disclosing")
        more = _term_spans(keyed, base, terms, told[1])
        span = _ordered(F.col("kind"), F.col("start"), F.col("end"), F.col("disclosure"))
        added = more.groupBy(*grouped).agg(F.collect_list(span).alias("_added"))
        out = out.join(added, same, "left").drop("_d", "_m")
    none = F.array().cast(base.schema["spans"].dataType)
    both = F.array_sort(F.concat(F.coalesce("_base", none), F.coalesce("_added", none)))
    return out.select("doc_id", "mark", both.alias("spans"))


def sanitised(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` with personal data replaced in the text.

    Base spans become ``[EMAIL]`` and so on, terms at ``REMOVE`` go, and terms
    below it become ``[TERM]``. Of overlapping spans the first stays. Null texts stay null.
    """
    spans = find(docs, key, text).dropDuplicates(["doc_id", "mark"]).select(F.col("doc_id").alias("_d"), F.col("mark").alias("_m"), F.explode("spans").alias("s"))
    row = Window.partitionBy("_d", "_m").orderBy("s.start", "s.place").rowsBetween(Window.unboundedPreceding, -1)
    label = F.when(F.col("s.kind") != "term", F.concat(F.lit("["), F.upper("s.kind"), F.lit("]"))).otherwise(
        F.when(F.col("s.disclosure") >= REMOVE, "").otherwise("[TERM]")
    )
    clear = spans.withColumn("_reach", F.max("s.end").over(row)).where(F.coalesce(F.col("_reach") <= F.col("s.start"), F.lit(True)))
    cuts = clear.groupBy("_d", "_m").agg(F.array_sort(F.collect_list(F.struct("s.start", "s.end", label.alias("label")))).alias("_cuts"))
    mark = F.xxhash64(F.coalesce(F.col(text), F.lit("")))
    joined = docs.withColumn("_mark", mark).join(cuts, F.col(key).eqNullSafe(F.col("_d")) & (F.col("_mark") == F.col("_m")), "left")

    def piece(cut: Column, i: Column) -> Column:
        last = F.coalesce(F.get("_cuts", i - 1)["end"], F.lit(0))
        return F.concat(F.substring(F.col(text), (last + 1).cast("int"), (cut["start"] - last).cast("int")), cut["label"])

    rest = F.substring(F.col(text), (F.element_at("_cuts", -1)["end"] + 1).cast("int"), F.length(text))
    clean = F.concat(F.array_join(F.transform("_cuts", piece), ""), rest)
    return joined.withColumn(text, F.when(F.col("_cuts").isNull(), F.col(text)).otherwise(clean)).select(*docs.columns)
