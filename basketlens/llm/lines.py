"""Removal of lines that many documents share, over levelled sorted runs of line hashes.

A batch of documents becomes one run: every line key found in it with the number of its
documents, bucketed and sorted by a 128-bit hash, so that runs meet in merge joins without
an exchange. A new run first leaves out, by merge anti-joins, the keys that an older run has
already counted often enough; two runs of one level are merged into a run of the next.
"""

from __future__ import annotations

import uuid
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from basketlens.llm.frames import SPACES, ascii_lower
from basketlens.session import materialize

MIN_DOCUMENTS = 10  # a key found in so many documents is common
MIN_CHARS = 1  # shorter keys, such as those of blank lines, are never common
BATCHES = 4  # runs that a whole table is read into
HOT_KEYS = 20_000  # at most so many keys are sent to every task; no other has more than BATCHES / HOT_KEYS of all places

_KEY = ["h", "g"]
_ASCII_BELOW = "\u212a\u0130"  # fixed: characters beyond ASCII whose lower case has ASCII letters


def _lines(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n")


def line_keys(text: Column, min_chars: int) -> Column:
    """For every line of a text what stands for its key, in order; empty for keys under ``min_chars``.

    The key is the line without white space at its ends and with A-Z lower-cased. Two lines have one key
    exactly if they are equal in full lower case and in their characters beyond ASCII; that pair takes a
    fraction of the time of replacing letter by letter. Two characters have lower cases within ASCII,
    so lines with them are replaced letter by letter.
    """

    def stripped(line: Column) -> Column:
        margin = reduce(or_, [F.startswith(line, F.lit(c)) | F.endswith(line, F.lit(c)) for c in SPACES])
        return F.when(margin, F.trim(line, F.lit(SPACES))).otherwise(line)

    def key(line: Column) -> Column:
        odd = reduce(or_, [F.contains(line, F.lit(c)) for c in _ASCII_BELOW])
        return (
            F.when(F.length(line) < min_chars, "")
            .when(F.octet_length(line) == F.length(line), F.lower(line))
            .when(odd, ascii_lower(line))
            .otherwise(F.concat(F.lower(line), F.lit("\n"), F.regexp_replace(line, "[\\x00-\\x7F]+", "")))
        )

    return F.transform(F.transform(_lines(text), stripped), key)


def _hashes(key: Column) -> list[Column]:
    """Two 64-bit hashes of a key; equal pairs count as equal keys."""
    return [F.xxhash64(key).alias("h"), F.xxhash64(F.lit(1), key).alias("g")]


class LineRuns:
    """The runs of a corpus that grows by batches; dropped with ``close``.

    Runs are managed tables, in the warehouse folder that all executors share.
    """

    def __init__(self, spark: SparkSession, min_documents: int = MIN_DOCUMENTS, min_chars: int = MIN_CHARS):
        self.spark, self.min_documents, self.min_chars = spark, min_documents, min_chars
        self.buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
        self.tables: list[str] = []
        self.levels: list[tuple[int, DataFrame]] = []  # level and run, oldest first

    def counted(self, docs: DataFrame, batch: Column) -> DataFrame:
        """``batch, h, g, n``: the documents of each key and batch, one pass over the texts, stored as sorted runs.

        A row is a document: repeated rows count apart, a key once for each.
        """
        keys = F.filter(line_keys(F.col("text"), self.min_chars), lambda key: key != "")
        found = docs.select(batch.alias("batch"), F.array_distinct(keys).alias("keys"))  # once a text, not once a line
        counts = found.select("batch", F.explode("keys").alias("key")).select("batch", *_hashes(F.col("key"))).groupBy("batch", *_KEY).agg(F.count(F.lit(1)).alias("n"))
        return self._stored(counts.repartition(self.buckets, *_KEY), "batch")

    def add(self, run: DataFrame) -> None:
        """Add the run of one batch; keys that are common already are left out of it."""
        if self.levels:
            for _, older in self.levels:
                run = run.join(self._common(older).hint("merge"), _KEY, "left_anti")
            run = self._stored(run)
        self.levels.append((0, run))
        while len(self.levels) > 1 and self.levels[-1][0] == self.levels[-2][0]:
            self._compact()

    def common(self) -> DataFrame:
        """``h, g`` of the keys found in ``min_documents`` documents of all batches or more."""
        while len(self.levels) > 1:
            self._compact()
        return self._common(self.levels[0][1])

    def close(self) -> None:
        """Drop the runs; what reads them must have been written before."""
        for name in self.tables:
            self.spark.sql(f"DROP TABLE IF EXISTS {name}")
        self.tables, self.levels = [], []

    def _common(self, run: DataFrame) -> DataFrame:
        return run.where(F.col("n") >= self.min_documents).select(*_KEY)

    def _compact(self) -> None:
        """Merge the two newest runs into one of the next level."""
        (low, new), (high, old) = self.levels.pop(), self.levels.pop()
        merged = old.withColumnRenamed("n", "_n").hint("merge").join(new, _KEY, "full_outer")
        n = F.coalesce("_n", F.lit(0)) + F.coalesce("n", F.lit(0))
        self.levels.append((max(low, high) + 1, self._stored(merged.select(*_KEY, n.alias("n")))))

    def _stored(self, run: DataFrame, *parts: str) -> DataFrame:
        name = f"line_run_{uuid.uuid4().hex}"
        self.tables.append(name)
        run.write.partitionBy(*parts).bucketBy(self.buckets, *_KEY).sortBy(*_KEY).saveAsTable(name)
        return self.spark.table(name)


def without_common_lines(
    docs: DataFrame, min_documents: int = MIN_DOCUMENTS, min_chars: int = MIN_CHARS, batches: int = BATCHES
) -> DataFrame:
    """``doc_id, n_lines, n_dropped, kept``: every row of ``docs``, its text without the common lines.

    A text is cut at ``\n``; null and empty texts are one empty line. A common key loses all its
    lines, the first included; the others stay as they are, joined by ``\n``. Repeated rows are
    documents of their own, and so are rows without ``doc_id``. An empty table gives no rows.

    Places of lines travel as hashes. The most frequent keys, at most ``HOT_KEYS``, are known to
    every task, and their places are spread by document; the others meet the common keys in a
    merge join. Dropped places go to their document, and texts move once.
    """
    docs = docs.select("doc_id", "text")
    runs = LineRuns(docs.sparkSession, min_documents, min_chars)
    batch = F.pmod(F.xxhash64("doc_id", "text"), F.lit(batches)).cast("int")
    counts = runs.counted(docs, batch)
    for number in range(batches):
        runs.add(counts.where(F.col("batch") == number).drop("batch"))
    common = runs.common()
    total = counts.agg(F.sum("n")).first()[0] or 0
    often = counts.where(F.col("n") * HOT_KEYS >= total).select(*_KEY)
    hot = common.join(often.hint("merge"), _KEY, "left_semi").select(*_KEY, F.lit(True).alias("hot"))

    identity = [F.xxhash64("doc_id", "text").alias("a"), F.xxhash64(F.lit(1), "doc_id", "text").alias("b")]
    keys = line_keys(F.col("text"), min_chars)
    places = (
        docs.select(*identity, keys.alias("keys"))  # once a text, not once a line
        .select("a", "b", F.posexplode("keys").alias("place", "key"))
        .where("key <> ''")
        .select("a", "b", "place", *_hashes(F.col("key")))
        .join(F.broadcast(hot), _KEY, "left")
        .select("a", "b", "place", "hot", *[F.when(F.col("hot"), F.col(x)).otherwise(F.col(y)).alias(y) for x, y in zip("ab", _KEY)])
    )
    met = places.join(common.withColumn("met", F.lit(True)).hint("merge"), _KEY, "left").where("hot OR met")
    dropped = materialize(met.groupBy("a", "b").agg(F.collect_set("place").alias("dropped")), "dropped")
    runs.close()

    rows = docs.select("*", *identity).join(dropped, ["a", "b"], "left")
    # the explode keeps the optimizer from cutting the text again for each line
    rows = rows.select("doc_id", "text", "dropped", F.explode(F.array(_lines(F.col("text")))).alias("lines"))
    stay = F.array_except(F.sequence(F.lit(0), F.size("lines") - 1), "dropped")
    kept = F.array_join(F.transform(stay, lambda place: F.get(F.col("lines"), place)), "\n")
    return rows.select(
        "doc_id",
        F.size("lines").cast("long").alias("n_lines"),
        F.coalesce(F.size("dropped"), F.lit(0)).cast("long").alias("n_dropped"),
        F.when(F.col("dropped").isNull(), F.coalesce("text", F.lit(""))).otherwise(kept).alias("kept"),
    )
