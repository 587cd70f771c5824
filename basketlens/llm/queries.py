"""The registered queries of the text operators, over whole tables."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from basketlens.llm import bpe, dialogue, importance, langid, lines, mixing, neardup, pii, quality, repeats, secrets, sharding, sketches
from basketlens.llm import sql as oracles
from basketlens.llm.frames import documents
from basketlens.session import materialize
from checks.registry import query

RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")


@query("op1_quality_rules", oracles.QUALITY)
def quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    judged = quality.judge(quality.document_features(documents(spark, folder)))
    counts = [name.split()[0] for name in quality.FEATURES.split(", ")]
    return judged.select("doc_id", *counts, "base_failed", "kept")


def _listed(spans: Column) -> Column:
    """``kind:start:end`` of (start, kind, end) structures, comma-joined."""
    return F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ","
    )


def _number_of(spans: Column, kind: str) -> Column:
    return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("long")


@query("op5_secret_scan")
def secret_scan(spark: SparkSession, folder: str) -> DataFrame:
    found = secrets.scan(documents(spark, folder))
    spans = F.zip_with(
        F.arrays_zip("kinds", "starts"), "ends", lambda a, e: F.struct(a["kinds"].alias("kind"), a["starts"].alias("start"), e.alias("end"))
    )
    base = F.filter("spans", lambda s: s["kind"] != "guess")
    return found.withColumn("spans", spans).select(
        "doc_id",
        *[_number_of(F.col("spans"), kind).alias(f"n_{kind}") for kind in ("assign", "access", "hex")],
        F.sha2(_listed(base), 256).alias("base_sha256"),
        _listed(F.col("spans")).alias("spans"),
    )


@query("op7_bpe_round_trip")
def bpe_round_trip(spark: SparkSession, folder: str) -> DataFrame:
    encoded = bpe.encode(documents(spark, folder), RANKS, TOKENIZER)
    return bpe.decode(encoded, RANKS, TOKENIZER).select(
        "doc_id",
        "n_tokens",
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def _held_out() -> Column:
    return F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(4)) == 2


@query("op8_language")
def language(spark: SparkSession, folder: str) -> DataFrame:
    docs = documents(spark, folder)
    model = langid.fit(docs.where(~F.coalesce(_held_out(), F.lit(False))))
    return langid.identify(docs, model).withColumn("held_out", F.coalesce(_held_out(), F.lit(False)))


@query("op2_personal_data")
def personal_data(spark: SparkSession, folder: str) -> DataFrame:
    found = pii.find(documents(spark, folder))
    base = F.filter("spans", lambda s: s["kind"] != "term")
    return found.select(
        "doc_id",
        *[_number_of(F.col("spans"), kind).alias(f"n_{kind}") for kind in pii.KINDS],
        F.sha2(_listed(base), 256).alias("base_sha256"),
        _listed(F.col("spans")).alias("spans"),
    )


@query("op3_repeated_strings", oracles.REPEATS)
def repeated_strings(spark: SparkSession, folder: str) -> DataFrame:
    cut = repeats.without_repeats(documents(spark, folder))
    return cut.select(
        "doc_id",
        "n_bytes",
        F.aggregate("lengths", F.lit(0).cast("long"), lambda total, n: total + n).alias("n_removed"),
        F.size("lengths").cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )


@query("op4_shards")
def shards(spark: SparkSession, folder: str) -> DataFrame:
    placed = sharding.shards_by_bytes(documents(spark, folder))
    return placed.select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard")
    )


@query("op6_mix")
def mix(spark: SparkSession, folder: str) -> DataFrame:
    rows = materialize(mixing.sizes(documents(spark, folder)), "sizes")
    return mixing.copies(rows).select(
        "doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"), "source", "copies"
    )


@query("op9_fingerprints")
def fingerprints(spark: SparkSession, folder: str) -> DataFrame:
    pairs = sketches.edited_pairs(documents(spark, folder))
    sketch, edited, following = F.col("sketch"), F.col("edited_sketch"), F.col("next_sketch")
    return pairs.select(
        "doc_id",
        "n_chars",
        F.sha2("edited", 256).alias("edited_sha256"),
        sketches.as_text(sketch).alias("fingerprint"),
        sketches.as_text(edited).alias("edited_fingerprint"),
        sketches.resemblance(sketch, edited).alias("near_edited"),
        sketches.resemblance(sketch, following).alias("near_next"),
    )


@query("op10_near_duplicates", oracles.NEAR)
def near_duplicates(spark: SparkSession, folder: str) -> DataFrame:
    return neardup.groups(documents(spark, folder))


@query("op11_conversation_repair")
def conversation_repair(spark: SparkSession, folder: str) -> DataFrame:
    rows = spark.read.parquet(f"{folder}/conversations.parquet")
    return dialogue.reports(rows, dialogue.damaged(rows))


@query("op12_importance_resampling", oracles.IMPORTANCE)
def importance_resampling(spark: SparkSession, folder: str) -> DataFrame:
    return importance.resampled(documents(spark, folder), spark.read.parquet(f"{folder}/benchmark.parquet"))


@query("op13_line_dedup", oracles.LINES)
def line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    cut = lines.without_common_lines(documents(spark, folder))
    return cut.select("doc_id", "n_lines", "n_dropped", F.sha2("kept", 256).alias("kept_sha256"))
