"""From raw documents to token ids: five stages, each a text operator over all rows of the one before."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from basketlens.llm import bpe, langid, mixing, neardup, secrets
from basketlens.llm.frames import documents
from basketlens.session import apply_settings, materialize
from checks.registry import query

# A document stays when the best language has at least this share of the score.
MIN_LANGUAGE_SCORE = 0.5


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is identified, by a model of their own labels."""
    apply_settings(spark)
    return langid.accepted(docs, langid.fit(docs), MIN_LANGUAGE_SCORE)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of every group of near duplicates; documents without words or id stay."""
    apply_settings(spark)
    return neardup.first_of_groups(docs)


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with secrets in their texts replaced and ``n_chars`` counted again."""
    apply_settings(spark)
    clean = secrets.without_secrets(docs)
    if "n_chars" in docs.columns:
        clean = clean.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return clean


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of sources takes them."""
    apply_settings(spark)
    return mixing.mixed(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """``doc_id, n_tokens, ids``: the token ids of every row."""
    apply_settings(spark)
    ranks, tokenizer = public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.path("byte_bpe_50k.json")
    return bpe.encode(docs, ranks, tokenizer).select("doc_id", "n_tokens", "ids")


STAGES = [
    ("language", language),
    ("near_duplicates", near_duplicates),
    ("secrets", secret_scan),
    ("mixing", mix),
    ("bpe", encode),
]

# The fitted model and the exponential rates have no SQL form; tests compare each stage with brute force.
ORACLE_SQL = None


@query("pipeline")
def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; every stage but the last is written and read again."""
    docs = documents(spark, sf_dir)
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
