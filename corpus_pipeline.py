"""Cleaning of a document corpus: stages that run one after the other.

Every stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame that is
written as Parquet and read again as the next stage's documents. All but the
last return the columns of ``documents``.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wakeline.llm import bpe, decontaminate, langid, line_dedup, simhash
from wakeline.llm.workers import importable
from wakeline.session import working_dir

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]

#: Least share of the best language for a document to stay.
LEAST_SCORE = 0.5


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a known language. Those without a letter or with an unsure language go; a
    missing ``lang`` is filled in."""
    importable(spark)
    model = langid.fit(docs.filter(~langid.held_out(F.col("doc_id"))))
    judged = langid.predict(docs, model)
    known = judged.filter((F.col("lang_pred") != langid.UNKNOWN) & (F.col("score") >= LEAST_SCORE))
    return known.withColumn("lang", F.coalesce("lang", "lang_pred")).select(*docs.columns)


def remove_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without repeated lines, a single line being a run; those of which nothing is
    left go."""
    kept = line_dedup.without_repeats(docs, min_lines=1)
    return kept.withColumn("n_chars", F.length("text").cast("long")).select(*docs.columns)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near copies: fingerprints of three-word shingles that differ in
    three bits at most, and what can be reached over these."""
    importable(spark)
    return simhash.one_of_each(docs)


def remove_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which no benchmark passage occurs."""
    importable(spark)
    return decontaminate.clean_of(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def tokenize(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document; each must decode to its text."""
    importable(spark)
    ranks = bpe.read_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken"))
    encoded = bpe.encode(docs, ranks, public_tokenizers.PATTERN)
    whole = F.col("decoded") == F.encode(F.coalesce("text", F.lit("")), "UTF-8")
    return encoded.select("doc_id", "lang", "source", "n_chars", "n_tokens", "ids", whole.alias("round_trip"))


STAGES: list[tuple[str, Stage]] = [
    ("language_id", language_id),
    ("line_dedup", remove_lines),
    ("simhash_near_dedup", near_dedup),
    ("benchmark_decontamination", remove_benchmark),
    ("byte_bpe", tokenize),
]

#: Language scores and fingerprints are not expressible in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    folder = working_dir(spark, "pipeline")
    for name, stage in STAGES:
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
    return docs
