"""Queries of this subpackage and, where SQL can express them, the SQL they equal."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wakeline.llm import bpe, html, langid, line_dedup, merkle, oracles, packing, quality, simhash, whiten
from wakeline.llm.chat import rotate
from wakeline.llm.decontaminate import find_passages
from wakeline.llm.substring_dedup import remove_repeats
from wakeline.llm.url_rules import judge
from wakeline.llm.workers import importable

REGISTRY: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def _query(run: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    REGISTRY[run.__name__] = lambda spark, sf_dir: run(importable(spark), sf_dir)
    return run


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@_query
def op1_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html.extract(_table(spark, sf_dir, "pages")).select("page_id", "url", "text", "n_chars")


@_query
def op2_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = _table(spark, sf_dir, "documents")
    aside = langid.held_out(F.col("doc_id"))
    model = langid.fit(documents.filter(~aside))
    judged = langid.predict(documents.select("doc_id", "text", aside.alias("held_out")), model)
    return judged.select("doc_id", "held_out", "lang_pred", "score")


@_query
def op3_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.classes(_table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select("doc_id", F.lpad(F.lower(F.hex("bits")), 16, "0").alias("fingerprint"), "component_id")


@_query
def op4_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return find_passages(documents, _table(spark, sf_dir, "benchmark")).select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("item_ids").cast("long").alias("n_items"),
        F.sha2(F.array_join("item_ids", ","), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


@_query
def op5_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = quality.judge(_table(spark, sf_dir, "documents").select("doc_id", "text"), _table(spark, sf_dir, "labels"))
    return judged.drop("text", "n_grams", "toxic_ratio")


@_query
def op6_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = _table(spark, sf_dir, "documents").select("doc_id", "text")
    ranks = bpe.read_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken"))
    encoded = bpe.encode(documents, ranks, public_tokenizers.PATTERN)
    return encoded.select(
        "doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256")
    )


#: The rules of the query.
URL_RULES = (
    ("org", "/", "allow"),
    ("example.org", "/es/", "block"),
    ("example.org", "/en/1", "block"),
    ("com", "/fr/", "allow"),
    ("com", "/de/", "block"),
)


@_query
def op7_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = spark.createDataFrame(list(URL_RULES), "host string, path string, verdict string")
    pages = _table(spark, sf_dir, "pages").select("page_id", "url")
    return judge(pages, rules).select("page_id", "host", "path", "rule", "verdict")


@_query
def op8_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rotate(_table(spark, sf_dir, "conversations"))


@_query
def op9_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = line_dedup.remove_repeats(_table(spark, sf_dir, "documents").select("doc_id", "text"))
    return kept.select("doc_id", "n_lines", "n_removed", F.sha2(F.coalesce("kept_text", F.lit("")), 256).alias("kept_sha256"))


@_query
def op10_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return remove_repeats(documents).select("doc_id", "n_words", "n_removed", "kept_sha256")


@_query
def op11_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    embeddings = _table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    return whiten.whiten(embeddings, "embedding", ["vec_id"], scale=64, shift=1_000_000)


@_query
def op12_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = _table(spark, sf_dir, "documents")
    doc_id, text = F.col("doc_id"), F.col("text")
    rest = [F.col(c) for c in ("source", "lang", "n_chars")]
    broken = F.coalesce(F.crc32(doc_id.cast("string")) % 2 == 0, F.lit(False)) & F.coalesce(F.contains(text, F.lit("\n")), F.lit(False))
    changed = F.when(broken, merkle.leaf_of(doc_id, *rest, F.replace(text, F.lit("\n"), F.lit(""))))
    found = merkle.manifest(
        documents.withColumn("changed", changed), merkle.leaf_of(doc_id, *rest, text), "source", "doc_id", ["doc_id", "changed"]
    )
    folded = merkle.fold(F.coalesce("changed", "leaf"), F.col("path"))
    proof = F.sha2(merkle.proof_text(F.col("path")), 256)
    found = found.select("doc_id", "leaf", "subroot", "root", proof.alias("proof_sha256"), folded.alias("folded_root"))
    return found.withColumn("verified", F.col("folded_root") == F.col("root"))


@_query
def op13_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    with open(public_tokenizers.path("byte_bpe_50k.json"), encoding="utf-8") as file:
        vocabulary = file.read()
    documents = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return packing.pack(packing.pieces(documents, vocabulary, public_tokenizers.PATTERN))


ORACLES: dict[str, str] = {
    "op4_benchmark_decontamination": oracles.CONTAMINATION,
    "op7_url_filters": oracles.URL_FILTERS,
    "op8_chat_formatting": oracles.PERSPECTIVES,
    "op9_line_dedup": oracles.LINE_DEDUP,
    "op10_substring_dedup": oracles.SUBSTRING_DEDUP,
    "op12_merkle_manifest": oracles.MERKLE}
