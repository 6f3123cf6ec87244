"""Registered queries of this subpackage and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from featurelake.llm import (
    byte_bpe, cover_tree, decontaminate, divergence, oracle, ordinal, pieces, pii, secrets, sharding, shingle_join, toxicity, vector_codes,
    wrappers,
)
from featurelake.llm.common import table


def op1_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return wrappers.main_text(table(spark, sf_dir, "pages"))


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")).select(
        "doc_id", "held_out", "score", "predicted", "evidence", "similarity")


def op3_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pieces.encode(table(spark, sf_dir, "documents")).select(
        "doc_id", "ids", F.size("ids").cast("long").alias("n_tokens"), "score", "round_trip")


def op4_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shingle_join.jaccard_components(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_shingles", "component_id")


def op5_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.scan(table(spark, sf_dir, "documents")).drop("th")


def op6_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")).drop("th")


def op7_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cover_tree.near_duplicates(table(spark, sf_dir, "embeddings"))


def op8_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.digest(pii.personal_data(table(spark, sf_dir, "documents")))


def op9_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard_documents(table(spark, sf_dir, "documents"))


def op10_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ordinal.quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")).drop("th")


def op11_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vector_codes.compressed(table(spark, sf_dir, "embeddings")).select(
        "vec_id", vector_codes.code_text("codes").alias("code"), "error", "label_error", "codebooks_sha256")


def op12_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.divergence(table(spark, sf_dir, "documents"))


def op13_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = byte_bpe.decode(byte_bpe.encode(table(spark, sf_dir, "documents")))
    return rows.select("doc_id", F.size("ids").cast("long").alias("n_tokens"),
                       F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
                       F.sha2("decoded", 256).alias("decoded_sha256"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_html_extraction": op1_html_extraction,
    "op2_toxicity": op2_toxicity,
    "op3_sentencepiece": op3_sentencepiece,
    "op4_ngram_jaccard": op4_ngram_jaccard,
    "op5_secrets": op5_secrets,
    "op6_decontamination": op6_decontamination,
    "op7_embedding_near_dedup": op7_embedding_near_dedup,
    "op8_pii": op8_pii,
    "op9_sharding": op9_sharding,
    "op10_quality": op10_quality,
    "op11_vector_codes": op11_vector_codes,
    "op12_source_divergence": op12_source_divergence,
    "op13_byte_bpe": op13_byte_bpe,
}

ORACLE: dict[str, str] = {
    "op4_ngram_jaccard": oracle.JACCARD,
    "op6_decontamination": oracle.CONTAMINATION,
    "op11_vector_codes": oracle.VECTOR_CODES,
    "op12_source_divergence": oracle.DIVERGENCE,
}
