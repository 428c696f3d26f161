"""The registered queries of the operators, with SQL where it can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from icdspark.llm import (
    conversation_repair,
    decontaminate,
    html_extract,
    license_scan,
    line_dedup,
    quality_classifier,
    quality_rules,
    secret_scan,
    sentencepiece_codec,
    simhash_dedup,
    source_mix,
    sql,
    token_counts,
    vector_codes,
)
from icdspark.llm.common import read_table

PIECE_MODEL = "piece_bpe_32k.model"


def piece_model() -> str:
    import public_tokenizers

    return public_tokenizers.path(PIECE_MODEL)


def op1_simhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash_dedup.near_duplicates(read_table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lpad(F.lower(F.hex("f")), 16, "0").alias("fingerprint"), "component_id")


def op2_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Best segmentation (ids), scores of the four best, and whether decoding gives the text back."""
    return sentencepiece_codec.encode(read_table(spark, sf_dir, "documents"), piece_model())


def op3_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.scan_licenses(read_table(spark, sf_dir, "documents"))


def op4_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    weights = quality_classifier.train(docs, read_table(spark, sf_dir, "labels"))
    return quality_classifier.classify(docs, weights)


def op5_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pairs of document and benchmark item that it holds, with the edit distance."""
    return decontaminate.find_leaks(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))


def op6_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.count_tokens(read_table(spark, sf_dir, "documents"), piece_model())


def op7_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's text without later repeated passages, and how many words went."""
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    return line_dedup.dedup_lines(docs, removed_col="n_removed")


def op8_html_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_extract.extract(read_table(spark, sf_dir, "pages"))


def op9_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secret_scan.scan_secrets(read_table(spark, sf_dir, "documents"))
    count = lambda kind: F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    return found.select(
        "doc_id", *(count(k) for k in secret_scan.BASE_KINDS), "base_sha256", F.col("joined").alias("spans"))


def op10_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.quality_report(read_table(spark, sf_dir, "documents"))


def op11_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vector_codes.report(read_table(spark, sf_dir, "embeddings"))


def op12_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return source_mix.report(read_table(spark, sf_dir, "documents"))


def op13_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversation_repair.report(read_table(spark, sf_dir, "conversations"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    operators = (
        op1_simhash_dedup, op2_sentencepiece, op3_license_scan, op4_quality_classifier, op5_decontaminate,
        op6_token_counts, op7_line_dedup, op8_html_extract, op9_secret_scan, op10_quality_rules,
        op11_vector_codes, op12_source_mix, op13_conversation_repair,
    )
    return {f.__name__: f for f in operators}


def oracle_sql() -> dict[str, str]:
    return {
        "op10_quality_rules": sql.QUALITY_RULES,
        "op11_vector_codes": sql.vector_codes(vector_codes.PARTS, vector_codes.ENTRIES, vector_codes.ROUNDS, vector_codes.SCALE),
        "op12_source_mix": sql.SOURCE_MIX,
    }
