"""The llm queries: each operator over its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import chat, decontam, fingerprint, linededup, packing, quality, secrets, simhash, substring, suffixarray
from ._shared import documents


def op1_pack(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(documents(spark, sf_dir))


def op2_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = chat.with_attack(spark, spark.read.parquet(f"{sf_dir}/conversations.parquet"))
    return chat.read_back(chat.format_conversations(turns))


def op4_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return linededup.digest(documents(spark, sf_dir))


def op3_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.scan_secrets(documents(spark, sf_dir))


def op5_document_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprint.fingerprint_documents(documents(spark, sf_dir))


def op6_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring.dedup_words(documents(spark, sf_dir), with_text=False).drop("kept")


def op7_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffixarray.dedup_bytes(documents(spark, sf_dir), with_text=False).drop("kept")


def op8_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(documents(spark, sf_dir))


def op9_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.report(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def op10_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.classify(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in (op1_pack, op2_chat_format, op3_secret_scan, op4_line_dedup, op5_document_fingerprints, op6_substring_dedup, op7_suffix_array_dedup, op8_simhash_near_dedup, op9_decontaminate, op10_quality_classifier)}


def oracle_sql() -> dict[str, str]:
    return {"op4_line_dedup": linededup.ORACLE, "op6_substring_dedup": substring.ORACLE, "op7_suffix_array_dedup": suffixarray.ORACLE, "op9_decontaminate": decontam.ORACLE}
