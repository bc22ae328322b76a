"""The queries opN_* over the given tables, and SQL for those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from .chat_format import chat_format
from .decontamination import contamination
from .html_extraction import extract_pages
from .license_scan import license_report
from .line_dedup import line_report
from .quality_rules import quality
from .secret_scan import secret_report
from .simhash_dedup import simhash_components
from .source_mixing import label_domains, mixing_rates
from .toxicity import toxicity


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels")).select("doc_id", "held_out", "score", "predicted")


def op2_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract_pages(_table(spark, sf_dir, "pages"))


def op3_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_report(_table(spark, sf_dir, "documents"))


def op4_simhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash_components(_table(spark, sf_dir, "documents")).select("doc_id", "fingerprint", "component_id")


def op5_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contamination(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op6_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing_rates(_table(spark, sf_dir, "documents"), label_domains(_table(spark, sf_dir, "labels")))


def op7_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat_format(_table(spark, sf_dir, "conversations"))


def op8_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_report(_table(spark, sf_dir, "documents"))


def op9_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    trusted = _table(spark, sf_dir, "labels").where("quality = 1").select("doc_id")
    cols = ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "score"]
    return quality(_table(spark, sf_dir, "documents"), trusted).select(*cols)


def op10_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_report(_table(spark, sf_dir, "documents"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in (op1_toxicity, op2_html_extraction, op3_license_scan, op4_simhash_dedup, op5_decontamination, op6_source_mixing, op7_chat_format, op8_line_dedup, op9_quality_rules, op10_secret_scan)}


def oracle_sql() -> dict[str, str]:
    return {}
