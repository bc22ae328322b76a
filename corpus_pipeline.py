"""From raw documents to a training mix: each stage calls one operator of `spindrift.llm`.

Every stage takes (spark, docs, sf_dir) and works on all rows of docs; its result is written as Parquet
and read again as the next stage's docs. All but the last return the columns of `documents`; the last
adds `rate`, how often a document is to be drawn.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from spindrift.llm import decontamination, line_dedup, quality_rules, simhash_dedup, source_mixing
from spindrift.llm.common import cut


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules reject go."""
    return quality_rules.quality_filter(docs, _table(spark, sf_dir, "labels").where("quality = 1").select("doc_id"))


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that repeat an earlier line go; n_chars follows the text."""
    return line_dedup.line_dedup(docs).withColumn("n_chars", F.length("text").cast("long"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group stays."""
    return simhash_dedup.simhash_dedup(docs)


def benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark passage go."""
    return decontamination.decontaminate(docs, _table(spark, sf_dir, "benchmark"))


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents get the rate that brings the domains to their target weights; those at rate 0 go."""
    return source_mixing.mix(docs, source_mixing.label_domains(_table(spark, sf_dir, "labels")))


STAGES = [("quality", quality), ("lines", lines), ("near_duplicates", near_duplicates), ("benchmark", benchmark), ("mixing", mixing)]

#: Hashed models, similarity joins and fitted rates are beyond SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, from the table of documents."""
    docs = _table(spark, sf_dir, "documents")
    for i, (_, stage) in enumerate(STAGES, 1):
        docs = stage(spark, docs, sf_dir)
        if i < len(STAGES):
            docs = cut(docs)
    return docs
