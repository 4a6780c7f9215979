"""Corpus pipeline: five training-data operators, one after another, over the documents table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from castwright.llm import bpe, decontaminate, line_dedup, quality_gam, simhash
from castwright.llm.common import prepare, read
from castwright.session import materialize


def _keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier (operator 6) accepts."""
    prepare(spark)
    return quality_gam.keep_good(docs, read(spark, sf_dir, "labels", "doc_id", "quality"))


def _dedup_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents less the lines that many share (operator 5); ``n_chars`` follows the text."""
    prepare(spark)
    out = line_dedup.dedup_lines(docs)
    return out.withColumn("n_chars", F.length("text").cast("long")) if "n_chars" in out.columns else out


def _one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash near-duplicate group (operator 1)."""
    prepare(spark)
    return simhash.drop_near_duplicates(docs)


def _decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that no benchmark item leaks into (operator 8)."""
    prepare(spark)
    return decontaminate.decontaminate(docs, read(spark, sf_dir, "benchmark", "item_id", "text"))


def _encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of each text and the bytes that they decode to (operator 10)."""
    prepare(spark)
    return bpe.encode(docs)


STAGES = [
    ("quality_classifier", _keep_good),
    ("line_dedup", _dedup_lines),
    ("simhash_near_dedup", _one_of_each_group),
    ("benchmark_decontamination", _decontaminate),
    ("byte_level_bpe", _encode),
]

#: SQL cannot express the classifier, the fingerprints, the tiling or the merges.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents table, each written to the shared folder and read again."""
    prepare(spark)
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
