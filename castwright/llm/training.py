"""Bounded labelled samples for the classifiers."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from castwright.llm.common import crc_mod


def clean_labels(labels: DataFrame, label: str, mod: int, held_out: int) -> DataFrame:
    """doc_id, label, fold: one label of each document that is not held out."""
    clean = labels.select("doc_id", F.col(label).cast("int").alias("label")).where("doc_id IS NOT NULL AND label IN (0, 1)")
    clean = clean.groupBy("doc_id").agg(F.max("label").alias("label")).withColumn("fold", crc_mod(F.col("doc_id"), mod))
    return clean.where(F.col("fold") != held_out)


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, per_class: int, mod: int, held_out: int) -> DataFrame:
    """doc_id, label, fold and text of at most ``per_class`` rows of each class, for training.

    Only rows whose crc32(doc_id) mod ``mod`` is not ``held_out`` are taken, those with the smallest
    hashes of doc_id (a top-k: no task sorts a whole class). Labels other than 0 and 1 and rows
    without an id are left out; repeated labels of a document count once, the larger one.
    """
    clean = clean_labels(labels, label, mod, held_out)
    picks = None
    for value in (0, 1):
        some = clean.where(F.col("label") == value).orderBy(F.xxhash64("doc_id"), "doc_id").limit(per_class)
        picks = some if picks is None else picks.unionByName(some)
    return docs.select("doc_id", "text").join(F.broadcast(picks), "doc_id")


def label_odds(labels: DataFrame, label: str, mod: int, held_out: int) -> float:
    """Natural odds of class 1 over the labels that training may see, those of ``labelled_sample``
    before its limit (1 where a class is missing)."""
    clean = clean_labels(labels, label, mod, held_out)
    n = clean.agg(*[F.count(F.when(F.col("label") == v, 1)) for v in (0, 1)]).first()
    return n[1] / n[0] if n[0] and n[1] else 1.0


def one_per_document(features: DataFrame, *by: str) -> DataFrame:
    """One row (doc_id, *by, x) for each document of a sample, the smallest features where rows repeat an
    id, so that what reaches the driver stays bounded however often an id is repeated."""
    return features.groupBy("doc_id", *by).agg(F.min("x").alias("x"))
