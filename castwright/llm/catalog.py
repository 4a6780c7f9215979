"""Registered queries of the training-data operators, each over its whole table."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from castwright.llm import bpe, decontaminate, importance, license_scan, line_dedup, quality_gam, quality_rules, secret_scan, simhash, toxicity, url_filter, vector_codes, warc
from castwright.llm.common import crc_mod, prepare, read
from castwright.llm.oracle import ORACLE_SQL  # noqa: F401
from castwright.session import ensure_checkpoint_dir


def op1_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SimHash near-duplicate groups of all documents."""
    prepare(spark)
    return simhash.near_duplicates(read(spark, sf_dir, "documents", "doc_id", "text"))


def op2_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Host, path, rule and verdict of every page url."""
    prepare(spark)
    judged = url_filter.judge(read(spark, sf_dir, "pages", "page_id", "url"))
    return judged.select("page_id", "host", "path", "rule", "verdict", "block_odds")


def op3_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base counts, tokeniser fertility and the verdict on every document."""
    prepare(spark)
    judged = quality_rules.judge(read(spark, sf_dir, "documents", "doc_id", "text", "lang"))
    base = ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"]
    return judged.select(*base, *quality_rules.MEASURES, F.array_join("reasons", ",").alias("reasons"))


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity scores of all documents."""
    prepare(spark)
    docs = read(spark, sf_dir, "documents", "doc_id", "text")
    model = toxicity.fit(docs, read(spark, sf_dir, "labels", "doc_id", "toxic"))
    held_out = (crc_mod(F.col("doc_id"), toxicity.MOD) == toxicity.HELD_OUT).alias("held_out")
    return toxicity.score(docs, model).select("doc_id", held_out, "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def op5_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line counts and the hash of what stays of every document."""
    prepare(spark)
    docs = read(spark, sf_dir, "documents", "doc_id", "text")
    out = line_dedup.dedup_lines(docs, counts=("n_lines", "n_dropped"))
    return out.select("doc_id", "n_lines", "n_dropped", F.sha2(F.col("text").cast("binary"), 256).alias("kept_sha256"))


def op6_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality scores of all documents."""
    prepare(spark)
    docs = read(spark, sf_dir, "documents", "doc_id", "text")
    model = quality_gam.fit(docs, read(spark, sf_dir, "labels", "doc_id", "quality"))
    held_out = (crc_mod(F.col("doc_id"), quality_gam.MOD) == quality_gam.HELD_OUT).alias("held_out")
    return quality_gam.score(docs, model).select("doc_id", held_out, "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def op7_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Licence phrases and labels of every document."""
    prepare(spark)
    found = license_scan.scan(read(spark, sf_dir, "documents", "doc_id", "text"))
    base, more = F.col("places.label"), F.col("matches.label")
    return found.select(
        "doc_id", "n_words", F.size("places").cast("long").alias("n_base"), F.array_min("places.start").alias("first_word"), F.array_max("places.start").alias("last_word"),
        F.array_join(F.array_sort(F.array_distinct(base)), ",").alias("base_labels"), F.array_join(F.array_sort(F.array_union(base, more)), ",").alias("labels"),
        F.coalesce(F.array_max("matches.share"), F.lit(0.0)).alias("score"),
    )


def op8_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents that a benchmark item leaks into, with the item and its tiles."""
    prepare(spark)
    return decontaminate.leaks(read(spark, sf_dir, "documents", "doc_id", "text"), read(spark, sf_dir, "benchmark", "item_id", "text"))


def op9_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secret spans of every document."""
    prepare(spark)
    found = secret_scan.scan(read(spark, sf_dir, "documents", "doc_id", "text"))
    def written(spans: Column) -> Column:
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")

    def count(kind: str) -> Column:
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    base = F.sha2(written(F.filter("spans", lambda s: s["base"])).cast("binary"), 256).alias("base_sha256")
    return found.select("doc_id", *map(count, secret_scan.KINDS[:3]), base, written(F.col("spans")).alias("spans"))


def op10_byte_level_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token count and digests of the ids and of the bytes decoded from them, of every document."""
    prepare(spark)
    made = bpe.encode(read(spark, sf_dir, "documents", "doc_id", "text"))
    ids = F.array_join(F.col("ids").cast("array<string>"), ",")
    return made.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), F.sha2(ids.cast("binary"), 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


def op11_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Features, weight, score and rank in the draw of every document."""
    prepare(spark)
    ranked = importance.rank(read(spark, sf_dir, "documents", "doc_id", "text"), read(spark, sf_dir, "benchmark", "text"))
    return ranked.select("doc_id", "n_features", "weight", "score", "rank")


def op12_warc_archives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page's record, read back from the archives written of the whole table."""
    prepare(spark)
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/warc-{uuid.uuid4().hex}"
    back = warc.archive_and_read(read(spark, sf_dir, "pages", "page_id", "url", "html"), path, payload=False)
    return back.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op13_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Product code and errors of every vector, with the digest of the codebooks."""
    prepare(spark)
    coded, books = vector_codes.compress(read(spark, sf_dir, "embeddings", "vec_id", "embedding", "label"))
    digest = F.lit(vector_codes.books_digest(books)).alias("codebooks_sha256")
    return coded.select("vec_id", F.lower(F.hex("code")).alias("code"), "error", "label_error", digest)


QUERIES = {
    f.__name__: f
    for f in (
        op1_simhash_near_dedup, op2_url_filter, op3_quality_rules, op4_toxicity, op5_line_dedup,
        op6_quality_classifier, op7_license_scan, op8_benchmark_decontamination, op9_secret_scan, op10_byte_level_bpe,
        op11_importance_resampling, op12_warc_archives, op13_vector_codes,
    )
}
