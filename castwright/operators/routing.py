"""The fetch stage over a table of jobs.

Priority (fixed by the source behaviour): an uploaded file, else given text (``youtube`` when
the URL is a video URL, else ``text``), else a video URL without text is an error, else the
URL is an article page. The page download is replaced by an equi-join with a ``pages`` table
keyed by URL. Inline payloads are dropped from the output (R14) and the source artefact key and
character count are added (K1, R13).

Plan: three branches by source. Article rows (ids and URL only) join the texts of the pages they ask
for, each URL extracted once; file and text rows are projections of their own row, payload dropped on
the spot; PDF rows alone join page texts. The branches are unioned.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from castwright.functions.encoding import strict_unbase64
from castwright.functions.urls import SCHEME_ERROR, is_video_url, scheme_ok
from castwright.operators.events import resolved_bucket
from castwright.session import materialize
from castwright.sources.files import E_FETCH_BAD_B64, doc_type, doc_type_error, document_parts, finish_documents
from castwright.sources.pages import extract_articles

E_VIDEO_NO_TEXT = (
    "YouTube source_url requires caller-provided transcript text "
    "(`source_text` / `transcript_text`). AWS-side YouTube transcript fetch is disabled."
)
DEFAULT_FILE_NAME = "uploaded-document"


def route(df: DataFrame | None = None) -> Column:
    """R3 routing decision: file / youtube / text / video_without_text / article."""
    url = F.col("source_url")
    video = url.isNotNull() & is_video_url(url)
    return (
        F.when(F.col("source_file_base64").isNotNull(), F.lit("file"))
        .when(F.col("source_text").isNotNull(), F.when(video, F.lit("youtube")).otherwise(F.lit("text")))
        .when(video, F.lit("video_without_text"))
        .otherwise(F.lit("article"))
    )


def route_type(df: DataFrame | None = None) -> Column:
    """The source type known before extraction (a file's type comes from its name)."""
    r = route()
    name = F.coalesce(F.col("source_file_name"), F.lit(DEFAULT_FILE_NAME))
    return F.when(r == "file", doc_type(name)).when(r == "video_without_text", F.lit(None)).otherwise(r)


def route_error(df: DataFrame | None = None) -> Column:
    r = route()
    name = F.coalesce(F.col("source_file_name"), F.lit(DEFAULT_FILE_NAME))
    return (
        F.when((r == "file") & strict_unbase64("source_file_base64").isNull(), F.lit(E_FETCH_BAD_B64))
        .when(r == "file", doc_type_error(name))
        .when(r == "video_without_text", F.lit(E_VIDEO_NO_TEXT))
        .when((r == "article") & ~scheme_ok("source_url"), F.lit(SCHEME_ERROR))
    )


def one_page_per_url(pages: DataFrame, wanted: DataFrame | None = None) -> DataFrame:
    """(page_url, html) with one crawl of each URL (of those in ``wanted``): that of the largest ``page_id``,
    then the largest html; by html alone where the table has no ids.

    URLs and ids are narrowed down first; the pages themselves meet the chosen ids once. Texts are compared
    only if some URL and id are repeated, which chooses the plan, not the result."""
    named = pages.select(F.col("url").alias("page_url"), "html", *(["page_id"] if "page_id" in pages.columns else []))
    if "page_id" not in named.columns:
        needed = named if wanted is None else named.join(wanted, "page_url", "left_semi")
        return needed.groupBy("page_url").agg(F.max("html").alias("html"))
    ids = named.select("page_url", "page_id")
    ids = ids if wanted is None else ids.join(wanted, "page_url", "left_semi")
    counted = ids.groupBy("page_url", "page_id").agg(F.count(F.lit(1)).alias("n"))
    last = materialize(counted.groupBy("page_url").agg(F.max(F.struct("page_id", "n")).alias("last")).select("page_url", "last.*"), "page-ids")
    met = named.join(last, (named["page_url"] == last["page_url"]) & named["page_id"].eqNullSafe(last["page_id"]), "left_semi")
    repeated = (last.agg(F.max("n")).first()[0] or 0) > 1
    return met.groupBy("page_url").agg(F.max("html").alias("html")) if repeated else met.select("page_url", "html")


def fetch_sources(jobs: DataFrame, pages: DataFrame | None = None, page_texts: DataFrame | None = None,
                  default_bucket: str = "podcast-artifacts", mode: str = "nested", key: str = "job_id",
                  keep: tuple[str, ...] = ()) -> DataFrame:
    """jobs(key, job_id, source_url, source_text, source_file_name, source_file_base64[, bucket], *keep)
    -> (key, *keep, bucket, source_type, text, article_s3_key, article_char_count, error).

    ``key`` tells runs apart; ``job_id`` only names the artefact. Article rows meet their page by
    URL and carry no payload; all other rows stay in their scan partition, so the inline texts and
    files are dropped before any shuffle (R14)."""
    bucket = resolved_bucket(default_bucket) if "bucket" in jobs.columns else F.lit(default_bucket)
    kept = list(dict.fromkeys([key, *keep, "job_id"]))
    base = jobs.select(*kept, "source_url", "source_text", "source_file_name", "source_file_base64",
                       bucket.alias("bucket"), route().alias("_route"))
    asked = (F.col("_route") == "article") & scheme_ok("source_url")
    empty = F.lit(None).cast("string")

    # Articles: each distinct URL is extracted once, however many jobs point at it, and only pages
    # that some job needs reach the extractor.
    wanted = base.where(asked).select(*kept, "bucket", F.col("source_url").alias("page_url"))
    not_found = F.concat(F.lit("Failed to fetch article from "), F.col("page_url"), F.lit(": page not found"))
    if pages is not None:
        needed = one_page_per_url(pages, wanted.select("page_url").distinct())
        texts = extract_articles(needed, mode=mode, key="page_url").select(
            "page_url", F.col("text").alias("_text"), F.col("error").alias("_error"), F.lit(True).alias("_found"))
        met = wanted.join(texts, "page_url", "left")
    else:
        met = wanted.select("*", empty.alias("_text"), empty.alias("_error"), F.lit(None).cast("boolean").alias("_found"))
    articles = met.select(
        *kept, "bucket", F.lit(False).alias("_is_file"), F.lit("article").alias("doc_type"), F.col("_text").alias("text"),
        F.when(F.col("_found").isNull(), not_found).otherwise(F.col("_error")).alias("error"))

    # Everything else is a projection of its own row.
    r = F.col("_route")
    raw = F.when(r == "file", strict_unbase64("source_file_base64"))
    name = F.coalesce(F.col("source_file_name"), F.lit(DEFAULT_FILE_NAME))
    pre = (
        F.when((r == "file") & raw.isNull(), F.lit(E_FETCH_BAD_B64))
        .when(r == "video_without_text", F.lit(E_VIDEO_NO_TEXT))
        .when(r == "article", F.lit(SCHEME_ERROR))
    )
    staged = base.where(~F.coalesce(asked, F.lit(False))).select(
        *kept, "bucket", "_route", "source_text", name.alias("_name"), raw.alias("_content"), pre.alias("_pre"))
    is_file = (F.col("_route") == "file") & F.col("_pre").isNull()
    doc = document_parts("_name", "_content", active=is_file)
    others = staged.select(
        *kept, "bucket", is_file.alias("_is_file"),
        F.when(is_file, doc["doc_type"]).otherwise(F.col("_route")).alias("doc_type"),
        F.when(is_file, doc["text"]).when(F.col("_route") != "article", F.col("source_text")).alias("text"),
        F.coalesce(F.col("_pre"), F.when(is_file, doc["error"])).alias("error"))
    carried = tuple(c for c in kept if c != key) + ("bucket",)
    is_pdf = F.coalesce(F.col("_is_file") & (F.col("doc_type") == "pdf"), F.lit(False))
    if page_texts is not None:  # only PDF rows meet the page texts
        parts = [finish_documents(others.where(is_pdf), key, page_texts, keep=carried, active="_is_file"),
                 finish_documents(others.where(~is_pdf), key, None, keep=carried, active="_is_file")]
    else:
        parts = [finish_documents(others, key, None, keep=carried, active="_is_file")]
    out = finish_documents(articles, key, None, keep=carried, active="_is_file")
    for part in parts:
        out = out.unionByName(part)
    ok = F.col("error").isNull()
    return out.select(
        key, *[c for c in keep if c != key], "bucket",
        F.when(ok, F.col("doc_type")).alias("source_type"),
        "text",
        F.when(ok, F.concat(F.lit("jobs/"), F.col("job_id"), F.lit("/source.txt"))).alias("article_s3_key"),
        F.col("n_chars").alias("article_char_count"),
        "error",
    )
