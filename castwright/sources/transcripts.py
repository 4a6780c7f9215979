"""Transcript segments to paragraph text.

Rule (fixed by the source behaviour): keep segment texts that are strings, in order; drop blank
lines, collapse whitespace runs to one space and strip; groups of 6 lines are joined by a space;
groups are joined by a blank line; no lines -> "YouTube transcript is empty".
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from castwright.functions.text import collapse_whitespace, piece_lines, py_strip
from castwright.operators.ordering import one_per_position, running_sum
from castwright.session import materialize

LINES_PER_PARAGRAPH = 6
EMPTY_TRANSCRIPT_ERROR = "YouTube transcript is empty"


# Fields under which an object holds its list of segments.
WRAPPERS = ("segments", "snippets", "raw_data")


def segments_of(df: DataFrame, key: str = "job_id", segments: str = "segments") -> DataFrame:
    """(key, pos, text) of the segments in order, from any form that they come in: an array of structs
    or maps, a variant, or JSON text, which may be a list or an object that wraps one (``WRAPPERS``).

    An item counts if it is an object with a ``text`` that is a string; ``pos`` is its place among all items.
    Everything goes through one variant path; rows that hold no list give no segments."""
    kind = df.schema[segments].dataType.simpleString()
    held = F.col(segments)
    if kind == "string":
        held = F.try_parse_json(held)
    elif kind != "variant":
        held = F.to_variant_object(held)

    def a_list(path: str):  # null for what is no list
        return F.try_variant_get("_held", path, "array<variant>")

    items = F.coalesce(a_list("$"), *[a_list(f"$.{w}") for w in WRAPPERS])
    text = F.try_variant_get("seg", "$.text", "variant")
    exploded = df.select(key, held.alias("_held")).select(key, F.posexplode(items).alias("pos", "seg"))
    return exploded.select(
        key, F.col("pos").cast("bigint").alias("pos"),
        F.when(F.schema_of_variant(text) == F.lit("STRING"), F.try_variant_get("seg", "$.text", "string")).alias("text"),
    ).where(F.col("text").isNotNull())


def segments_from_array(df: DataFrame, key: str = "job_id", segments: str = "segments") -> DataFrame:
    """S6 for an array of segments."""
    return segments_of(df, key, segments)


def segments_from_json(df: DataFrame, key: str = "job_id", segments: str = "segments_json") -> DataFrame:
    """S6 for segments held as JSON text."""
    return segments_of(df, key, segments)


def transcript_paragraphs(rows: DataFrame, key: str = "job_id", order: tuple[str, ...] = ("pos",),
                          text: str = "text", group_size: int = LINES_PER_PARAGRAPH,
                          split_rows: bool = False) -> DataFrame:
    """Ordered transcript rows -> (key, paragraph_no, text) with ``group_size`` kept lines per
    paragraph. Each row is one line (a segment), or several lines when ``split_rows``.

    The global line index is a per-job running count of kept lines over narrow rows, computed
    with the blocked scan (``ordering.running_sum``) so one very long transcript is spread over
    many tasks; the rows are joined back on (key, order) and grouped by (key, paragraph). Each
    position holds one row (``ordering.one_per_position``; ``position_rejects`` has the rest)."""
    order = tuple(order)

    def clean(x):
        return py_strip(collapse_whitespace(x))

    lines = F.transform(piece_lines(text), clean) if split_rows else F.array(clean(F.col(text)))
    lines = F.filter(lines, lambda ln: ln != F.lit("")).alias("_lines")
    if order:
        # Cleaned once and written: the numbering reads the counts several times, the lines once.
        rows = materialize(one_per_position(rows, key, order, text).select(key, *order, lines).where(F.size("_lines") > 0)
                           .withColumn("_n", F.size("_lines").cast("bigint")), "lines")
        before = running_sum(rows.select(key, *order, "_n"), key, order, "_n", "_cum").select(
            key, *order, (F.col("_cum") - F.col("_n")).alias("_before"))
        kept = rows.select(key, *order, "_lines").join(before, [key, *order]).select(
            key, *order, "_before", F.posexplode("_lines").alias("_line", "line"))
        idx = F.col("_before") + F.col("_line") + F.lit(1)
    else:
        kept = rows.select(key, F.posexplode(lines).alias("_line", "line"))
        idx = F.row_number().over(Window.partitionBy(key).orderBy("_line")) if split_rows else F.lit(1)
    numbered = kept.withColumn("paragraph_no", F.floor((idx - 1) / group_size).cast("bigint"))
    order_sql = ", ".join([*order, "_line"])
    return numbered.groupBy(key, "paragraph_no").agg(
        F.expr(f"listagg(line, ' ') WITHIN GROUP (ORDER BY {order_sql})").alias("text")
    )


def transcript_text(paragraphs: DataFrame, jobs: DataFrame | None = None, key: str = "job_id") -> DataFrame:
    """Paragraph rows -> one source text per job, joined by a blank line; jobs without any
    paragraph (when ``jobs`` is given) keep a row with the error."""
    texts = paragraphs.groupBy(key).agg(
        py_strip(F.expr("listagg(text, '\\n\\n') WITHIN GROUP (ORDER BY paragraph_no)")).alias("text")
    )
    if jobs is not None:
        texts = jobs.select(key).distinct().join(texts, key, "left")
    return texts.select(
        key, "text", F.char_length("text").cast("bigint").alias("n_chars"),
        F.when(F.col("text").isNull(), F.lit(EMPTY_TRANSCRIPT_ERROR)).alias("error"),
    )
