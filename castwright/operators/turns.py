"""Two-host script parsing into speaker turns.

Rule (fixed by the source behaviour): a line matching ``^\\s*(HOST_A|HOST_B)\\s*:\\s*(.*)$``
(case-insensitive) starts a new turn, even for the same speaker; unlabelled lines continue the
current turn; lines before the first label are dropped; a turn's text is its stripped lines
joined by newline, then stripped (inner blank lines stay); empty turns are dropped.

Plan: see ``parse_duo_turns``; no step groups a whole job into one task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from castwright.functions.text import WS_CLASS, char_count, piece_lines, py_strip, split_lines
from castwright.operators.ordering import one_per_position, running_sum

# The two speaker labels.
HOST_A = "HOST_A"
HOST_B = "HOST_B"
LABEL_RX = f"(?i)^{WS_CLASS}*({HOST_A}|{HOST_B}){WS_CLASS}*:{WS_CLASS}*(.*)$"
NO_TURNS_ERROR = "script_mode=duo requires script lines prefixed with HOST_A: or HOST_B:."


def script_lines(scripts: DataFrame, key: str = "job_id", text: str = "text") -> DataFrame:
    """(key, text) -> (key, line_no, raw) with ``str.splitlines`` boundaries, 0-based."""
    return scripts.select(
        key, F.posexplode(split_lines(text)).alias("line_no", "raw")
    ).withColumn("line_no", F.col("line_no").cast("bigint"))


def parse_duo_turns(rows: DataFrame, key: str = "job_id", order: tuple[str, ...] = (),
                    text: str = "text") -> DataFrame:
    """Script rows -> (key, turn_no, speaker, text, n_chars).

    ``rows`` holds each job's script as consecutive pieces in ``order`` (one row per job when
    ``order`` is empty); the script is the pieces joined by newline, so a piece may span
    several lines (``piece_lines``). ``turn_no`` is the 1-based ordinal of
    the turn's label in the script.

    Plan: the only cross-row dependency is how many labels precede a piece. That count is a
    per-job running sum over narrow (key, order, count) rows, computed with the blocked scan
    (``ordering.running_sum``) so a job with a huge number of pieces is split over many tasks.
    Each position holds one piece (``ordering.one_per_position``; ``position_rejects`` has the rest).
    The pieces are then joined back on (key, order), exploded into lines, numbered inside each
    piece, and grouped by (key, turn) -- every wide shuffle is keyed by more than the job, so no
    single job lands in one task.
    """
    order = tuple(order)
    lines_of = piece_lines if order else split_lines
    n_labels = F.size(F.filter(lines_of(text), lambda ln: ln.rlike(LABEL_RX))).cast("bigint")
    if order:
        rows = one_per_position(rows, key, order, text)
        narrow = rows.select(key, *order, n_labels.alias("_n"))
        before = running_sum(narrow, key, order, "_n", "_cum").select(
            key, *order, (F.col("_cum") - F.col("_n")).alias("_before"))
        wide = rows.select(key, *order, text).join(before, [key, *order])
    else:
        wide = rows.select(key, text, F.lit(0).cast("bigint").alias("_before"))
    lines = wide.select(key, *order, "_before", F.posexplode(lines_of(text)).alias("_line", "_raw"))
    raw = F.col("_raw")
    is_label = raw.rlike(LABEL_RX)
    marked = lines.select(
        key, *order, "_before", "_line",
        F.when(is_label, py_strip(F.regexp_extract(raw, LABEL_RX, 2))).otherwise(py_strip(raw)).alias("body"),
        F.when(is_label, F.upper(F.regexp_extract(raw, LABEL_RX, 1))).alias("speaker"),
        is_label.cast("int").alias("is_label"),
    )
    w = Window.partitionBy(key, *order).orderBy("_line").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    numbered = marked.withColumn(
        "turn_no", (F.col("_before") + F.sum("is_label").over(w)).cast("bigint")).where("turn_no > 0")
    order_sql = ", ".join([*order, "_line"])
    turns = numbered.groupBy(key, "turn_no").agg(
        F.max("speaker").alias("speaker"),
        py_strip(F.expr(f"listagg(body, '\\n') WITHIN GROUP (ORDER BY {order_sql})")).alias("text"),
    )
    return turns.where(F.col("text") != F.lit("")).select(
        key, "turn_no", "speaker", "text", char_count("text").alias("n_chars")
    )


def duo_rejects(jobs: DataFrame, turns: DataFrame, key: str = "job_id") -> DataFrame:
    """Duo jobs without any turn -> (key, stage, error_message)."""
    return jobs.select(key).distinct().join(turns.select(key).distinct(), key, "left_anti").select(
        key, F.lit("generate").alias("stage"), F.lit(NO_TURNS_ERROR).alias("error")
    )
