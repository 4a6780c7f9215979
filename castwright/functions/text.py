"""Text kernel as Spark column expressions (JVM side, inside whole-stage codegen).

Python's ``str.strip``/``str.split``/``str.splitlines`` treat a wider set of characters as
whitespace or line breaks than Spark's ``trim``/``split``; these helpers state the Python
rules with built-in functions so no row leaves the JVM.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Characters for which Python's str.isspace() is true (built from the rule, not listed by hand).
WHITESPACE = "".join(chr(c) for c in range(0x110000) if chr(c).isspace())


def _class(chars: str) -> str:
    """Regex class of ``chars`` with consecutive code points merged into ranges (a short class
    is several times faster in Java's matcher than one alternative per character)."""
    cps = sorted({ord(c) for c in chars})
    parts, i = [], 0
    while i < len(cps):
        j = i
        while j + 1 < len(cps) and cps[j + 1] == cps[j] + 1:
            j += 1
        parts.append(f"\\x{{{cps[i]:x}}}" + (f"-\\x{{{cps[j]:x}}}" if j > i else ""))
        i = j + 1
    return "[" + "".join(parts) + "]"


# Regex class of the same set, usable by Java regex (Spark) and RE2 (DuckDB).
WS_CLASS = _class(WHITESPACE)
# Line boundaries of str.splitlines: \r\n first, then the single characters.
LINE_BREAK_CHARS = "\n\r\x0b\x0c\x1c\x1d\x1e\x85\u2028\u2029"
LINE_BREAK_RX = "\\r\\n|" + _class(LINE_BREAK_CHARS)


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def py_strip(c: Column | str) -> Column:
    """``str.strip()`` with Python's Unicode whitespace set."""
    return F.btrim(_col(c), F.lit(WHITESPACE))


def py_lstrip(c: Column | str) -> Column:
    return F.ltrim(_col(c), F.lit(WHITESPACE))


def py_rstrip(c: Column | str) -> Column:
    return F.rtrim(_col(c), F.lit(WHITESPACE))


def blank_to_null(c: Column | str) -> Column:
    """strip; empty after strip -> null."""
    s = py_strip(c)
    return F.when(s != F.lit(""), s)


def split_lines(c: Column | str) -> Column:
    """``str.splitlines()``: split on every line boundary, drop one trailing empty piece."""
    parts = F.split(_col(c), LINE_BREAK_RX, -1)
    n = F.size(parts)
    return F.when(
        F.element_at(parts, -1) == F.lit(""), F.slice(parts, 1, n - 1)
    ).otherwise(parts)


def piece_lines(c: Column | str) -> Column:
    """Lines a piece contributes when pieces are joined by newline and the whole is split with
    ``str.splitlines``: every boundary splits (an empty piece is one empty line), and a piece
    ending in CR loses that CR because CR + the joining LF form one boundary. (The joined text's
    final empty line, which ``splitlines`` drops, is kept: a trailing blank line changes no turn
    or paragraph.)"""
    return F.split(F.regexp_replace(_col(c), "\\r\\z", ""), LINE_BREAK_RX, -1)


def split_words(c: Column | str) -> Column:
    """``str.split()`` with no argument: runs of whitespace separate, no empty words."""
    return F.filter(F.split(_col(c), WS_CLASS + "+", -1), lambda w: w != F.lit(""))


def collapse_whitespace(c: Column | str) -> Column:
    """``re.sub(r"\\s+", " ", x)`` with Python's Unicode ``\\s``."""
    return F.regexp_replace(_col(c), WS_CLASS + "+", " ")


def clean_lines(lines: Column) -> Column:
    """Strip each line, drop blanks, join by newline, 3+ newlines -> 2, strip."""
    kept = F.filter(F.transform(lines, lambda x: py_strip(x)), lambda x: x != F.lit(""))
    joined = F.array_join(kept, "\n")
    return py_strip(F.regexp_replace(joined, "\n{3,}", "\n\n"))


def char_count(c: Column | str) -> Column:
    """``len(text)`` in code points, as bigint."""
    return F.char_length(_col(c)).cast("bigint")


def word_count(c: Column | str) -> Column:
    return F.size(split_words(c)).cast("bigint")


def estimate_duration_sec(c: Column | str, words_per_minute: int = 150) -> Column:
    """``int(words / max(wpm, 1) * 60)``; double division then truncation, in that order."""
    wpm = float(max(words_per_minute, 1))
    return ((word_count(c).cast("double") / F.lit(wpm)) * F.lit(60.0)).cast("bigint")


def html_escape_text(c: Column | str) -> Column:
    """``html.escape(x, quote=False)``: & first, then < and >."""
    x = F.replace(_col(c), F.lit("&"), F.lit("&amp;"))
    x = F.replace(x, F.lit("<"), F.lit("&lt;"))
    return F.replace(x, F.lit(">"), F.lit("&gt;"))


def utc_seconds(ts: Column) -> Column:
    """``yyyy-MM-dd HH:mm:ss`` of a timestamp in UTC, whatever the session's time zone is (a
    timestamp without zone is taken as UTC already)."""
    epoch = F.to_timestamp_ntz(F.lit("1970-01-01 00:00:00"))
    seconds = F.unix_micros(ts.cast("timestamp")).cast("decimal(20,0)") / F.lit(1000000).cast("decimal(7,0)")
    moved = epoch + F.make_dt_interval(secs=seconds.cast("decimal(18,6)"))
    return F.substring(F.when(F.typeof(ts) == "timestamp_ntz", ts.cast("string")).otherwise(moved.cast("string")), 1, 19)
