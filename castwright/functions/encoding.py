"""Strict base64 and plain-text decoding.

Spark's ``unbase64``/``to_binary`` accept missing padding and embedded spaces; the strict
rule is stated as a regex guard in front of the native decoder. UTF-8 text is decoded on the
JVM; only rows that are not valid UTF-8 go through a small Arrow function for the UTF-16 and
Latin-1 fallbacks.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from castwright.functions.text import py_strip

# \z, not $: Java's $ also matches before a final line break.
STRICT_B64_RX = r"^(?:[A-Za-z0-9+/]{4})*(?:[A-Za-z0-9+/]{2}==|[A-Za-z0-9+/]{3}=)?\z"
BOM_UTF8 = "\ufeff"


def _c(x: Column | str) -> Column:
    return F.col(x) if isinstance(x, str) else x


def b64encode(b: Column | str) -> Column:
    """Standard base64 on one line (Spark's ``base64`` may wrap MIME-style every 76 chars)."""
    return F.regexp_replace(F.base64(_c(b)), "[\r\n]", "")


# The same rule without a repeated group: Java evaluates ``(?:...){4})*`` recursively, one
# stack frame per group, which overflows on multi-megabyte payloads. A character-class run
# is iterative, and the group structure is replaced by the length check.
B64_ALPHABET_RUN_RX = r"^[A-Za-z0-9+/]*={0,2}\z"


def is_strict_base64(s: Column | str) -> Column:
    """Strict base64: alphabet only, at most two '=' at the end, length a multiple of 4."""
    c = _c(s)
    return c.rlike(B64_ALPHABET_RUN_RX) & (F.length(c) % 4 == 0)


def strict_unbase64(s: Column | str) -> Column:
    """Binary for strictly valid base64, else null."""
    return F.when(is_strict_base64(s), F.unbase64(_c(s)))


def _fallback_decode(raw: bytes) -> tuple[str, str]:
    try:
        return raw.decode("utf-16"), "utf-16"
    except UnicodeDecodeError:
        return raw.decode("latin-1"), "latin-1"


@F.pandas_udf(T.StructType([T.StructField("text", T.StringType()), T.StructField("encoding", T.StringType())]))
def _decode_fallback(raw: pd.Series) -> pd.DataFrame:
    texts, encs = [], []
    for b in raw:
        if b is None:
            texts.append(None)
            encs.append(None)
        else:
            t, e = _fallback_decode(bytes(b))
            texts.append(t.strip())
            encs.append(e)
    return pd.DataFrame({"text": texts, "encoding": encs})


def decode_text_bytes(b: Column | str) -> Column:
    """struct(text, encoding): utf-8 (one leading byte-order mark dropped), else utf-16,
    else latin-1; the text is stripped. Valid UTF-8 never leaves the JVM; the Arrow function
    only receives the bytes of rows that failed it (others are passed as null)."""
    raw = _c(b)
    utf8 = F.try_validate_utf8(raw.cast("string"))
    native = py_strip(F.regexp_replace(utf8, "^" + BOM_UTF8, ""))
    fallback = _decode_fallback(F.when(utf8.isNull(), raw))
    return F.when(
        utf8.isNotNull(), F.struct(native.alias("text"), F.lit("utf-8-sig").alias("encoding"))
    ).otherwise(fallback)
