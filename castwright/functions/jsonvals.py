"""JSON as a service reads it, in two steps.

``try_parse_json`` reads nearly every row on the JVM. It refuses some texts that the service's reader takes:
repeated keys (the last one counts), ``NaN`` and ``Infinity``, numbers of any length, nesting beyond its
limit, and base64 with padding in unusual places. Only rows that it refuses go on to a small Arrow function,
which answers with the value (as a variant) or with the kind of problem: what is no JSON, and what the
service itself would break on.
"""

from __future__ import annotations

import base64
import json

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

BAD_BASE64 = "base64"
BAD_JSON = "json"
INTERNAL = "internal"

_READ = T.StructType([T.StructField("value", T.VariantType()), T.StructField("problem", T.StringType())])


def _read_one(body: str, wrapped: bool):
    text = body
    if wrapped:
        try:
            text = base64.b64decode(body).decode("utf-8")
        except Exception:
            return None, BAD_BASE64
    try:
        json.loads(text)
    except json.JSONDecodeError:
        return None, BAD_JSON
    except Exception:  # numbers and nesting beyond the reader's own limits
        return None, INTERNAL
    try:
        return T.VariantVal.parseJson(text), None
    except Exception:  # read, but more than a variant can hold
        return None, INTERNAL


@F.pandas_udf(_READ)
def _read(body: pd.Series, wrapped: pd.Series) -> pd.DataFrame:
    made = [(None, None) if b is None else _read_one(b, bool(w)) for b, w in zip(body, wrapped)]
    return pd.DataFrame({"value": [v for v, _ in made], "problem": [p for _, p in made]}, dtype=object)


def read_refused(body: Column, wrapped: Column, refused: Column) -> Column:
    """struct(value variant, problem): the second step, for rows where ``refused``; null for the others."""
    return _read(F.when(refused, body), F.coalesce(wrapped, F.lit(False)))
