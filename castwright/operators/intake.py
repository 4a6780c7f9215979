"""Request intake as one projection over a table of raw requests.

Every rule is a native column expression over the parsed ``VARIANT`` body; a request never
raises, it gets ``status_code`` 400 and the reference's error text instead. The first failing
rule wins, in the reference's order.

Bodies that ``try_parse_json`` refuses are read a second time as the service reads them (repeated
keys, ``NaN``, long numbers, odd base64: ``functions/jsonvals``); a body that would break the service
itself is answered with 500 and the fixed text.
"""

from __future__ import annotations

import secrets

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from castwright.functions.encoding import is_strict_base64
from castwright.functions.jsonvals import BAD_BASE64, INTERNAL, read_refused
from castwright.functions.text import py_strip, utc_seconds
from castwright.functions.urls import is_video_url
from castwright.session import observed
from castwright.settings import DEFAULT_SCRIPT_MODE, DEFAULT_STYLE, SCRIPT_MODES

DEFAULT_REGION = "us-east-1"

# Error texts of the request layer.
E_BODY_NOT_STRING = "request body must be a JSON string"
E_BAD_BASE64_BODY = "invalid base64 request body"
E_BAD_JSON = "invalid JSON request body"
E_NOT_OBJECT = "request body must be a JSON object"
E_EXACTLY_ONE = "provide exactly one of source_url or source_file_base64"
E_NAME_REQUIRED = "source_file_name is required when source_file_base64 is provided"
E_TEXT_WITH_FILE = "source_text cannot be used with source_file_base64"
E_BAD_FILE_B64 = "source_file_base64 must be valid base64"
E_VIDEO_NEEDS_TEXT = (
    "YouTube URLs require transcript text in `source_text` (or API alias "
    "`transcript_text`). AWS-side YouTube transcript fetch is disabled."
)
E_INTERNAL = "internal server error"
E_MODE = "script_mode must be one of: " + ", ".join(sorted(SCRIPT_MODES))


def must_be_string(name: str) -> str:
    return f"field must be a string: {name}"


def must_not_be_empty(name: str) -> str:
    return f"field must not be empty: {name}"


# --- variant field access ------------------------------------------------------------------

def field(v: Column, name: str) -> Column:
    """The field as a variant; SQL null when the key is absent."""
    return F.try_variant_get(v, f"$.{name}", "variant")


def field_type(v: Column, name: str) -> Column:
    return F.schema_of_variant(field(v, name))


def is_absent(v: Column, name: str) -> Column:
    """Absent key or JSON null (both read as None by a dict lookup)."""
    t = field_type(v, name)
    return t.isNull() | (t == F.lit("VOID"))


def is_string(v: Column, name: str) -> Column:
    return F.coalesce(field_type(v, name) == F.lit("STRING"), F.lit(False))


def string_value(v: Column, name: str) -> Column:
    return F.when(is_string(v, name), F.try_variant_get(v, f"$.{name}", "string"))


def falsy(v: Column) -> Column:
    """Truthiness of a JSON value held in a variant: absent, null, false, 0, "", [] and {} are false."""
    t = F.schema_of_variant(v)
    return (
        v.isNull() | (t == F.lit("VOID"))
        | ((t == F.lit("BOOLEAN")) & ~F.try_variant_get(v, "$", "boolean"))
        | (t.rlike("^(BIGINT|DOUBLE|DECIMAL)") & (F.try_variant_get(v, "$", "double") == 0))
        | ((t == F.lit("STRING")) & (F.try_variant_get(v, "$", "string") == F.lit("")))
        | (t.startswith("ARRAY") & (F.size(F.try_variant_get(v, "$", "array<variant>")) == 0))
        | (t.startswith("OBJECT") & (t == F.lit("OBJECT<>")))
    )


def first_error(*pairs: tuple[Column, str | Column]) -> Column:
    """First (condition, message) pair whose condition holds, else null."""
    out = None
    for cond, msg in pairs:
        m = F.lit(msg) if isinstance(msg, str) else msg
        out = F.when(cond, m) if out is None else out.when(cond, m)
    return out


def query_param(query: Column, name: str) -> Column:
    """Optional string from the query map; strip; blank -> null."""
    return _nonblank(F.try_element_at(query, F.lit(name)))


def _nonblank(c: Column) -> Column:
    return F.when(py_strip(c) != F.lit(""), py_strip(c))


# --- S1 ---------------------------------------------------------------------------------

def parse_bodies(df: DataFrame, body: str = "body", is_base64: str | None = "is_base64",
                 keep_text: bool = False, tolerant: bool = True) -> DataFrame:
    """Adds ``_payload`` (variant) and ``_parse_error``. Absent or empty body -> {};
    optional base64 layer (lenient alphabet, then UTF-8); invalid JSON or a non-object -> error.

    Staged projections (text, parse, decide) so the parsed variant is computed once per row. With
    ``tolerant`` the bodies that the native parser refuses are read again as the service reads them
    (``functions/jsonvals``); what would break the service itself is an internal error."""
    wrapped = (F.coalesce(F.col(is_base64), F.lit(False)) if is_base64 and is_base64 in df.columns
               else F.lit(False))
    cleaned = F.regexp_replace(F.col(body), "[^A-Za-z0-9+/=]", "")
    decoded = F.try_validate_utf8(F.when(is_strict_base64(cleaned), F.unbase64(cleaned)).cast("string"))
    keep = [c for c in df.columns if c != body]
    staged = df.select(
        *keep,
        (F.col(body).isNull() | (F.col(body) == F.lit(""))).alias("_empty"),
        wrapped.alias("_wrapped"),
        F.when(wrapped, decoded).otherwise(F.col(body)).alias("_text"),
        *([F.col(body).alias("_body_as_sent")] if tolerant else []),
    )
    parsed = staged.select(*[c for c in staged.columns if c != "_text"], "_text", F.try_parse_json("_text").alias("_parsed"))
    problem = F.lit(None).cast("string")
    if tolerant:
        refused = ~F.col("_empty") & F.col("_parsed").isNull()
        read = parsed.withColumn("_again", read_refused(F.col("_body_as_sent"), F.col("_wrapped"), refused))
        parsed = read.withColumn("_parsed", F.coalesce("_parsed", "_again.value"))
        problem = F.col("_again.problem")
    error = first_error(
        (F.col("_empty"), F.lit(None).cast("string")),
        (problem == INTERNAL, E_INTERNAL),
        ((problem == BAD_BASE64) if tolerant else (F.col("_wrapped") & F.col("_text").isNull()), E_BAD_BASE64_BODY),
        (F.col("_parsed").isNull(), E_BAD_JSON),
        (~F.coalesce(F.schema_of_variant("_parsed").startswith("OBJECT"), F.lit(False)), E_NOT_OBJECT),
    )
    decided = parsed.select(*keep, "_empty", "_parsed", "_text", error.alias("_parse_error"))
    payload = F.when(F.col("_empty"), F.parse_json(F.lit("{}"))).when(
        F.col("_parse_error").isNull(), F.col("_parsed"))
    text = [F.when(F.col("_parse_error").isNull(), F.col("_text")).alias("_text")] if keep_text else []
    return decided.select(*keep, payload.alias("_payload"), "_parse_error", *text)


# --- V1–V3, V11 -------------------------------------------------------------------------

# Payload fields the request layer reads.
REQUEST_INPUT_FIELDS = ("source_url", "source_text", "transcript_text", "source_file_name",
                        "source_file_base64", "job_id", "style", "script_mode", "voice_id",
                        "voice_id_b", "state_machine_arn")


def probe_fields(v: Column, names) -> list[Column]:
    """One variant probe per field: ``_t_<name>`` (variant type name, null when absent) and
    ``_s_<name>`` (string value when the field is a JSON string). Computed once in their own
    projection so the rules below reference narrow columns instead of re-reading the variant."""
    cols = []
    for n in names:
        t = F.schema_of_variant(field(v, n))
        cols.append(t.alias(f"_t_{n}"))
        cols.append(F.when(t == F.lit("STRING"), F.try_variant_get(v, f"$.{n}", "string")).alias(f"_s_{n}"))
    return cols


def _absent(n: str) -> Column:
    t = F.col(f"_t_{n}")
    return t.isNull() | (t == F.lit("VOID"))


def _is_str(n: str) -> Column:
    return F.col(f"_s_{n}").isNotNull()


def _sval(n: str) -> Column:
    return F.col(f"_s_{n}")


def normalize_request(query: Column | None = None) -> dict[str, Column]:
    """V1/V2 over probed columns: cleaned request fields and the first normalisation error."""
    # V1: transcript alias only when source_text is absent or null (a blank string blocks it).
    text_src = F.when(_absent("source_text"), _sval("transcript_text")).otherwise(_sval("source_text"))
    mode_raw = F.lower(py_strip(F.coalesce(_sval("script_mode"), F.lit(""))))
    out = {
        "source_url": _nonblank(_sval("source_url")),
        "source_text": _nonblank(text_src),
        "source_file_name": _nonblank(_sval("source_file_name")),
        "source_file_base64": _nonblank(_sval("source_file_base64")),
        "job_id": _nonblank(_sval("job_id")),
        "style": F.coalesce(_nonblank(_sval("style")), F.lit(DEFAULT_STYLE)),
        "script_mode": F.when(mode_raw == F.lit(""), F.lit(DEFAULT_SCRIPT_MODE)).otherwise(mode_raw),
        "voice_id": _nonblank(_sval("voice_id")),
        "voice_id_b": _nonblank(_sval("voice_id_b")),
        "state_machine_arn": _nonblank(_sval("state_machine_arn")),
    }
    checks = [(~_absent("source_url") & ~_is_str("source_url"), must_be_string("source_url"))]
    checks += _optional_required_string("source_file_name")
    checks.append((~out["script_mode"].isin(*SCRIPT_MODES), E_MODE))
    checks += _optional_required_string("voice_id")
    checks += _optional_required_string("voice_id_b")
    out["normalize_error"] = first_error(*checks)
    if query is not None:
        out["region"] = F.coalesce(query_param(query, "region"), F.lit(DEFAULT_REGION))
        # every value that counts as false falls through to the query parameter; a blank text does not
        out["state_machine_arn"] = F.when(F.col("_f_state_machine_arn"), query_param(query, "state_machine_arn")).otherwise(
            out["state_machine_arn"])
    return out


def _optional_required_string(n: str) -> list[tuple[Column, str]]:
    return [
        (~_absent(n) & ~_is_str(n), must_be_string(n)),
        (_is_str(n) & (py_strip(_sval(n)) == F.lit("")), must_not_be_empty(n)),
    ]


def validate_sources(f: dict[str, Column] | None = None) -> Column:
    """V3 over cleaned columns: exactly one source; file needs a name, excludes text, must be
    strict base64; a video URL needs transcript text."""
    c = f or {n: F.col(n) for n in ("source_url", "source_text", "source_file_name", "source_file_base64")}
    has_url = c["source_url"].isNotNull()
    has_file = c["source_file_base64"].isNotNull()
    return first_error(
        (has_url == has_file, E_EXACTLY_ONE),
        (has_file & c["source_file_name"].isNull(), E_NAME_REQUIRED),
        (has_file & c["source_text"].isNotNull(), E_TEXT_WITH_FILE),
        (has_file & ~is_strict_base64(c["source_file_base64"]), E_BAD_FILE_B64),
        (has_url & is_video_url(c["source_url"]) & c["source_text"].isNull(), E_VIDEO_NEEDS_TEXT),
    )


REQUEST_FIELDS = ("job_id", "source_url", "source_text", "source_file_name", "source_file_base64",
                  "style", "script_mode", "voice_id", "voice_id_b", "region", "state_machine_arn")


def intake_requests(requests: DataFrame, key: str = "request_id", body: str = "body",
                    is_base64: str = "is_base64", query: str = "query") -> DataFrame:
    """requests(key, body, is_base64, query) -> one row per request with the cleaned fields,
    ``status_code`` (202 accepted / 400 rejected / 500 the body broke the reader) and ``error``. Rejected rows keep their key
    and reason; their cleaned fields are null.

    Three projections: parse + probe, clean, decide. Each stage's expressions are referenced
    more than once by the next, so the optimizer keeps them apart and every variant lookup
    runs once per row inside compact generated code.
    """
    q = F.col(query) if query in requests.columns else F.lit(None).cast("map<string,string>")
    base = requests.select(F.col(key), F.col(body).alias("_body"),
                           (F.col(is_base64) if is_base64 in requests.columns else F.lit(False)).alias("_b64"),
                           q.alias("_q"))
    parsed = parse_bodies(base, "_body", "_b64")
    probed = parsed.select(
        key, F.col("_parse_error"), "_q",
        *probe_fields(F.col("_payload"), REQUEST_INPUT_FIELDS),
        falsy(field(F.col("_payload"), "state_machine_arn")).alias("_f_state_machine_arn"),
    )
    f = normalize_request(F.col("_q"))
    cleaned = probed.select(
        key, "_parse_error", f["normalize_error"].alias("_normalize_error"),
        *[f[n].alias(n) for n in REQUEST_FIELDS],
    )
    error = F.coalesce(F.col("_parse_error"), F.col("_normalize_error"), validate_sources())
    decided = observed(
        cleaned.select("*", error.alias("error")), "intake",
        F.count(F.lit(1)).alias("requests"), F.count(F.when(F.col("error").isNull(), 1)).alias("accepted"),
    )
    ok = F.col("error").isNull()
    return decided.select(
        key,
        *[F.when(ok, F.col(n)).alias(n) for n in REQUEST_FIELDS],
        F.when(ok, F.lit(202)).when(F.col("error") == E_INTERNAL, F.lit(500)).otherwise(F.lit(400)).cast("int").alias("status_code"),
        "error",
    )


GENERATED_JOB_ID_RX = r"^job-[0-9]{8}T[0-9]{12}Z-[0-9a-f]{8}\z"


def _generated_id() -> Column:
    """``job-<UTC yyyyMMddTHHmmssffffff>Z-<8 hex>``, no two alike within a batch by construction.

    A row is its partition and its number there (``monotonically_increasing_id``). The number is
    added to the batch time in microseconds, the partition gives the eight digits through an odd
    factor and the batch's random start (one-to-one modulo 2^32)."""
    place = F.monotonically_increasing_id()
    row, part = place.bitwiseAND(F.lit((1 << 33) - 1)), F.shiftright(place, 33)
    micros = F.unix_micros(F.current_timestamp()) + row
    seconds = F.translate(utc_seconds(F.timestamp_micros(micros)), " -:", "T")
    stamp = F.concat(seconds, F.lpad((micros % 1000000).cast("string"), 6, "0"), F.lit("Z"))
    digits = F.pmod(part * F.lit(0x9E3779B1) + F.lit(secrets.randbits(32)), F.lit(1 << 32))
    return F.concat(F.lit("job-"), stamp, F.lit("-"), F.lower(F.lpad(F.hex(digits), 8, "0")))


def assign_job_ids(accepted: DataFrame, job_col: str = "job_id") -> DataFrame:
    """V5: keep a given id, else generate one.

    Non-deterministic: the caller must materialise the result (``session.materialize``)
    before it is used twice; ``unique_job_ids`` does that."""
    return accepted.withColumn(job_col, F.coalesce(F.col(job_col), _generated_id()))


def unique_job_ids(accepted: DataFrame, job_col: str = "job_id") -> DataFrame:
    """V5 for a whole batch, written once: one pass, without a shuffle. Given ids stay as they are,
    repeats included (``job_id`` only names artefacts; runs are told apart by their request key)."""
    from castwright.session import materialize

    return materialize(assign_job_ids(accepted, job_col), "job-ids")


def accept_response(intake: DataFrame, key: str = "request_id") -> DataFrame:
    """K5: the record of what was started, for accepted rows (execution id = job id based)."""
    return intake.where(F.col("status_code") == 202).select(
        key, "job_id", "source_url", "source_file_name", "style", "script_mode", "voice_id",
        "voice_id_b", "region", "state_machine_arn",
    )
