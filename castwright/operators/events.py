"""The pipeline event record between stages.

An event is a JSON object with 18 known fields plus open extras. Reading it types and checks
every known field (first failing field in the fixed order wins), keeps unknown keys, and a
stage gate checks what the stage needs. All rules are native columns over the parsed variant;
each bad event keeps its row with the reason.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from castwright.functions.text import py_strip
from castwright.operators.intake import first_error, parse_bodies, probe_fields
from castwright.session import observed
from castwright.settings import DEFAULT_SCRIPT_MODE, DEFAULT_STYLE, SCRIPT_MODES

# The known event fields, in the order they are read and written.
EVENT_FIELDS = (
    "job_id", "source_url", "source_text", "source_file_name", "source_file_base64",
    "source_type", "title", "style", "script_mode", "voice_id", "voice_id_b", "bucket",
    "article_s3_key", "article_char_count", "script_s3_key", "script_metadata_s3_key",
    "audio_s3_key", "audio_estimated_duration_sec",
)
INT_FIELDS = ("article_char_count", "audio_estimated_duration_sec")
STAGES = ("fetch", "rewrite", "generate")

E_NOT_OBJECT = "event must be a JSON object"
E_FETCH_JOB = "event must include job_id"
E_FETCH_ONE = "event must include exactly one of source_url or source_file_base64"
E_FETCH_NAME = "event with source_file_base64 must also include source_file_name"
E_FETCH_TEXT = "event with source_file_base64 cannot also include source_text"
E_REWRITE = "event must include job_id and article_s3_key"
E_GENERATE = "event must include job_id and script_s3_key"
E_MODE = "event field 'script_mode' must be one of: " + ", ".join(sorted(SCRIPT_MODES))


def _field_checks(name: str) -> list[tuple[Column, str]]:
    t = F.col(f"_t_{name}")
    absent = t.isNull() | (t == F.lit("VOID"))
    if name in INT_FIELDS:
        return [
            (~absent & (t != F.lit("BIGINT")), f"event field '{name}' must be an integer"),
            (~absent & (F.col(f"_i_{name}") < 0), f"event field '{name}' must be >= 0"),
        ]
    s = F.col(f"_s_{name}")
    checks = [
        (~absent & s.isNull(), f"event field '{name}' must be a string"),
        (s.isNotNull() & (py_strip(s) == F.lit("")), f"event field '{name}' must not be empty"),
    ]
    if name == "script_mode":
        checks.append((~_mode().isin(*SCRIPT_MODES), E_MODE))
    return checks


def _mode() -> Column:
    return F.lower(py_strip(F.coalesce(py_strip(F.col("_s_script_mode")), F.lit(DEFAULT_SCRIPT_MODE))))


def _clean(name: str) -> Column:
    if name in INT_FIELDS:
        return F.col(f"_i_{name}")
    if name == "style":
        return F.coalesce(py_strip(F.col("_s_style")), F.lit(DEFAULT_STYLE))
    if name == "script_mode":
        return _mode()
    return py_strip(F.col(f"_s_{name}"))


def read_events(df: DataFrame, key: str = "event_id", body: str = "body") -> DataFrame:
    """events(key, body[, stage]) -> key, the 18 typed fields, ``extras`` (map<string,variant>),
    ``error`` (first failing field, or the parse error). Other input columns pass through."""
    keep = [c for c in df.columns if c != body]
    parsed = parse_bodies(df.select(*keep, F.col(body)), body, None, keep_text=True, tolerant=False)
    v = F.col("_payload")
    probes = probe_fields(v, EVENT_FIELDS)
    ints = [F.when(F.schema_of_variant(F.try_variant_get(v, f"$.{n}", "variant")) == F.lit("BIGINT"),
                   F.try_variant_get(v, f"$.{n}", "bigint")).alias(f"_i_{n}") for n in INT_FIELDS]
    # Extras come from the JSON text (a variant object sorts its keys; the text keeps their order).
    extras = F.map_filter(
        F.from_json(F.col("_text"), "map<string,variant>"),
        lambda k, _: ~k.isin(*EVENT_FIELDS),
    )
    probed = parsed.select(*keep, "_parse_error", *probes, *ints, extras.alias("extras"))
    checks = [c for n in EVENT_FIELDS for c in _field_checks(n)]
    parse_err = F.when(F.col("_parse_error") == F.lit("request body must be a JSON object"),
                       F.lit(E_NOT_OBJECT)).otherwise(F.col("_parse_error"))
    error = F.coalesce(parse_err, first_error(*checks))
    decided = observed(
        probed.select(*keep, *[_clean(n).alias(n) for n in EVENT_FIELDS], "extras", error.alias("error")),
        "events", F.count(F.lit(1)).alias("events"), F.count(F.when(F.col("error").isNull(), 1)).alias("valid"),
    )
    ok = F.col("error").isNull()
    # An invalid event keeps only its key, pass-through columns and the reason.
    return decided.select(*keep, *[F.when(ok, F.col(n)).alias(n) for n in EVENT_FIELDS + ("extras",)], "error")


def stage_gate(stage: Column | str = "stage") -> Column:
    """V8: the first unmet requirement of the stage, null when the event may run it."""
    st = F.col(stage) if isinstance(stage, str) else stage
    has_url = F.col("source_url").isNotNull()
    has_file = F.col("source_file_base64").isNotNull()
    job = F.col("job_id").isNotNull()
    fetch = first_error(
        (~job, E_FETCH_JOB),
        (has_url == has_file, E_FETCH_ONE),
        (has_file & F.col("source_file_name").isNull(), E_FETCH_NAME),
        (has_file & F.col("source_text").isNotNull(), E_FETCH_TEXT),
    )
    return (
        F.when(st == F.lit("fetch"), fetch)
        .when(st == F.lit("rewrite"), F.when(~job | F.col("article_s3_key").isNull(), F.lit(E_REWRITE)))
        .when(st == F.lit("generate"), F.when(~job | F.col("script_s3_key").isNull(), F.lit(E_GENERATE)))
        .otherwise(F.concat(F.lit("unsupported pipeline stage: "), st))
    )


def resolved_bucket(default_bucket: str) -> Column:
    """V9: the event's bucket, else the run's default."""
    return F.coalesce(F.col("bucket"), F.lit(default_bucket))


def event_json(df: DataFrame) -> Column:
    """K4: the hand-over record as JSON text: extras first, then the known non-null fields in
    their fixed order (known keys overwrite)."""
    known = F.map_from_arrays(
        F.array(*[F.lit(n) for n in EVENT_FIELDS]),
        F.array(*[F.col(n).cast("variant") for n in EVENT_FIELDS]),
    )
    merged = F.map_concat(F.coalesce(F.col("extras"), F.create_map().cast("map<string,variant>")),
                          F.map_filter(known, lambda k, val: val.isNotNull()))
    return F.to_json(merged)


def handover_keys(df: DataFrame) -> Column:
    """Keys of the K4 record in output order."""
    known = F.filter(
        F.array(*[F.when(F.col(n).isNotNull(), F.lit(n)) for n in EVENT_FIELDS]), lambda k: k.isNotNull()
    )
    extra_keys = F.coalesce(F.map_keys("extras"), F.array().cast("array<string>"))
    return F.concat(extra_keys, known)
