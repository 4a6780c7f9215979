"""K1–K3 artefact sinks, K6–K8 run status lookup, K9 run ledger.

The ledger is a union of the stage outputs keyed by job: the chain stops at the first failing
stage, so a job's status is decided by its earliest stage error. Everything is an equi-join or
a projection on the job key; nothing is collected to the driver.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from castwright.functions.jsonvals import INTERNAL, read_refused
from castwright.functions.text import py_strip, utc_seconds

# Artefact names under jobs/<job_id>/.
ARTEFACTS = (("source", "source.txt"), ("script", "script.txt"), ("script_metadata", "script.json"),
             ("audio", "audio.mp3"))
STAGE_ORDER = ("fetch", "rewrite", "generate")

E_MISSING_ARN = "missing required parameter: execution_arn"
E_NO_OUTPUT = "stage gave no output: "


def artefact_key(job_id: Column | str, file_name: str) -> Column:
    j = F.col(job_id) if isinstance(job_id, str) else job_id
    return F.concat(F.lit("jobs/"), j, F.lit("/" + file_name))


def artefact_keys(jobs: DataFrame, key: str = "job_id") -> DataFrame:
    """K1: one row per (job, artefact) with its object key."""
    arr = F.array(*[F.struct(F.lit(a).alias("artefact"), artefact_key(key, f).alias("object_key"))
                    for a, f in ARTEFACTS])
    return jobs.select(key, F.inline(arr))


def write_artefacts(df: DataFrame, path: str, kind_col: str = "artefact", mode: str = "append") -> None:
    """K1–K3 sink: one parquet dataset partitioned by artefact kind; text, JSON and binary
    payloads stay columns (``text``/``json``/``audio``) of the rows."""
    df.write.mode(mode).partitionBy(kind_col).parquet(path)


# --- K6–K8 --------------------------------------------------------------------------------

def iso_timestamp(ts: Column | str) -> Column:
    """K8: ISO-8601 of a UTC timestamp as ``datetime.isoformat`` writes it (microseconds only
    when non-zero, ``+00:00`` offset)."""
    t = (F.col(ts) if isinstance(ts, str) else ts).cast("timestamp")
    micros = F.unix_micros(t) % 1000000
    base = F.translate(utc_seconds(F.col(ts) if isinstance(ts, str) else ts), " ", "T")
    frac = F.when(micros != 0, F.concat(F.lit("."), F.lpad(micros.cast("string"), 6, "0"))).otherwise(F.lit(""))
    return F.when(t.isNotNull(), F.concat(base, frac, F.lit("+00:00")))


def json_or_raw(raw: Column | str) -> Column:
    """K7: struct(kind, json, raw): parsed JSON (as variant) when the text is JSON, else the raw text.

    A text that the native parser refuses is read again as the service reads it (``functions/jsonvals``);
    kind ``internal`` is one that would break the service."""
    r = F.col(raw) if isinstance(raw, str) else raw
    parsed = F.try_parse_json(r)
    again = read_refused(r, F.lit(False), parsed.isNull())
    value = F.coalesce(parsed, again["value"])
    kind = F.when(r.isNull(), F.lit(None)).when(value.isNotNull(), F.lit("json")).when(
        again["problem"] == INTERNAL, F.lit(INTERNAL)).otherwise(F.lit("raw"))
    return F.struct(kind.alias("kind"), value.alias("json"), F.when(kind == "raw", r).alias("raw"))


def lookup_id(query: Column | str, path_params: Column | str | None = None, name: str = "execution_arn") -> Column:
    """K6 id resolution: the query parameter (stripped, blank -> absent), else the path
    parameter of the same name (stripped, blank -> absent); null means a 400 lookup."""
    q = F.col(query) if isinstance(query, str) else query
    from_query = F.try_element_at(q, F.lit(name))
    cleaned_q = F.when(py_strip(from_query) != F.lit(""), py_strip(from_query))
    if path_params is None:
        return cleaned_q
    p = F.col(path_params) if isinstance(path_params, str) else path_params
    from_path = F.try_element_at(p, F.lit(name))
    return F.coalesce(cleaned_q, F.when(py_strip(from_path) != F.lit(""), py_strip(from_path)))


def run_status(lookups: DataFrame, runs: DataFrame, key: str = "request_id", arn: str = "execution_arn") -> DataFrame:
    """K6: a batch of status lookups joined with the runs table.

    Blank id -> 400 with the missing-parameter error; unknown id -> 400 too; found -> 200 with the
    7 fields (dates ISO, input/output JSON-or-raw)."""
    ids = lookups.select(key, F.when(py_strip(arn) != F.lit(""), py_strip(arn)).alias("_arn"))
    r = runs.select(
        F.col("execution_arn").alias("_arn"), "state_machine_arn", "status", "start_date", "stop_date",
        "input", "output")
    # Blank ids get a key of their own each (no run has it), so they do not meet in one partition.
    own = F.coalesce(F.col("_arn"), F.concat(F.lit("\u0000"), F.col(key).cast("string")))
    j = ids.withColumn("_at", own).join(r.withColumnRenamed("_arn", "_at"), "_at", "left")
    found = F.col("status").isNotNull()
    i = json_or_raw("input")
    o = json_or_raw("output")
    return j.select(
        key,
        F.col("_arn").alias("execution_arn"),
        "state_machine_arn", "status",
        iso_timestamp("start_date").alias("start_date"),
        iso_timestamp("stop_date").alias("stop_date"),
        i.alias("input"), o.alias("output"),
        F.when(F.col("_arn").isNull() | ~found, F.lit(400)).otherwise(F.lit(200)).alias("status_code"),
        F.when(F.col("_arn").isNull(), F.lit(E_MISSING_ARN))
        .when(~found, F.concat(F.lit("execution not found: "), F.col("_arn"))).alias("error"),
    )


# --- K9 -----------------------------------------------------------------------------------

def run_ledger(stage_results: dict[str, DataFrame], key: str = "job_id",
               counts: tuple[str, ...] = ()) -> DataFrame:
    """K9: stage results (each keyed by job with an ``error`` column, in stage order) -> one row
    per job: status, failed stage, error of the first failing stage, plus the ``counts``
    columns (each taken from whichever stage table carries it).

    A job has SUCCEEDED only with a row without error in the last stage; one that ended without
    any error row is FAILED at the first stage it has no row of.

    The stage tables are unioned (narrow: key, stage rank, error, counts) and reduced with one
    aggregation per job (``min_by`` for the first failure, partial aggregation map-side), so the
    ledger costs one shuffle on the job key."""
    parts = []
    for rank, (stage, df) in enumerate(stage_results.items()):
        cols = [F.col(c).cast("bigint").alias(c) if c in df.columns else F.lit(None).cast("bigint").alias(c)
                for c in counts]
        parts.append(df.select(key, F.lit(rank).alias("_rank"), F.lit(stage).alias("_stage"), "error", *cols))
    u = parts[0]
    for p in parts[1:]:
        u = u.unionByName(p)
    agg = u.groupBy(key).agg(
        F.expr("min_by(_stage, _rank) FILTER (WHERE error IS NOT NULL)").alias("failed_stage"),
        F.expr("min_by(error, _rank) FILTER (WHERE error IS NOT NULL)").alias("error"),
        F.max("_rank").alias("_reached"),
        *[F.max(c).alias(c) for c in counts],
    )
    stages = F.array(*[F.lit(s) for s in stage_results])
    missing = F.when(F.col("failed_stage").isNull() & (F.col("_reached") < len(stage_results) - 1),
                     F.get(stages, F.col("_reached") + 1))
    return agg.select(
        key,
        F.when(F.coalesce("failed_stage", missing).isNull(), F.lit("SUCCEEDED")).otherwise(F.lit("FAILED")).alias("status"),
        F.coalesce("failed_stage", missing).alias("failed_stage"),
        F.coalesce("error", F.concat(F.lit(E_NO_OUTPUT), missing)).alias("error"), *counts,
    )
