"""K5/K6: the registry of runs, an append-only table of what happened to each execution.

A run that is accepted appends a start, one that ends a stop; nothing is ever changed. A run's state is the
latest of its rows (``runs``), so repeats of a row, as a retried stage leaves them, do no harm, and
rows may come in any order. Execution ids are made from the state machine and the run's key, so a rerun
of the same requests has the same ids. One aggregation by execution id, map-side first; lookups join it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from castwright.operators.ledger import iso_timestamp, lookup_id, run_status

DEFAULT_STATE_MACHINE = "arn:aws:states:us-east-1:000000000000:stateMachine:podcast"
RUNNING = "RUNNING"
START, STOP = 0, 1
COLUMNS = "execution_arn string, state_machine_arn string, phase int, status string, at timestamp, input string, output string"

# Fields of an execution's input, in their order; absent ones are left out.
INPUT_FIELDS = ("job_id", "style", "script_mode", "source_url", "source_text", "source_file_name", "source_file_base64", "voice_id", "voice_id_b")
# Fields of the answer to a start request.
RESPONSE_FIELDS = ("job_id", "source_url", "source_file_name", "style", "script_mode", "voice_id", "voice_id_b", "region", "state_machine_arn")


def execution_arn(state_machine_arn: Column | str, name: Column | str) -> Column:
    """The id of the execution ``name`` of a state machine."""
    machine = F.col(state_machine_arn) if isinstance(state_machine_arn, str) else state_machine_arn
    own = F.col(name) if isinstance(name, str) else name
    return F.concat(F.replace(machine, F.lit(":stateMachine:"), F.lit(":execution:")), F.lit(":"), own.cast("string"))


def with_execution(accepted: DataFrame, key: str = "request_id", default_arn: str = DEFAULT_STATE_MACHINE) -> DataFrame:
    """``accepted`` with the state machine that runs it and the id of its execution."""
    machine = F.coalesce("state_machine_arn", F.lit(default_arn))
    return accepted.withColumn("state_machine_arn", machine).withColumn("execution_arn", execution_arn("state_machine_arn", F.concat(F.lit("run-"), F.col(key).cast("string"))))


def starts(accepted: DataFrame, at: Column) -> DataFrame:
    """The rows that accepted runs (``with_execution``) append."""
    absent = F.lit(None).cast("string")
    return accepted.select("execution_arn", "state_machine_arn", F.lit(START).alias("phase"), F.lit(RUNNING).alias("status"), at.cast("timestamp").alias("at"),
                           F.to_json(F.struct(*INPUT_FIELDS)).alias("input"), absent.alias("output"))


def stops(ended: DataFrame, at: Column, output: Column) -> DataFrame:
    """The rows that ended runs (execution_arn, state_machine_arn, status SUCCEEDED or FAILED) append."""
    absent = F.lit(None).cast("string")
    return ended.select("execution_arn", "state_machine_arn", F.lit(STOP).alias("phase"), "status", at.cast("timestamp").alias("at"),
                        absent.alias("input"), output.cast("string").alias("output"))


def append(rows: DataFrame, path: str) -> None:
    rows.write.mode("append").parquet(path)


def read(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(COLUMNS).parquet(path)


def runs(transitions: DataFrame) -> DataFrame:
    """One row for each execution: status, start and stop date, input and output, as its latest rows say."""
    place = F.struct("phase", "at", "status")
    begun, ended = F.col("phase") == START, F.col("phase") == STOP
    return transitions.groupBy("execution_arn").agg(
        F.max("state_machine_arn").alias("state_machine_arn"),
        F.max_by("status", place).alias("status"),
        F.min(F.when(begun, F.col("at"))).alias("start_date"),
        F.max(F.when(ended, F.col("at"))).alias("stop_date"),
        F.max_by(F.when(begun, F.col("input")), F.when(begun, F.col("at"))).alias("input"),
        F.max_by(F.when(ended, F.col("output")), F.when(ended, F.col("at"))).alias("output"),
    )


def start_response(accepted: DataFrame, at: Column, key: str = "request_id") -> DataFrame:
    """K5: the answer to each accepted request (``with_execution``), with the id and the start of its run."""
    return accepted.select(key, *RESPONSE_FIELDS, "execution_arn", iso_timestamp(at).alias("start_date"))


def lookup(requests: DataFrame, transitions: DataFrame, key: str = "request_id", query: str = "query", path_params: str = "path_params") -> DataFrame:
    """K6: requests(key, query map, path parameter map) -> the status of the run that each asks for."""
    asked = requests.select(key, lookup_id(query, path_params).alias("execution_arn"))
    return run_status(asked, runs(transitions), key=key)
