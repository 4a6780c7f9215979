"""Whole runs inside the stream.

Each micro-batch of requests goes through the whole chain (``plans/jobs.run_requests``) in a run
folder of its own, named by the batch. A batch that is replayed after a failure finds its folder: the job ids
are the ones written before, whole stage tables are read, finished model and speech calls are not made
again, and objects keep their names. The batch's rows of every output table replace those of an earlier
attempt (one folder for each table and batch), so after any number of restarts the tables are those of one
run over all requests. Requests are not deduplicated across batches.

A run folder is dropped when a later batch begins, as its batch is then committed. The source, the output,
the stream's checkpoint and the run folders lie in shared folders; a batch must be replayed with the rows it
had, which Structured Streaming's offset log gives for file sources.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from castwright.operators import prompts, speech
from castwright.plans.jobs import run_requests
from castwright.plans.runs import RunFolder
from castwright.session import drop_folder
from castwright.settings import Settings
from castwright.streaming.intake import REQUEST_SCHEMA, dealt

TABLES = ("intake", "jobs", "sources", "scripts", "turns", "chunks", "ledger")
OBJECT_TABLES = ("objects", "audio_ranges")


def run_batch(out_path: str, settings: Settings, model_call_factory: Callable[[], prompts.ModelCall],
              speech_call_factory: Callable[[], speech.SpeechCall], key: str, pages: Callable[[SparkSession], DataFrame] | None,
              objects_at: str | None, keep_runs: bool):
    """The ``foreachBatch`` function: one micro-batch through the chain, its tables written."""
    def folder(batch_id: int) -> str:
        return f"{out_path}/runs/batch_id={batch_id}"

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        if batch_id and not keep_runs:
            drop_folder(spark, folder(batch_id - 1))
        run = RunFolder(spark, folder(batch_id))
        out = run_requests(dealt(batch), settings, model_call_factory, speech_call_factory, pages=pages(spark) if pages else None,
                           key=key, run=run, objects_at=objects_at)
        for name in (*TABLES, *(OBJECT_TABLES if objects_at else ())):
            out[name].write.mode("overwrite").parquet(f"{out_path}/{name}/batch_id={batch_id}")

    return write


def start_run_stream(spark: SparkSession, source_dir: str, out_path: str, checkpoint: str, settings: Settings,
                     model_call_factory: Callable[[], prompts.ModelCall], speech_call_factory: Callable[[], speech.SpeechCall],
                     key: str = "event_id", pages: Callable[[SparkSession], DataFrame] | None = None, schema: T.StructType = REQUEST_SCHEMA,
                     fmt: str = "parquet", max_files_per_trigger: int | None = None, available_now: bool = True,
                     objects_at: str | None = None, keep_runs: bool = False):
    """Start the stream over request files in ``source_dir``; returns the query handle. ``pages`` gives the page
    table as it is at each batch."""
    reader = spark.readStream.schema(schema).format(fmt)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    one = run_batch(out_path.rstrip("/"), settings, model_call_factory, speech_call_factory, key, pages, objects_at, keep_runs)
    writer = reader.load(source_dir).writeStream.foreachBatch(one).option("checkpointLocation", checkpoint)
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="10 seconds")
    return writer.start()


def read_runs(spark: SparkSession, out_path: str, table: str) -> DataFrame:
    """One output table over all batches (``batch_id`` comes from the folder layout)."""
    return spark.read.option("basePath", f"{out_path.rstrip('/')}/{table}").parquet(f"{out_path.rstrip('/')}/{table}")
