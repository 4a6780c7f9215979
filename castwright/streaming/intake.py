"""Continuous request intake with Structured Streaming.

Each micro-batch goes through the same stateless intake projections as the batch path (S1, S2, V1–V3, V11)
inside ``foreachBatch``, which writes accepted and rejected rows to two sinks (one parquet dataset
partitioned by ``outcome``). A batch that arrives in fewer splits than there are cores (one file
is often one split, however many requests it holds) is dealt to all cores first (``dealt``). Each batch overwrites its own
``batch_id`` folder, so a batch replayed after a failure replaces its earlier output instead
of duplicating it; with the checkpoint this gives exactly-once files per batch. Requests are not
deduplicated across batches (a repeated ``job_id`` starts another run, as in the reference).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from castwright.operators.intake import intake_requests
from castwright.session import spread

REQUEST_SCHEMA = T.StructType([
    T.StructField("event_id", T.LongType()),
    T.StructField("body", T.StringType()),
    T.StructField("is_base64", T.BooleanType()),
    T.StructField("query", T.MapType(T.StringType(), T.StringType())),
])


def dealt(batch: DataFrame) -> DataFrame:
    """A micro-batch's rows over all cores; left alone where its files give enough splits. The rows are dealt
    in turn, not by a key, so repeated or missing keys do not meet in one task."""
    return spread(batch)


def intake_batch_writer(out_path: str, key: str):
    def write(batch: DataFrame, batch_id: int) -> None:
        out = intake_requests(dealt(batch), key=key).withColumn(
            "outcome", F.when(F.col("status_code") == 202, F.lit("accepted")).otherwise(F.lit("rejected"))
        )
        out.write.mode("overwrite").partitionBy("outcome").parquet(f"{out_path}/batch_id={batch_id}")

    return write


def start_intake_stream(spark: SparkSession, source_dir: str, out_path: str, checkpoint: str,
                        key: str = "event_id", schema: T.StructType = REQUEST_SCHEMA, fmt: str = "parquet",
                        max_files_per_trigger: int | None = None, available_now: bool = True):
    """Start the intake stream over request files in ``source_dir``; returns the query handle."""
    reader = spark.readStream.schema(schema).format(fmt)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    writer = (reader.load(source_dir).writeStream.foreachBatch(intake_batch_writer(out_path, key))
              .option("checkpointLocation", checkpoint).queryName(f"intake_{abs(hash(out_path)) % 10**8}"))
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="10 seconds")
    return writer.start()


def read_intake_output(spark: SparkSession, out_path: str) -> DataFrame:
    """Both sinks read back (``outcome`` and ``batch_id`` come from the folder layout)."""
    return spark.read.parquet(out_path)
