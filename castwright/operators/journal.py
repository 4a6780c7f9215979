"""A journal of remote calls (M7, T9): each finished call is kept, so that a broken run goes on where it stopped.

Every request has a call key, a hash of all that the call is made of. Tasks append the result of each
call, as it returns, as a line of JSON to a file of their own in the journal's folder, outside the job's
commit, so what was paid for stays when the task, the job or the driver is lost; a line that was cut off is no
result. A run asks only for requests that have no good result in the journal (an anti-join on the
keys); a task that is tried again first reads what its earlier attempts wrote. A run that breaks ends when its tasks
have, so that no call is made behind the back of the next run (``tasks_ended``). A call that was under way
when its process ended is made again; it carries its key for a service that recognises repeats. Stores that
show a file only when it is closed lose what a killed task wrote since its last file (``FILE_SECONDS``).
"""

from __future__ import annotations

import base64
import json
import time
import uuid
from collections.abc import Callable, Iterator
from concurrent.futures import ThreadPoolExecutor

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from castwright.session import make_folder, materialize
from castwright.sources.objects import address, open_folder

CALL_KEY = "call_key"
#: A task goes on to a new file after this many seconds.
FILE_SECONDS = 10.0
#: Longest wait for the tasks of a job that failed; Spark ends their workers after ``spark.python.task.killTimeout`` (2 s).
END_SECONDS = 60.0

#: The last fields of a line; one without its id was cut off.
_ROW = "call_ok boolean, finished_at double, call_id string"


def call_key(stage: str, *parts: Column | str) -> Column:
    """Hash of everything that a call is made of."""
    cols = [F.col(p) if isinstance(p, str) else p for p in parts]
    named = F.struct(F.lit(stage).alias("stage"), *[c.alias(f"p{i}") for i, c in enumerate(cols)])
    return F.sha2(F.to_json(named, {"ignoreNullFields": "false"}).cast("binary"), 256).alias(CALL_KEY)


class JournalWriter:
    """Files of one task: ``<folder>/<partition>/<id>.jsonl``, a line for each finished call."""

    def __init__(self, folder: str, partition: int, seconds: float = FILE_SECONDS):
        self.files, root = open_folder(folder)
        self.root, self.seconds, self.out, self.since = f"{root}/{partition:06d}", seconds, None, 0.0

    def known(self) -> set[str]:
        """Keys of the good results that earlier attempts of this task wrote."""
        from pyarrow import fs

        out: set[str] = set()
        for info in self.files.get_file_info(fs.FileSelector(self.root, allow_not_found=True)):
            if info.path.endswith(".jsonl"):
                with self.files.open_input_file(info.path) as held:
                    for line in held.read().split(b"\n")[:-1]:
                        row = json.loads(line)
                        if row["call_ok"]:
                            out.add(row[CALL_KEY])
        return out

    def add(self, row: dict) -> None:
        if self.out is None:
            self.files.create_dir(self.root)
            self.out = self.files.open_output_stream(f"{self.root}/{uuid.uuid4().hex}.jsonl")
            self.since = time.monotonic()
        self.out.write(json.dumps(row, default=lambda v: base64.b64encode(v).decode()).encode() + b"\n")
        self.out.flush()
        if time.monotonic() - self.since >= self.seconds:
            self.close()

    def close(self) -> None:
        if self.out is not None:
            self.out.close()
        self.out = None


def journaled_calls(requests: DataFrame, folder: str, make_call: Callable[[], Callable], one: Callable[[Callable, dict], dict],
                    carried: list[str], results: str, ok: Callable[[dict], bool], concurrency: int = 1) -> DataFrame:
    """(call_key, *carried, *results) of every request, each called once.

    ``requests`` has ``call_key`` and what ``one(call, record)`` needs; ``one`` returns a dict of the
    ``results`` columns (a DDL string) and records its own errors; results for which ``ok`` is false are kept,
    and called again by the next run. ``make_call`` is invoked once a task, at its first pending request."""
    spark = requests.sparkSession
    folder = address(folder)
    make_folder(spark, folder)
    kinds = {f.name: f.dataType.simpleString() for f in requests.schema}
    ddl = ", ".join([f"{CALL_KEY} string", *[f"`{c}` {kinds[c]}" for c in carried], results, _ROW])
    schema = T.StructType.fromDDL(ddl)

    good = read_journal(spark, folder, schema).where("call_ok").select(CALL_KEY).distinct()
    pending = requests.join(good, CALL_KEY, "left_anti")
    dealt = pending.repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), CALL_KEY)
    job = uuid.uuid4().hex

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        context = TaskContext.get()
        writer = JournalWriter(f"{folder}/{job}", context.partitionId() if context else 0)
        known, call, made = writer.known(), None, 0
        pool = ThreadPoolExecutor(max_workers=concurrency) if concurrency > 1 else None
        try:
            for batch in batches:
                todo = [r for r in batch.to_pylist() if r[CALL_KEY] not in known]
                known |= {r[CALL_KEY] for r in todo}  # requests that are alike are one call
                todo = list({r[CALL_KEY]: r for r in todo}.values())
                if todo and call is None:
                    call = make_call()
                for record, result in zip(todo, (pool.map if pool else map)(lambda r: one(call, r), todo)):
                    made += 1
                    writer.add({CALL_KEY: record[CALL_KEY], **{c: record[c] for c in carried}, **result,
                                "call_ok": ok(result), "finished_at": time.time(), "call_id": uuid.uuid4().hex})
        finally:
            writer.close()
            if pool:
                pool.shutdown(cancel_futures=True)
        yield pa.RecordBatch.from_arrays([pa.array([made], pa.int64())], names=["calls"])

    tag = f"calls-{job}"
    spark.sparkContext.addJobTag(tag)
    try:
        dealt.mapInArrow(run, "calls bigint").agg(F.sum("calls")).collect()
    except Exception:
        tasks_ended(spark, tag)
        raise
    finally:
        spark.sparkContext.removeJobTag(tag)
    return latest_results(spark, folder, schema, requests).select(CALL_KEY, *carried, *[f.name for f in T.StructType.fromDDL(results)])


def tasks_ended(spark: SparkSession, tag: str, seconds: float = END_SECONDS) -> None:
    """Wait until no task of the jobs with this tag is running. A job fails with its first task; the others go on
    calling until they are stopped, and what they call would not be in the journal yet when the next run reads it."""
    context = spark.sparkContext
    by_tag, tracker = context._jsc.sc().statusTracker(), context.statusTracker()

    def running() -> bool:
        jobs = [j for j in map(tracker.getJobInfo, by_tag.getJobIdsForTag(tag)) if j]
        stages = [s for j in jobs for s in map(tracker.getStageInfo, j.stageIds) if s]
        return any(j.status == "RUNNING" for j in jobs) or any(s.numActiveTasks for s in stages)

    until = time.monotonic() + seconds
    time.sleep(0.1)  # the status comes a little later than the error
    while running() and time.monotonic() < until:
        time.sleep(0.1)


def read_journal(spark, folder: str, schema: T.StructType | str) -> DataFrame:
    """All whole lines of a journal, whichever attempt wrote them."""
    lines = spark.read.schema(schema).option("recursiveFileLookup", "true").option("pathGlobFilter", "*.jsonl").json(folder)
    return lines.where("call_id IS NOT NULL")


def latest_results(spark, folder: str, schema: T.StructType, requests: DataFrame) -> DataFrame:
    """One journal row for each request: a good one before a failed one, then the latest.

    Only keys are compared. What falls out (repeats of broken attempts, results of other requests) is
    written as a narrow table first, usually empty, so that the results themselves are not shuffled."""
    rows = read_journal(spark, folder, schema)
    narrow = rows.select(CALL_KEY, "call_id", "call_ok", "finished_at")
    asked = narrow.join(requests.select(CALL_KEY).distinct(), CALL_KEY, "left_semi")
    best = asked.groupBy(CALL_KEY).agg(F.max_by("call_id", F.struct("call_ok", "finished_at", "call_id")).alias("call_id"))
    out = materialize(narrow.select(CALL_KEY, "call_id").join(best, [CALL_KEY, "call_id"], "left_anti").select("call_id"), "journal-unused")
    return rows.join(out, "call_id", "left_anti")
