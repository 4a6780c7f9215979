"""Runs that break and go on: call journal, run folder, the stream of whole runs, objects and audio ranges."""

import base64
import json
import os
import tempfile
import time
import uuid

import pytest
from pyspark import TaskContext
from pyspark.sql import functions as F

from castwright.operators import prompts, speech
from castwright.operators.journal import call_key, journaled_calls
from castwright.plans.jobs import run_requests
from castwright.plans.runs import RunFolder
from castwright.settings import Settings
from castwright.sources import objects
from castwright.streaming.runs import read_runs, start_run_stream

SETTINGS = Settings(model_id="us.amazon.nova-pro-v1:0", polly_voice_id="Amy", polly_duo_voice_id="Matthew")
REQUESTS = "event_id long, body string, is_base64 boolean, query map<string,string>"


def counted(folder, call, name):
    """``call`` that leaves a file for every time it is made."""
    def one(*args):
        with open(f"{folder}/{name}-{uuid.uuid4().hex}", "w") as out:
            out.write(json.dumps(args, default=str))
        return call(*args)

    return one


def calls(folder, name):
    made = [f for f in os.listdir(folder) if f.startswith(f"{name}-")]
    return [open(f"{folder}/{f}").read() for f in made]


def test_finished_calls_are_not_made_again(spark):
    folder, seen = tempfile.mkdtemp(prefix="castwright-journal-"), tempfile.mkdtemp(prefix="castwright-calls-")
    requests = spark.range(60).select("id", F.col("id").cast("string").alias("text")).withColumn("call_key", call_key("t", "id", "text"))

    def run(breaks, fails=()):
        def factory():
            return counted(seen, lambda text: text * 2, "one")

        def one(call, record):
            if record["id"] in breaks:
                raise SystemError("worker lost")
            if record["id"] in fails:
                return {"answer": None, "problem": "failed"}
            return {"answer": call(record["text"]), "problem": None}

        return journaled_calls(requests, folder, factory, one, ["id"], "answer string, problem string", lambda r: r["problem"] is None)

    with pytest.raises(Exception, match="worker lost"):
        run({17, 40}).collect()
    first = calls(seen, "one")
    assert 0 < len(first) < 60
    made = run((), {5}).collect()  # a result that is an error is kept, and asked for again by the next run
    done = calls(seen, "one")
    assert len(done) == len(set(done)) and set(first) <= set(done) and len(done) in (59, 60)
    again = run(()).collect()
    assert len(calls(seen, "one")) == len(set(calls(seen, "one"))) == 60
    assert len(made) == len(again) == 60 and sorted((r["id"], r["answer"], r["problem"]) for r in again) == [(i, str(i) * 2, None) for i in range(60)]


def test_a_broken_run_makes_no_calls_after_its_end(spark):
    folder, seen = tempfile.mkdtemp(prefix="castwright-journal-"), tempfile.mkdtemp(prefix="castwright-calls-")
    requests = spark.range(60).select("id").withColumn("call_key", call_key("t", "id"))

    def factory():
        if TaskContext.get().partitionId() == 0:
            while not os.listdir(seen):  # breaks when another task has begun to call
                time.sleep(0.01)
            raise SystemError("worker lost")
        return counted(seen, lambda i: time.sleep(0.3), "one")

    with pytest.raises(Exception, match="worker lost"):
        journaled_calls(requests, folder, factory, lambda call, r: {"answer": str(call(r["id"]))}, ["id"], "answer string", lambda r: True)
    made = len(calls(seen, "one"))
    time.sleep(1.0)
    assert 0 < made == len(calls(seen, "one"))


def test_other_requests_and_repeats_leave_the_journal_alone(spark):
    folder = tempfile.mkdtemp(prefix="castwright-journal-")
    rows = spark.createDataFrame([(1, "a"), (2, "b"), (2, "b"), (3, None)], "id long, text string").withColumn("call_key", call_key("t", "id", "text"))
    args = (lambda: str, lambda call, r: {"answer": call(r["text"])}, ["id"], "answer string", lambda r: True)
    assert sorted((r["id"], r["answer"]) for r in journaled_calls(rows, folder, *args).collect()) == [(1, "a"), (2, "b"), (3, "None")]
    fewer = rows.where("id = 2")
    assert [(r["id"], r["answer"]) for r in journaled_calls(fewer, folder, *args, concurrency=3).collect()] == [(2, "b")]
    changed = rows.select("id", F.lit("new").alias("text")).withColumn("call_key", call_key("t", "id", "text"))
    assert {r["answer"] for r in journaled_calls(changed, folder, *args).collect()} == {"new"}
    assert journaled_calls(rows.limit(0), folder, *args).count() == 0


def bodies(n=12):
    out = []
    for i in range(n):
        kind = i % 6
        if kind == 0:
            body = {"source_url": f"https://site/{i}", "source_text": f"Plain text {i}. " * 200}
        elif kind == 1:
            body = {"source_url": "https://youtu.be/x", "transcript_text": f"HOST_A: hi {i}\nHOST_B: hello\nhost_a: bye", "script_mode": "duo"}
        elif kind == 2:
            body = {"source_url": "https://youtu.be/x", "transcript_text": f"no labels {i}", "script_mode": "duo"}
        elif kind == 3:
            body = {"source_file_name": "x.txt", "source_file_base64": base64.b64encode(f"file {i} – ünï 日本 \U0001f600".encode()).decode(), "job_id": f"job ../{i}"}
        elif kind == 4:
            body = {"source_url": "https://youtu.be/x"}
        else:
            body = {"source_url": f"https://nowhere/{i}"}
        out.append((i, json.dumps(body), False, {}))
    return out


def as_rows(df):
    cols = sorted(df.columns)
    return sorted(str([r[c] for c in cols]) for r in df.collect())


def test_broken_run_goes_on_from_its_folder(spark):
    seen = tempfile.mkdtemp(prefix="castwright-calls-")
    requests = spark.createDataFrame(bodies(), REQUESTS)
    run = RunFolder(spark)

    def voice(broken):
        def factory():
            say = counted(seen, speech.stand_in_speech(), "speech")

            def call(rec):
                if broken and "bye" in rec["chunk"]:
                    os._exit(9)  # the worker dies: no result, no error row
                return say({k: rec[k] for k in ("chunk", "idempotency_key")})

            return call

        return factory

    def model():
        return counted(seen, prompts.echo_model(), "model")

    with pytest.raises(Exception):
        run_requests(requests, SETTINGS, model, voice(True), key="event_id", run=run)
    n_model = len(calls(seen, "model"))
    out = run_requests(requests, SETTINGS, model, voice(False), key="event_id", run=run, objects_at=run.at("objects"))
    jobs = as_rows(out["jobs"])
    whole = run_requests(requests, SETTINGS, prompts.echo_model, speech.stand_in_speech, key="event_id")
    for name in ("sources", "turns", "chunks", "ledger"):
        ours, theirs = (x[name].drop("job_id", "article_s3_key", "elapsed_ms") for x in (out, whole))
        assert as_rows(ours) == as_rows(theirs), name
    assert len(calls(seen, "model")) == n_model == out["scripts"].count()
    again = run_requests(requests, SETTINGS, model, voice(False), key="event_id", run=run)
    assert as_rows(again["jobs"]) == jobs and len(calls(seen, "model")) == n_model
    spoken = [json.loads(x)[0]["idempotency_key"] for x in calls(seen, "speech")]
    assert set(spoken) == {f"{r['event_id']}/{r['turn_no']}/{r['chunk_no']}" for r in out["chunks"].collect()}

    # the objects: texts, metadata and audio as the reference names and writes them
    texts = {r["event_id"]: r for r in out["scripts"].where("error IS NULL").collect()}
    held = {(r["event_id"], r["artefact"]): r for r in out["objects"].collect()}
    made = held[3, "script_metadata"]
    assert made["object_key"] == "jobs/job ../3/script.json" and "/.." not in made["path"].removeprefix("file://")
    body = json.dumps({"job_id": "job ../3", "source_url": None, "source_type": "txt", "title": None, "style": "podcast", "script_mode": "single",
                       "model_id": SETTINGS.model_id, "script_s3_key": "jobs/job ../3/script.txt"}, ensure_ascii=True, indent=2)
    assert open(made["path"].removeprefix("file://"), "rb").read() == body.encode()
    assert open(held[3, "script"]["path"].removeprefix("file://"), "rb").read().decode() == texts[3]["script"]
    audio = speech.read_audio(out["audio_ranges"], run.at("objects"), job_key="event_id")
    joined = {}
    for r in sorted(audio.collect(), key=lambda r: (r["event_id"], r["range_no"])):
        assert r["offset"] == len(joined.get(r["event_id"], b""))
        joined[r["event_id"]] = joined.get(r["event_id"], b"") + bytes(r["content"])
    assert joined == {r["event_id"]: bytes(r["audio"]) for r in out["audio"].collect() if r["audio"] is not None}


def test_stream_killed_and_started_again(spark):
    base, seen = tempfile.mkdtemp(prefix="castwright-stream-"), tempfile.mkdtemp(prefix="castwright-calls-")
    rows = bodies()
    for i in range(3):
        spark.createDataFrame(rows[4 * i : 4 * i + 4], REQUESTS).coalesce(1).write.parquet(f"{base}/in/{i}")

    def start(breaks):
        def model():
            call = counted(seen, prompts.echo_model(), "model")

            def answer(model_id, body):
                if breaks and "file 9" in body:
                    raise SystemExit("worker stopped")
                return call(model_id, body)

            return answer

        q = start_run_stream(spark, f"{base}/in/*", f"{base}/out", f"{base}/ckpt", SETTINGS, model, speech.stand_in_speech,
                             max_files_per_trigger=1, objects_at=f"{base}/objects", keep_runs=True)
        try:
            q.awaitTermination()
        except Exception:
            return False
        return q.exception() is None

    assert not start(True)
    before = {}
    for i in range(3):
        path = f"{base}/out/runs/batch_id={i}/tables/jobs"
        if os.path.exists(f"{path}/_SUCCESS"):
            before |= {r["event_id"]: r["job_id"] for r in spark.read.parquet(path).collect()}
    assert before and start(False)
    jobs = {r["event_id"]: r["job_id"] for r in read_runs(spark, f"{base}/out", "jobs").collect()}
    assert before.items() <= jobs.items()  # ids written before the failure are the ids of the replay
    asked = calls(seen, "model")
    assert sorted(x for x in asked if asked.count(x) > 1) == []  # no finished call was made again
    whole = run_requests(spark.createDataFrame(rows, REQUESTS), SETTINGS, prompts.echo_model, speech.stand_in_speech, key="event_id")
    for name in ("intake", "sources", "turns", "ledger"):
        ours, theirs = (x.drop("job_id", "article_s3_key", "batch_id") for x in (read_runs(spark, f"{base}/out", name), whole[name]))
        assert as_rows(ours) == as_rows(theirs), name
    kept = read_runs(spark, f"{base}/out", "audio_ranges")
    assert kept.select("event_id").distinct().count() == whole["ledger"].where("status = 'SUCCEEDED'").count()


@pytest.mark.parametrize("range_bytes", [1, 10, 1000])
def test_audio_ranges_of_a_single_turn(spark, range_bytes):
    parts = [(k, 1, c, bytes([65 + c % 26]) * (c % 7), (c % 7), None) for k in (1, 2) for c in range(50)] + [(3, 1, 0, None, None, "failed"), (3, 1, 1, b"x", 1, None)]
    df = spark.createDataFrame(parts, "job long, turn_no long, chunk_no long, audio binary, audio_bytes long, error string").repartition(3)
    made = speech.audio_ranges(df, "job", range_bytes=range_bytes).collect()
    assert {r["job"] for r in made} == {1, 2}
    for job in (1, 2):
        own = sorted((r for r in made if r["job"] == job), key=lambda r: r["range_no"])
        assert b"".join(bytes(r["content"]) for r in own) == b"".join(p[3] for p in parts if p[0] == job)
        at = 0
        for r in own:
            assert r["offset"] == at and r["n_bytes"] == len(r["content"]) < range_bytes + 7
            at += r["n_bytes"]


def test_json_objects_read_back(spark):
    root = objects.address(tempfile.mkdtemp(prefix="castwright objects+"))
    values = ['plain', 'quo"te\\ \n\t\r\b\f', "\x01\x1f\x7f", "é 日本 \U0001f600 ퟿", "", None]
    df = spark.createDataFrame([(i, f"jobs/a b/{i}%20/é/../x.json", v) for i, v in enumerate(values)], "id int, object_key string, v string")
    texts = df.select("id", "object_key", objects.json_object({"id": F.col("id").cast("string"), "v": F.col("v")}).alias("content"))
    for r in texts.collect():
        assert r["content"] == json.dumps({"id": str(r["id"]), "v": values[r["id"]]}, ensure_ascii=True, indent=2)
    written = objects.write_objects(texts, root, keep=("id",)).cache()
    assert written.count() == len(values)
    for name, data in (("broken.json", b"{oops"), ("list.json", b'[{"id": "1"}, {"id": "2"}]'), ("empty.json", b""), ("typed.json", b'{"id": {"x": 1}}')):
        with open(f"{root.removeprefix('file://')}/{name}", "wb") as out:
            out.write(data)
    more = spark.createDataFrame([(100 + i, f"{root}/{n}.json") for i, n in enumerate(("broken", "list", "empty", "typed", "gone"))], "id int, path string")
    asked = written.select("id", "path").unionByName(more)
    schema = "id string, v string"
    from pyspark.sql.types import StructType

    back = {r["asked"]: r for r in objects.read_json_objects(spark, asked.withColumnRenamed("id", "asked"), StructType.fromDDL(schema), folder=root, keep=("asked",)).collect()}
    assert len(back) == len(values) + 5
    for i, v in enumerate(values):
        assert (back[i]["id"], back[i]["v"], back[i]["error"]) == (str(i), v, None)
    assert all(back[100 + i]["error"] is not None and back[100 + i]["id"] is None for i in (0, 1, 2, 4))
    assert back[104]["error"].startswith(objects.E_MISSING_OBJECT)
