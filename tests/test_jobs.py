import base64
import json

from castwright.operators import prompts, speech
from castwright.operators.turns import NO_TURNS_ERROR
from castwright.plans.jobs import run_requests
from castwright.settings import Settings


def test_end_to_end_run(spark):
    bodies = {
        1: {"source_url": "https://site/a", "job_id": "art"},
        2: {"source_url": "https://youtu.be/x", "transcript_text": "HOST_A: hi there\nHOST_B: hello back",
            "script_mode": "duo", "job_id": "duo", "voice_id": "Joanna"},
        3: {"source_url": "https://youtu.be/y", "source_text": "no labels at all", "script_mode": "duo", "job_id": "nolab"},
        4: {"source_file_name": "notes.md", "source_file_base64": base64.b64encode(b"x").decode(), "job_id": "md"},
        5: {"source_file_name": "notes.txt", "source_file_base64": base64.b64encode(b"file words here").decode()},
        6: "{bad-json",
    }
    req = spark.createDataFrame([(k, v if isinstance(v, str) else json.dumps(v), False, {}) for k, v in bodies.items()],
                                "request_id long, body string, is_base64 boolean, query map<string,string>")
    pages = spark.createDataFrame([(1, "https://site/a", "<article><p>Page words.</p></article>")],
                                  "page_id long, url string, html string")
    st = Settings(model_id="us.amazon.nova-pro-v1:0", polly_voice_id="Amy", polly_duo_voice_id="Matthew")
    out = run_requests(req, st, prompts.echo_model, speech.stand_in_speech, pages=pages)

    intake = {r["request_id"]: r for r in out["intake"].collect()}
    assert intake[6]["status_code"] == 400 and intake[1]["status_code"] == 202
    jobs = {r["request_id"]: r["job_id"] for r in out["jobs"].collect()}
    assert jobs[1] == "art" and jobs[5].startswith("job-")
    book = {jobs[r["request_id"]]: r for r in out["ledger"].collect()}
    assert book["art"]["status"] == "SUCCEEDED" and book["art"]["chunk_count"] == 1
    assert book["duo"]["status"] == "SUCCEEDED" and book["duo"]["chunk_count"] == 2
    assert book["nolab"]["failed_stage"] == "generate" and book["nolab"]["error"] == NO_TURNS_ERROR
    assert book["md"]["failed_stage"] == "fetch" and book["md"]["error"].startswith("Unsupported document type")
    assert book[jobs[5]]["status"] == "SUCCEEDED" and book[jobs[5]]["duration_sec"] == 1
    audio = {jobs[r["request_id"]]: bytes(r["audio"]) for r in out["audio"].collect()}
    assert audio["duo"] == b"hi therehello back" and audio["art"] == b"Page words."
    voices = {(jobs[r["request_id"]], r["turn_no"]): r["voice_id"] for r in out["turns"].collect()}
    made = {(r["artefact"], r["object_key"]): r for r in out["artefacts"].collect()}
    assert made["source", "jobs/art/source.txt"]["text"] == "Page words."
    assert json.loads(made["script_metadata", "jobs/art/script.json"]["json"])["source_url"] == "https://site/a"
    assert voices[("duo", 1)] == "Joanna" and voices[("duo", 2)] == "Matthew" and voices[("art", 1)] == "Amy"


def _run(spark, bodies, model=prompts.echo_model, voice=speech.stand_in_speech, pages=None):
    req = spark.createDataFrame([(k, json.dumps(v), False, {}) for k, v in bodies.items()],
                                "request_id long, body string, is_base64 boolean, query map<string,string>")
    st = Settings(model_id="us.amazon.nova-pro-v1:0", polly_voice_id="Amy", polly_duo_voice_id="Matthew")
    return run_requests(req, st, model, voice, pages=pages)


def test_repeated_job_ids_are_runs_of_their_own(spark):
    bodies = {k: {"source_url": "https://youtu.be/x", "source_text": f"HOST_A: run {k}\nHOST_B: reply {k}", "script_mode": "duo", "job_id": "same"}
              for k in (1, 2, 3)}
    out = _run(spark, bodies)
    assert out["scripts"].count() == 3 and out["parts"].count() == 6
    audio = {r["request_id"]: bytes(r["audio"]) for r in out["audio"].collect()}
    assert audio == {k: f"run {k}reply {k}".encode() for k in bodies}
    book = out["ledger"].collect()
    assert len(book) == 3 and all(r["status"] == "SUCCEEDED" and r["chunk_count"] == 2 for r in book)


def test_ledger_tells_blank_scripts_and_failed_calls(spark):
    def model():
        call = prompts.echo_model()
        blank = json.dumps({"output": {"message": {"content": [{"text": " \n "}]}}})

        def answer(model_id, body):
            if "broken" in body:
                raise RuntimeError("no model")
            return blank if "silent" in body else call(model_id, body)

        return answer

    def voice():
        return lambda rec: (200, None if "mute" in rec["chunk"] else rec["chunk"].encode(), None)

    texts = {1: "silent one", 2: "broken one", 3: "mute one", 4: "good one"}
    out = _run(spark, {k: {"source_url": "https://example.com", "source_text": v} for k, v in texts.items()}, model, voice)
    book = {r["request_id"]: (r["status"], r["failed_stage"], r["error"]) for r in out["ledger"].collect()}
    assert book[1] == ("FAILED", "generate", "Input text is empty.")
    assert book[2] == ("FAILED", "rewrite", "Model call failed: no model")
    assert book[3] == ("FAILED", "generate", "Polly response missing AudioStream for chunk 0.")
    assert book[4] == ("SUCCEEDED", None, None)


def test_two_crawls_of_a_url_give_one_source(spark):
    pages = spark.createDataFrame([(1, "https://site/a", "<article><p>Old.</p></article>"), (2, "https://site/a", "<article><p>New.</p></article>")],
                                  "page_id long, url string, html string")
    out = _run(spark, {1: {"source_url": "https://site/a"}}, pages=pages)
    assert [r["text"] for r in out["sources"].collect()] == ["New."]
