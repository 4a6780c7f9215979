import base64
import json

from castwright.operators import intake as K
from tests.conftest import rows


def _run(spark, bodies, b64=None, query=None):
    data = []
    for i, b in enumerate(bodies):
        body = b if isinstance(b, str) or b is None else json.dumps(b)
        data.append((i, body, bool(b64 and i in b64), (query or {}).get(i, {})))
    df = spark.createDataFrame(data, "request_id long, body string, is_base64 boolean, query map<string,string>")
    return {r["request_id"]: r for r in K.intake_requests(df).collect()}


def test_source_rules(spark):
    out = _run(spark, [
        {"source_url": "https://www.youtube.com/watch?v=abc"},
        {"source_url": "https://example.com", "source_file_base64": "aGVsbG8="},
        {"source_file_base64": "aGVsbG8="},
        {"source_file_base64": "aGVsbG8=", "source_file_name": "a.pdf", "source_text": "x"},
        {"source_file_base64": "aGVsbG8", "source_file_name": "a.pdf"},
        {},
    ])
    assert [out[i]["error"] for i in range(6)] == [
        K.E_VIDEO_NEEDS_TEXT, K.E_EXACTLY_ONE, K.E_NAME_REQUIRED, K.E_TEXT_WITH_FILE, K.E_BAD_FILE_B64,
        K.E_EXACTLY_ONE]
    assert all(out[i]["status_code"] == 400 for i in range(6))


def test_normalisation_errors_and_defaults(spark):
    out = _run(spark, [
        {"source_url": "https://example.com", "script_mode": "three-way"},
        {"source_url": "https://example.com", "voice_id_b": "   "},
        {"source_url": 5},
        {"source_url": "  https://example.com  ", "style": 7, "script_mode": " Duo ", "voice_id": " Amy "},
    ])
    assert out[0]["error"] == "script_mode must be one of: duo, single"
    assert out[1]["error"] == "field must not be empty: voice_id_b"
    assert out[2]["error"] == "field must be a string: source_url"
    r = out[3]
    assert (r["status_code"], r["source_url"], r["style"], r["script_mode"], r["voice_id"]) == (
        202, "https://example.com", "podcast", "duo", "Amy")


def test_body_parse_and_alias(spark):
    good = json.dumps({"source_url": "https://youtu.be/x", "transcript_text": " words "})
    out = _run(spark, ["{bad-json", "", "[1]", good, base64.b64encode(good.encode()).decode(),
                       {"source_url": "https://youtu.be/x", "source_text": "", "transcript_text": "t"}],
               b64={4})
    assert out[0]["error"] == "invalid JSON request body" and out[0]["status_code"] == 400
    assert out[1]["error"] == K.E_EXACTLY_ONE  # empty body reads as {}
    assert out[2]["error"] == "request body must be a JSON object"
    assert out[3]["status_code"] == 202 and out[3]["source_text"] == "words"
    assert out[4]["status_code"] == 202 and out[4]["source_text"] == "words"
    assert out[5]["error"] == K.E_VIDEO_NEEDS_TEXT  # a blank source_text blocks the alias


def test_region_query_param(spark):
    body = {"source_url": "https://example.com"}
    out = _run(spark, [body, body], query={0: {"region": " eu-west-1 "}, 1: {"region": "  "}})
    assert out[0]["region"] == "eu-west-1" and out[1]["region"] == "us-east-1"


def test_job_id_generated(spark):
    out = _run(spark, [{"source_url": "https://example.com"}, {"source_url": "https://example.com", "job_id": " j "}])
    df = spark.createDataFrame([(k, v["job_id"]) for k, v in out.items()], "request_id long, job_id string")
    ids = dict(rows(K.assign_job_ids(df), "request_id", "job_id"))
    assert ids[1] == "j"
    assert ids[0].startswith("job-") and ids[0].endswith(ids[0][-8:]) and len(ids[0]) == len("job-20240101T000000000000Z-abcdef12")


def test_base64_wrapped_bodies(spark):
    bodies = ["QQ", "/w==", "@@@", base64.b64encode(b'{"source_url": "https://e.com"}').decode()]
    out = _run(spark, bodies, b64={0, 1, 2, 3})
    assert out[0]["error"] == "invalid base64 request body"   # bad padding
    assert out[1]["error"] == "invalid base64 request body"   # not UTF-8 once decoded
    assert out[2]["error"] == "invalid JSON request body"     # nothing left after dropping non-alphabet
    assert out[3]["status_code"] == 202 and out[3]["source_url"] == "https://e.com"


def test_job_ids_of_a_batch_differ_by_construction(spark):
    df = spark.range(0, 40000, numPartitions=7).selectExpr("id AS request_id", "CASE WHEN id < 3 THEN 'given' END AS job_id")
    ids = [r.job_id for r in K.unique_job_ids(df).collect()]
    made = [i for i in ids if i != "given"]
    assert len(ids) == 40000 and ids.count("given") == 3 and len(set(made)) == len(made)
    import re

    assert all(re.fullmatch(K.GENERATED_JOB_ID_RX.replace("\\z", ""), i) for i in made)


def test_job_id_stamp_is_utc(spark):
    import datetime as dt

    zone = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        made = K.unique_job_ids(spark.createDataFrame([(1, None)], "request_id long, job_id string")).first().job_id
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)
    stamp = dt.datetime.strptime(made[4:25], "%Y%m%dT%H%M%S%f").replace(tzinfo=dt.timezone.utc)
    assert abs((dt.datetime.now(dt.timezone.utc) - stamp).total_seconds()) < 600
