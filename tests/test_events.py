import json

from castwright.operators import events as EV


def _read(spark, events, stages=None):
    data = [(i, stages[i] if stages else "fetch", e if isinstance(e, str) else json.dumps(e)) for i, e in enumerate(events)]
    df = spark.createDataFrame(data, "event_id long, stage string, body string")
    out = EV.read_events(df)
    return {r["event_id"]: r for r in out.select("*", EV.stage_gate("stage").alias("gate")).collect()}


def test_stage_gates(spark):
    out = _read(spark, [{}, {"job_id": "j"}, {"job_id": "j", "source_url": "u", "source_file_base64": "x"},
                        {"job_id": "j"}, {"job_id": "j"}, {"job_id": "j", "source_file_base64": "x",
                                                           "source_file_name": "n", "source_text": "t"}, {"job_id": "j"}],
                stages=["fetch", "fetch", "fetch", "rewrite", "generate", "fetch", "publish"])
    assert [out[i]["gate"] for i in range(7)] == [
        EV.E_FETCH_JOB, EV.E_FETCH_ONE, EV.E_FETCH_ONE, EV.E_REWRITE, EV.E_GENERATE, EV.E_FETCH_TEXT,
        "unsupported pipeline stage: publish"]


def test_typed_fields_and_extras(spark):
    out = _read(spark, [
        {"job_id": "j", "trace_id": "abc-123"},
        {"job_id": 123},
        {"job_id": "j", "audio_estimated_duration_sec": -1},
        {"job_id": "j", "script_mode": "three-way"},
        {"job_id": "j", "article_char_count": True},
        {"job_id": "j", "article_char_count": 1.0},
    ])
    r = out[0]
    assert (r["style"], r["script_mode"], dict(r["extras"]).keys() == {"trace_id"}) == ("podcast", "single", True)
    assert out[1]["error"] == "event field 'job_id' must be a string"
    assert out[2]["error"] == "event field 'audio_estimated_duration_sec' must be >= 0"
    assert "script_mode" in out[3]["error"]
    assert out[4]["error"] == "event field 'article_char_count' must be an integer"
    assert out[5]["error"] == "event field 'article_char_count' must be an integer"


def test_handover_record(spark):
    data = [(0, json.dumps({"z": 1, "job_id": " j ", "duo": None, "article_char_count": 5}))]
    df = spark.createDataFrame(data, "event_id long, body string")
    ev = EV.read_events(df)
    r = ev.select(EV.event_json(ev).alias("js")).first()["js"]
    assert json.loads(r) == {"z": 1, "duo": None, "job_id": "j", "style": "podcast", "script_mode": "single",
                             "article_char_count": 5}
    assert list(json.loads(r).keys())[:2] == ["z", "duo"]
