import datetime as dt

from castwright.operators import ledger as L
from tests.conftest import rows


def test_iso_and_json_or_raw(spark):
    df = spark.createDataFrame([(dt.datetime(2024, 1, 1, 0, 0, 7), '{"a": 1}'),
                                (dt.datetime(2024, 1, 1, 0, 0, 7, 1234), "not json"), (None, None)],
                               "ts timestamp_ntz, raw string")
    got = rows(df.select(L.iso_timestamp("ts").alias("s"), L.json_or_raw("raw").alias("j"))
               .select("s", "j.kind", "j.raw"))
    assert got == [("2024-01-01T00:00:07+00:00", "json", None),
                   ("2024-01-01T00:00:07.001234+00:00", "raw", "not json"), (None, None, None)]


def test_status_lookup(spark):
    runs = spark.createDataFrame([("arn:1", "sm", "SUCCEEDED", dt.datetime(2024, 1, 1), None, "{}", "oops")],
                                 "execution_arn string, state_machine_arn string, status string, start_date timestamp_ntz, "
                                 "stop_date timestamp_ntz, input string, output string")
    look = spark.createDataFrame([(1, " arn:1 "), (2, "  "), (3, "arn:2")], "request_id long, execution_arn string")
    out = {r[0]: r[1:] for r in rows(L.run_status(look, runs), "request_id", "status_code", "error", "status")}
    assert out[1] == (200, None, "SUCCEEDED")
    assert out[2] == (400, L.E_MISSING_ARN, None)
    assert out[3][0] == 400 and out[3][1].startswith("execution not found")


def test_ledger_first_failure_wins(spark):
    fetch = spark.createDataFrame([("a", None), ("b", "bad file"), ("c", None)], "job_id string, error string")
    rewrite = spark.createDataFrame([("a", None), ("c", "bad mode")], "job_id string, error string")
    gen = spark.createDataFrame([("a", None)], "job_id string, error string")
    out = {r[0]: r[1:] for r in rows(L.run_ledger({"fetch": fetch, "rewrite": rewrite, "generate": gen}))}
    assert out == {"a": ("SUCCEEDED", None, None), "b": ("FAILED", "fetch", "bad file"),
                   "c": ("FAILED", "rewrite", "bad mode")}


def test_artefact_keys(spark):
    df = spark.createDataFrame([("job-1",)], "job_id string")
    assert rows(L.artefact_keys(df), "artefact", "object_key") == [
        ("source", "jobs/job-1/source.txt"), ("script", "jobs/job-1/script.txt"),
        ("script_metadata", "jobs/job-1/script.json"), ("audio", "jobs/job-1/audio.mp3")]


def test_artefact_sink_roundtrip(spark, tmp_path):
    """K1-K3: text, JSON and binary artefacts in one dataset partitioned by kind."""
    from pyspark.sql import functions as F

    df = spark.createDataFrame(
        [("j1", "source", "text body", None, None), ("j1", "script_metadata", None, '{"job_id": "j1"}', None),
         ("j1", "audio", None, None, bytearray(b"\x00\x01mp3"))],
        "job_id string, artefact string, text string, json string, audio binary")
    keyed = df.withColumn("object_key", F.concat(F.lit("jobs/"), "job_id", F.lit("/"), "artefact"))
    path = str(tmp_path / "artefacts")
    L.write_artefacts(keyed, path)
    back = {r["artefact"]: r for r in spark.read.parquet(path).collect()}
    assert back["source"]["text"] == "text body"
    assert back["script_metadata"]["json"] == '{"job_id": "j1"}'
    assert bytes(back["audio"]["audio"]) == b"\x00\x01mp3"


def test_lookup_id_query_then_path(spark):
    df = spark.createDataFrame([({"execution_arn": " a "}, {"execution_arn": "b"}), ({"execution_arn": "  "}, {"execution_arn": " b "}),
                                ({}, {}), (None, {"execution_arn": "  "})],
                               "q map<string,string>, p map<string,string>")
    assert [r[0] for r in df.select(L.lookup_id("q", "p")).collect()] == ["a", "b", None, None]


def test_iso_timestamp_in_another_zone(spark):
    zone = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        df = spark.sql("SELECT timestamp_micros(0) AS a, timestamp_micros(1500000) AS b, TIMESTAMP_NTZ '2024-03-10 02:30:00' AS c")
        assert rows(df.select(*[L.iso_timestamp(c).alias(c) for c in "abc"])) == [
            ("1970-01-01T00:00:00+00:00", "1970-01-01T00:00:01.500000+00:00", "2024-03-10T02:30:00+00:00")]
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)


def test_a_run_without_its_last_stage_has_not_succeeded(spark):
    fetch = spark.createDataFrame([("a", None), ("b", None)], "job_id string, error string")
    gen = spark.createDataFrame([("a", None)], "job_id string, error string")
    out = {r[0]: r[1:] for r in rows(L.run_ledger({"fetch": fetch, "generate": gen}))}
    assert out == {"a": ("SUCCEEDED", None, None), "b": ("FAILED", "generate", L.E_NO_OUTPUT + "generate")}
