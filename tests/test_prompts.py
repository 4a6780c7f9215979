import json

from pyspark.sql import functions as F

from castwright.operators import prompts as P


def test_prompt_duo_and_bad_mode(spark):
    df = spark.createDataFrame([("Body", "T", "podcast", "youtube", " Duo "), ("Body", None, "podcast", None, "trio")],
                               "text string, title string, style string, st string, mode string")
    r = df.select(P.prompt_column("text", "title", "style", "st", "mode").alias("p"),
                  P.prompt_error("mode").alias("e")).collect()
    p = r[0].p
    assert "two-host podcast dialogue" in p and "HOST_A:" in p and "HOST_B:" in p and "Script Mode: duo" in p
    assert "Title: T\n" in p and "YouTube transcript:\nBody" in p
    assert r[1].p is None and r[1].e == P.PROMPT_MODE_ERROR


def test_model_routing(spark):
    ids = ["anthropic.x", "us.anthropic.y", "amazon.nova-lite", "us.amazon.nova-pro", "meta.llama"]
    df = spark.createDataFrame([(i,) for i in ids], "m string")
    got = [(r.f, r.e) for r in df.select(P.model_family("m").alias("f"), P.model_family_error("m").alias("e")).collect()]
    assert got[:4] == [("anthropic", None), ("anthropic", None), ("nova", None), ("nova", None)]
    assert got[4] == (None, "Unsupported Bedrock model_id: meta.llama")


def test_request_bodies(spark):
    df = spark.createDataFrame([("anthropic", "hi"), ("nova", "hi")], "f string, p string")
    a, n = [json.loads(r.b) for r in df.select(P.request_body("f", "p").alias("b")).collect()]
    assert a == {"anthropic_version": "bedrock-2023-05-31", "max_tokens": 1400, "temperature": 0.5,
                 "messages": [{"role": "user", "content": [{"type": "text", "text": "hi"}]}]}
    assert n == {"messages": [{"role": "user", "content": [{"text": "hi"}]}],
                 "inferenceConfig": {"maxTokens": 1400, "temperature": 0.5}}


def test_response_parsing(spark):
    cases = [("anthropic", {"content": [{"type": "text", "text": " s "}]}, "s", None),
             ("anthropic", {"content": []}, None, P.E_A_NO_CONTENT),
             ("anthropic", {}, None, P.E_A_NO_CONTENT),
             ("anthropic", {"content": [{"type": "text", "text": ""}]}, None, P.E_A_NO_TEXT),
             ("nova", {"output": {"message": {"content": [{"x": 1}, {"text": " n "}]}}}, "n", None),
             ("nova", {"output": {}}, None, P.E_N_NO_TEXT)]
    df = spark.createDataFrame([(f, json.dumps(r)) for f, r, _, _ in cases], "f string, r string")
    got = [(x.t, x.e) for x in df.select(P.response_text("f", "r").alias("x")).select("x.*").select(
        F.col("text").alias("t"), F.col("error").alias("e")).collect()]
    assert got == [(t, e) for _, _, t, e in cases]


def test_rewrite_with_concurrent_calls_keeps_row_order(spark):
    jobs = spark.createDataFrame([(f"j{i}", f"text {i}", None, "podcast", "text", "single" if i % 5 else "trio")
                                  for i in range(40)],
                                 "job_id string, text string, title string, style string, source_type string, script_mode string")
    out = {r.job_id: (r.script, r.error) for r in
           P.rewrite(jobs, P.echo_model, "amazon.nova-lite-v1:0", concurrency=4, write_once=False).collect()}
    for i in range(40):
        if i % 5:
            assert out[f"j{i}"] == (f"text {i}", None)
        else:
            assert out[f"j{i}"] == (None, P.PROMPT_MODE_ERROR)
