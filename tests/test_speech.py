from pyspark.sql import functions as F

from castwright.operators import speech as S
from castwright.operators import turns as T
from castwright.settings import Settings, SettingsError, settings_from
from tests.conftest import rows


def test_voice_and_format_routing(spark):
    st = Settings(polly_voice_id="Amy", polly_duo_voice_id="Matthew")
    df = spark.createDataFrame([("HOST_A", None, None), ("HOST_B", None, None), ("HOST_A", "Joanna", "Ruth"),
                                ("HOST_B", "Joanna", "Ruth")], "speaker string, v string, vb string")
    assert [r[0] for r in rows(df.select(S.route_voice("speaker", "v", "vb", st)))] == ["Amy", "Matthew", "Joanna", "Ruth"]
    fmt = df.limit(1).select(S.route_format(F.lit(" Polly "), st).alias("f"),
                             S.route_format(F.lit("elevenlabs"), Settings(elevenlabs_output_format="mp3")).alias("g"),
                             S.route_format(F.lit("unknown"), st).alias("h")).first()
    assert (fmt.f.output_format, fmt.f.text_type) == ("mp3", "ssml")
    assert (fmt.g.output_format, fmt.g.text_type) == ("mp3_44100_128", "text")
    assert fmt.h.error == S.UNKNOWN_PROVIDER_ERROR


def test_request_errors(spark):
    chunks = spark.createDataFrame([(0, "hello", "V")], "chunk_no long, chunk string, voice_id string")
    bad_type = S.synthesis_requests(chunks, Settings(), text_type=F.lit("invalid")).first()
    assert bad_type.request_error == S.TEXT_TYPE_ERROR
    no_key = S.synthesis_requests(chunks, Settings(tts_provider="elevenlabs")).first()
    assert no_key.request_error == S.ELEVENLABS_KEY_ERROR
    ssml = S.synthesis_requests(chunks, Settings(tts_provider="elevenlabs", elevenlabs_api_key="k"),
                                text_type=F.lit("ssml")).first()
    assert ssml.request_error == S.ELEVENLABS_SSML_ERROR
    ok = S.synthesis_requests(chunks, Settings(tts_provider="elevenlabs", elevenlabs_api_key="k")).first()
    assert ok.request_error is None and ok.endpoint.endswith("/V") and ok.request_text == "hello"


def test_synthesis_errors_and_concat(spark):
    chunks = spark.createDataFrame([("j", 1, 0, "a", "V"), ("j", 2, 0, "b", "V"), ("k", 1, 0, "c", "V"), ("k", 1, 1, "d", "V")],
                                   "job_id string, turn_no long, chunk_no long, chunk string, voice_id string")
    req = S.synthesis_requests(chunks, Settings(tts_provider="elevenlabs", elevenlabs_api_key="k"))

    def factory():
        def call(rec):
            if rec["chunk"] == "d":
                return 500, None, "  upstream broke  "
            return 200, {"a": b"voice-a", "b": b"voice-b", "c": b"x"}[rec["chunk"]], None
        return call

    parts = S.synthesize(req, factory, keys=["job_id", "turn_no"], concurrency=3)
    errs = {(r[0], r[1], r[2]): r[3] for r in rows(parts, "job_id", "turn_no", "chunk_no", "error")}
    assert errs[("k", 1, 1)] == "ElevenLabs request failed (status=500, chunk=1): upstream broke"
    out = {r[0]: (r[1], r[2]) for r in rows(S.concat_audio(parts), "job_id", "audio", "error")}
    assert out["j"] == (bytearray(b"voice-avoice-b"), None)
    assert out["k"][0] is None and out["k"][1].startswith("ElevenLabs request failed")
    rep = {(r[0], r[1]): r[2] for r in rows(S.synthesis_report(parts), "job_id", "turn_no", "chunk_count")}
    assert rep[("j", None)] == 2 and rep[("k", 1)] == 2


def test_polly_missing_audio(spark):
    chunks = spark.createDataFrame([("j", 1, 0, "a", "V")], "job_id string, turn_no long, chunk_no long, chunk string, voice_id string")
    req = S.synthesis_requests(chunks, Settings())
    parts = S.synthesize(req, lambda: (lambda rec: (None, None, None)), keys=["job_id", "turn_no"], write_once=False)
    assert parts.first().error == "Polly response missing AudioStream for chunk 0."


def test_settings_checks():
    s = settings_from({"bucket": "b", "model_id": "m", "tts_provider": " ElevenLabs ", "elevenlabs_api_key": "k"})
    assert s.tts_provider == "elevenlabs" and s.default_voices[0] == "JBFqnCBsd6RMkjVDRZzb"
    for bad in ({"model_id": "m"}, {"bucket": "b"}, {"bucket": "b", "model_id": "m", "tts_provider": "x"},
                {"bucket": "b", "model_id": "m", "tts_provider": "elevenlabs"}):
        try:
            settings_from(bad)
            raise AssertionError(bad)
        except SettingsError:
            pass


def test_write_audio_parts_in_order(spark, tmp_path):
    parts = spark.createDataFrame(
        [("j", 2, 0, bytearray(b"C"), None), ("j", 1, 1, bytearray(b"B"), None), ("j", 1, 0, bytearray(b"A"), None),
         ("k", 1, 0, None, "boom")],
        "job_id string, turn_no long, chunk_no long, audio binary, error string")
    path = str(tmp_path / "audio")
    S.write_audio_parts(parts, path)
    back = spark.read.parquet(path).orderBy("job_id", "turn_no", "chunk_no").collect()
    assert b"".join(bytes(r.audio) for r in back if r.job_id == "j") == b"ABC"
    assert all(r.job_id == "j" for r in back)
