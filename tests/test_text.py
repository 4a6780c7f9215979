from pyspark.sql import functions as F

from castwright.functions import text as tx
from castwright.operators import chunking


def one(spark, expr, value, dtype="string"):
    return spark.createDataFrame([(value,)], f"x {dtype}").select(expr.alias("y")).first()["y"]


def test_strip_is_python_strip(spark):
    for s in ["\t a b \n", " x　", "\x1cy\x1f", "  ", "", "z"]:
        assert one(spark, tx.py_strip(F.col("x")), s) == s.strip()


def test_split_lines_matches_splitlines(spark):
    for s in ["a\nb", "a\r\nb\rc", "a\n", "", "\n", "a\x0bb\x1cc d\u0085e", "x\n\ny\n"]:
        assert one(spark, tx.split_lines(F.col("x")), s) == s.splitlines()


def test_words_and_duration(spark):
    assert one(spark, tx.word_count(F.col("x")), "one two three four five") == 5
    assert one(spark, tx.estimate_duration_sec(F.col("x")), "one two three four five") == 2
    # truncation of the double: 615 words -> 245 s (exact arithmetic would give 246)
    assert one(spark, tx.estimate_duration_sec(F.col("x")), " ".join(["w"] * 615)) == int(615 / 150 * 60) == 245


def test_clean_lines(spark):
    got = one(spark, tx.clean_lines(tx.split_lines(F.col("x"))), "  a \n\n\n b\t\n \n")
    assert got == "a\nb"


def test_ssml(spark):
    got = one(spark, chunking.ssml_column(F.col("x")), "Line one.\n\nLine two & <three>\n'q'")
    assert got.startswith('<speak><prosody rate="95%">')
    assert '<break time="700ms"/>' in got and '<break time="350ms"/>' in got
    assert "&amp;" in got and "&lt;three&gt;" in got and "'q'" in got
    assert one(spark, chunking.ssml_column(F.col("x")), "   ") is None


def test_segments_in_every_form(spark):
    from castwright.sources.transcripts import segments_of

    held = [(1, '[{"text": "a"}, {"text": 3}, "bare", {"text": "b", "start": 1.5}, {"other": 1}, {"text": null}]'), (2, '{"segments": [{"text": "c"}]}'),
            (3, '{"snippets": [{"text": "d"}, {"text": ["x"]}]}'), (4, '{"segments": 5}'), (5, "not json"), (6, None), (7, "[]"), (8, "7")]
    want = [(1, 0, "a"), (1, 3, "b"), (2, 0, "c"), (3, 0, "d")]
    df = spark.createDataFrame(held, "job_id int, segments string")
    assert sorted(map(tuple, segments_of(df).collect())) == want
    assert sorted(map(tuple, segments_of(df.selectExpr("job_id", "try_parse_json(segments) AS segments")).collect())) == want
    structs = spark.createDataFrame([(1, [("a", 0.5), (None, 1.0), ("b", 2.0)]), (2, None), (3, [])], "job_id int, segments array<struct<text: string, start: double>>")
    assert sorted(map(tuple, segments_of(structs).collect())) == [(1, 0, "a"), (1, 2, "b")]
    nested = structs.selectExpr("job_id", "named_struct('segments', segments) AS segments")
    assert sorted(map(tuple, segments_of(nested).collect())) == [(1, 0, "a"), (1, 2, "b")]
