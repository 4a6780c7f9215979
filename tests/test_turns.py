import random
import re

from castwright.operators import turns as T
from castwright.sources import transcripts
from tests.conftest import rows


def _parse(spark, scripts):
    df = spark.createDataFrame(list(scripts.items()), "job_id string, text string")
    out = T.parse_duo_turns(df)
    got = {}
    for job, _, spk, text in rows(out.orderBy("job_id", "turn_no"), "job_id", "turn_no", "speaker", "text"):
        got.setdefault(job, []).append((spk, text))
    return got


_LABEL = re.compile(r"^\s*(HOST_A|HOST_B)\s*:\s*(.*)$", re.IGNORECASE)


def _brute(script):
    """Independent statement: find label lines, each owns the lines up to the next label."""
    lines = script.splitlines()
    starts = [i for i, ln in enumerate(lines) if _LABEL.match(ln)]
    out = []
    for n, s in enumerate(starts):
        end = starts[n + 1] if n + 1 < len(starts) else len(lines)
        m = _LABEL.match(lines[s])
        body = [m.group(2).strip()] + [ln.strip() for ln in lines[s + 1:end]]
        text = "\n".join(body).strip()
        if text:
            out.append((m.group(1).upper(), text))
    return out


def test_two_turns(spark):
    assert _parse(spark, {"j": "HOST_A: hello there\nHOST_B: hi back"})["j"] == [
        ("HOST_A", "hello there"), ("HOST_B", "hi back")]


def test_same_label_twice_and_multiline(spark):
    s = "intro dropped\nhost_a : one\n\n  more\n\nHOST_A:two\nHOST_B:\n\n  three  \n\n"
    assert _parse(spark, {"j": s})["j"] == [("HOST_A", "one\n\nmore"), ("HOST_A", "two"), ("HOST_B", "three")]


def test_no_turns_is_rejected(spark):
    df = spark.createDataFrame([("j1", "No speaker labels here"), ("j2", "HOST_B: x")], "job_id string, text string")
    t = T.parse_duo_turns(df)
    assert rows(T.duo_rejects(df, t), "job_id", "error") == [("j1", T.NO_TURNS_ERROR)]


def test_random_scripts_match_brute_force(spark):
    rng = random.Random(11)
    pieces = ["HOST_A: ", "host_b:", "  HOST_B :  ", "", "word", "  ", "x y", "\n", "\r\n", "HOST_C: z"]
    scripts = {}
    for i in range(120):
        scripts[f"s{i}"] = "\n".join("".join(rng.choice(pieces) for _ in range(rng.randint(1, 3)))
                                     for _ in range(rng.randint(1, 12)))
    got = _parse(spark, scripts)
    for k, s in scripts.items():
        assert got.get(k, []) == _brute(s), s


def test_transcript_paragraphs_groups_of_six(spark):
    lines = [("j", i, f"  line   {i} ") for i in range(7)] + [("j", 7, "   ")]
    df = spark.createDataFrame(lines, "job_id string, pos long, text string")
    paras = transcripts.transcript_paragraphs(df)
    got = rows(transcripts.transcript_text(paras), "job_id", "text")
    assert got == [("j", "line 0 line 1 line 2 line 3 line 4 line 5\n\nline 6")]


def test_transcript_empty_is_error(spark):
    jobs = spark.createDataFrame([("j",)], "job_id string")
    empty = spark.createDataFrame([], "job_id string, pos long, text string")
    out = transcripts.transcript_text(transcripts.transcript_paragraphs(empty), jobs=jobs)
    assert rows(out, "job_id", "error") == [("j", transcripts.EMPTY_TRANSCRIPT_ERROR)]


def test_pieces_across_rows_match_single_row(spark):
    """The blocked-scan path (script split over many ordered rows) equals the one-row path."""
    rng = random.Random(5)
    pieces = ["HOST_A: a", "HOST_B: b b", "cont", "", "  ", "x\\ny", "host_a:", "z"]
    data, scripts = [], {}
    for j in range(30):
        parts = [rng.choice(pieces).replace("\\n", "\n") for _ in range(rng.randint(1, 40))]
        scripts[f"j{j}"] = "\n".join(parts)
        data += [(f"j{j}", i, p) for i, p in enumerate(parts)]
    rows_df = spark.createDataFrame(data, "job_id string, pos long, text string")
    multi = T.parse_duo_turns(rows_df, order=("pos",))
    got = {}
    for job, _, spk, text in rows(multi.orderBy("job_id", "turn_no"), "job_id", "turn_no", "speaker", "text"):
        got.setdefault(job, []).append((spk, text))
    for k, s in scripts.items():
        assert got.get(k, []) == _brute(s), s


def test_running_sum_hot_key(spark):
    from pyspark.sql import functions as F

    from castwright.operators.ordering import running_sum

    # one key with most rows plus many small keys; ranges cut the hot key into pieces
    data = [("hot", i, i % 3) for i in range(5000)] + [(f"k{i}", 0, 1) for i in range(200)]
    df = spark.createDataFrame(data, "k string, o long, v long")
    out = running_sum(df, "k", ["o"], "v", "cum", ranges=16)
    hot = rows(out.where(F.col("k") == "hot").orderBy("o"), "o", "cum")
    expect, acc = [], 0
    for i in range(5000):
        acc += i % 3
        expect.append((i, acc))
    assert hot == expect
    assert out.where(F.col("k") != "hot").where(F.col("cum") != 1).count() == 0


def test_running_sum_both_plans_with_negative_values(spark):
    from pyspark.sql import functions as F

    from castwright.operators.ordering import blocked_running_sum, ranged_running_sum

    data = [("hot", i, (i % 7) - 3) for i in range(3000)] + [(f"k{i}", 5, -2) for i in range(50)]
    df = spark.createDataFrame(data, "k string, o long, v long")
    expect, acc = {}, 0
    for i in range(3000):
        acc += (i % 7) - 3
        expect[("hot", i)] = acc
    for i in range(50):
        expect[(f"k{i}", 5)] = -2
    for out in (blocked_running_sum(df, "k", "o", "v", "cum", block_rows=64),
                ranged_running_sum(df, "k", ["o"], "v", "cum", ranges=12),
                ranged_running_sum(df.withColumn("o2", F.lpad(F.col("o").cast("string"), 6, "0")),
                                   "k", ["o2"], "v", "cum", ranges=12)):
        assert {(r["k"], r["o"]): r["cum"] for r in out.collect()} == expect


def test_segments_from_json_skip_non_string_text(spark):
    import json

    segs = [{"text": "one  two"}, {"text": 5}, {"start": 1}, {"text": "three"}, "x"]
    df = spark.createDataFrame([("j", json.dumps(segs))], "job_id string, segments_json string")
    lines = transcripts.segments_from_json(df)
    assert rows(lines.orderBy("pos"), "pos", "text") == [(0, "one  two"), (3, "three")]
    out = transcripts.transcript_text(transcripts.transcript_paragraphs(lines))
    assert rows(out, "job_id", "text") == [("j", "one two three")]


def test_repeated_and_missing_positions(spark):
    from castwright.operators.ordering import E_NO_POSITION, E_REPEATED_POSITION, position_rejects

    rows = [("j", 1, "HOST_A: hi"), ("j", 2, "yo"), ("j", 2, "zz"), ("j", 2, "zz"), ("j", None, "lost"), ("j", 3, "HOST_B: bye")]
    pieces = spark.createDataFrame(rows, "job_id string, pos long, text string")
    made = T.parse_duo_turns(pieces, order=("pos",)).orderBy("turn_no").collect()
    assert [(r["turn_no"], r["speaker"], r["text"]) for r in made] == [(1, "HOST_A", "hi\nyo"), (2, "HOST_B", "bye")]
    lost = {(r["pos"], r["n_rejected"], r["error"]) for r in position_rejects(pieces, "job_id", ("pos",)).collect()}
    assert lost == {(None, 1, E_NO_POSITION), (2, 2, E_REPEATED_POSITION)}
    paras = transcripts.transcript_paragraphs(pieces, order=("pos",)).collect()
    assert [r["text"] for r in paras] == ["HOST_A: hi yo HOST_B: bye"]
