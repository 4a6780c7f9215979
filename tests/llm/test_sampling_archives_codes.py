"""Importance resampling, WARC archives and vector codes against plain Python, and their edge cases."""

import base64
import hashlib
import math
import random
import re
import uuid
import zlib

import numpy as np
import pytest
import zstandard
from pyspark.sql import functions as F

from castwright.llm import importance, vector_codes, warc
from castwright.session import ensure_checkpoint_dir

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def features(text, n):
    words = WORD.findall(lower(text))
    return len(words), [" ".join(words[i : i + k]) for i in range(len(words)) for k in range(1, n + 1) if i + k <= len(words)]


@pytest.mark.parametrize("n", [1, 2, 3, 4])
def test_features_are_all_runs_of_words(n):
    r = random.Random(n)
    texts = [None, "", "  ", "...", "One", "a b", "a--b\nC d\x00e", "ÉÀ ß日本 x", "x" * 5000]
    texts += ["".join(r.choice("aB1 é-\n日.") for _ in range(r.randint(0, 60))) for _ in range(300)]
    for text in texts:
        n_words, made = importance.feature_buckets(text, n, 10_000)
        expected = features(text, n)
        assert n_words == expected[0]
        assert sorted(made.tolist()) == sorted(zlib.crc32(f.encode()) % 10_000 for f in expected[1])


def draw_by_hand(rows, target, percent, min_words):
    corpus, wanted = [0] * 10_000, [0] * 10_000
    for _, text in rows:
        for f in features(text, 2)[1]:
            corpus[zlib.crc32(f.encode()) % 10_000] += 1
    for text in target:
        for f in features(text, 2)[1]:
            wanted[zlib.crc32(f.encode()) % 10_000] += 1
    s, t = sum(corpus), sum(wanted)
    gain = [math.floor(1000 * math.log((b + 1) * (s + 10_000) / ((a + 1) * (t + 10_000)))) for a, b in zip(corpus, wanted)]
    out = []
    for id_, text in rows:
        n_words, feats = features(text, 2)
        weight = sum(gain[zlib.crc32(f.encode()) % 10_000] for f in feats) // len(feats) if feats else 0
        h = int(hashlib.sha256(f"7:{'' if id_ is None else id_}".encode()).hexdigest()[:8], 16)
        out.append((id_, len(feats), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), n_words))
    fits = sorted((r for r in out if r[4] >= min_words), key=lambda r: (-r[3], r[0] is None, r[0] or 0))
    return out, [r[:4] for r in fits[: percent * len(fits) // 100]]


def corpus_rows():
    r = random.Random(5)
    rows = [(i, " ".join(r.choice(["alpha", "Beta", "gamma", "delta", "x1", "né"]) for _ in range(r.randint(0, 40)))) for i in range(120)]
    return rows + [(500, None), (501, ""), (None, rows[3][1]), (None, "Beta " * 50), (7, rows[7][1]), (7, rows[7][1]), (502, "long words " * 20_000)]


@pytest.mark.parametrize("percent, min_words", [(25, 20), (100, 0), (0, 20), (60, 1)])
def test_draw_against_plain_python(spark, percent, min_words):
    rows, target = corpus_rows(), ["alpha beta alpha beta", None, "x1"]
    docs = spark.createDataFrame([(i, t, 9, "s") for i, t in rows], "doc_id long, text string, WEIGHT int, source string").repartition(5)
    bench = spark.createDataFrame([(t,) for t in target], "text string")
    every, drawn = draw_by_hand(rows, target, percent, min_words)
    made = importance.rank(docs, bench, percent=percent, min_words=min_words).collect()
    key = lambda x: tuple((v is not None, v) for v in x)
    assert sorted((tuple(r)[0:1] + (r["n_features"], r["weight"], r["score"]) for r in made), key=key) == sorted((x[:4] for x in every), key=key)
    by_rank = sorted((r for r in made if r["rank"] is not None), key=lambda r: r["rank"])
    assert [r["rank"] for r in by_rank] == list(range(1, len(drawn) + 1))
    assert [(r["doc_id"], r["n_features"], r["weight"], r["score"]) for r in by_rank] == drawn
    taken = importance.resample(docs, bench, percent=percent, min_words=min_words)
    assert set(taken.columns) >= {"doc_id", "text", "source", "weight", "score"} and len(set(c.lower() for c in taken.columns)) == len(taken.columns)
    texts = dict(rows)
    got = taken.collect()
    assert sorted(((r["doc_id"], r["n_features"], r["weight"], r["score"]) for r in got), key=key) == sorted(drawn, key=key)
    assert all(r["text"] == texts[r["doc_id"]] for r in got if r["doc_id"] is not None)


def test_empty_tables_of_the_draw(spark):
    docs = spark.createDataFrame([(1, "a b " * 20)], "doc_id long, text string")
    none = spark.createDataFrame([], "text string")
    assert importance.rank(docs.limit(0), none).count() == 0 and importance.resample(docs.limit(0), none).count() == 0
    assert importance.rank(docs, none, percent=100).first()["rank"] == 1


def pages():
    r = random.Random(3)
    rows = [(i, f"http://h{i % 7}.example/{i}", "".join(r.choice(["<p>", "word ", "é", "\n", "日本 "]) for _ in range(r.randint(0, 400)))) for i in range(150)]
    rows += [(200 + i, "http://copy.example/", rows[i % 3][2]) for i in range(40)]
    rows += [(300, None, None), (301, "x\ny z", ""), (302, "u", "\x00\r\n\r\n\n"), (303, "u", "\x00\r\n\r\n\n"), (None, "n", "only without id"), (None, "n", "only without id"),
             (None, "n", rows[0][2]), (304, "t", "tie"), (304, "t", "tie"), (305, "big", "<p>long text</p>" * 300_000)]
    return rows


def records_by_hand(rows, min_bytes=0):
    largest = {}
    for id_, _, html in rows:
        key = html or ""
        if id_ is not None and (largest.get(key) is None or id_ > largest[key]):
            largest[key] = id_
    out = []
    for id_, _, html in rows:
        data = (html or "").encode()
        keeper = largest.get(html or "")
        again = len(data) >= min_bytes and keeper is not None and id_ != keeper
        out.append((id_, len(data), base64.b32encode(hashlib.sha1(data).digest()).decode(), "revisit" if again else "response", keeper if again else None))
    return out


def folder(spark):
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/warc-test-{uuid.uuid4().hex}"


@pytest.mark.parametrize("min_bytes, archive_bytes", [(0, 1 << 26), (6, 4096)])
def test_archives_round_trip(spark, min_bytes, archive_bytes):
    rows = pages()
    df = spark.createDataFrame([(*x, 1) for x in rows], "page_id long, url string, html string, SHA1 int").repartition(3)
    back = warc.archive_and_read(df, folder(spark), min_bytes=min_bytes, archive_bytes=archive_bytes).collect()
    key = lambda x: tuple((v is not None, v) for v in x)
    got = [(r["page_id"], r["payload_bytes"], r["payload_digest"], r["record_type"], r["refers_to"]) for r in back]
    assert sorted(got, key=key) == sorted(records_by_hand(rows, min_bytes), key=key)
    assert all(r["problem"] is None for r in back)
    held = sorted(bytes(r["payload"]).decode() for r in back if r["record_type"] == "response")
    by_hand = records_by_hand(rows, min_bytes)
    assert held == sorted(html or "" for (_, _, html), made in zip(rows, by_hand) if made[3] == "response")


def test_archive_files_follow_the_format(spark, tmp_path):
    path = folder(spark)
    warc.write_archives(spark.createDataFrame(pages(), "page_id long, url string, html string"), path)
    seen, ids, refers = 0, set(), set()
    for row in spark.read.format("binaryFile").load(path).collect():
        data = bytes(row["content"])
        assert data[:4] == (0x184D2A5D).to_bytes(4, "little")  # the dictionary comes first
        size = int.from_bytes(data[4:8], "little")
        dictionary = zstandard.ZstdCompressionDict(data[8 : 8 + size])
        assert dictionary.dict_id() > 0
        # any Zstandard reader that is given the dictionary reads the file as one stream
        whole = zstandard.ZstdDecompressor(dict_data=dictionary).stream_reader(data, read_across_frames=True).read()
        assert whole.startswith(b"WARC/1.1\r\nWARC-Type: warcinfo")
        parsed = [warc.parse(x) for x in warc.records(data)]
        assert b"".join(warc.records(data)) == whole
        ids |= {p["record_id"] for p in parsed if p["record_type"] == "response"}
        refers |= {p["refers_to_id"] for p in parsed if p["record_type"] == "revisit"}
        seen += len(parsed) - 1
    assert seen == len(pages()) and refers and refers <= ids


def test_dictionary_makes_archives_smaller():
    rows = [warc.row_record(str(i), f"http://a.example/{i}", "X" * 32, 9, f"<html><head><title>{i}</title></head><body>{i * i}</body></html>".encode(), None) for i in range(400)]
    dictionary = warc.train(rows)
    small, large = warc.Writer(dictionary), warc.Writer(None)
    assert 3 * sum(len(small.row(x)) for x in rows) < 2 * sum(len(large.row(x)) for x in rows)
    assert warc.train(rows[:3]) is None


@pytest.mark.parametrize("packed", [False, True])
def test_other_writers_files_and_damage(packed):
    rows = [warc.row_record(str(i), None, warc.base32_sha1(b"abc" * i), 3 * i, b"abc" * i, None) for i in range(200)]
    dictionary = warc.train(rows)
    writer = warc.Writer(dictionary)
    held = zstandard.ZstdCompressor().compress(dictionary) if packed else dictionary
    frames = [writer.compress(x) for x in rows]
    data = (0x184D2A5D).to_bytes(4, "little") + len(held).to_bytes(4, "little") + held + b"".join(frames)
    assert list(warc.records(data)) == rows
    plain = warc.Writer(None)
    assert list(warc.records(b"".join(plain.compress(x) for x in rows))) == rows and list(warc.records(b"")) == []
    with pytest.raises((ValueError, zstandard.ZstdError)):
        list(warc.records(data[:-3]))
    assert warc.parse(rows[5].replace(b"abcabc", b"abcabd", 1))["problem"] is not None
    assert warc.parse(b"junk")["problem"] == "not a WARC record"


def test_empty_archive(spark):
    path = folder(spark)
    df = spark.createDataFrame([], "page_id long, url string, html string")
    assert warc.archive_and_read(df, path).count() == 0


def codes_by_hand(rows, parts=8, entries=16, rounds=6, scale=4096):
    kept = [(i, v, l) for i, v, l in rows if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    kept.sort(key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    size = -(-max((len(v) for _, v, _ in kept), default=1) // parts)
    ints = [[math.floor(float(np.float32(x)) * scale) for x in v] + [0] * (parts * size - len(v)) for _, v, _ in kept]
    cut = [[x[p * size : (p + 1) * size] for p in range(parts)] for x in ints]
    books = [[x[p] for x in cut[:entries]] for p in range(parts)]

    def near(p, part):
        far = [sum((a - b) ** 2 for a, b in zip(part, e)) for e in books[p]]
        return far.index(min(far)), min(far)

    for _ in range(rounds):
        held = [[[] for _ in books[p]] for p in range(parts)]
        for x in cut:
            for p in range(parts):
                held[p][near(p, x[p])[0]].append(x[p])
        books = [[[sum(c) // len(h) for c in zip(*h)] if h else books[p][e] for e, h in enumerate(held[p])] for p in range(parts)]
    out = []
    for (i, _, label), x in zip(kept, cut):
        found = [near(p, x[p]) for p in range(parts)]
        out.append((i, "".join(f"{e:02x}" for e, _ in found), sum(f for _, f in found), label))
    sums = {}
    for _, _, e, label in out:
        sums[label] = sums.get(label, 0) + e
    flat = ",".join(str(v) for book in books for e in book for v in e)
    return [(i, c, e, sums[label]) for i, c, e, label in out], hashlib.sha256(flat.encode()).hexdigest()


def vectors(n, dims, seed):
    r = random.Random(seed)
    rows = [(i, [round(r.gauss(0, 0.2), 3) for _ in range(dims)], r.choice([None, 1, 1, 1, 2])) for i in range(n)]
    return rows + [(n, None, 1), (n + 1, [0.1] * (dims - 1) + [None], 1), (n + 2, [float("nan")] * dims, 1), (n + 3, [float("-inf")] * dims, 2),
                   (3, rows[3][1] if n > 3 else [0.0] * dims, 1), (None, [0.5] * dims, 7), (n + 4, [0.0] * dims, None)]


@pytest.mark.parametrize("n, dims", [(300, 64), (60, 16), (5, 24), (40, 13), (50, 96)])
def test_codes_against_plain_python(spark, n, dims):
    rows = vectors(n, dims, n)
    df = spark.createDataFrame([(*x, 0) for x in rows], "vec_id long, embedding array<float>, label int, CODE int").repartition(4)
    made, books = vector_codes.compress(df)
    expected, digest = codes_by_hand(rows)
    key = lambda x: tuple((v is not None, v) for v in x)
    got = [(r["vec_id"], bytes(r["code"]).hex(), r["error"], r["label_error"]) for r in made.collect()]
    assert sorted(got, key=key) == sorted(expected, key=key) and vector_codes.books_digest(books) == digest


def test_codes_of_odd_tables(spark):
    schema = "vec_id long, embedding array<float>, label int"
    for rows in ([], [(1, None, 1)], [(1, [], 1)], [(2, [1e30] * 8, 1), (1, [-1e30] * 8, 1), (3, [0.0] * 3, None)]):
        made, _ = vector_codes.compress(spark.createDataFrame(rows, schema))
        assert made.count() == len([r for r in rows if r[1] is not None])


@pytest.mark.parametrize("dims, spread", [(8, 300), (8, 20_000), (11, 300), (16, 5)])
def test_cells_leave_out_only_what_cannot_be_nearest(dims, spread, monkeypatch):
    r = np.random.default_rng(dims)
    book = r.integers(-300, 300, (16, dims))
    book[7] = book[3]
    cells = vector_codes.Cells(book)
    for step in range(4):
        monkeypatch.setattr(vector_codes, "CELLS", 50 if step == 3 else 1 << 17)
        parts = r.integers(-spread, spread, (3000, dims))
        parts[:16] = book
        far = ((parts[:, None] - book[None]) ** 2).sum(2)
        entry, least = cells.nearest(parts)
        assert (entry == far.argmin(1)).all() and (least == far.min(1)).all()
    if spread == 5:
        assert cells.evaluated < 4 * 3000 * 16


def test_frequent_groups_meet_their_rows(spark):
    from castwright.llm.common import join_groups

    df = spark.range(6000).select("id", F.when(F.col("id") % 3 != 0, F.lit(-1)).when(F.col("id") % 6 != 0, F.col("id")).alias("k"), F.lit(1).alias("group_n"))
    groups = df.groupBy(F.col("k").alias("of")).agg(F.count(F.lit(1)).alias("n"), F.min("id").alias("least"))
    made = join_groups(df, groups, {"k": "of"}, "n", ["least"], F.xxhash64("id"))
    assert made.columns == ["id", "k", "group_n", "least"] and made.count() == 6000
    assert made.where("least <> CASE WHEN k = -1 THEN 1 WHEN k IS NULL THEN 0 ELSE id END OR least IS NULL").count() == 0
    # a fixed number of partitions is for keys that are never null: the rows move once
    dealt = join_groups(df.where("k IS NOT NULL"), groups.where("of IS NOT NULL"), {"k": "of"}, "n", ["least"], F.xxhash64("id"), 5)
    assert dealt.count() == 5000 and dealt.rdd.getNumPartitions() == 5
    assert dealt.where("least <> CASE WHEN k = -1 THEN 1 ELSE id END OR least IS NULL").count() == 0
