"""SimHash near-duplicates and line dedup against plain statements of their rules."""

import hashlib
import random
import re

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from castwright.llm import line_dedup, simhash

SCHEMA = "doc_id long, text string"
EDGE = [(1, None), (2, ""), (3, " \n\t "), (4, "one"), (5, "one"), (5, "one"), (None, "a b c d e"), (6, "A b\x0bC d E"), (7, "é" * 50)]


def fingerprint(text):
    low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", low)
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 4]) for i in range(len(words) - 3)] or [" ".join(words)]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def groups(rows, radius=4):
    """Smallest id reachable of each row, by comparing every pair."""
    prints = [fingerprint(t) for _, t in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if bin(prints[i] ^ prints[j]).count("1") <= radius:
                root[find(i)] = find(j)
    ids = {}
    for i, (d, _) in enumerate(rows):
        ids.setdefault(find(i), []).append(d)
    return [(d, f"{prints[i]:016x}", min((x for x in ids[find(i)] if x is not None), default=None)) for i, (d, _) in enumerate(rows)]


def corpus(seed=3, n=60):
    r = random.Random(seed)
    words = ["".join(r.choice("abcdefgé") for _ in range(r.randint(2, 9))) for _ in range(400)]
    texts = [" ".join(r.choice(words) for _ in range(r.choice([3, 40, 300]))) for _ in range(n)]
    near = [" ".join(w if r.random() > 0.01 else "zz" for w in t.split()) for t in texts[:25]]
    return list(enumerate(texts + near + texts[:10], 10))


def test_shingle_hash_is_that_of_spark(spark):
    for text in ("a b c d", "é ü 日本 x", "x" * 100):
        assert spark.range(1).select(F.xxhash64(F.lit(text))).first()[0] & (2**64 - 1) == xxhash.xxh64_intdigest(text.encode(), 42)


@pytest.mark.parametrize("chunk", [1 << 20, 64])
def test_fingerprint(chunk, monkeypatch):
    monkeypatch.setattr(simhash.word_chunks, "__defaults__", (chunk,))
    for _, text in corpus() + EDGE:
        assert simhash.fingerprint(text) == fingerprint(text)


def test_components_match_brute_force(spark):
    rows = corpus() + EDGE
    made = simhash.near_duplicates(spark.createDataFrame(rows, SCHEMA), tile=8).collect()
    assert sorted(map(tuple, made), key=str) == sorted(groups(rows), key=str)


def test_tiles_find_all_close_pairs_and_stars_stay_small():
    r = np.random.default_rng(1)
    base = r.integers(0, 2**63, 40).astype(np.uint64)
    near = np.concatenate([base ^ (np.uint64(1) << np.uint64(k)) for k in range(12)])
    a = np.unique(np.concatenate([base, near]))
    found = {(i, j) for x, y in simhash.close_pairs(a, a, 4, block=16) for i, j in zip(x.tolist(), y.tolist())}
    want = {(i, j) for i in range(len(a)) for j in range(len(a)) if bin(int(a[i]) ^ int(a[j])).count("1") <= 4}
    assert found == want
    u, v = simhash.tile_links(a, a, 4)
    assert len(u) < len(a)


def test_long_chain_is_one_component(spark):
    edges = [(i, i + 1) for i in range(200)] + [(500, 501), (7, 7)]
    made = {r["node"]: r["root"] for r in simhash.star_components(spark.createDataFrame(edges, "u long, v long")).collect()}
    assert made == {i: 0 for i in range(1, 201)} | {501: 500}


def test_empty_and_representatives(spark):
    assert simhash.near_duplicates(spark.createDataFrame([], SCHEMA)).count() == 0
    rows = [(i, t, "x", i) for i, t in corpus() + EDGE]
    docs = spark.createDataFrame(rows, "doc_id long, text string, fp string, root long")
    kept = simhash.drop_near_duplicates(docs)
    assert kept.columns == docs.columns
    want = {d for d, _, c in groups([r[:2] for r in rows]) if d is not None and d == c}
    assert sorted(r["doc_id"] for r in kept.where("doc_id IS NOT NULL").collect()) == sorted(want)


def test_one_row_of_each_group_stays(spark):
    rows = [(5, "a b c d e"), (5, "a b c d e"), (5, "other words that stand alone here"), (None, "a b c d e"), (None, "only without an id"), (None, "only without an id"), (2, "OTHER words that stand alone here"), (9, None), (8, "")]
    kept = simhash.drop_near_duplicates(spark.createDataFrame([(d, t, 0) for d, t in rows], "doc_id long, text string, row int"))
    assert kept.columns == ["doc_id", "text", "row"]
    got = sorted(((r["doc_id"], r["text"]) for r in kept.collect()), key=str)
    assert got == sorted([(2, rows[6][1]), (5, "a b c d e"), (8, ""), (None, "only without an id")], key=str)


def lines_kept(rows, min_chars=20, min_docs=3):
    def key(line):
        k = re.sub("[A-Z]", lambda m: m[0].lower(), line.strip(" \t\n\x0b\x0c\r"))
        return k if len(k) >= min_chars else None

    holders = {}
    for d, text in rows:
        for k in {key(x) for x in (text or "").split("\n")} - {None}:
            holders.setdefault(k, []).append(d)
    last = {k: max((d for d in ds if d is not None), default=None) for k, ds in holders.items() if len(ds) >= min_docs}
    out = []
    for d, text in rows:
        lines = (text or "").split("\n")
        kept = [x for x in lines if key(x) not in last or last[key(x)] == d]
        out.append((d, len(lines), len(lines) - len(kept), "\n".join(kept)))
    return out


def line_rows():
    r = random.Random(5)
    pool = [f"Line number {i} with enough characters é" for i in range(30)] + ["short", "", "  ", "x" * 19, "é" * 20, " " + "y" * 19]
    rows = [(i, "\n".join(r.choice(pool).upper() if r.random() < 0.3 else "\t" + r.choice(pool) + " " for _ in range(r.randint(0, 8)))) for i in range(60)]
    return rows + [(3, None), (4, ""), (4, ""), (None, pool[0]), (None, pool[1] + "\n" + pool[0])]


@pytest.mark.parametrize("batches, fanout", [(1, 2), (5, 2), (4, 3)])
def test_line_dedup(spark, batches, fanout):
    rows = line_rows()
    docs = spark.createDataFrame([(d, t, 1, 2) for d, t in rows], "doc_id long, text string, lost int, n_lines int")
    made = line_dedup.dedup_lines(docs, batches=batches, fanout=fanout, counts=("n_all", "n_gone"))
    assert made.columns == [*docs.columns, "n_all", "n_gone"]
    got = [(r["doc_id"], r["n_all"], r["n_gone"], r["text"]) for r in made.collect()]
    assert sorted(got, key=str) == sorted(lines_kept(rows), key=str)
    assert line_dedup.dedup_lines(docs).columns == docs.columns


def test_runs_are_levelled_and_unseen_lines_found(spark):
    docs = spark.createDataFrame(line_rows(), SCHEMA)
    records = line_dedup.line_records(docs, batches=4).cache()
    runs = line_dedup.LineRuns(spark, fanout=2)
    for batch in range(3):
        runs.add(records.where(F.col("batch") == batch))
    assert [len(level) for level in runs.levels] == [1, 1]
    seen = {(r["h1"], r["h2"]) for r in records.where("batch < 3").collect()}
    fresh = {(r["h1"], r["h2"]) for r in runs.unseen(records.where("batch = 3")).collect()}
    assert fresh == {(r["h1"], r["h2"]) for r in records.where("batch = 3").collect()} - seen
    runs.add(records.where("batch = 3"))
    assert [len(level) for level in runs.levels] == [0, 0, 1]
    whole = runs.all()
    assert whole.count() == whole.select("h1", "h2").distinct().count()
    records.unpersist()


def test_line_dedup_empty(spark):
    made = line_dedup.dedup_lines(spark.createDataFrame([], SCHEMA), counts=("n_lines", "n_dropped"))
    assert made.collect() == []
    assert hashlib.sha256(b"").hexdigest().startswith("e3b0")
