"""Quality and toxicity classifiers: held-out accuracy, parts of the models, edge cases."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from castwright.llm import catalog, quality_gam, toxicity, training
from castwright.llm.common import crc_mod

SF = "/root/testdata/sf0.01"


def accuracy(spark, df, label):
    labels = spark.read.parquet(f"{SF}/labels.parquet").select("doc_id", label)
    met = df.where("held_out").join(labels, "doc_id")
    return met.agg(F.avg((F.col("predicted") == F.col(label)).cast("double"))).first()[0]


def test_folds_follow_crc32(spark):
    import zlib

    rows = spark.range(200).select("id", crc_mod(F.col("id"), 5).alias("r")).collect()
    assert all(r["r"] == zlib.crc32(str(r["id"]).encode()) % 5 for r in rows)


def test_quality_held_out(spark):
    out = catalog.op6_quality_classifier(spark, SF).cache()
    assert out.count() == spark.read.parquet(f"{SF}/documents.parquet").count()
    assert out.where("score < 0 OR score > 1 OR score IS NULL OR (score >= 0.5) <> (predicted = 1)").count() == 0
    assert accuracy(spark, out, "quality") > 0.95
    out.unpersist()


def test_toxicity_held_out(spark):
    out = catalog.op4_toxicity(spark, SF).cache()
    assert out.count() == spark.read.parquet(f"{SF}/documents.parquet").count()
    assert out.where("score < 0 OR score > 1 OR score IS NULL OR (score >= 0.5) <> (predicted = 1)").count() == 0
    assert accuracy(spark, out, "toxic") > 0.88
    out.unpersist()


def test_gam_learns_an_interaction():
    r = np.random.default_rng(0)
    x = r.normal(size=(1500, 3))
    y = ((x[:, 0] > 0) ^ (x[:, 1] > 0)).astype(int)
    model = quality_gam.Gam(x, y, 1.0)
    assert (0, 1) in model.pairs
    fresh = r.normal(size=(500, 3))
    assert ((model.scores(fresh) >= 0.5) == ((fresh[:, 0] > 0) ^ (fresh[:, 1] > 0))).mean() > 0.9


def test_gam_score_is_a_sum_of_table_entries():
    r = np.random.default_rng(1)
    x = r.normal(size=(400, 2))
    model = quality_gam.Gam(x, (x[:, 0] > 0.3).astype(int), 1.0)
    one = x[7]
    total = model.base + sum(t[np.searchsorted(e, v, "right")] for t, e, v in zip(model.tables, model.edges, one))
    for table, (i, j) in zip(model.pair_tables, model.pairs):
        total += table[np.searchsorted(model.pair_edges[i], one[i], "right"), np.searchsorted(model.pair_edges[j], one[j], "right")]
    assert model.scores(one[None])[0] == pytest.approx(1 / (1 + np.exp(-total)))


def test_features_of_edge_texts():
    assert quality_gam.features(None) == quality_gam.features(" \n") == [0.0] * len(quality_gam.FEATURES)
    assert all(np.isfinite(quality_gam.features(t)).all() for t in ("a", "\x00", "é" * 10_000, "a a a\na a a", "|||"))


def test_pooled_response_is_the_largest_window():
    r = np.random.default_rng(2)
    texts = [toxicity.bucket_ids([b"good", b"day"] * 5 + [b"nastyword"] * int(k % 2)) for k in range(60)]
    model = toxicity.TextCnn(texts, np.arange(60) % 2, np.zeros(60, bool))
    ids = toxicity.bucket_ids([b"good", b"nastyword", b"unknown", b"day"])
    rows, _ = model._padded(model.row[ids])
    x, pooled = model.emb[rows].sum(1), []
    for k in toxicity.WIDTHS:
        windows = [sum(x[at + j] @ model.w[k][j] for j in range(k)) + model.b[k] for at in range(len(ids))]
        pooled.append(np.maximum(np.max(windows, axis=0), 0))
    assert model.logit(model.responses(ids)) == pytest.approx(float(np.concatenate(pooled) @ model.v + model.c), abs=1e-3)
    scorer = toxicity.Scorer(model)
    high, low, empty, none = scorer.scores(["good nastyword day", "good day", "", None])
    assert high > low and empty == none
    assert r is not None


def test_long_texts_are_pooled_in_parts(monkeypatch):
    r = np.random.default_rng(4)
    texts = [toxicity.bucket_ids([b"good", b"day"] * 5 + [b"nastyword"] * int(k % 2)) for k in range(60)]
    model = toxicity.TextCnn(texts, np.arange(60) % 2, np.zeros(60, bool))
    words = [toxicity.bucket_ids([b"good", b"day", b"nastyword", b"odd"])[r.integers(0, 4, n)] for n in (0, 1, 2, 9, 30)]
    whole = [model.logit(model.responses(ids)) for ids in words]
    for part in (1, 2, 7):
        monkeypatch.setattr(toxicity, "PART", part)
        assert [model.logit(model.responses(ids)) for ids in words] == whole


def test_a_repeated_id_is_one_row_of_the_sample(spark):
    rows = [(1, [2.0, 1.0], 0)] * 50 + [(1, [1.0, 5.0], 0), (2, [], 1), (None, [0.0], 1)]
    made = training.one_per_document(spark.createDataFrame(rows, "doc_id long, x array<double>, label int"), "label")
    assert sorted(map(tuple, made.select("doc_id", "x").collect()), key=str) == [(1, [1.0, 5.0]), (2, []), (None, [0.0])]


def test_held_out_labels_do_not_reach_the_model(spark):
    docs = spark.createDataFrame([(i, "word " * (i % 9 + 1) + "#" * (i % 2)) for i in range(60)], "doc_id long, text string")
    schema = "doc_id long, quality int"
    rows = [(i, i % 2) for i in range(60)]
    held = {r["doc_id"] for r in docs.where(crc_mod(F.col("doc_id"), quality_gam.MOD) == quality_gam.HELD_OUT).collect()}
    seen = [(d, v) for d, v in rows if d not in held]
    want = sum(v for _, v in seen) / sum(1 - v for _, v in seen)
    more = [(d, 1) for d in held] + [(None, 1)] * 9 + [r for r in seen if r[1]] * 3 + [(seen[0][0], 2)]
    plain = quality_gam.fit(docs, spark.createDataFrame(seen, schema))
    for labels in (rows, seen + more):
        made = quality_gam.fit(docs, spark.createDataFrame(labels, schema))
        assert held and made.base == pytest.approx(np.log(want)) == plain.base
        assert all(np.array_equal(a, b) for a, b in zip(made.tables, plain.tables))


def test_cut_lies_in_the_gap():
    assert toxicity.TextCnn._best_cut(np.array([-2.0, -1.0, 3.0, 4.0]), np.array([0, 0, 1, 1])) == 1.0
    assert toxicity.TextCnn._best_cut(np.array([1.0]), np.array([1])) == 0.0


def test_edge_tables(spark):
    docs = spark.createDataFrame([(1, None, "a"), (2, "", "b"), (2, "", "b"), (None, "some text", "c")], "doc_id long, text string, score string")
    labels = spark.createDataFrame([(1, 1, None), (None, 0, 1), (2, 7, 0)], "doc_id long, quality int, toxic int")
    for module, default in ((quality_gam, 0.5), (toxicity, 0.0)):
        assert module.fit(docs, labels) is None
        made = module.score(docs, None)
        assert sorted(r["score"] for r in made.collect()) == [default] * 4
        assert module.score(docs.limit(0), None).count() == 0
        assert module.fit(docs.limit(0), labels.limit(0)) is None
    kept = quality_gam.keep_good(docs, labels)
    assert kept.columns == docs.columns and kept.count() == 4


def test_the_training_sample_is_bounded_in_words(spark):
    rows = [(i, [1, 2, 3] * (i % 5)) for i in range(100)] + [(200, [1, 2, 3] * 50)]
    df = spark.createDataFrame(rows, "doc_id long, x array<int>")
    size = {d: len(x) // 3 for d, x in rows}
    kept = [r["doc_id"] for r in toxicity.bounded(df, each=10, whole=60).collect()]
    assert 200 not in kept and 50 <= sum(size[d] for d in kept) <= 60
    assert toxicity.bounded(df, each=10, whole=10_000).count() == 100 and toxicity.bounded(df.limit(0)).count() == 0
