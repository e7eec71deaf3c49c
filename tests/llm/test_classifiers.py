import random

import numpy as np
import pytest
from helpers import DOCS, clashing, edge_docs, prose
from pyspark.sql import functions as F

from recolake.llm import language_id, quality_classifier
from recolake.llm.common import crc_of_id
from recolake.llm.language_id import has_letter, subwords
from recolake.llm.quality_classifier import STATS, classify, isotonic, statistics

LABELS = "doc_id long, quality int, toxic int"


def test_statistics_of_odd_texts():
    assert len(statistics(b"one two two. Three!")) == len(STATS)
    for t in (None, b"", b" \n\t"):
        assert statistics(t) == [0.0] * len(STATS)
    for t in ("é" * 9, "#", "a\n\na", "x " * 5000):
        assert np.isfinite(statistics(t.encode())).all()


def test_isotonic_is_the_monotone_least_squares_fit():
    rng = np.random.default_rng(2)
    x, w = np.arange(40.0), rng.integers(1, 9, 40).astype(float)
    y = np.clip(x / 40 + rng.normal(0, 0.3, 40), 0, 1)
    kx, ky = isotonic(x, y, w)
    assert (np.diff(kx) > 0).all() and (np.diff(ky) > 0).all()
    # min-max formula of isotonic regression
    want = [max(min(np.average(y[a:b + 1], weights=w[a:b + 1]) for b in range(i, 40)) for a in range(i + 1))
            for i in range(40)]
    assert np.allclose(sorted(set(np.round(want, 9))), np.round(ky, 9))


def auc(score, y):
    pos, neg = score[y == 1], score[y == 0]
    return (pos[:, None] > neg[None, :]).mean() + 0.5 * (pos[:, None] == neg[None, :]).mean()


def test_held_out_quality(spark):
    sf = "/root/testdata/sf0.1"
    docs, labels = (spark.read.parquet(f"{sf}/{t}.parquet") for t in ("documents", "labels"))
    rows = classify(docs, labels, crc_of_id() % 3 == 1).where("held_out").join(labels, "doc_id").toPandas()
    assert auc(rows["score"].to_numpy(), rows["quality"].to_numpy()) > 0.98
    assert (rows["predicted"] == rows["quality"]).mean() > 0.97
    bins = rows.groupby(np.floor(rows["score"] * 5))
    assert all(abs(b["score"].mean() - b["quality"].mean()) < 0.15 for _, b in bins if len(b) >= 100)


@pytest.mark.parametrize("wrap", [lambda d: d, clashing])
def test_every_row_is_scored(spark, wrap):
    docs = wrap(edge_docs(spark, null_id=True))
    labels = spark.createDataFrame([(i, i % 2, 0) for i in range(30)] + [(3, None, 0), (4, 0, 0), (None, 1, 0)], LABELS)
    rows = classify(docs, labels, crc_of_id() % 3 == 1, features=16).collect()
    assert len(rows) == docs.count()
    for r in rows:
        assert 0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.5)


def test_without_labels_or_rows(spark):
    none = spark.createDataFrame([], LABELS)
    assert classify(spark.createDataFrame([], DOCS), none, F.lit(False)).count() == 0
    assert {r["score"] for r in classify(edge_docs(spark), none, F.lit(False)).collect()} == {0.5}
    one = spark.createDataFrame([(1, 1, 0)], LABELS)
    assert {r["score"] for r in classify(edge_docs(spark), one, F.lit(False)).collect()} == {1.0}


def test_partitions_do_not_change_the_model(spark):
    rng = random.Random(1)
    rows = [([rng.random() + (i % 2) * (k % 3) for k in range(len(STATS))], i % 2, i % 5 == 0) for i in range(200)]
    train = spark.createDataFrame(rows, "stats array<double>, quality int, fold boolean")
    a = quality_classifier.fit(train.coalesce(1), features=16)
    b = quality_classifier.fit(train.repartition(7), features=16)
    assert np.allclose(a.weights, b.weights) and np.allclose(a.knots[0], b.knots[0])


def test_subwords_of_chunks_equal_the_whole(monkeypatch):
    t = "Ein Satz mit Wörtern " * 50
    whole = subwords(t, 1 << 12)
    monkeypatch.setattr(language_id, "CHUNK", 13)
    assert (subwords(t, 1 << 12) == whole).all()
    n = len((" " + " ".join(t.split()) + " ").encode())
    assert whole.sum() == 3 * n - 6
    assert subwords(None, 1 << 12).sum() == 1  # two spaces


def test_letters():
    assert has_letter("12 é") and not has_letter("12 ½ _ ²") and not has_letter(None) and not has_letter("")


def test_held_out_languages(spark):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    held = crc_of_id() % 4 == 2
    model = language_id.fit(docs, ~held)
    rows = language_id.identify(docs, model).where(held).select("lang", "language.*").toPandas()
    assert (rows["lang"] == rows["lang_pred"]).mean() > 0.995
    assert rows["rejected"].mean() < 0.005
    assert model.predict("Thender the of and ing thation")[0] == "en"


@pytest.mark.parametrize("wrap", [lambda d: d, clashing])
def test_edges_of_identification(spark, wrap):
    docs = wrap(edge_docs(spark, null_id=True)).withColumn("language", F.lit(1))
    model = language_id.fit(docs, F.lit(True), per_lang=20, buckets=1 << 8)
    rows = language_id.identify(docs, model).collect()
    assert len(rows) == docs.count() and model.langs == ["en"]
    for r in rows:
        want = "en" if has_letter(r["text"]) else "und"
        assert r["language"]["lang_pred"] == want and r["language"]["rejected"] == (want == "und")
    empty = spark.createDataFrame([], DOCS)
    nothing = language_id.fit(empty, F.lit(True))
    assert language_id.identify(empty, nothing).count() == 0
    assert {r["language"]["lang_pred"] for r in language_id.identify(docs, nothing).collect()} == {"und"}


def test_low_confidence_is_rejected():
    rng = random.Random(0)

    def row(lang):
        c = subwords(" ".join(("aa" if lang == "x" else "bb") + prose(rng, 1, 9) for _ in range(30)), 1 << 8)
        at = np.flatnonzero(c)
        return lang, at, c[at]
    model = language_id.train([row("x") for _ in range(40)] + [row("y") for _ in range(40)], 1 << 8,
                              false_rejects=0.0, most=0.9)
    assert model.predict("aaw1 aaw2 aaw3")[0] == "x" and model.predict("bbw1 bbw3")[0] == "y"
    assert 0.5 <= model.threshold <= 0.9


def _sample(monkeypatch, docs, per_lang):
    """Rows that reach the training, by language."""
    monkeypatch.setattr(language_id, "train", lambda rows, buckets, **options: rows)
    rows = language_id.fit(docs, F.lit(True), per_lang=per_lang, buckets=1 << 8)
    return {g: sorted((r[1].tobytes(), r[2].tobytes()) for r in rows if r[0] == g) for g in {r[0] for r in rows}}


@pytest.mark.parametrize("doc_id", ["id", "id % 3", "7", "null"])
def test_language_sample_is_bounded_whatever_the_ids(spark, monkeypatch, doc_id):
    docs = spark.range(4000).selectExpr(f"cast({doc_id} as long) as doc_id", "concat('text number ', id, ' of them') as text",
                                        "if(id % 4 = 0, 'xx', 'yy') as lang")
    one, other = (_sample(monkeypatch, d, 100) for d in (docs, docs.repartition(9)))
    assert {g: len(r) for g, r in one.items()} == {"xx": 100, "yy": 100}
    assert one == other
    same = docs.selectExpr("cast(null as long) as doc_id", "'one text' as text", "lang")  # rows that repeat everything
    assert {g: len(r) for g, r in _sample(monkeypatch, same, 100).items()} == {"xx": 1, "yy": 1}


def test_training_step_is_the_gradient():
    """One epoch of one batch moves every parameter by its gradient, taken here
    by differences of the loss."""
    rng = np.random.default_rng(4)
    buckets, dim, n = 12, 16, 19  # fewer than 20 rows are one batch, none held out
    rows = [("ab"[i % 2], np.arange(buckets), rng.integers(1, 9, buckets)) for i in range(n)]
    model = language_id.train(rows, buckets, dim=dim, epochs=1, batch=32, rate=2.0, seed=3)
    again = np.random.default_rng(3)
    again.permutation(n)
    emb = again.normal(0, 0.1, (buckets, dim)).astype(np.float32).astype(float)
    out, bias = again.normal(0, 0.1, (dim, 2)), np.zeros(2)
    x = np.array([r[2] / r[2].sum() for r in rows])
    y = np.array([i % 2 for i in range(n)])

    def loss():
        z = x @ emb @ out + bias
        return float((np.log(np.exp(z).sum(axis=1)) - z[np.arange(n), y]).mean())

    def gradient(p):
        g = np.zeros_like(p)
        for i in np.ndindex(p.shape):
            keep = p[i]
            p[i] = keep + 1e-5
            up = loss()
            p[i] = keep - 1e-5
            g[i] = (up - loss()) / 2e-5
            p[i] = keep
        return g

    steps = [(p, rate * gradient(p)) for p, rate in ((emb, 2.0), (out, 0.2), (bias, 0.02))]
    for p, g in steps:
        p -= g
    assert np.allclose(model.table, emb @ out, atol=1e-5) and np.allclose(model.bias, bias, atol=1e-6)


def test_ridge_solves_the_normal_equations(spark):
    rng = np.random.default_rng(6)
    stats = rng.normal(size=(300, len(STATS)))
    y = (stats[:, 0] + rng.normal(size=300) > 0.4).astype(int)
    fold = np.arange(300) % 5 == 0
    train = spark.createDataFrame([(s.tolist(), int(q), bool(f)) for s, q, f in zip(stats, y, fold)],
                                  "stats array<double>, quality int, fold boolean").repartition(6)
    model = quality_classifier.fit(train, features=20, ridge=1e-2)
    z = model.features(stats[~fold])
    t = 2.0 * y[~fold] - 1
    share = np.where(y[~fold] == 1, 300 / (2 * y.sum()), 300 / (2 * (1 - y).sum()))
    left = z.T @ (share * (z @ model.weights - t)) + 1e-2 * 300 * model.weights
    assert np.abs(left).max() < 1e-7
    # the features' products approximate the Gaussian kernel
    wide = quality_classifier.fit(train, features=4000)
    a, b = wide.features(stats[:20])[:, :-1], wide.features(stats[20:40])[:, :-1]
    x0, x1 = (np.clip(((s - wide.mean) / wide.scale), -8, 8) for s in (stats[:20], stats[20:40]))
    width = 1.5 * np.sqrt(len(STATS))
    kernel = np.exp(-((x0 - x1) ** 2).sum(axis=1) / (2 * width ** 2))
    assert np.abs((a * b).sum(axis=1) - kernel).max() < 0.08
