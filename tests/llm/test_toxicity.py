import itertools
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from recolake.llm import toxicity as tx
from recolake.llm.common import crc_of_id
from recolake.llm.queries import QUERIES
from helpers import clashing, edge_docs, prose


def brute_weights(s):
    """Subsequence weights of a string, place by place."""
    a = [x for x in tx.symbols([s])[0].tolist() if x]
    out = {}
    for i in range(len(a)):
        for rest in itertools.combinations(range(i + 1, min(len(a), i + tx.REACH)), tx.ORDER - 1):
            key = (a[i], *(a[k] for k in rest))
            out[key] = out.get(key, 0) + tx.DECAY ** (rest[-1] - i + 1 - tx.ORDER)
    return out


def kernel(s, t):
    a, b = brute_weights(s), brute_weights(t)
    return sum(w * b.get(k, 0) for k, w in a.items())


STRINGS = ["you are an idiot", "you are an i d i o t", "idxiot", "a i.d-i*o t b", "é è moron é", "", "x", "nothing to see",
           "scum scummy scums"]
MARKS = ["idiot", "moron", "scum", "nothing", "the"]


def test_landmark_features_equal_brute_kernel():
    lm = tx.Landmarks(MARKS)
    gram = np.array([[kernel(a, b) for b in MARKS] for a in MARKS])
    norm = np.sqrt(np.diag(gram))
    value, vector = np.linalg.eigh(gram / np.outer(norm, norm))
    kept = value > 1e-3
    raw = np.array([[kernel(s, m) for m in MARKS] for s in STRINGS]) / norm
    want = raw @ (vector[:, kept] / np.sqrt(value[kept]))
    got = lm.features(STRINGS, rows=4)
    # eigenvectors are unique up to sign
    assert np.allclose(got @ got.T, want @ want.T, rtol=1e-4, atol=1e-4)


def test_folded_machine_equals_features():
    lm = tx.Landmarks(MARKS)
    w = np.random.default_rng(0).normal(size=lm.table.shape[1])
    assert np.allclose(tx.decide(STRINGS, lm.fold(w)), lm.features(STRINGS) @ w, rtol=1e-3, atol=1e-3)


def test_strings_do_not_touch_and_chunks_do_not_matter(monkeypatch):
    lm = tx.Landmarks(MARKS)
    weights = lm.fold(np.ones(lm.table.shape[1]))
    together = tx.decide(STRINGS * 3, weights)
    assert np.allclose(together, np.concatenate([tx.decide([s], weights) for s in STRINGS * 3]), atol=1e-5)
    monkeypatch.setattr(tx, "CHUNK", 20)
    assert np.allclose(together, tx.decide(STRINGS * 3, weights), atol=1e-5)
    assert len(tx.decide([], weights)) == 0


def test_svm_is_stationary():
    rng = np.random.default_rng(1)
    z = rng.normal(size=(400, 6)).astype(np.float32)
    y = np.where(z[:, 0] + 0.3 * rng.normal(size=400) > 0.8, 1.0, -1.0)
    w, bias = tx.train_svm(z, y, cost=0.7)
    weight = np.where(y > 0, (y < 0).sum() / (y > 0).sum(), 1.0)
    slack = np.maximum(0, 1 - y * (z @ w + bias))
    assert np.allclose(w / 0.7, z.T @ (weight * slack * y), atol=1e-4)
    assert abs((weight * slack * y).sum()) < 1e-3


def test_logistic_is_stationary():
    rng = np.random.default_rng(2)
    x = rng.normal(3, 2, size=(500, tx.STATS))
    y = (x[:, 0] + rng.normal(size=500) > 4).astype(float)
    w = tx.logistic(x, y)
    p = 1 / (1 + np.exp(-(x @ w[:-1] + w[-1])))
    scale = x.std(axis=0) + 1e-6
    assert np.allclose(((x - x.mean(axis=0)) / scale).T @ (y - p), w[:-1] * scale, atol=1e-6)


def test_sentences_hold_whole_texts():
    text = "One two. Three!! four\n" + " ".join(f"w{i}" for i in range(100)) + " " + "x" * 10_000
    kept = re.sub(r"[\s.!]", "", text.lower())
    assert "".join(tx.sentences(text)).replace(" ", "") == kept
    assert tx.sentences("a.b c. d") == ["a.b c", "d"]
    assert max(len(s.split()) for s in tx.sentences(text)) == tx.WORDS
    assert tx.sentences("the the the end end") == ["the end"]
    assert tx.sentences(None) == tx.sentences("") == tx.sentences(" \n.") == []


INSULTS = ["idiot", "moron", "worthless", "scum"]


def corpus(spark, n=600, seed=0):
    rng = random.Random(seed)
    docs, labels = [], []
    for i in range(n):
        words = prose(rng, rng.randrange(20, 80)).split()
        toxic = i % 4 == 0
        for k in range(3 * toxic):
            words.insert(rng.randrange(len(words)), rng.choice(INSULTS))
        for k in range(8, len(words), 9):
            words[k] += "."
        docs.append((i, " ".join(words)))
        if i % 5:
            labels.append((i, int(toxic)))
    return spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, toxic int")


OPTIONS = {"per_class": 200, "marked": 24, "plain": 40}


def test_learns_and_tolerates_gaps(spark):
    docs, labels = corpus(spark)
    odd = [(1000 + k, f"w1 w2 {w} w3 w4. w5 {w} w6 w7. w8 {w} w9") for k, w in enumerate(
        ["idiot", "i.d.i.o.t", "i-diot", "idi*ot", "wor-thless", "scum###", "IDIOT!!", "mooron", "w17"])]
    docs = docs.unionAll(spark.createDataFrame(odd, docs.schema))
    out = {r["doc_id"]: r for r in tx.score_toxicity(docs, labels, crc_of_id() % 4 == 2, **OPTIONS).collect()}
    held = [r for r in out.values() if r["held_out"] and r["doc_id"] < 1000]
    assert len(held) > 100
    hit = [r["predicted"] == int(r["doc_id"] % 4 == 0) for r in held]
    assert np.mean(hit) > 0.97
    assert [out[1000 + k]["predicted"] for k in range(9)] == [1] * 8 + [0]
    assert all(r["predicted"] == int(r["score"] >= 0.3) for r in out.values())


def test_held_out_labels_are_not_used(spark):
    docs, labels = corpus(spark, 300)
    other = labels.withColumn("toxic", F.when(crc_of_id() % 4 == 2, 1 - F.col("toxic")).otherwise(F.col("toxic")))
    a, b = (sorted(map(tuple, tx.score_toxicity(docs.repartition(n), x, crc_of_id() % 4 == 2, **OPTIONS).collect()))
            for n, x in ((3, labels), (5, other)))
    assert [r[:2] for r in a] == [r[:2] for r in b] and np.allclose([r[2] for r in a], [r[2] for r in b])


def test_edges(spark):
    docs = edge_docs(spark, null_id=True)
    big = docs.unionAll(spark.createDataFrame([(700, "ab cd. " * 150_000, "en", "s", 1), (701, "x" * 1_000_000, "en", "s", 1)],
                                              docs.schema))
    labels = spark.createDataFrame([(i, i % 2) for i in range(0, 40)] + [(None, 1), (5000, 1), (3, None), (4, 1)],
                                   "doc_id long, toxic int")
    out = tx.score_toxicity(clashing(big).withColumn("toxic", F.lit("x")), labels, crc_of_id() % 4 == 2, **OPTIONS)
    assert out.columns == ["doc_id", "held_out", "score", "predicted"]
    rows = out.collect()
    assert len(rows) == big.count() and all(0 <= r["score"] <= 1 for r in rows)
    assert tx.score_toxicity(docs.limit(0), labels, crc_of_id() % 4 == 2).collect() == []
    none = tx.score_toxicity(docs, labels.limit(0), crc_of_id() % 4 == 2).collect()
    assert {(r["score"], r["predicted"]) for r in none} == {(0.5, 1)}
    one = tx.score_toxicity(docs, labels.where("toxic = 0"), crc_of_id() % 4 == 2).collect()
    assert {(r["score"], r["predicted"]) for r in one} == {(0.0, 0)}


def test_bounds_hold_for_repeated_ids(spark):
    docs = spark.range(3000).select(F.lit(7).cast("long").alias("doc_id"), F.concat(F.lit("w"), F.col("id")).alias("text"))
    docs = docs.unionAll(docs.withColumn("doc_id", F.lit(8).cast("long")))
    marks = spark.createDataFrame([(7, 0), (8, 1)], "doc_id long, toxic int")
    rows = tx._sampled(docs, marks, per_class=10, per_doc=5, longest=100, most=50)
    assert rows.num_rows == 100


def test_query_held_out_accuracy(spark):
    out = QUERIES["op11_toxicity"].run(spark, "/root/testdata/sf0.1")
    labels = spark.read.parquet("/root/testdata/sf0.1/labels.parquet")
    held = out.where("held_out").join(labels, "doc_id").select("predicted", "toxic").collect()
    hits = sum(r["predicted"] and r["toxic"] for r in held)
    assert hits / sum(r["toxic"] for r in held) > 0.7 and hits / sum(r["predicted"] for r in held) > 0.7
