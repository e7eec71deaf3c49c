"""Language identification: averaged embeddings of hashed subwords under a
linear softmax, trained by stochastic gradient descent in numpy, with a
temperature and a rejection threshold set on rows it did not learn from.

A document is the mean embedding of its byte 2- to 4-grams (A-Z lower-cased, a
space at either end, words joined by one space), hashed to a fixed table.
Training reads a bounded sample, ``per_lang`` documents of each language in
expectation, picked by a hash of their id; scoring reads every whole text.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

GRAMS = (2, 3, 4)
CHUNK = 1 << 20  # bytes hashed at once


def has_letter(text: str | None) -> bool:
    return next(filter(str.isalpha, text or ""), None) is not None


def subwords(text: str | None, buckets: int) -> np.ndarray:
    """Counts of a text's hashed subwords; ``buckets`` is a power of two."""
    shift = np.uint32(32 - (buckets.bit_length() - 1))
    data = np.frombuffer(b" " + b" ".join((text or "").encode().lower().split()) + b" ", dtype=np.uint8)
    total = np.zeros(buckets, dtype=np.int64)
    for at in range(0, len(data), CHUNK):
        part = data[at:at + CHUNK + GRAMS[-1] - 1].astype(np.uint32)
        for n in GRAMS:
            starts = min(CHUNK, len(part) - n + 1)
            if starts <= 0:
                continue
            h = np.full(starts, n, dtype=np.uint32)
            for k in range(n):
                h = h * np.uint32(257) + part[k:k + starts]
            h = (h * np.uint32(0x9E3779B1)) >> shift
            total += np.bincount(h, minlength=buckets)
    return total


@dataclass(frozen=True)
class Model:
    langs: list[str]
    table: np.ndarray  # buckets x langs: embedding times softmax weights
    bias: np.ndarray
    temperature: float = 1.0
    threshold: float = 0.0

    def logits(self, counts: np.ndarray) -> np.ndarray:
        return (counts @ self.table) / max(1, counts.sum()) + self.bias

    def predict(self, text: str | None) -> tuple[str, float, bool]:
        """Language, calibrated probability, and whether it is rejected."""
        if not self.langs or not has_letter(text):
            return "und", 0.0, True
        z = self.logits(subwords(text, len(self.table))) / self.temperature
        p = np.exp(z - z.max())
        p /= p.sum()
        best = int(p.argmax())
        return self.langs[best], float(p[best]), bool(p[best] < self.threshold)


def train(rows: list[tuple[str, np.ndarray, np.ndarray]], buckets: int, dim: int = 16, epochs: int = 8,
          batch: int = 32, rate: float = 30.0, seed: int = 3, false_rejects: float = 0.001,
          most: float = 0.5) -> Model:
    """Model of (lang, bucket numbers, counts) rows; every fifth row calibrates.

    The threshold is the largest probability, ``most`` at most, under which no
    more than ``false_rejects`` of the calibration rows fall."""
    langs = sorted({r[0] for r in rows})
    if not langs:
        return Model([], np.zeros((buckets, 0)), np.zeros(0))
    rng = np.random.default_rng(seed)
    order = rng.permutation(len(rows))
    held = order[::5] if len(rows) >= 20 else order
    learn = np.setdiff1d(order, held) if len(rows) >= 20 else order
    y = np.array([langs.index(r[0]) for r in rows])
    emb = rng.normal(0, 0.1, (buckets, dim)).astype(np.float32)
    out, bias = rng.normal(0, 0.1, (dim, len(langs))), np.zeros(len(langs))

    def dense(idx: np.ndarray) -> np.ndarray:
        x = np.zeros((len(idx), buckets), dtype=np.float32)
        for i, k in enumerate(idx):
            x[i, rows[k][1]] = rows[k][2] / rows[k][2].sum()
        return x

    for epoch in range(epochs):
        step = rate * (1 - epoch / epochs)
        order = rng.permutation(learn)
        for at in range(0, len(order), batch):
            idx = order[at:at + batch]
            x = dense(idx)
            v = x @ emb
            z = v @ out + bias
            p = np.exp(z - z.max(axis=1, keepdims=True))
            p /= p.sum(axis=1, keepdims=True)
            p[np.arange(len(idx)), y[idx]] -= 1
            p /= len(idx)
            back = p @ out.T
            out -= 0.1 * step * (v.T @ p)
            bias -= 0.01 * step * p.sum(axis=0)
            emb -= (x.T @ (step * back).astype(np.float32))
    table = emb @ out
    z = np.concatenate([dense(held[i:i + 64]) @ table + bias for i in range(0, len(held), 64)])

    def probabilities(t: float) -> np.ndarray:
        p = np.exp(z / t - (z / t).max(axis=1, keepdims=True))
        return p / p.sum(axis=1, keepdims=True)

    def loss(t: float) -> float:
        return float(-np.log(probabilities(t)[np.arange(len(held)), y[held]] + 1e-12).mean())

    best = min(np.geomspace(0.2, 5.0, 33).tolist(), key=loss)
    top = np.sort(probabilities(best).max(axis=1))
    return Model(langs, table, bias, best, float(min(most, top[int(false_rejects * len(top))])))


def fit(docs: DataFrame, learn: Column, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
        per_lang: int = 1000, buckets: int = 1 << 14, **options) -> Model:
    """Model of the rows for which ``learn`` (an expression of ``doc_id``)
    holds, ``lang`` is known and the text has a letter.

    Learns from at most ``per_lang`` rows of a language, picked by a hash of id
    and text, so the sample does not depend on the partitions; rows that repeat
    id, text and language count once, and rows without an id like any other."""
    src = (docs.select(F.col(f"`{id_col}`").alias("doc_id"), F.col(f"`{text_col}`").alias("text"),
                       F.col(f"`{lang_col}`").alias("lang"))
           .where(learn & F.col("lang").isNotNull() & F.col("text").isNotNull())
           .withColumn("h", F.xxhash64("doc_id", "text")))
    counts = {r["lang"]: r["n"] for r in src.groupBy("lang").agg(F.approx_count_distinct("h").alias("n")).collect()}
    if not counts:
        return train([], buckets, **options)
    # one row per language; a margin of 8 leaves per_lang rows with certainty
    share = F.create_map(*[F.lit(v) for k, c in counts.items() for v in (k, min(1.0, 8.0 * per_lang / max(1, c)))])
    some = src.where(F.pmod("h", F.lit(1 << 30)) < share[F.col("lang")] * (1 << 30))
    nth = F.row_number().over(Window.partitionBy("lang").orderBy("h"))
    chosen = some.select("lang", "h").distinct().withColumn("nth", nth).where(F.col("nth") <= per_lang).drop("nth")
    # at most per_lang rows of a language
    picked = some.join(F.broadcast(chosen), ["lang", "h"]).groupBy("lang", "h").agg(F.first("text").alias("text"))

    def featurise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = [(lang, subwords(t, buckets)) for t, lang in zip(b.column("text").to_pylist(),
                                                                    b.column("lang").to_pylist()) if has_letter(t)]
            at = [np.flatnonzero(c).astype(np.int32) for _, c in rows]
            yield pa.RecordBatch.from_arrays(
                [pa.array([r[0] for r in rows], pa.string()), pa.array(at, pa.list_(pa.int32())),
                 pa.array([c[i].astype(np.int32) for (_, c), i in zip(rows, at)], pa.list_(pa.int32()))],
                ["lang", "at", "n"])

    rows = picked.select("text", "lang").mapInArrow(featurise, "lang string, at array<int>, n array<int>")
    sample = []
    for b in rows.toArrow().to_batches():  # the bounded sample, as views of its buffers
        ends = b.column("at").offsets.to_numpy()
        at, n = (b.column(c).values.to_numpy() for c in ("at", "n"))
        sample += [(g, at[i:j], n[i:j]) for g, i, j in zip(b.column("lang").to_pylist(), ends[:-1].tolist(),
                                                          ends[1:].tolist())]
    # in an order that depends on the documents alone
    sample.sort(key=lambda r: (r[0], len(r[1]), r[2].sum(), r[1].tobytes(), r[2].tobytes()))
    return train(sample, buckets, **options)


def identify(docs: DataFrame, model: Model, text_col: str = "text", out: str = "language") -> DataFrame:
    """Every input row with a struct column ``out`` (lang_pred, score,
    rejected) added; an input column of that name is replaced.

    A null text and one without a letter are ``und`` with score 0 and rejected;
    so is every text under a model that learnt from nothing.  Repeated rows are
    judged alike; an empty table gives an empty result."""
    kind = pa.struct([("lang_pred", pa.string()), ("score", pa.float64()), ("rejected", pa.bool_())])

    def judge(texts: pa.Array) -> pa.Array:
        found = [model.predict(t.as_py()) for t in texts]
        lang, score, rejected = zip(*found) if found else ((), (), ())
        return pa.StructArray.from_arrays([pa.array(lang, pa.string()), pa.array(score, pa.float64()),
                                           pa.array(rejected, pa.bool_())], fields=list(kind))

    udf = F.arrow_udf(judge, "struct<lang_pred: string, score: double, rejected: boolean>")
    return docs.withColumn(out, udf(F.col(f"`{text_col}`")))


def recognised(docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """The input rows, with their columns as they are, whose language is not
    rejected (see ``identify``)."""
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"),
                       F.col(f"`{text_col}`").alias("text"))
    return (identify(rows, model).where("not language.rejected")
            .select(*[F.col("row").getField(c).alias(c) for c in docs.columns]))
