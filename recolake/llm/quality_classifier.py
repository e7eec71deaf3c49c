"""Quality classifier: ridge regression on random Fourier features of document
statistics, calibrated by isotonic regression.

Every task sums its rows' outer products; the sums are added per matrix row, so
only a matrix of fixed size reaches the driver, which solves it.  The features
approximate a Gaussian kernel over the standardised statistics.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from recolake.session import materialize

STATS = ["log_chars", "log_words", "mean_word", "sd_word", "log_longest_word", "distinct", "distinct3", "top_word",
         "same_as_next", "upper", "digits", "high_bytes", "punctuation", "symbols", "exclaims", "stops", "commas",
         "log_lines", "same_lines", "line_words", "sd_line", "entropy", "odd_words", "capital_words"]

_CLASS = np.zeros((256, 8), dtype=np.float64)  # upper, digit, high, punctuation, symbol, !, .?, comma
for _i, _set in enumerate((range(65, 91), range(48, 58), range(128, 256),
                           [c for c in range(33, 127) if not chr(c).isalnum()], b"#*$%&|<>", b"!", b".?", b",")):
    _CLASS[list(_set), _i] = 1
_LETTER = np.array([chr(c).isalpha() or c >= 128 for c in range(256)])


def statistics(text: bytes | None) -> list[float]:
    """STATS of a whole UTF-8 text; all 0 if it has no word."""
    words = text.split() if text else []
    if not words:
        return [0.0] * len(STATS)
    n = len(words)
    sizes = np.fromiter(map(len, words), dtype=np.float64, count=n)
    chars = sizes.sum()
    counts = np.bincount(np.frombuffer(b"".join(words), dtype=np.uint8), minlength=256)
    upper, digit, high, punct, symbol, exclaim, stop, comma = counts @ _CLASS
    share = counts[counts > 0] / chars
    lines = [x for x in text.split(b"\n") if x.strip()]
    in_line = np.fromiter((len(x) for x in lines), dtype=np.float64, count=len(lines))
    triples = set(zip(words, words[1:], words[2:]))
    return [np.log1p(len(text)), np.log1p(n), sizes.mean(), sizes.std(), np.log1p(sizes.max()),
            len(set(words)) / n, len(triples) / max(1, n - 2), Counter(words).most_common(1)[0][1] / n,
            sum(map(bytes.__eq__, words, words[1:])) / n, upper / chars, digit / chars, high / chars, punct / chars,
            symbol / n, exclaim / n, stop / n, comma / n, np.log1p(len(lines)), 1 - len(set(lines)) / len(lines),
            np.log1p(n / len(lines)), np.log1p(in_line.std()), -float(share @ np.log2(share)),
            sum(not _LETTER[w[-1]] and not _LETTER[w[-2:][0]] for w in words) / n,
            sum(65 <= w[0] <= 90 for w in words) / n]


def with_statistics(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``doc_id`` and ``stats`` of every row."""
    src = docs.select(F.col(f"`{id_col}`").alias("doc_id"), F.col(f"`{text_col}`").cast("binary").alias("text"))
    id_type = src.schema["doc_id"].dataType.simpleString()

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            stats = np.array([statistics(t.as_py()) for t in b.column("text")], dtype=np.float64).reshape(-1, len(STATS))
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), pa.ListArray.from_arrays(
                    pa.array(np.arange(0, stats.size + 1, len(STATS), dtype=np.int32)), pa.array(stats.ravel()))],
                ["doc_id", "stats"])

    return src.mapInArrow(scan, f"doc_id {id_type}, stats array<double>")


@dataclass(frozen=True)
class Model:
    """Standardisation, Fourier directions, ridge weights and calibration; a
    model without directions scores everything at ``constant``."""

    constant: float
    mean: np.ndarray | None = None
    scale: np.ndarray | None = None
    directions: np.ndarray | None = None
    phases: np.ndarray | None = None
    weights: np.ndarray | None = None
    knots: tuple[np.ndarray, np.ndarray] | None = None

    def features(self, stats: np.ndarray) -> np.ndarray:
        x = np.clip((stats - self.mean) / self.scale, -8, 8)
        z = np.sqrt(2 / len(self.phases)) * np.cos(x @ self.directions + self.phases)
        return np.concatenate((z, np.ones((len(x), 1))), axis=1)

    def raw(self, stats: np.ndarray) -> np.ndarray:
        return self.features(stats) @ self.weights

    def score(self, stats: np.ndarray) -> np.ndarray:
        if self.directions is None:
            return np.full(len(stats), self.constant)
        return np.clip(np.interp(self.raw(stats), *self.knots), 0.0, 1.0)


def isotonic(x: np.ndarray, y: np.ndarray, w: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pool-adjacent-violators fit of means ``y`` (weights ``w``) over ascending
    ``x``: the blocks' mean x and value, which rise strictly in x."""
    blocks: list[list[float]] = []  # weight, sum of x, sum of y
    for a, b, c in zip(x, y, w):
        blocks.append([c, a * c, b * c])
        while len(blocks) > 1 and blocks[-2][2] * blocks[-1][0] >= blocks[-1][2] * blocks[-2][0]:
            last = blocks.pop()
            blocks[-1] = [p + q for p, q in zip(blocks[-1], last)]
    b = np.array(blocks)
    return b[:, 1] / b[:, 0], b[:, 2] / b[:, 0]


def _matrix(col) -> np.ndarray:
    return np.array(col.values.to_numpy()[col.offsets[0].as_py():col.offsets[-1].as_py()]).reshape(-1, len(STATS))


def fit(train: DataFrame, features: int = 256, ridge: float = 1e-3, width: float | None = None, seed: int = 7,
        bins: int = 512) -> Model:
    """Model of ``train`` (stats, quality 0 or 1, fold: true for the rows that
    calibrate).  All rows are used.  Both classes weigh the same in the ridge
    fit; calibration restores their shares.  With one class or no row the model
    is constant (0.5 without rows)."""
    moments = train.groupBy("quality").count().collect()
    counts = {int(r["quality"]): r["count"] for r in moments}
    if len(counts) < 2:
        return Model(float(next(iter(counts), 0.5)))
    dims = [F.get("stats", i) for i in range(len(STATS))]
    m = train.agg(*[F.avg(d) for d in dims], *[F.stddev_pop(d) for d in dims]).first()
    mean, scale = np.array(m[:len(STATS)]), np.maximum(np.array(m[len(STATS):]), 1e-6)
    rng = np.random.default_rng(seed)
    width = width or 1.5 * np.sqrt(len(STATS))
    model = Model(0.5, mean, scale, rng.normal(0, 1 / width, (len(STATS), features)), rng.uniform(0, 2 * np.pi, features))
    total = sum(counts.values())
    balance = {k: total / (2 * v) for k, v in counts.items()}

    def products(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        size = features + 1
        both = np.zeros((size, size + 1))
        for b in batches:
            y = b.column("quality").to_numpy().astype(np.float64)
            z = model.features(_matrix(b.column("stats")))
            w = np.where(y > 0.5, balance[1], balance[0])[:, None]
            both += (z * w).T @ np.concatenate((z, (2 * y - 1)[:, None]), axis=1)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.arange(size, dtype=np.int32)), pa.ListArray.from_arrays(
                pa.array(np.arange(0, both.size + 1, size + 1, dtype=np.int32)), pa.array(both.ravel()))], ["i", "row"])

    def add(pdf: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({"i": pdf["i"].iloc[:1], "row": [np.sum(pdf["row"].tolist(), axis=0)]})

    learn = train.where("not fold").select("stats", "quality")
    rows = (learn.mapInArrow(products, "i int, row array<double>").groupBy("i")
            .applyInPandas(add, "i int, row array<double>").orderBy("i").collect())  # features + 1 rows
    both = np.array([r["row"] for r in rows])
    gram = both[:, :-1] + ridge * total * np.eye(features + 1)
    weights = np.linalg.solve(gram, both[:, -1])
    model = Model(0.5, mean, scale, model.directions, model.phases, weights)

    def raw(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield pa.RecordBatch.from_arrays([pa.array(model.raw(_matrix(b.column("stats")))),
                                              b.column("quality").cast(pa.float64())], ["x", "y"])

    seen = (train.where("fold").select("stats", "quality").mapInArrow(raw, "x double, y double")
            .groupBy(F.floor(F.least(F.greatest(F.col("x"), F.lit(-2.0)), F.lit(2.0)) * (bins // 4)).alias("bin"))
            .agg(F.avg("x").alias("x"), F.avg("y").alias("y"), F.count(F.lit(1)).alias("w")).orderBy("bin").collect())
    if not seen:
        knots = (np.array([-1.0, 1.0]), np.array([0.0, 1.0]))
    else:
        x, y = isotonic(*(np.array([r[c] for r in seen], dtype=float) for c in "xyw"))
        # ends, so that scores still rise beyond the outer blocks
        knots = (np.concatenate(([x[0] - 1], x, [x[-1] + 1])),
                 np.concatenate(([y[0] / 2], np.clip(y, 1e-3, 1 - 1e-3), [(1 + y[-1]) / 2])))
        knots = (knots[0], np.maximum.accumulate(knots[1]))
    return Model(0.5, mean, scale, model.directions, model.phases, weights, knots)


def classify(docs: DataFrame, labels: DataFrame, held_out: Column, id_col: str = "doc_id", text_col: str = "text",
             label_col: str = "quality", **options) -> DataFrame:
    """One row per input row: doc_id, held_out, score (0 to 1, higher: label 1
    likelier) and predicted (1 from a score of 0.5).

    The model learns from the labelled rows for which ``held_out`` (an
    expression of ``doc_id``) is false, a fifth of them for the calibration.
    Null labels are ignored; a document with several labels has the rounded
    mean.  Null and empty texts have statistics of 0 and are scored like any
    other; repeated rows score alike; an empty table gives an empty result.
    Nothing but the text enters a score: other input columns, whatever their
    names, are not read.
    """
    stats = materialize(with_statistics(docs, id_col, text_col).withColumn("held_out", held_out), "quality_stats")
    marks = (labels.where(F.col(label_col).isNotNull()).groupBy(F.col(f"`{id_col}`").alias("doc_id"))
             .agg(F.round(F.avg(label_col)).cast("int").alias("quality")))
    fold = F.pmod(F.xxhash64("doc_id"), F.lit(5)) == 0
    train = materialize(stats.where("not held_out").join(marks, "doc_id").select("stats", "quality", fold.alias("fold")),
                        "quality_train")
    model = fit(train, **options)
    id_type = stats.schema["doc_id"].dataType.simpleString()

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            score = model.score(_matrix(b.column("stats")))
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), b.column("held_out"), pa.array(score),
                                              pa.array((score >= 0.5).astype(np.int32))],
                                             ["doc_id", "held_out", "score", "predicted"])

    return stats.mapInArrow(apply, f"doc_id {id_type}, held_out boolean, score double, predicted int")
