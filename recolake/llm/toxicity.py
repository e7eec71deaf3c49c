"""Toxicity: a support vector machine over a gap-weighted subsequence kernel,
with Nystroem landmarks, trained on labelled sentences.

The kernel of two strings sums, over all subsequences of ORDER symbols within
REACH places, the products of their weights; a subsequence that spans g more
places than symbols weighs DECAY ** g.  A word with an inserted character or
letters set apart still shares most of its subsequences with the plain word;
punctuation and digits are left out before.

Landmarks are words; a sentence's features are its kernel values with them,
whitened.  The machine is linear in these features, and every feature is linear
in the subsequence weights, so the trained machine folds into one weight per
subsequence: scoring a text needs no landmark.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field
from itertools import combinations, groupby

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from recolake.session import materialize

ORDER, REACH, DECAY = 4, 7, 0.6
WORDS = 32  # a sentence of more words is cut
LETTERS = 4096  # and a word of more characters
CHUNK = 1 << 19  # symbols in one numpy pass

_EDGE, _DROP = 31, 255  # the symbol between words; characters left out
_SYMBOL = np.full(0x110000, _DROP, dtype=np.uint8)
_SYMBOL[128:] = 27 + np.arange(128, 0x110000) % 4
_SYMBOL[97:123] = np.arange(1, 27)
_SYMBOL[32] = _EDGE
_SYMBOL[0] = 0
_END = re.compile(r"[.!?]+(?=\s|$)|\n")  # not inside of a word: letters may be set apart by points
# places of the second to last symbol, by the number of places left out
_PLACES = [[c for c in combinations(range(1, REACH), ORDER - 1) if c[-1] == ORDER - 1 + g] for g in range(REACH - ORDER + 1)]
CODES = 1 << (5 * ORDER)


def sentences(text: str | None) -> list[str]:
    """The whole text in lower case, cut at sentence ends, after WORDS words and
    inside of words over LETTERS characters.  A word repeated at once stands
    for one: else its small weights would add up."""
    out = []
    for s in _END.split((text or "").replace("\0", " ").lower()):
        words = [w for w, _ in groupby(s.split())]
        if len(s) > LETTERS:
            words = [w[i:i + LETTERS] for w in words for i in range(0, len(w), LETTERS)]
        out += [" ".join(words[i:i + WORDS]) for i in range(0, len(words), WORDS)]
    return out


def symbols(strings: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """The strings' symbols, each string between edges and followed by REACH - 1
    zeros, and where each begins."""
    if not strings:
        return np.zeros(0, dtype=np.int32), np.zeros(0, dtype=np.int64)
    joined = "".join(f" {s} \0" for s in strings)
    a = _SYMBOL[np.frombuffer(joined.encode("utf-32-le", "replace"), dtype=np.uint32)]
    a = a[a != _DROP]
    a = a[np.concatenate(([True], (a[1:] != _EDGE) | (a[:-1] != _EDGE)))]
    a = np.repeat(a, np.where(a == 0, REACH - 1, 1))
    zero = np.flatnonzero(a == 0)[REACH - 2::REACH - 1]
    return a.astype(np.int32), np.concatenate(([0], zero[:-1] + 1))


def _codes(a: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """For each shape of a subsequence: places left out, and the code that
    starts at every place (no code of a landmark has a zero symbol)."""
    size = len(a) - REACH + 1
    shifted = [a << (5 * (ORDER - 1 - k)) for k in range(ORDER)]
    for gaps, shapes in enumerate(_PLACES):
        for places in shapes:
            code = shifted[0][:size]
            for k, p in enumerate(places):
                code = code | shifted[k + 1][p:p + size]
            yield gaps, code


def chunks(strings: list[str]) -> Iterator[list[str]]:
    part, size = [], 0
    for s in strings:
        part.append(s)
        size += len(s) + REACH + 1
        if size >= CHUNK:
            yield part
            part, size = [], 0
    if part:
        yield part


def decide(strings: list[str], weights: np.ndarray) -> np.ndarray:
    """Sum of the subsequence weights of each string."""
    out = []
    for part in chunks(strings):
        a, starts = symbols(part)
        total = np.zeros(len(a))
        for gaps, code in _codes(a):
            total[:len(code)] += DECAY ** gaps * weights.take(code)
        out.append(np.add.reduceat(total, starts))
    return np.concatenate(out) if out else np.zeros(0)


@dataclass
class Landmarks:
    """Whitened kernel values with landmark strings."""

    strings: list[str]
    place: np.ndarray = field(init=False)  # code -> row of ``table``; the last row is zero
    codes: np.ndarray = field(init=False)
    table: np.ndarray = field(init=False)  # subsequence weights of the landmarks, whitened

    def __post_init__(self):
        a, starts = symbols(self.strings)
        owner = np.repeat(np.arange(len(starts)), np.diff(np.concatenate((starts, [len(a)]))))
        keys, vals = [], []
        for gaps, code in _codes(a):
            keys.append(code.astype(np.int64) + CODES * owner[:len(code)].astype(np.int64))
            vals.append(np.full(len(code), DECAY ** gaps))
        keys, vals = np.concatenate(keys), np.concatenate(vals)
        code = keys % CODES
        full = np.ones(len(keys), dtype=bool)
        for k in range(ORDER):
            full &= (code >> (5 * k)) & 31 != 0
        keys, inverse = np.unique(keys[full], return_inverse=True)
        vals = np.bincount(inverse, vals[full])
        self.codes, row = np.unique(keys % CODES, return_inverse=True)
        table = np.zeros((len(self.codes) + 1, len(self.strings)))
        table[row, keys // CODES] = vals
        norm = np.sqrt((table ** 2).sum(axis=0))
        table /= np.maximum(norm, 1e-9)
        value, vector = np.linalg.eigh(table.T @ table)
        kept = value > 1e-3
        self.table = table @ (vector[:, kept] / np.sqrt(value[kept]))
        self.place = np.full(CODES, len(self.codes), dtype=np.int32)
        self.place[self.codes] = np.arange(len(self.codes))

    def features(self, strings: list[str], rows: int = 256) -> np.ndarray:
        """One row of whitened kernel values per string."""
        out = np.zeros((len(strings), self.table.shape[1]), dtype=np.float32)
        table = self.table.astype(np.float32)
        for at in range(0, len(strings), rows):
            a, starts = symbols(strings[at:at + rows])
            owner = np.repeat(np.arange(len(starts)), np.diff(np.concatenate((starts, [len(a)]))))
            phi = np.zeros(len(starts) * len(table))
            for gaps, code in _codes(a):
                place = self.place[code]
                hit = place < len(self.codes)
                phi += DECAY ** gaps * np.bincount(owner[:len(code)][hit] * len(table) + place[hit], minlength=len(phi))
            out[at:at + rows] = phi.reshape(len(starts), -1).astype(np.float32) @ table
        return out

    def fold(self, w: np.ndarray) -> np.ndarray:
        """The machine with weights ``w`` over the features, as one weight per code."""
        out = np.zeros(CODES, dtype=np.float32)
        out[self.codes] = (self.table @ w)[:-1]
        return out


def choose_landmarks(strings: list[str], toxic: np.ndarray, marked: int, plain: int) -> list[str]:
    """Words as landmarks: the ``marked`` ones that stand most surely in
    sentences of label 1, and the ``plain`` most frequent others."""
    seen = [Counter(), Counter()]
    for s, y in zip(strings, toxic):
        seen[int(y)].update(set(s.split()))
    n = [max(1, int((toxic == k).sum())) for k in (0, 1)]
    rate = {w: (seen[1][w] + 0.1) / n[1] / ((seen[0][w] + 1) / n[0]) for w in seen[1]}
    gain = {w: seen[1][w] / n[1] * np.log(r) for w, r in rate.items() if r > 1}
    first = sorted(gain, key=lambda w: (-gain[w], w))[:marked]
    both = seen[0] + seen[1]
    rest = sorted(both.keys() - set(first), key=lambda w: (-both[w], w))[:plain]
    return first + rest


def train_svm(z: np.ndarray, y: np.ndarray, cost: float = 1.0, steps: int = 30) -> tuple[np.ndarray, float]:
    """Squared-hinge support vector machine in the primal (weights, bias), by
    Newton steps on the rows inside of the margin.  Both classes weigh the same."""
    x = np.concatenate((z, np.ones((len(z), 1), dtype=z.dtype)), axis=1)
    weight = np.where(y > 0, (y < 0).sum() / max(1, (y > 0).sum()), 1.0)
    ridge = np.eye(x.shape[1]) / cost
    ridge[-1, -1] = 1e-6
    w, inside = np.zeros(x.shape[1]), None
    for _ in range(steps):
        now = y * (x @ w) < 1
        if inside is not None and (now == inside).all():
            break
        inside = now
        part = x[inside].astype(np.float64)
        scaled = part * weight[inside, None]
        w = np.linalg.solve(ridge + part.T @ scaled, scaled.T @ y[inside])
    return w[:-1], float(w[-1])


def train_sentences(z: np.ndarray, toxic: np.ndarray, owner: np.ndarray, rounds: int = 3) -> tuple[np.ndarray, float]:
    """Labels belong to whole documents: after each round, a sentence of a
    document of label 1 keeps this label if the machine agrees or if it is the
    document's highest."""
    y = np.where(toxic == 1, 1.0, -1.0)
    w, bias = train_svm(z, y)
    for _ in range(rounds - 1):
        value = z @ w + bias
        y = np.where((toxic == 1) & (value > 0), 1.0, -1.0)
        by_owner = np.lexsort((-value, owner))
        highest = by_owner[np.concatenate(([True], np.diff(owner[by_owner]) != 0))]
        y[highest[toxic[highest] == 1]] = 1.0
        w, bias = train_svm(z, y)
    return w, bias


STATS = 7


def summary(values: np.ndarray) -> list[float]:
    """What of a document's sentences decides: the four highest values, the
    mean and the sum of the positive part, and the number of sentences."""
    top = np.full(4, -2.0)
    head = -np.sort(-values)[:4]
    top[:len(head)] = np.clip(head, -2, 6)
    over = np.maximum(values + 0.5, 0).sum()
    return [*top, over / (1 + len(values)), np.log1p(over), np.log1p(len(values))]


def logistic(x: np.ndarray, y: np.ndarray, steps: int = 30, ridge: float = 1.0) -> np.ndarray:
    """Weights (the last one is the bias) of a ridge logistic regression."""
    mean, scale = x.mean(axis=0), x.std(axis=0) + 1e-6
    x = np.concatenate(((x - mean) / scale, np.ones((len(x), 1))), axis=1)
    w = np.zeros(x.shape[1])
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        w += np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + ridge * np.eye(len(w)), x.T @ (y - p) - ridge * w)
    w[:-1] /= scale
    w[-1] -= w[:-1] @ mean
    return w


@dataclass(frozen=True)
class Model:
    """Subsequence weights (``codes``, ``values``) and bias of the machine."""

    codes: np.ndarray
    values: np.ndarray
    bias: float

    def table(self) -> np.ndarray:
        out = np.zeros(CODES, dtype=np.float32)
        out[self.codes] = self.values
        return out


def _sampled(docs: DataFrame, marks: DataFrame, per_class: int, per_doc: int, longest: int, most: int) -> pa.Table:
    """Sentences (key, owner, sentence, toxic) of ``per_class`` documents per
    label, at most ``per_doc`` of a row and ``most`` per label; documents,
    sentences and rows are picked by hash."""
    key = F.xxhash64("doc_id", F.lit(3))
    present = docs.select("doc_id").distinct().join(marks, "doc_id").select("doc_id", "toxic", key.alias("key"))
    picked = [present.where(F.col("toxic") == k).orderBy("key", "doc_id").limit(per_class) for k in (0, 1)]
    picked = picked[0].unionAll(picked[1])  # at most 2 x per_class rows

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for owner, toxic, text in zip(*(b.column(c).to_pylist() for c in ("key", "toxic", "text"))):
                own = [s for s in sentences(text) if len(s) <= longest]
                order = np.random.default_rng(owner & 0xFFFFFFFF).permutation(len(own))[:per_doc]
                yield pa.RecordBatch.from_pydict({
                    "owner": pa.array([owner] * len(order), pa.int64()), "toxic": pa.array([toxic] * len(order), pa.int32()),
                    "sentence": pa.array([own[i] for i in order], pa.string())})

    rows = materialize(docs.join(F.broadcast(picked), "doc_id").select("key", "toxic", "text")
                       .mapInArrow(cut, "owner long, toxic int, sentence string"), "toxicity_sentences")
    order = F.xxhash64("sentence", "owner")
    parts = [rows.where(F.col("toxic") == k).orderBy(order, "owner", "sentence").limit(most) for k in (0, 1)]
    return parts[0].unionAll(parts[1]).toArrow()  # at most 2 x most rows


def fit(docs: DataFrame, marks: DataFrame, per_class: int = 2000, per_doc: int = 48, longest: int = 1000,
        most: int = 24_000, marked: int = 160, plain: int = 96) -> Model | None:
    """Machine learned from ``docs`` (doc_id, text) and ``marks`` (doc_id, toxic
    0 or 1); None if a label has no sentence."""
    rows = _sampled(docs, marks, per_class, per_doc, longest, most)
    toxic = np.array(rows["toxic"].to_pylist(), dtype=np.int32)
    if len(set(toxic.tolist())) < 2:
        return None
    strings = rows["sentence"].to_pylist()
    landmarks = Landmarks(choose_landmarks(strings, toxic, marked, plain))
    w, bias = train_sentences(landmarks.features(strings), toxic, np.array(rows["owner"].to_pylist()))
    folded = landmarks.fold(w)
    codes = np.flatnonzero(folded)
    return Model(codes, folded[codes], bias)


def with_summary(docs: DataFrame, model: Model, columns: list[str]) -> DataFrame:
    """``columns`` and ``stats`` (summary of the sentences' values) of each row
    of ``docs``, which also has ``text``."""
    src = docs.select(*columns, "text")

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights = model.table()
        for b in batches:
            cut = [sentences(t.as_py()) for t in b.column("text")]
            value = decide([s for c in cut for s in c], weights) + model.bias
            at = np.cumsum([0] + [len(c) for c in cut])
            stats = np.array([summary(value[i:j]) for i, j in zip(at, at[1:])], dtype=np.float64).reshape(-1, STATS)
            yield pa.RecordBatch.from_arrays(
                [b.column(c) for c in columns] + [pa.ListArray.from_arrays(
                    pa.array(np.arange(0, stats.size + 1, STATS, dtype=np.int32)), pa.array(stats.ravel()))],
                [*columns, "stats"])

    kinds = ", ".join(f"{c} {src.schema[c].dataType.simpleString()}" for c in columns)
    return src.mapInArrow(scan, f"{kinds}, stats array<double>")


def score_toxicity(docs: DataFrame, labels: DataFrame, held_out: Column, id_col: str = "doc_id", text_col: str = "text",
                   label_col: str = "toxic", threshold: float = 0.3, calibration_rows: int = 20_000, **options) -> DataFrame:
    """One row per input row: doc_id, held_out, score (0 to 1, higher: label 1
    likelier) and predicted (1 from a score of ``threshold``).

    Learns from labelled rows for which ``held_out`` (an expression of
    ``doc_id``) is false: seven tenths of the ids train the machine (a bounded
    sample, see ``fit``), the others calibrate the documents' scores (at most
    ``calibration_rows``, picked by hash).  Null labels and labels of null or
    unknown ids are ignored; a document with several labels has the rounded
    mean; repeated rows score alike.  Null and empty texts have no sentence and
    get the score of that.  With one label or none in the sample every score is
    that label (0.5 without labels).  An empty table gives an empty result, and
    columns beside the id and the text, whatever their names, are not read.
    """
    src = docs.select(F.col(f"`{id_col}`").alias("doc_id"), F.col(f"`{text_col}`").alias("text"))
    marks = (labels.select(F.col(f"`{id_col}`").alias("doc_id"), F.col(f"`{label_col}`").alias("toxic"))
             .where("doc_id is not null and toxic is not null and not isnan(toxic)").groupBy("doc_id")
             .agg(F.round(F.avg("toxic")).cast("int").alias("toxic")).where(~held_out))
    fold = F.pmod(F.xxhash64("doc_id", F.lit(5)), F.lit(10)) < 3
    model = fit(src, marks.where(~fold), **options)
    out = ["doc_id", held_out.alias("held_out")]
    if model is None:
        share = marks.agg(F.avg("toxic")).first()[0]
        constant = F.lit(0.5 if share is None else float(share))
        return src.select(*out, constant.alias("score"), (constant >= threshold).cast("int").alias("predicted"))
    stats = materialize(with_summary(src, model, ["doc_id"]), "toxicity_summary")
    seen = (stats.where(~held_out & fold).join(marks, "doc_id").orderBy(F.xxhash64("doc_id", F.lit(9)), "doc_id")
            .limit(calibration_rows).select("stats", "toxic").toArrow())
    y = np.array(seen["toxic"].to_pylist(), dtype=np.float64)
    if len(set(y.tolist())) == 2:
        w = logistic(np.array(seen["stats"].to_pylist(), dtype=np.float64), y)
    else:  # nothing to calibrate with: the highest sentence's value
        w = np.array([2.0] + [0.0] * STATS)
    value = F.lit(float(w[-1]))
    for i in range(STATS):
        value = value + F.lit(float(w[i])) * F.get("stats", i)
    score = 1 / (1 + F.exp(-value))
    return stats.select(*out, score.alias("score"), (score >= threshold).cast("int").alias("predicted"))
