"""Quality rules by weak supervision (DataFrame functions only).

Each rule looks at a few statistics of a document and votes good (1), bad (-1)
or abstains (0).  Expectation-maximisation over the counts of vote patterns (at
most 3^rules rows, whatever the corpus) estimates each rule's accuracy, the
share of its votes that name the class; the posterior probability of good under
those accuracies is the verdict.  A rule that looks for a defect abstains where
it finds none.  Nothing is learnt from labels.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from recolake.llm.common import WS, packed, unpacked
from recolake.session import materialize

WINDOW = 8
STATS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_distinct", "n_upper",
         "n_punct", "n_stops"]


def _let(value: Column, body) -> Column:
    """``body`` over ``value``, which is evaluated once."""
    return F.transform(F.array(value), body)[0]


def _covered(hashes: Column) -> Column:
    """Words in windows whose hash occurs at least twice in the document."""
    def words_of(s: Column) -> Column:
        at = F.filter(
            F.transform(s, lambda x, k: F.when(
                x["h"].eqNullSafe(F.get(s, k - 1)["h"]) | x["h"].eqNullSafe(F.get(s, k + 1)["h"]), x["i"])),
            lambda i: i.isNotNull())
        # from each start to the next, a window's length at most
        return _let(F.array_sort(at), lambda p: F.aggregate(
            F.zip_with(p, F.slice(p, 2, F.greatest(F.size(p), F.lit(1))),
                       lambda a, b: F.least(F.lit(WINDOW), F.coalesce(b - a, F.lit(WINDOW)))),
            F.lit(0), lambda acc, x: acc + x))

    placed = F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i")))
    return F.when(F.size(F.array_distinct(hashes)) == F.size(hashes), F.lit(0)).otherwise(
        _let(F.array_sort(placed), words_of))


def with_statistics(src: DataFrame) -> DataFrame:
    """``row`` and ``id`` of the packed documents with the columns of STATS.

    A null text has no words and no lines."""
    text = F.coalesce(F.col("text"), F.lit(""))
    base = src.select(
        "row", "id",
        F.filter(F.split(text, f"{WS}+"), lambda w: w != "").alias("words"),
        F.filter(F.split(text, "\n"), lambda x: x.rlike(f"[^{WS[1:-1]}]")).alias("lines"),
        F.char_length(F.regexp_replace(text, f"{WS}+", "")).alias("word_chars"),
        F.regexp_count(text, F.lit(r"[#*$%&|<>]")).alias("n_symbols"),
        F.regexp_count(text, F.lit(r"\p{Lu}")).alias("n_upper"),
        F.regexp_count(text, F.lit(r"[^\p{L}\p{M}\p{N}\s]")).alias("n_punct"),
        F.regexp_count(text, F.lit(r"[.!?][\"')\]]*(?=[\x20\x09-\x0D]|$)")).alias("n_stops"))
    windows = F.when(F.size("words") >= WINDOW, F.transform(
        F.sequence(F.lit(1), F.size("words") - (WINDOW - 1)),
        lambda i: F.xxhash64(F.slice("words", i, WINDOW)))).otherwise(F.array().cast("array<bigint>"))
    hashed = base.select("*", windows.alias("windows"))
    return hashed.select("row", "id", *[x.cast("long").alias(n) for n, x in {
        "n_words": F.size("words"), "word_chars": F.col("word_chars"), "n_symbols": F.col("n_symbols"),
        "n_dup_lines": F.size("lines") - F.size(F.array_distinct("lines")),
        "n_repeat_words": _covered(F.col("windows")), "n_lines": F.size("lines"),
        "n_distinct": F.size(F.array_distinct("words")), "n_upper": F.col("n_upper"),
        "n_punct": F.col("n_punct"), "n_stops": F.col("n_stops")}.items()])


def _vote(bad: Column | bool, good: Column | bool) -> Column:
    return F.when(F.lit(bad), -1).when(F.lit(good), 1).otherwise(0)


def rules() -> dict[str, Column]:
    """Name and vote of each rule over the statistics of a document."""
    n, chars = F.greatest("n_words", F.lit(1)), F.greatest("word_chars", F.lit(1))
    mean = F.col("word_chars") / n
    symbols, upper, punct = F.col("n_symbols") / n, F.col("n_upper") / chars, F.col("n_punct") / chars
    repeats, dups = F.col("n_repeat_words") / n, F.col("n_dup_lines") / F.greatest("n_lines", F.lit(1))
    variety, stops = F.col("n_distinct") / n, F.col("n_stops") / n
    long = F.col("n_words") >= 50
    return {
        "word_length": _vote((mean < 2.5) | (mean > 12), False),
        "symbols": _vote(symbols > 0.2, False),
        "punctuation": _vote(punct > 0.1, False),
        "capitals": _vote(upper > 0.3, False),
        "lines": _vote(dups > 0.3, False),
        "repeats": _vote(repeats > 0.2, False),
        "variety": _vote(variety < F.when(F.col("n_words") < 100, 0.5).when(F.col("n_words") < 400, 0.35).otherwise(0.1),
                         variety > 0.6),
        "sentences": _vote(long & ((stops > 0.5) | (stops < 0.01)), (stops >= 0.03) & (stops <= 0.35)),
        "plain": _vote((punct > 0.1) & ((symbols > 0.2) | (upper > 0.3)), (punct < 0.08) & (upper < 0.15)),
    }


def fit(patterns: list[tuple[tuple[int, ...], int]], rounds: int = 200, accuracy: float = 0.9,
        strength: float = 0.1) -> tuple[float, list[float]]:
    """Expectation-maximisation over (votes, documents): the prior log-odds of
    good, and per rule the log-odds that one of its votes carries.

    A rule's accuracy is the expected share of its votes that name the class,
    under a prior that stands for ``strength`` of its votes (and two more) at
    ``accuracy``; it is kept between 0.5 and 0.999, so no vote counts against
    its own meaning.  Documents start at ``accuracy`` for every rule and even
    odds.  Without documents the prior log-odds are 0."""
    m = len(patterns[0][0]) if patterns else 0
    total = sum(c for _, c in patterns)
    prior, weights = 0.0, [math.log(accuracy / (1 - accuracy))] * m
    for _ in range(rounds if total else 0):
        post = [1 / (1 + math.exp(-max(-500.0, min(500.0, prior + sum(w * x for w, x in zip(weights, v))))))
                for v, _ in patterns]
        good = sum(p * c for p, (_, c) in zip(post, patterns))
        new = [math.log((good + 1) / (total - good + 1))]
        for j in range(m):
            cast = sum(c for v, c in patterns if v[j])
            right = sum(c * (p if v[j] > 0 else 1 - p) for p, (v, c) in zip(post, patterns) if v[j])
            extra = strength * cast + 2
            a = min(0.999, max(0.5, (right + accuracy * extra) / (cast + extra)))
            new.append(math.log(a / (1 - a)))
        moved = max(abs(a - b) for a, b in zip(new, [prior, *weights]))
        prior, weights = new[0], new[1:]
        if moved < 1e-9:
            break
    return prior, weights


def score_quality(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep: float = 0.5,
                  columns: list[str] | None = None) -> DataFrame:
    """Every input row (its ``columns``, by default all) with ``n_words``,
    ``word_chars``, ``n_symbols``, ``n_dup_lines``, ``n_repeat_words``,
    ``base_failed``, ``quality_prob`` and ``kept`` (input columns of these names
    are replaced).

    ``base_failed``: fewer than 20 words, or over 30 % of the words in repeated
    8-word windows.  ``kept``: not base_failed, and the posterior is at least
    ``keep``.  Null and empty texts have no words and fail the base.  Repeated
    rows are judged alike; an empty table gives an empty result.
    """
    columns = docs.columns if columns is None else columns
    src = packed(docs, id_col, text_col).withColumn(
        "row", F.struct(*[F.col("row").getField(c).alias(c) for c in columns]))
    stats = materialize(with_statistics(src), "quality_stats")
    votes = rules()
    counted = (stats.groupBy(*[v.alias(k) for k, v in votes.items()]).count()).collect()
    prior, weights = fit([(tuple(r[:-1]), r[-1]) for r in counted] or [((0,) * len(votes), 0)])
    odds = F.lit(prior)
    for w, v in zip(weights, votes.values()):
        odds = odds + F.lit(w) * v
    prob = 1 / (1 + F.exp(-odds))
    failed = (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))
    out = {**{c: F.col(c) for c in STATS[:5]}, "base_failed": failed, "quality_prob": prob,
           "kept": ~failed & (prob >= keep)}
    return unpacked(stats, docs.select(*[f"`{c}`" for c in columns]), out)
