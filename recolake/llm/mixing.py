"""Temperature mixing of sources, realised as budgeted block permutations.

A source's weight is its token share raised to an exponent between 0 (all
sources alike) and 1 (as they come), normalised.  The exponent is bisected so
that the weights reach an entropy, or so that no source is repeated more often
than allowed.  Each source is then read in passes, every pass a permutation of
its own, until its share of the budget is used up; a block takes from every
source its weight's part of the block's tokens.

Positions are prefix sums over each pass of each source.  A pass is cut into
buckets by its permutation key, buckets are summed first and positions taken
within a bucket, so that no task sorts a whole source.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from recolake.llm.common import WS
from recolake.session import materialize

MOST_SOURCES = 100_000  # rows the driver takes, one per source; more stay a table
BUCKET_ROWS, MOST_BUCKETS = 512, 1 << 16
KEY_BITS = 60


@dataclass(frozen=True)
class Mix:
    """Exponent, token budget, and per source: tokens, weight, passes."""

    exponent: float
    budget: float
    tokens: dict[str, int]
    weights: dict[str, float]
    passes: dict[str, float]


def weights_at(tokens: dict[str, int], exponent: float) -> dict[str, float]:
    """Normalised weights; a source without tokens has weight 0."""
    total = sum(tokens.values())
    raw = {k: (v / total) ** exponent if v else 0.0 for k, v in tokens.items()}
    norm = math.fsum(raw.values())
    return {k: v / norm if norm else 0.0 for k, v in raw.items()}


def entropy(weights: dict[str, float]) -> float:
    return -math.fsum(w * math.log(w) for w in weights.values() if w)


def bisect(holds, rounds: int = 60) -> float:
    """The least exponent in [0, 1] for which ``holds``, true from there on
    (1 if it is true nowhere), to 6 places."""
    low, high = 0.0, 1.0
    if holds(low):
        return low
    for _ in range(rounds):
        mid = (low + high) / 2
        low, high = (low, mid) if holds(mid) else (mid, high)
    return round(high, 6)


def solve(tokens: dict[str, int], target_entropy: float | None = None, max_passes: float | None = None,
          budget: float | None = None) -> Mix:
    """The flattest mix whose entropy does not exceed ``target_entropy`` and in
    which no source is read more than ``max_passes`` times (None: no limit; both
    None: exponent 1).  ``budget`` None: the fewest tokens at which every source
    is read whole at least once.  With a budget, sources can be read in part,
    and a limit on passes can be out of reach: the exponent is then 1."""
    def spent(w: dict[str, float]) -> float:
        return budget if budget is not None else max((tokens[k] / v for k, v in w.items() if v), default=0.0)

    def holds(exponent: float) -> bool:
        w = weights_at(tokens, exponent)
        total = spent(w)
        return ((target_entropy is None or entropy(w) <= target_entropy + 1e-12) and
                (max_passes is None or all(total * v <= max_passes * tokens[k] * (1 + 1e-12) for k, v in w.items())))

    exponent = 1.0 if target_entropy is None and max_passes is None else bisect(holds)
    w = weights_at(tokens, exponent)
    total = spent(w)
    # a source without tokens is read once
    return Mix(exponent, total, dict(tokens), w,
               {k: round(total * w[k] / tokens[k], 9) if tokens[k] else 1.0 for k in tokens})


def solve_table(sources: DataFrame, target_entropy: float | None = None, max_passes: float | None = None,
                budget: float | None = None) -> DataFrame:
    """``solve`` for any number of sources: ``sources`` (a stored table of
    source, tokens and more) with ``weight`` and ``passes``.  A step of the
    bisection is one aggregate; the limit on passes binds at the smallest source
    and the budget at the largest."""
    full = sources.where("tokens > 0")
    total, least, most = full.agg(F.sum("tokens"), F.min("tokens"), F.max("tokens")).first()
    if total is None:
        return sources.withColumns({"weight": F.lit(0.0), "passes": F.lit(1.0)})
    share = F.col("tokens") / F.lit(float(total))

    def sums(exponent: float) -> tuple[float, float]:
        raw = F.pow(share, F.lit(exponent))
        return full.agg(F.sum(raw), F.sum(raw * F.log(share))).first()

    def spent(exponent: float, norm: float) -> float:
        return budget if budget is not None else most * norm / (most / total) ** exponent

    def holds(exponent: float) -> bool:
        norm, logs = sums(exponent)
        read = spent(exponent, norm) * (least / total) ** exponent / norm
        return ((target_entropy is None or math.log(norm) - exponent * logs / norm <= target_entropy + 1e-12) and
                (max_passes is None or read <= max_passes * least * (1 + 1e-12)))

    exponent = 1.0 if target_entropy is None and max_passes is None else bisect(holds, 30)
    norm = sums(exponent)[0]
    weight = F.when(F.col("tokens") > 0, F.pow(share, F.lit(exponent)) / F.lit(norm)).otherwise(F.lit(0.0))
    # a source without tokens is read once
    passes = F.when(F.col("tokens") > 0, F.round(F.lit(spent(exponent, norm)) * F.col("weight") / F.col("tokens"), 9))
    return sources.withColumn("weight", weight).withColumn("passes", passes.otherwise(F.lit(1.0)))


def n_words(text: Column) -> Column:
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(f"[^{WS[1:-1]}]+")).cast("long")


def key(doc_id: Column, nth: Column, seed: int) -> Column:
    """Permutation key of a document in a pass, uniform below 2^60."""
    text = F.concat_ws("|", F.lit(str(seed)), nth.cast("string"), F.coalesce(doc_id.cast("string"), F.lit("")))
    return F.conv(F.substring(F.md5(text.cast("binary")), 1, KEY_BITS // 4), 16, 10).cast("long")


def _plan(rows: DataFrame, limits: dict, block_tokens: int, seed: int, whole: DataFrame | None = None) -> DataFrame:
    """The readings of ``rows``, or of ``whole``: the same rows with more columns."""
    sources = materialize(rows.groupBy("source").agg(F.sum("n_tokens").alias("tokens"),
                                                     F.count(F.lit(1)).alias("docs")), "mix_sources")
    few = sources.count() <= MOST_SOURCES
    if few:
        mix = solve({r["source"]: r["tokens"] for r in sorted(sources.collect())}, **limits)
        solved = rows.sparkSession.createDataFrame([(k, mix.weights[k], mix.passes[k]) for k in mix.tokens],
                                                   "source string, weight double, passes double")
        solved = sources.join(F.broadcast(solved), "source")  # one row per source
    else:
        solved = solve_table(sources, **limits)
    buckets = F.greatest(F.lit(1), F.least(F.lit(MOST_BUCKETS), F.floor(F.col("docs") / BUCKET_ROWS)))
    table = solved.select("source", "tokens", "passes", F.greatest(F.col("weight") * block_tokens, F.lit(1e-9)).alias("quota"),
                          buckets.cast("int").alias("buckets"))
    table = F.broadcast(table) if few else materialize(table, "mix_table")

    def read(frame: DataFrame) -> DataFrame:
        return (frame.join(table, "source")
                .withColumn("pass", F.explode(F.sequence(F.lit(0), F.greatest(
                    F.ceil("passes").cast("int") - 1, F.lit(0)))))
                .withColumn("key", key(F.col("doc_id"), F.col("pass"), seed))
                .withColumn("bucket", F.shiftright(F.shiftright("key", 30) * F.col("buckets"), 30)))

    before = Window.partitionBy("source", "pass").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    earlier = (read(rows).groupBy("source", "pass", "bucket").agg(F.sum("n_tokens").alias("sum"))
               .select("source", "pass", "bucket", F.coalesce(F.sum("sum").over(before), F.lit(0)).alias("earlier")))
    within = (Window.partitionBy("source", "pass", "bucket").orderBy("key", "doc_id", "n_tokens")
              .rowsBetween(Window.unboundedPreceding, -1))
    placed = (read(rows if whole is None else whole).withColumn("inside", F.coalesce(F.sum("n_tokens").over(within), F.lit(0)))
              .join(earlier, ["source", "pass", "bucket"])
              .withColumn("start", F.col("pass") * F.col("tokens") + F.col("earlier") + F.col("inside")))
    # whole passes keep every row, also texts without tokens at their end; the last one is cut if it is read in part
    kept = placed.where((F.col("pass") + 1 <= F.col("passes")) | (F.col("start") < F.col("passes") * F.col("tokens")))
    return kept.withColumn("block", F.floor(F.col("start") / F.col("quota")).cast("long"))


def _named(docs: DataFrame, id_col: str, text_col: str, source_col: str, *more: Column) -> DataFrame:
    return docs.select(F.col(f"`{id_col}`").alias("doc_id"), F.coalesce(F.col(f"`{source_col}`"), F.lit("")).alias("source"),
                       n_words(F.col(f"`{text_col}`")).alias("n_tokens"), *more)


def _rows(docs: DataFrame, id_col: str, text_col: str, source_col: str) -> DataFrame:
    return materialize(_named(docs, id_col, text_col, source_col), "mix_rows")


def schedule(docs: DataFrame, block_tokens: int = 1 << 18, seed: int = 11, id_col: str = "doc_id",
             text_col: str = "text", source_col: str = "source", **limits) -> DataFrame:
    """One row for each reading of each input row: doc_id, source, pass (from
    0), n_tokens, start (tokens its source has given before it, all passes) and
    block.

    Tokens are words.  A null source counts as the empty name, a null text as
    one without tokens.  Rows that repeat an id are read like any others, next
    to each other.  An empty table gives an empty result.  Other input columns,
    whatever their names, are not read.  ``limits``: see ``solve``.
    """
    plan = _plan(_rows(docs, id_col, text_col, source_col), limits, block_tokens, seed)
    return plan.select("doc_id", "source", F.col("pass").cast("int").alias("pass"), "n_tokens", "start", "block")


def mixed(docs: DataFrame, seed: int = 11, id_col: str = "doc_id", text_col: str = "text",
          source_col: str = "source", block_tokens: int = 1 << 18, **limits) -> DataFrame:
    """The input rows, each as often as ``schedule`` reads it, with the input
    columns alone, in the order of the reading: partitions and the rows within
    them go by block, and in a block by how much of its part of the block a
    source has given, which keeps every pass's permutation.

    Nulls, empty texts, repeated rows and an empty table: as in ``schedule``.
    The columns come back as they are, whatever their names.  Texts are moved
    twice: to the buckets of their passes, and to the order."""
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")
    plan = _plan(_rows(docs, id_col, text_col, source_col), limits, block_tokens, seed,
                 _named(docs, id_col, text_col, source_col, row))
    # the block is the whole part of ``at``; readings without tokens before them share one and go by key
    return (plan.withColumn("at", F.col("start") / F.col("quota")).repartitionByRange("at", "key")
            .sortWithinPartitions("at", "key", "doc_id")
            .select(*[F.col("row").getField(c).alias(c) for c in docs.columns]))
