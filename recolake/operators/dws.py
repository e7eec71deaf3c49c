"""Summary layer: rating statistics and per-genre top movies."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def count_by_month(ratings: DataFrame) -> DataFrame:
    """Non-null scores per (mid, yyyy-MM); a null time forms a null month."""
    return (ratings.filter(F.col("mid").isNotNull())
            .groupBy("mid", F.date_format("time", "yyyy-MM").alias("yearmonth"))
            .agg(F.count("score").alias("rating_count")))


def count_total(by_month: DataFrame) -> DataFrame:
    """Roll the monthly counts up to one count per movie."""
    return by_month.groupBy("mid").agg(F.sum("rating_count").alias("rating_count"))


def avg_score(ratings: DataFrame) -> DataFrame:
    return (ratings.filter(F.col("mid").isNotNull())
            .groupBy("mid").agg(F.avg("score").alias("avg")))


def partials(ratings: DataFrame, part_col: str = "date") -> DataFrame:
    """(mid, yearmonth, n, total, part_col): non-null scores and their sum by
    movie, month and partition of the input.  They merge to every statistic
    above, so a partition is aggregated once."""
    return (ratings.filter(F.col("mid").isNotNull())
            .groupBy("mid", F.date_format("time", "yyyy-MM").alias("yearmonth"), part_col)
            .agg(F.count("score").alias("n"), F.sum("score").alias("total")))


def merged_by_month(stored: DataFrame) -> DataFrame:
    """``count_by_month`` of the ratings behind stored partials, with the
    months' sums as ``total``."""
    return stored.groupBy("mid", "yearmonth").agg(F.sum("n").alias("rating_count"), F.sum("total").alias("total"))


def merged_avg(by_month: DataFrame) -> DataFrame:
    """``avg_score`` from ``merged_by_month``; null without a score."""
    return by_month.groupBy("mid").agg(F.try_divide(F.sum("total"), F.sum("rating_count")).alias("avg"))


def explode_genres(movies: DataFrame) -> DataFrame:
    """One row per (movie, genre); genres split on '|', untrimmed.  Movies
    with null genres produce no rows."""
    return movies.select("mid", "name", F.explode(F.split("genres", r"\|")).alias("genre"))


def genre_top(movies: DataFrame, avgs: DataFrame, k: int = 10) -> DataFrame:
    """Top ``k`` movies per genre by average score.

    Genres are grouped after trimming; the emitted ``genre`` keeps its
    blanks.  Ties on ``avg`` are broken by ``mid`` so the result is
    deterministic.  The rank filter is planned as a partial (map-side)
    WindowGroupLimit before the shuffle, so a genre holding a large share of
    the rows sends at most ``k`` rows per input partition across the network.
    """
    joined = (movies.select("mid", "name", "genres")
              .join(avgs.select("mid", "avg"), "mid")
              .select("mid", "name", F.explode(F.split("genres", r"\|")).alias("genre"), "avg"))
    w = Window.partitionBy(F.trim(F.col("genre"))).orderBy(F.col("avg").desc_nulls_last(), F.col("mid").asc())
    return (joined.withColumn("rank", F.row_number().over(w))
            .filter(F.col("rank") <= k))


# Presentation orders of the summary tables.  A partitioned table has no row
# order, so these are applied only when a caller asks for sorted output.
def order_by_month(by_month: DataFrame) -> DataFrame:
    return by_month.orderBy(F.col("yearmonth").desc(), F.col("rating_count").desc(), F.col("mid"))


def order_by_count(counts: DataFrame) -> DataFrame:
    return counts.orderBy(F.col("rating_count").desc(), F.col("mid"))


def order_by_avg(avgs: DataFrame) -> DataFrame:
    return avgs.orderBy(F.col("avg").desc(), F.col("mid"))
