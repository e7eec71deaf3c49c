"""Dimension layer: the daily movie snapshot."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from recolake.operators.ods import stamp_date


def movie_snapshot(movies: DataFrame, date: str) -> DataFrame:
    """Movies with a key, stamped with the snapshot date.  The null filter is
    pushed into the source scan (Parquet or JDBC) by Catalyst."""
    return stamp_date(movies.filter(F.col("mid").isNotNull()), date)
