"""Shared pieces of the training-data operators: the white-space class, column
packing that no input column name can clash with, and stable row identities."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# White space of the contracts: space and the five ASCII controls 9 to 13.
# bytes.split() without arguments splits at exactly these six bytes.
WS = r"[\x20\x09-\x0D]"


def packed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``row`` (every input column), ``id`` and ``text``: whatever the input
    columns are called, none clashes with a working column."""
    return docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"),
                       F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").alias("text"))


def unpacked(df: DataFrame, docs: DataFrame, out: dict[str, Column]) -> DataFrame:
    """Input columns of ``docs`` from ``row``, then the columns of ``out``; an
    input column with the name of an output column is replaced by it."""
    taken = {k.lower() for k in out}
    return df.select(*[F.col("row").getField(c).alias(c) for c in docs.columns if c.lower() not in taken],
                     *[v.alias(k) for k, v in out.items()])


def width(df: DataFrame) -> int:
    """Shuffle width of the session."""
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def crc_of_id(col: str = "doc_id") -> Column:
    """crc32 of the id written as text (null id: of the empty text)."""
    return F.crc32(F.coalesce(F.col(col).cast("string"), F.lit("")).cast("binary"))
