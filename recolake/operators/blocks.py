"""Block-pair scheduling for exact all-pairs kernels.

Rows are hashed into ``n`` blocks of bounded size.  Each row is then copied
to the ``n`` block pairs it belongs to, and Spark groups by pair, so every
task sees at most two blocks: memory per task is bounded by the block size,
never by the data or by a hot key.  Each unordered block pair is visited
exactly once; a kernel evaluates the pair with vectorised numpy and emits
only qualifying results.

Blocks that are packed into one row each are not copied: they are stored once,
and the tasks read the blocks of their block pairs from the stored table.
"""

from __future__ import annotations

import math
from collections.abc import Callable

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BLOCK = "_blk"
LO = "_lo"
HI = "_hi"


# Enough blocks that the block pairs give every core a few tasks.
PAIRS_PER_CORE = 4


def n_blocks(n_rows: int, block_size: int, cores: int | None = None) -> int:
    """Blocks of at most ``block_size`` rows; with ``cores``, at least enough
    blocks for PAIRS_PER_CORE block pairs per core (small inputs only)."""
    nb = max(1, math.ceil(n_rows / max(1, block_size)))
    if cores:
        floor = math.ceil(math.sqrt(2 * PAIRS_PER_CORE * cores))
        nb = max(nb, min(floor, max(1, n_rows)))
    return nb


def with_block(df: DataFrame, id_col: str, n: int) -> DataFrame:
    from recolake.session import ship_package
    ship_package(df.sparkSession)  # the kernels run in Python workers
    return df.withColumn(BLOCK, F.pmod(F.xxhash64(F.col(id_col)), F.lit(n)).cast("int"))


# Packed blocks of a file, so that reading one stays small.
BLOCKS_PER_FILE = 4


def self_pairs(df: DataFrame, id_col: str, n: int, pack: Callable[[pd.DataFrame], pd.DataFrame] | None = None,
               schema: str = "") -> DataFrame:
    """Copy each row to every unordered block pair (lo <= hi) containing its block.

    ``pack`` makes one row (the block's number and ``schema``) of a block's rows.
    Then every unordered block pair is one row with the columns of both, suffixed
    1 and 2, and what is written grows with the table, not with the pairs."""
    b = with_block(df, id_col, n)
    if pack is not None:
        return _packed_pairs(b.groupBy(BLOCK).applyInPandas(pack, f"{BLOCK} int, {schema}"))
    other = F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    return (b.select("*", other.alias("_other"))
            .withColumn(LO, F.least(F.col(BLOCK), F.col("_other")))
            .withColumn(HI, F.greatest(F.col(BLOCK), F.col("_other")))
            .drop("_other"))


def _packed_pairs(packed: DataFrame) -> DataFrame:
    from recolake.session import scratch_path
    spark = packed.sparkSession
    path = scratch_path(spark, "blocks")
    packed.write.option("maxRecordsPerFile", BLOCKS_PER_FILE).parquet(path)
    one, two = (spark.read.parquet(path).select(*[F.col(c).alias(f"{c}{i}") for c in packed.columns]) for i in (1, 2))
    x, y = F.col(f"{BLOCK}1"), F.col(f"{BLOCK}2")
    # one of (x, y) and (y, x), spread evenly; partitions of the stored table meet, nothing is shuffled
    return one.join(two.hint("shuffle_replicate_nl"), (x == y) | ((x < y) == (F.pmod(x + y, F.lit(2)) == 0)))


def cross_pairs(left: DataFrame, right: DataFrame, left_id: str, right_id: str,
                n_left: int, n_right: int) -> DataFrame:
    """Rows of two different tables scheduled on (left block, right block)
    pairs; a ``_side`` column tells them apart (0 = left, 1 = right).  Both
    inputs must have the same columns apart from the id names."""
    lb = with_block(left, left_id, n_left).select(
        "*", F.col(BLOCK).alias(LO), F.explode(F.sequence(F.lit(0), F.lit(n_right - 1))).alias(HI),
        F.lit(0).alias("_side"))
    rb = with_block(right, right_id, n_right).select(
        "*", F.explode(F.sequence(F.lit(0), F.lit(n_left - 1))).alias(LO), F.col(BLOCK).alias(HI),
        F.lit(1).alias("_side"))
    return lb.unionByName(rb)
