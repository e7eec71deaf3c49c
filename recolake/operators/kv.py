"""Key/value table operations over a long cell table.

A wide-column table is held as rows (rowkey, family, qualifier, value, ts):
one row per cell version.  Row keys compare as UTF-8 byte strings, which is
Spark's string order, so key ranges are plain filters that reach the scan.
Reads give the newest version of a cell unless more are asked for.  Columns are
named as (family, qualifier) pairs; a plain qualifier stands for every family.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

CELL = ["rowkey", "family", "qualifier", "value", "ts"]
ADDRESS = CELL[:3]


def newest(kv: DataFrame, versions: int = 1, wins: Column | None = None) -> DataFrame:
    """The newest ``versions`` versions of every cell, with ``version``
    (1 = newest).  Of versions with one ts a single one counts: where ``wins``
    is true, else the larger value."""
    first = [] if wins is None else [wins.desc()]
    cell = Window.partitionBy(*ADDRESS).orderBy(F.col("ts").desc(), *first, F.col("value").desc())
    by_ts = Window.partitionBy(*ADDRESS).orderBy(F.col("ts").desc())
    return (kv.withColumn("_repeats", F.lag("ts").over(cell).eqNullSafe(F.col("ts")))
            .withColumn("version", F.dense_rank().over(by_ts))
            .where(~F.col("_repeats") & (F.col("version") <= versions)).drop("_repeats"))


def latest(kv: DataFrame) -> DataFrame:
    """Newest version of every cell (of equal ts, the larger value)."""
    return newest(kv).select(*kv.columns)


def _named(columns: list, family: str | None = None) -> Column:
    """Whether a cell is one of ``columns``."""
    pairs = [c if isinstance(c, tuple) else (family, c) for c in columns]
    return reduce(lambda a, b: a | b, [
        (F.col("qualifier") == q) if f is None else (F.col("family") == f) & (F.col("qualifier") == q)
        for f, q in pairs])


def range_scan(kv: DataFrame, start: str, stop: str, columns: list | None = None,
               family: str | None = None, versions: int = 1) -> DataFrame:
    """Newest cells with start <= rowkey < stop, optionally only the given
    columns.  Key and column filters reach the scan; what is left is ranked."""
    out = kv.filter((F.col("rowkey") >= start) & (F.col("rowkey") < stop))
    if family is not None:
        out = out.filter(F.col("family") == family)
    if columns:
        out = out.filter(_named(columns, family))
    return newest(out, versions).select(*kv.columns)


def range_filter(kv: DataFrame, start: str, stop: str, family: str, column: str, value: str,
                 keep_missing: bool = True, versions: int = 1) -> DataFrame:
    """Newest cells of the rows in [start, stop) whose newest
    ``family:column`` equals ``value``.  With ``keep_missing`` (the store's
    default) rows that lack the column pass as well."""
    rng = newest(kv.filter((F.col("rowkey") >= start) & (F.col("rowkey") < stop)), versions)
    is_col = (F.col("family") == family) & (F.col("qualifier") == column) & (F.col("version") == 1)
    row = Window.partitionBy("rowkey")  # a row's cells: bounded by its columns x versions
    flagged = (rng.withColumn("_has", F.max(is_col.cast("int")).over(row))
               .withColumn("_hit", F.max((is_col & (F.col("value") == value)).cast("int")).over(row)))
    cond = (F.col("_hit") == 1) | (F.col("_has") == 0) if keep_missing else (F.col("_hit") == 1)
    return flagged.filter(cond).select(*kv.columns)


def multi_get(kv: DataFrame, keys: DataFrame, columns: list | None = None,
              key_col: str = "rowkey", versions: int = 1) -> DataFrame:
    """Newest cells of the given row keys (a DataFrame of keys, any size;
    repeated keys are harmless, a semi join never duplicates cells)."""
    out = kv.filter(_named(columns)) if columns else kv
    out = out.join(keys.select(F.col(key_col).alias("rowkey")), "rowkey", "left_semi")
    return newest(out, versions).select(*kv.columns)


# Parquet settings of a stored cell table: row groups and pages small enough that
# a key range or a single key touches few of them, and a bloom filter per row
# group for keys that its bounds do not rule out.
STORED = {
    "parquet.block.size": 16 << 20,
    "parquet.page.size": 64 << 10,
    "parquet.page.row.count.limit": 2000,
    "parquet.bloom.filter.enabled#rowkey": "true",
    "parquet.bloom.filter.adaptive.enabled": "true",
}
LOOKUP_KEYS = 1000  # keys that are looked up by a filter; more are joined


def store(kv: DataFrame, path: str, partitions: int | None = None, layout: dict | None = None) -> None:
    """Write cells in the order of their addresses, newest version first: files
    hold consecutive key ranges.  A row key over many cells spreads over files
    by family, qualifier and ts."""
    width = partitions or int(kv.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    order = [*ADDRESS, F.col("ts").desc()]
    (kv.repartitionByRange(width, *order).sortWithinPartitions(*order).write
     .options(**{k: str(v) for k, v in (STORED | (layout or {})).items()}).parquet(path))


def lookup(stored: DataFrame, keys: DataFrame, columns: list | None = None, key_col: str = "rowkey",
           versions: int = 1) -> DataFrame:
    """``multi_get`` on a stored table.  Up to LOOKUP_KEYS distinct keys become a
    filter of the scan, so bounds, page indexes and bloom filters leave out what
    holds none of them; more keys are met in a join, over the range they span."""
    wanted = keys.select(F.col(key_col).alias("rowkey")).where("rowkey is not null").distinct()
    few = [r[0] for r in wanted.limit(LOOKUP_KEYS + 1).collect()]  # bounded
    if len(few) <= LOOKUP_KEYS:
        out = stored.where(F.col("rowkey").isin(few))
        return newest(out.where(_named(columns)) if columns else out, versions).select(*stored.columns)
    low, high = wanted.agg(F.min("rowkey"), F.max("rowkey")).first()
    return multi_get(stored.where((F.col("rowkey") >= low) & (F.col("rowkey") <= high)), wanted, columns,
                     versions=versions)


def upsert(kv: DataFrame, puts: DataFrame, versions: int = 5) -> DataFrame:
    """Apply puts and keep the newest ``versions`` versions of every cell.
    Adds ``version`` (1 = newest).  A put replaces a stored version of the same
    ts; of puts of one ts the larger value counts.

    A stored table that carries ``version`` from an earlier upsert is ranked
    only where a put touches it: the other cells pass through an anti join on
    the cells' addresses, which moves nothing when the puts are few."""
    new = puts.select(*CELL, F.lit(1).alias("_put"))
    old = kv.select(*CELL, F.lit(0).alias("_put"))
    if "version" not in kv.columns:
        return newest(old.unionByName(new), versions, F.col("_put")).drop("_put")
    touched = puts.select(*ADDRESS).distinct()
    ranked = newest(old.join(touched, ADDRESS, "left_semi").select(*CELL, "_put").unionByName(new), versions,
                    F.col("_put")).drop("_put")
    return (kv.join(touched, ADDRESS, "left_anti").select(*CELL, "version").where(F.col("version") <= versions)
            .unionByName(ranked))


def delete(kv: DataFrame, keys: DataFrame, key_col: str = "rowkey") -> DataFrame:
    """Remove every cell of the given row keys."""
    return kv.join(keys.select(F.col(key_col).alias("rowkey")), "rowkey", "left_anti")
