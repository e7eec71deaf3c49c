"""Checked queries for key/value table operations over the customer cells."""

from __future__ import annotations

from pyspark.sql import functions as F

from recolake.operators import kv
from recolake.plans.registry import register
from recolake.session import scratch_path
from recolake.sources import fixtures as fx
from recolake.sources.fixtures import KV_SQL, with_ctes

START, STOP = "Customer#000000100", "Customer#000000900"


_PUTS_SQL = """puts AS (
  SELECT c.c_name AS rowkey, 'info' AS family, 'last_order' AS qualifier,
         CAST(o.o_orderkey AS VARCHAR) AS value, CAST(epoch(o.o_orderdate) AS BIGINT) AS ts
  FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey)"""


def _puts(spark, sf_dir):
    o = fx.table(spark, sf_dir, "orders")
    c = fx.table(spark, sf_dir, "customer")
    return (o.join(c, o.o_custkey == c.c_custkey)
            .select(F.col("c_name").alias("rowkey"), F.lit("info").alias("family"),
                    F.lit("last_order").alias("qualifier"), F.col("o_orderkey").cast("string").alias("value"),
                    F.expr("timestampdiff(SECOND, TIMESTAMP_NTZ'1970-01-01 00:00:00', o_orderdate)").alias("ts")))


# Cells with several versions and two families: the customer columns, up to
# five orders per customer as versions of one cell, and the same qualifier in
# another family.
_CELLS_SQL = """cells AS (
  SELECT rowkey, family, qualifier, value, ts FROM (
    SELECT *, row_number() OVER (PARTITION BY rowkey, family, qualifier ORDER BY ts DESC, value DESC) AS v,
           dense_rank() OVER (PARTITION BY rowkey, family, qualifier ORDER BY ts DESC) AS version,
           row_number() OVER (PARTITION BY rowkey, family, qualifier, ts ORDER BY value DESC) AS same
    FROM (SELECT * FROM kv UNION ALL SELECT * FROM puts
          UNION ALL SELECT rowkey, 'log', qualifier, value, ts FROM puts)) WHERE version <= 5 AND same = 1),
newest AS (SELECT rowkey, family, qualifier, value, ts FROM (
  SELECT *, row_number() OVER (PARTITION BY rowkey, family, qualifier ORDER BY ts DESC) AS v FROM cells) WHERE v = 1)"""


def _cells(spark, sf_dir):
    puts = _puts(spark, sf_dir)
    both = puts.unionByName(puts.withColumn("family", F.lit("log")))
    return kv.upsert(fx.kv(spark, sf_dir), both, versions=5).drop("version")


@register("kv_range_scan", with_ctes(KV_SQL, _PUTS_SQL, _CELLS_SQL) + f"""
SELECT rowkey, family, qualifier, value FROM newest
WHERE rowkey >= '{START}' AND rowkey < '{STOP}'
  AND (family, qualifier) IN (('info', 'c_acctbal'), ('info', 'last_order'))""")
def kv_range_scan(spark, sf_dir):
    return kv.range_scan(_cells(spark, sf_dir), START, STOP, [("info", "c_acctbal"), ("info", "last_order")]).select(
        "rowkey", "family", "qualifier", "value")


@register("kv_range_filter", with_ctes(KV_SQL, _PUTS_SQL, _CELLS_SQL) + f""",
rng AS (SELECT * FROM newest WHERE rowkey >= '{START}' AND rowkey < '{STOP}'),
ok AS (SELECT rowkey FROM rng GROUP BY rowkey
       HAVING max(CASE WHEN family = 'info' AND qualifier = 'c_mktsegment' AND value = 'BUILDING' THEN 1 ELSE 0 END) = 1
           OR max(CASE WHEN family = 'info' AND qualifier = 'c_mktsegment' THEN 1 ELSE 0 END) = 0)
SELECT rowkey, family, qualifier, value FROM rng WHERE rowkey IN (SELECT rowkey FROM ok)""")
def kv_range_filter(spark, sf_dir):
    return kv.range_filter(_cells(spark, sf_dir), START, STOP, "info", "c_mktsegment", "BUILDING").select(
        "rowkey", "family", "qualifier", "value")


@register("kv_multi_get", with_ctes(KV_SQL, _PUTS_SQL, _CELLS_SQL) + """
SELECT rowkey, family, qualifier, value FROM newest
WHERE rowkey IN (SELECT c_name FROM customer WHERE c_acctbal > 5000)
  AND ((family = 'log' AND qualifier = 'last_order') OR qualifier = 'c_acctbal')""")
def kv_multi_get(spark, sf_dir):
    keys = fx.table(spark, sf_dir, "customer").filter(F.col("c_acctbal") > 5000).select(F.col("c_name").alias("rowkey"))
    return kv.multi_get(_cells(spark, sf_dir), keys, [("log", "last_order"), "c_acctbal"]).select(
        "rowkey", "family", "qualifier", "value")


def _stored(spark, sf_dir):
    """The cells as a stored table in key order."""
    path = scratch_path(spark, "cells")
    kv.store(_cells(spark, sf_dir), path)
    return spark.read.parquet(path)


@register("kv_stored_range", with_ctes(KV_SQL, _PUTS_SQL, _CELLS_SQL) + f"""
SELECT rowkey, family, qualifier, value FROM newest
WHERE rowkey >= '{START}' AND rowkey < '{STOP}'
  AND (family, qualifier) IN (('info', 'c_acctbal'), ('info', 'last_order'))""")
def kv_stored_range(spark, sf_dir):
    return kv.range_scan(_stored(spark, sf_dir), START, STOP, [("info", "c_acctbal"), ("info", "last_order")]).select(
        "rowkey", "family", "qualifier", "value")


@register("kv_stored_lookup", with_ctes(KV_SQL, _PUTS_SQL, _CELLS_SQL) + """
SELECT rowkey, family, qualifier, value FROM newest
WHERE rowkey IN (SELECT c_name FROM customer WHERE c_acctbal > 9900)
  AND ((family = 'log' AND qualifier = 'last_order') OR qualifier = 'c_acctbal')""")
def kv_stored_lookup(spark, sf_dir):
    keys = fx.table(spark, sf_dir, "customer").filter(F.col("c_acctbal") > 9900).select(F.col("c_name").alias("rowkey"))
    return kv.lookup(_stored(spark, sf_dir), keys, [("log", "last_order"), "c_acctbal"]).select(
        "rowkey", "family", "qualifier", "value")


@register("kv_upsert_latest", with_ctes(KV_SQL, _PUTS_SQL) + """
SELECT rowkey, family, qualifier, value, ts, CAST(version AS INTEGER) AS version FROM (
  SELECT *, dense_rank() OVER (PARTITION BY rowkey, family, qualifier ORDER BY ts DESC) AS version,
         row_number() OVER (PARTITION BY rowkey, family, qualifier, ts ORDER BY value DESC) AS same
  FROM (SELECT * FROM kv UNION ALL SELECT * FROM puts)) WHERE version <= 5 AND same = 1""")
def kv_upsert_latest(spark, sf_dir):
    stored = fx.kv(spark, sf_dir).withColumn("version", F.lit(1))
    return kv.upsert(stored, _puts(spark, sf_dir), versions=5)


@register("kv_delete", with_ctes(KV_SQL) + """
SELECT rowkey, family, qualifier, value FROM kv
WHERE rowkey NOT IN (SELECT c_name FROM customer WHERE c_nationkey = 0)""")
def kv_delete(spark, sf_dir):
    keys = fx.table(spark, sf_dir, "customer").filter(F.col("c_nationkey") == 0).select(F.col("c_name").alias("rowkey"))
    return kv.delete(fx.kv(spark, sf_dir), keys).select("rowkey", "family", "qualifier", "value")
