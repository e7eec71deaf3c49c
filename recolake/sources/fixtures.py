"""Views that present the driver's test tables in the shapes the jobs consume.

Each view has a Spark definition (a DataFrame over the parquet tables) and
the same definition as a DuckDB CTE, so that an oracle query reads exactly
the derived input the Spark query reads.  The mapping is documented in
FIXTURES.md.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


# ---------------------------------------------------------------- ratings
def ratings_l(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Large rating view: every line item is a rating by the order's customer."""
    li = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_quantity", "l_shipdate")
    od = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    return (li.join(od, li.l_orderkey == od.o_orderkey)
            .select(F.col("o_custkey").cast("int").alias("uid"),
                    F.col("l_partkey").cast("int").alias("mid"),
                    (F.floor("l_quantity").cast("int") % 5 + 1).cast("double").alias("score"),
                    F.col("l_shipdate").alias("time")))


RATINGS_L_SQL = """ratings_l AS (
  SELECT CAST(o.o_custkey AS INTEGER) AS uid, CAST(l.l_partkey AS INTEGER) AS mid,
         CAST(CAST(floor(l.l_quantity) AS INTEGER) % 5 + 1 AS DOUBLE) AS score,
         l.l_shipdate AS time
  FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey)"""


def ratings_e(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Event rating view: totally ordered by (ts, event_id) per user."""
    ev = table(spark, sf_dir, "events")
    return ev.select(F.col("event_id"),
                     F.col("user_id").cast("int").alias("uid"),
                     F.get_json_object("props", "$.k").cast("int").alias("mid"),
                     (F.col("event_id") % 5 + 1).cast("double").alias("score"),
                     F.col("ts").alias("time"))


RATINGS_E_SQL = """ratings_e AS (
  SELECT event_id, CAST(user_id AS INTEGER) AS uid,
         CAST(json_extract_string(props, '$.k') AS INTEGER) AS mid,
         CAST(event_id % 5 + 1 AS DOUBLE) AS score, ts AS time
  FROM events)"""


# ---------------------------------------------------------------- movies
def movies(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = table(spark, sf_dir, "part")
    return p.select(F.col("p_partkey").cast("int").alias("mid"),
                    F.col("p_name").alias("name"),
                    F.concat_ws(" | ", "p_type", "p_brand").alias("genres"),
                    F.col("p_name").alias("description"))


MOVIES_SQL = """movies AS (
  SELECT CAST(p_partkey AS INTEGER) AS mid, p_name AS name,
         p_type || ' | ' || p_brand AS genres, p_name AS description
  FROM part)"""


def corpus(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as movies with long descriptions (for TF-IDF)."""
    d = table(spark, sf_dir, "documents")
    return d.select(F.col("doc_id").cast("int").alias("mid"),
                    F.col("source").alias("name"),
                    F.col("text").alias("description"),
                    F.col("lang").alias("genres"))


CORPUS_SQL = """corpus AS (
  SELECT CAST(doc_id AS INTEGER) AS mid, source AS name, text AS description, lang AS genres
  FROM documents)"""


# ---------------------------------------------------------------- factors
def item_factors(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "embeddings")
    return e.select(F.col("vec_id").cast("int").alias("id"), F.col("embedding").alias("features"))


ITEM_FACTORS_SQL = """item_factors AS (
  SELECT CAST(vec_id AS INTEGER) AS id, embedding AS features FROM embeddings)"""


# Weight of the label's direction in ``clustered_factors``.
CLUSTER_PULL = 2.0


def clustered_factors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The item factors, each pulled towards the mean direction of its label:
    vectors in clusters, as those of a trained model are."""
    e = table(spark, sf_dir, "embeddings").select(F.col("vec_id").cast("int").alias("id"), "label", "embedding")
    mean = (e.select("label", F.posexplode("embedding").alias("pos", "x")).groupBy("label", "pos")
            .agg(F.avg(F.col("x").cast("double")).alias("x")).groupBy("label")
            .agg(F.sort_array(F.collect_list(F.struct("pos", "x"))).alias("m"),
                 F.sqrt(F.sum(F.col("x") * F.col("x"))).alias("norm")))
    return e.join(mean, "label").select("id", F.zip_with(
        "embedding", "m", lambda x, m: x.cast("double") + CLUSTER_PULL * m["x"] / F.col("norm")).alias("features"))


CLUSTERED_FACTORS_SQL = f"""elements AS (
  SELECT vec_id, label, unnest(embedding)::DOUBLE AS x, generate_subscripts(embedding, 1) AS pos FROM embeddings),
means AS (
  SELECT label, pos, m / sqrt(sum(m * m) OVER (PARTITION BY label)) AS m
  FROM (SELECT label, pos, avg(x) AS m FROM elements GROUP BY label, pos)),
clustered AS (
  SELECT CAST(vec_id AS INTEGER) AS id, list(x + {CLUSTER_PULL} * m ORDER BY pos) AS features
  FROM elements JOIN means USING (label, pos) GROUP BY vec_id)"""


# ---------------------------------------------------------------- streams
def rating_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rating events rendered as stream records (key, value JSON)."""
    return rating_records(ratings_e(spark, sf_dir))


def rating_records(r: DataFrame) -> DataFrame:
    """(key, value) records of rating rows (event_id, uid, mid, score, time)."""
    return r.select(F.col("event_id").cast("string").alias("key"),
                    F.to_json(F.struct(
                        "uid", "mid", "score",
                        F.date_format("time", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS").alias("time"))).alias("value"))


def tag_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = table(spark, sf_dir, "events")
    return ev.select(F.col("event_id").cast("string").alias("key"),
                     F.to_json(F.struct(
                         F.col("user_id").cast("int").alias("uid"),
                         F.get_json_object("props", "$.k").cast("int").alias("mid"),
                         F.col("event_type").alias("tag"),
                         F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS").alias("time"))).alias("value"))


# ---------------------------------------------------------------- key/value
KV_COLUMNS = ["c_custkey", "c_nationkey", "c_acctbal", "c_mktsegment"]


def kv(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customer as a long key/value table: one cell per (rowkey, qualifier)."""
    c = table(spark, sf_dir, "customer")
    cells = F.array(*[F.struct(F.lit(q).alias("qualifier"), F.col(q).cast("string").alias("value"))
                      for q in KV_COLUMNS])
    return (c.select(F.col("c_name").alias("rowkey"), F.explode(cells).alias("cell"))
            .select("rowkey", F.lit("info").alias("family"), "cell.qualifier", "cell.value",
                    F.lit(1).cast("bigint").alias("ts")))


KV_SQL = """kv AS (
  SELECT c_name AS rowkey, 'info' AS family, 'c_custkey' AS qualifier, CAST(c_custkey AS VARCHAR) AS value, CAST(1 AS BIGINT) AS ts FROM customer
  UNION ALL SELECT c_name, 'info', 'c_nationkey', CAST(c_nationkey AS VARCHAR), CAST(1 AS BIGINT) FROM customer
  UNION ALL SELECT c_name, 'info', 'c_acctbal', CAST(c_acctbal AS VARCHAR), CAST(1 AS BIGINT) FROM customer
  UNION ALL SELECT c_name, 'info', 'c_mktsegment', c_mktsegment, CAST(1 AS BIGINT) FROM customer)"""


def with_ctes(*ctes: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n"
