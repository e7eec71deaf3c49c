"""Checked queries for the ODS, DIM and DWS layers."""

from __future__ import annotations

from pyspark.sql import functions as F

from recolake.operators import dim, dws, ods
from recolake.plans.registry import register
from recolake.sources import fixtures as fx
from recolake.sources.fixtures import (MOVIES_SQL, RATINGS_E_SQL, RATINGS_L_SQL,
                                       with_ctes)

# Fixed run date stamped on snapshot outputs by the checked queries.
RUN_DATE = "2024-01-31"


def _r6(c):
    return F.round(F.col(c), 6).alias(c)


# ------------------------------------------------------------------ DWS
@register("movie_count_by_month", with_ctes(RATINGS_L_SQL) + """
SELECT mid, strftime(time, '%Y-%m') AS yearmonth, count(score) AS rating_count
FROM ratings_l WHERE mid IS NOT NULL GROUP BY 1, 2""")
def movie_count_by_month(spark, sf_dir):
    return dws.count_by_month(fx.ratings_l(spark, sf_dir))


@register("movie_count", with_ctes(RATINGS_L_SQL) + """
SELECT mid, CAST(sum(rating_count) AS BIGINT) AS rating_count FROM (
  SELECT mid, strftime(time, '%Y-%m') AS yearmonth, count(score) AS rating_count
  FROM ratings_l WHERE mid IS NOT NULL GROUP BY 1, 2) GROUP BY mid""")
def movie_count(spark, sf_dir):
    return dws.count_total(dws.count_by_month(fx.ratings_l(spark, sf_dir)))


@register("movie_avg", with_ctes(RATINGS_L_SQL) + """
SELECT mid, round(avg(score), 6) AS avg FROM ratings_l WHERE mid IS NOT NULL GROUP BY mid""")
def movie_avg(spark, sf_dir):
    return dws.avg_score(fx.ratings_l(spark, sf_dir)).select("mid", _r6("avg"))


# The presentation orders; the checks compare rows, pytest their order.
@register("movie_months_sorted", with_ctes(RATINGS_L_SQL) + """
SELECT mid, strftime(time, '%Y-%m') AS yearmonth, count(score) AS rating_count
FROM ratings_l WHERE mid IS NOT NULL GROUP BY 1, 2 ORDER BY 2 DESC, 3 DESC, 1""")
def movie_months_sorted(spark, sf_dir):
    return dws.order_by_month(dws.count_by_month(fx.ratings_l(spark, sf_dir)))


@register("movie_counts_sorted", with_ctes(RATINGS_L_SQL) + """
SELECT mid, count(score) AS rating_count FROM ratings_l WHERE mid IS NOT NULL GROUP BY mid ORDER BY 2 DESC, 1""")
def movie_counts_sorted(spark, sf_dir):
    return dws.order_by_count(dws.count_total(dws.count_by_month(fx.ratings_l(spark, sf_dir))))


@register("movie_avgs_sorted", with_ctes(RATINGS_L_SQL) + """
SELECT mid, round(avg(score), 6) AS avg FROM ratings_l WHERE mid IS NOT NULL GROUP BY mid ORDER BY avg(score) DESC, 1""")
def movie_avgs_sorted(spark, sf_dir):
    return dws.order_by_avg(dws.avg_score(fx.ratings_l(spark, sf_dir))).select("mid", _r6("avg"))


@register("genre_explode", with_ctes(MOVIES_SQL) + """
SELECT mid, name, unnest(string_split(genres, '|')) AS genre FROM movies""")
def genre_explode(spark, sf_dir):
    return dws.explode_genres(fx.movies(spark, sf_dir))


GENRE_TOP_SQL = with_ctes(RATINGS_L_SQL, MOVIES_SQL) + """,
avgs AS (SELECT mid, avg(score) AS avg FROM ratings_l WHERE mid IS NOT NULL GROUP BY mid),
g AS (SELECT m.mid, m.name, unnest(string_split(m.genres, '|')) AS genre, a.avg
      FROM movies m JOIN avgs a ON m.mid = a.mid)
SELECT mid, name, genre, round(avg, 6) AS avg, rank FROM (
  SELECT *, CAST(row_number() OVER (PARTITION BY trim(genre) ORDER BY avg DESC NULLS LAST, mid ASC) AS INTEGER) AS rank
  FROM g) WHERE rank <= 10"""


@register("genre_top_movies", GENRE_TOP_SQL)
def genre_top_movies(spark, sf_dir):
    r = fx.ratings_l(spark, sf_dir)
    top = dws.genre_top(fx.movies(spark, sf_dir), dws.avg_score(r), k=10)
    return top.select("mid", "name", "genre", _r6("avg"), "rank")


# ------------------------------------------------------------------ ODS
@register("ods_rating_parse", with_ctes(RATINGS_E_SQL) + """
SELECT uid, mid, score, strftime(time, '%Y-%m-%d %H:%M:%S.%f') AS time, '""" + RUN_DATE + """' AS date
FROM ratings_e""")
def ods_rating_parse(spark, sf_dir):
    parsed = ods.stamp_date(ods.parse_ratings(fx.rating_json(spark, sf_dir)), RUN_DATE)
    return parsed.select("uid", "mid", "score",
                         F.date_format("time", "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("time"), "date")


@register("ods_online_parse", with_ctes(RATINGS_E_SQL) + """
SELECT uid, mid, score FROM ratings_e WHERE uid IS NOT NULL AND mid IS NOT NULL AND score IS NOT NULL""")
def ods_online_parse(spark, sf_dir):
    """Records without a time, as the online path reads them."""
    raw = fx.rating_json(spark, sf_dir)
    bare = raw.select("key", F.regexp_replace("value", r',"time":"[^"]*"', "").alias("value"))
    return ods.parse_online_ratings(bare).select("uid", "mid", "score")


@register("ods_tag_parse", """
SELECT CAST(user_id AS INTEGER) AS uid, CAST(json_extract_string(props, '$.k') AS INTEGER) AS mid,
       event_type AS tag, strftime(ts, '%Y-%m-%d %H:%M:%S.%f') AS time, '""" + RUN_DATE + """' AS date
FROM events""")
def ods_tag_parse(spark, sf_dir):
    parsed = ods.stamp_date(ods.parse_tags(fx.tag_json(spark, sf_dir)), RUN_DATE)
    return parsed.select("uid", "mid", "tag",
                         F.date_format("time", "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("time"), "date")


# ------------------------------------------------------------------ DIM
@register("dim_movie_snapshot", with_ctes(MOVIES_SQL) + """
SELECT mid, name, genres, description, '""" + RUN_DATE + """' AS date FROM movies WHERE mid IS NOT NULL""")
def dim_movie_snapshot(spark, sf_dir):
    return dim.movie_snapshot(fx.movies(spark, sf_dir), RUN_DATE)


# ------------------------------------------------------------------ sinks
SNAP_D1, SNAP_D2 = "2024-01-30", "2024-01-31"


@register("snapshot_overwrite", with_ctes(RATINGS_L_SQL, RATINGS_E_SQL) + f"""
SELECT mid, round(avg(score), 6) AS avg, '{SNAP_D1}' AS date FROM ratings_l WHERE mid IS NOT NULL GROUP BY mid
UNION ALL
SELECT mid, round(avg(score), 6) AS avg, '{SNAP_D2}' AS date FROM ratings_e WHERE mid IS NOT NULL GROUP BY mid""")
def snapshot_overwrite(spark, sf_dir):
    """Daily partitions of a summary table under dynamic overwrite: write
    date 1, write date 2, re-run date 1 with other input, write an empty
    frame for date 2 (skipped).  Only date 1 may change."""
    import uuid

    from recolake.session import scratch_path
    from recolake.sources.tables import Lakehouse

    lake = Lakehouse(spark, scratch_path(spark, "warehouse"), database=f"snap_{uuid.uuid4().hex[:12]}")
    ev = dws.avg_score(fx.ratings_e(spark, sf_dir))
    li = dws.avg_score(fx.ratings_l(spark, sf_dir))
    lake.write(ods.stamp_date(ev, SNAP_D1), "dws", "MovieAvgRating")
    lake.write(ods.stamp_date(ev, SNAP_D2), "dws", "MovieAvgRating")
    lake.write(ods.stamp_date(li, SNAP_D1), "dws", "MovieAvgRating")
    lake.write(ods.stamp_date(ev.limit(0), SNAP_D2), "dws", "MovieAvgRating")
    return lake.read("dws", "MovieAvgRating").select("mid", _r6("avg"), "date")


@register("ods_rating_ingest", with_ctes(RATINGS_E_SQL) + """
SELECT uid, mid, score, strftime(time, '%Y-%m-%d %H:%M:%S.%f') AS time, '""" + RUN_DATE + """' AS date
FROM ratings_e""")
def ods_rating_ingest(spark, sf_dir):
    """AvailableNow ingest of the rating records into the ODS table; a
    second run with no new records must append nothing."""
    import uuid

    from recolake.session import scratch_path
    from recolake.sources.events import read_events, write_records
    from recolake.sources.tables import Lakehouse
    from recolake.streaming.ingest import ingest

    root = scratch_path(spark, "ods_ingest")
    write_records(fx.rating_json(spark, sf_dir), f"{root}/events", "rating")
    lake = Lakehouse(spark, f"{root}/warehouse", database=f"ods_{uuid.uuid4().hex[:12]}")
    for _ in range(2):
        ingest(lake, read_events(spark, "rating", fmt="json", path=f"{root}/events"), "Rating", RUN_DATE)
    t = lake.read("ods", "Rating")
    return t.select("uid", "mid", "score", F.date_format("time", "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("time"), "date")


@register("ods_tag_ingest", """
SELECT CAST(user_id AS INTEGER) AS uid, CAST(json_extract_string(props, '$.k') AS INTEGER) AS mid,
       event_type AS tag, strftime(ts, '%Y-%m-%d %H:%M:%S.%f') AS time, '""" + RUN_DATE + """' AS date
FROM events""")
def ods_tag_ingest(spark, sf_dir):
    """AvailableNow ingest of the tag records into the ODS table."""
    import uuid

    from recolake.session import scratch_path
    from recolake.sources.events import read_events, write_records
    from recolake.sources.tables import Lakehouse
    from recolake.streaming.ingest import ingest

    root = scratch_path(spark, "ods_ingest")
    write_records(fx.tag_json(spark, sf_dir), f"{root}/events", "tag")
    lake = Lakehouse(spark, f"{root}/warehouse", database=f"ods_{uuid.uuid4().hex[:12]}")
    ingest(lake, read_events(spark, "tag", fmt="json", path=f"{root}/events"), "Tag", RUN_DATE)
    t = lake.read("ods", "Tag")
    return t.select("uid", "mid", "tag", F.date_format("time", "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("time"), "date")


LOG_PARTITIONS = 4

# Records in the order of their event, in partitions by event id.
_LOG_SQL = f"""logged AS (
  SELECT *, event_id % {LOG_PARTITIONS} AS partition,
         row_number() OVER (PARTITION BY event_id % {LOG_PARTITIONS} ORDER BY event_id) - 1 AS "offset" FROM ratings_e)"""


def _event_log(spark, sf_dir):
    """Folder of the rating records as a log, appended in two parts."""
    from recolake.session import scratch_path
    from recolake.sources.event_log import append_records

    root = scratch_path(spark, "event_log")
    recs = fx.rating_json(spark, sf_dir).withColumn("_id", F.col("key").cast("long"))
    recs = recs.withColumn("partition", (F.col("_id") % LOG_PARTITIONS).cast("int"))
    middle = recs.agg(F.expr("percentile_approx(_id, 0.5)")).first()[0]
    for part in ([recs] if middle is None else [recs.where(F.col("_id") <= middle), recs.where(F.col("_id") > middle)]):
        append_records(part, root, "rating", LOG_PARTITIONS, ["_id"])
    return root


@register("stream_log_offsets", with_ctes(RATINGS_E_SQL, _LOG_SQL) + """
SELECT partition * 1099511627776 + "offset" AS event_id, uid, mid, score,
       strftime(time, '%Y-%m-%d %H:%M:%S.%f') AS time FROM logged""")
def stream_log_offsets(spark, sf_dir):
    """Records of a log as the online job parses them, by position, read in
    bounded triggers by a query that is stopped and restarted in between."""
    from recolake.sources.events import read_events
    from recolake.streaming.online_stream import parse_stream

    root = _event_log(spark, sf_dir)
    most = 1 + fx.table(spark, sf_dir, "events").count() // 3
    while True:
        raw = read_events(spark, "rating", "log", root, max_per_trigger=most, options={"checkpoint": f"{root}/checkpoint"})
        q = (parse_stream(raw).writeStream.format("parquet").option("checkpointLocation", f"{root}/checkpoint")
             .trigger(availableNow=True).start(f"{root}/out"))
        q.awaitTermination()
        if not any(p["numInputRows"] for p in q.recentProgress):
            break
    return spark.read.parquet(f"{root}/out").select(
        "event_id", "uid", "mid", "score", F.date_format("time", "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("time"))


_DAYS = ["2024-01-29", "2024-01-30", "2024-01-31"]

_INCREMENTAL_SQL = """kept AS (SELECT * FROM ratings_l WHERE uid % 3 <> 1 OR score >= 3)"""


@register("movie_stats_incremental", with_ctes(RATINGS_L_SQL, _INCREMENTAL_SQL) + """
SELECT m.mid, m.yearmonth, m.rating_count, c.total_count, c.avg
FROM (SELECT mid, strftime(time, '%Y-%m') AS yearmonth, count(score) AS rating_count FROM kept GROUP BY 1, 2) m
JOIN (SELECT mid, count(score) AS total_count, round(avg(score), 6) AS avg FROM kept GROUP BY mid) c ON m.mid = c.mid""")
def movie_stats_incremental(spark, sf_dir):
    """Statistics kept by partial aggregates: three daily partitions, then the
    second one again with other rows; each run reads its own partition only."""
    import uuid

    from recolake.plans.jobs import dws_rating_incremental_job
    from recolake.session import scratch_path
    from recolake.sources.tables import Lakehouse

    lake = Lakehouse(spark, scratch_path(spark, "warehouse"), database=f"inc_{uuid.uuid4().hex[:12]}")
    r = fx.ratings_l(spark, sf_dir)
    for k, day in enumerate(_DAYS):
        lake.write(ods.stamp_date(r.where(F.col("uid") % 3 == k), day), "ods", "Rating")
        assert set(dws_rating_incremental_job(lake, day)) <= {day}
    lake.write(ods.stamp_date(r.where("uid % 3 = 1 and score >= 3"), _DAYS[1]), "ods", "Rating")
    assert set(dws_rating_incremental_job(lake, _DAYS[1])) <= {_DAYS[1]}
    t = {name: lake.read("dws", name, _DAYS[1]) for name in ("MovieCountRatingMonth", "MovieCountRating", "MovieAvgRating")}
    return (t["MovieCountRatingMonth"].select("mid", "yearmonth", "rating_count")
            .join(t["MovieCountRating"].select("mid", F.col("rating_count").alias("total_count")), "mid")
            .join(t["MovieAvgRating"].select("mid", _r6("avg")), "mid"))
