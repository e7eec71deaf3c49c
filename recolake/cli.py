"""Command line: ``python -m recolake.cli <job> --date D --warehouse W [options]``.

Jobs: dim-movie, dws-rating, dws-movie-rating, als-predictor, als-trainer,
tfidf, db-loader, ods-rating, ods-tag, online (the streaming recommender,
runs until stopped; --sink is a parquet path, or "jdbc:<table>" for the
database named by RECOLAKE_DB_URL); table tools: view (print rows of
--layer/--source, optionally one --date), drop (remove the catalog entry).  Connection settings for JDBC come
from RECOLAKE_DB_URL / _USER / _PASSWORD / _DRIVER.
"""

from __future__ import annotations

import argparse

from recolake.plans import jobs
from recolake.session import build_session
from recolake.sources.tables import Lakehouse, checkpoint_path


def main(argv=None) -> None:
    ap = argparse.ArgumentParser(prog="recolake")
    ap.add_argument("job")
    ap.add_argument("--date", required=True)
    ap.add_argument("--warehouse", required=True)
    ap.add_argument("--master", default=None)
    ap.add_argument("--shuffle-partitions", type=int, default=None)
    ap.add_argument("--format", default="parquet")
    ap.add_argument("--movies-table", default="t_movie")
    ap.add_argument("--jdbc-column", default=None, help="numeric column splitting a JDBC read")
    ap.add_argument("--jdbc-lower", type=int, default=None)
    ap.add_argument("--jdbc-upper", type=int, default=None)
    ap.add_argument("--jdbc-partitions", type=int, default=None)
    ap.add_argument("--events-format", default="kafka")
    ap.add_argument("--events-path", default=None)
    ap.add_argument("--bootstrap-servers", default=None)
    ap.add_argument("--layer", default=None)
    ap.add_argument("--source", default=None)
    ap.add_argument("--sink", default=None)
    ap.add_argument("--rows", type=int, default=20)
    ap.add_argument("--checkpoint", default=None)
    ap.add_argument("--interval", default="5 seconds")
    ap.add_argument("--incremental", action="store_true", help="dws-rating: read new partitions only")
    ap.add_argument("--only-date", action="store_true", help="view: only the --date partition")
    a = ap.parse_args(argv)

    spark = build_session(f"recolake-{a.job}", master=a.master, shuffle_partitions=a.shuffle_partitions,
                          streaming=a.job.startswith("ods-") or a.job == "online")
    lake = Lakehouse(spark, a.warehouse, fmt=a.format)
    if a.job == "dim-movie":
        from recolake.sources.jdbc import connection_from_env, read_jdbc
        c = connection_from_env()
        url = c.pop("url")
        movies = read_jdbc(spark, a.movies_table, url, c, column=a.jdbc_column, lower=a.jdbc_lower,
                           upper=a.jdbc_upper, num_partitions=a.jdbc_partitions)
        jobs.dim_movie_job(lake, movies, a.date)
    elif a.job == "dws-rating":
        (jobs.dws_rating_incremental_job if a.incremental else jobs.dws_rating_job)(lake, a.date)
    elif a.job == "dws-movie-rating":
        jobs.dws_movie_rating_job(lake, a.date)
    elif a.job == "als-predictor":
        jobs.als_predictor_job(lake, a.date)
    elif a.job == "als-trainer":
        jobs.als_trainer_job(lake, a.date)
    elif a.job == "tfidf":
        jobs.tfidf_job(lake, a.date)
    elif a.job == "db-loader":
        from recolake.sources.jdbc import connection_from_env
        c = connection_from_env()
        url = c.pop("url")
        jobs.database_loader_job(lake, a.layer, a.source, a.sink, url, c)
    elif a.job in ("ods-rating", "ods-tag"):
        from recolake.sources.events import read_events
        topic = "rating" if a.job == "ods-rating" else "tag"
        raw = read_events(spark, topic, fmt=a.events_format, path=a.events_path,
                          bootstrap_servers=a.bootstrap_servers)
        jobs.ods_job(lake, raw, "Rating" if topic == "rating" else "Tag", a.date)
    elif a.job == "online":
        from recolake.sources.events import read_events
        from recolake.streaming import online_stream
        raw = read_events(spark, "rating", fmt=a.events_format, path=a.events_path,
                          bootstrap_servers=a.bootstrap_servers)
        if a.sink.startswith("jdbc:"):
            from recolake.sources.jdbc import connection_from_env
            c = connection_from_env()
            url = c.pop("url")
            sink = online_stream.jdbc_sink(url, a.sink[len("jdbc:"):], c)
        else:
            sink = online_stream.parquet_sink(a.sink)
        checkpoint = a.checkpoint or checkpoint_path(lake.stream_warehouse, "ads", "Rating")
        jobs.online_job(lake, raw, sink, checkpoint, a.interval).awaitTermination()
    elif a.job == "view":
        lake.read(a.layer, a.source, a.date if a.only_date else None).show(a.rows, truncate=False)
    elif a.job == "drop":
        lake.drop(a.layer, a.source)
    else:
        raise SystemExit(f"unknown job {a.job}")
    spark.stop()


if __name__ == "__main__":
    main()
