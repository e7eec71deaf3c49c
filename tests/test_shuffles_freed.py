"""Shuffle files of stored tables, and tables that nothing reads, go at once."""

import glob
import os
import time

from pyspark.sql import functions as F

from recolake import session


def test_shuffle_files_go_when_the_table_is_stored(spark):
    before = spark.conf.get(session.FREE_SHUFFLES, "false")
    folders = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirsString()
    files = lambda: {f for d in folders for f in glob.glob(f"{d}/*/shuffle_*.data")}
    old = files()
    spark.range(20000).repartition(5, "id").write.format("noop").mode("overwrite").save()
    assert files() - old
    old = files()
    stored = session.materialize(spark.range(20000).repartition(5, "id").groupBy((F.col("id") % 7).alias("k")).count(), "freed")
    until = time.time() + 20  # they go in the background
    while files() - old and time.time() < until:
        time.sleep(0.2)
    assert not files() - old
    assert stored.count() == 7 and spark.conf.get(session.FREE_SHUFFLES) == before
    with session.shuffles_freed(spark), session.shuffles_freed(spark):
        assert spark.conf.get(session.FREE_SHUFFLES) == "true"
    assert spark.conf.get(session.FREE_SHUFFLES) == before
    folder = stored.inputFiles()[0].removeprefix("file:").replace("//", "").rsplit("/data/", 1)[0]
    assert os.path.isdir(folder)
    session.forget(stored)
    assert not os.path.exists(folder)
