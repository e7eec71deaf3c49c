"""Lakehouse tables: naming, dynamic partition overwrite, empty-write skip,
date partition pruning."""

import pytest
from pyspark.sql import functions as F

from recolake.session import scratch_path
from recolake.sources import tables
from recolake.sources.tables import Lakehouse


def test_layer_names():
    assert tables.layer("ods") == "OperationalDataStore"
    assert tables.layer("ADS") == "AppDataStore"
    assert tables.table_name("dim", "Movie") == "Recommender.Dimension_Movie"
    with pytest.raises(ValueError):
        tables.layer("nope")


def test_overwrite_replaces_only_written_dates(spark):
    lake = Lakehouse(spark, scratch_path(spark, "wh"), database="t_tables")
    d = lambda rows, date: spark.createDataFrame(rows, "mid int, avg double").withColumn("date", F.lit(date))
    lake.write(d([], "d0"), "dws", "A")
    assert not lake.exists("dws", "A")  # an empty first write creates nothing
    lake.write(d([(1, 1.0), (2, 2.0)], "d1"), "dws", "A")
    lake.write(d([(3, 3.0)], "d2"), "dws", "A")
    lake.write(d([(9, 9.0)], "d1"), "dws", "A")
    lake.write(d([], "d2"), "dws", "A")  # empty re-run of d2: d2 stays
    got = sorted((r.mid, r.date) for r in lake.read("dws", "A").collect())
    assert got == [(3, "d2"), (9, "d1")]
    one = lake.read("dws", "A", date="d2")
    assert [r.mid for r in one.collect()] == [3]
    plan = one._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan and "d2" in plan


def test_tables_shared_across_processes(spark):
    """A second job with its own (empty) catalog finds the tables by path."""
    wh = scratch_path(spark, "wh")
    first = Lakehouse(spark, wh, database="t_proc_a")
    first.write(spark.createDataFrame([(1, 2.0)], "mid int, avg double").withColumn("date", F.lit("2024-01-31")),
                "dws", "MovieAvgRating")
    second = Lakehouse(spark, wh, database="t_proc_b")
    assert second.exists("dws", "MovieAvgRating")
    assert [(r.mid, r.date) for r in second.read("dws", "MovieAvgRating", "2024-01-31").collect()] == [(1, "2024-01-31")]
    assert spark.sql("SELECT count(*) AS n FROM t_proc_a.DataWarehouseSummary_MovieAvgRating").collect()[0].n == 1


def test_partition_values_are_strings_and_newest_is_static(spark):
    lake = Lakehouse(spark, scratch_path(spark, "wh"), database="t_newest")
    assert lake.dates("dws", "B") == []
    with pytest.raises(FileNotFoundError):
        lake.newest("dws", "B")
    for date in ("007", "006", "2024-01-31 a:b"):
        lake.write(spark.createDataFrame([(1, 1.0)], "mid int, avg double").withColumn("date", F.lit(date)), "dws", "B")
    assert lake.dates("dws", "B") == ["006", "007", "2024-01-31 a:b"]
    assert [r.date for r in lake.read("dws", "B", "007").collect()] == ["007"]
    assert sorted(r.date for r in spark.table(lake.name("dws", "B")).collect()) == ["006", "007", "2024-01-31 a:b"]
    newest = lake.newest("dws", "B")
    assert [r.date for r in newest.collect()] == ["2024-01-31 a:b"]
    plan = newest._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(date" in plan and "= 2024-01-31 a:b)" in plan
