"""Plan properties that matter at scale: filters and column pruning reach the
Parquet scan, top-k is limited before the shuffle, no cartesian products."""

import __spark_entry__ as entry

SF = "/root/testdata/sf0.001"


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_key_range_pushed_to_scan(spark):
    p = _plan(entry.queries()["kv_range_scan"](spark, SF))
    assert "GreaterThanOrEqual(c_name" in p and "LessThan(c_name" in p


def test_column_pruning_on_statistics(spark):
    p = _plan(entry.queries()["movie_avg"](spark, SF))
    assert "ReadSchema: struct<l_orderkey:bigint,l_partkey:bigint,l_quantity:double>" in p


def test_no_cartesian_products(spark):
    for name in ["item_similarity", "content_similarity", "online_recommend", "als_predict_all",
                 "als_predict_unrated", "genre_top_movies", "user_recent_ratings", "movie_sim_list"]:
        p = _plan(entry.queries()[name](spark, SF))
        assert "CartesianProduct" not in p and "BroadcastNestedLoopJoin" not in p, name


def test_top_k_limited_before_shuffle(spark):
    p = _plan(entry.queries()["genre_top_movies"](spark, SF))
    assert p.count("WindowGroupLimit") >= 2
