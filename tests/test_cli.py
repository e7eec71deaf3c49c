"""The command line runs a job in its own process against a path-based
lakehouse written by another process."""

import os
import subprocess
import sys

from pyspark.sql import functions as F

from recolake.session import scratch_path
from recolake.sources.tables import Lakehouse

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def test_cli_dws_rating_in_a_separate_process(spark):
    wh = scratch_path(spark, "cli")
    lake = Lakehouse(spark, wh, database="t_cli")
    ratings = spark.createDataFrame([(1, 10, 4.0), (2, 10, 2.0), (3, 11, 5.0)], "uid int, mid int, score double")
    lake.write(ratings.withColumn("time", F.to_timestamp(F.lit("2024-01-05 00:00:00")))
               .withColumn("date", F.lit("2024-01-31")), "ods", "Rating")
    env = dict(os.environ, PYTHONPATH=ROOT)
    out = subprocess.run([sys.executable, "-m", "recolake.cli", "dws-rating", "--date", "2024-01-31",
                          "--warehouse", wh, "--master", "local[2]"], cwd=ROOT, env=env,
                         capture_output=True, text=True, timeout=300)
    assert out.returncode == 0, out.stderr[-2000:]
    avg = {r.mid: r.avg for r in lake.read("dws", "MovieAvgRating", "2024-01-31").collect()}
    assert avg == {10: 3.0, 11: 5.0}


def test_entry_from_another_directory_without_pythonpath(tmp_path):
    """The driver may load __spark_entry__.py by path from anywhere: the
    Python workers must still import the package (it is shipped)."""
    code = (
        "import importlib.util\n"
        f"spec = importlib.util.spec_from_file_location('e', {os.path.join(ROOT, '__spark_entry__.py')!r})\n"
        "m = importlib.util.module_from_spec(spec); spec.loader.exec_module(m)\n"
        "from pyspark.sql import SparkSession\n"
        "s = SparkSession.builder.master('local[2]').config('spark.ui.enabled', 'false').getOrCreate()\n"
        "print('ROWS', m.queries()['item_similarity'](s, '/root/testdata/sf0.001').count())\n"
    )
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    out = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, env=env, capture_output=True,
                         text=True, timeout=300)
    assert out.returncode == 0, out.stderr[-2000:]
    assert "ROWS 13806" in out.stdout
