"""Spark session construction and job-wide settings.

One builder serves batch and streaming jobs.  Everything that differs between
a laptop test and a cluster run is configuration: the master, the shuffle
width, the warehouse and checkpoint roots.  Values already present on the
session (for example ``spark.checkpoint.dir`` set by the cluster) always win.
"""

from __future__ import annotations

import os
import tempfile
import threading
from contextlib import contextmanager

from pyspark.sql import SparkSession

# Settings every job gets.  Shuffle width is a floor: AQE coalesces small
# partitions at runtime and splits skewed join partitions.
BASE_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}

STREAMING_CONF = {
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}


def build_session(app_name: str = "recolake", master: str | None = None,
                  shuffle_partitions: int | None = None, streaming: bool = False,
                  extra: dict | None = None) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(BASE_CONF)
    if streaming:
        conf.update(STREAMING_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("WARN")
    ensure_checkpoint_dir(spark)
    return spark


_LOCAL_CHECKPOINT_ROOT: dict = {}


def _context(spark: SparkSession):
    """The SparkContext, or None for a session without one (Spark Connect)."""
    try:
        return spark.sparkContext
    except Exception:
        return None


def app_id(spark: SparkSession) -> str:
    sc = _context(spark)
    return sc.applicationId if sc is not None else spark.conf.get("spark.app.id", "connect")


def cores(spark: SparkSession) -> int:
    """Default parallelism of the session (task slots)."""
    sc = _context(spark)
    if sc is not None:
        return sc.defaultParallelism
    return int(spark.conf.get("spark.default.parallelism", spark.conf.get("spark.sql.shuffle.partitions")))


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint root named by the cluster.

    ``spark.checkpoint.dir`` is read from the session.  Only in local mode,
    when it is unset (tests), is a scratch directory created; on a cluster an
    unset root is an error rather than a machine-local folder.  The RDD
    checkpoint directory is registered once per context.
    """
    sc = _context(spark)
    d = spark.conf.get("spark.checkpoint.dir", None)
    if not d:
        master = sc.master if sc is not None else spark.conf.get("spark.master", "")
        if not master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a folder shared by the cluster")
        d = _LOCAL_CHECKPOINT_ROOT.get(app_id(spark))
        if d is None:
            d = tempfile.mkdtemp(prefix="recolake-ckpt-")
            _LOCAL_CHECKPOINT_ROOT[app_id(spark)] = d
    if sc is not None and sc.getCheckpointDir() is None:
        sc.setCheckpointDir(d)
    return d


_SCOPES = threading.local()


@contextmanager
def scratch_scope(spark: SparkSession):
    """Scratch folders that this thread makes inside of the block go at its end:
    for work that repeats in one JVM, such as a stream's micro-batches."""
    outer, _SCOPES.made = getattr(_SCOPES, "made", None), []
    try:
        yield
    finally:
        made, _SCOPES.made = _SCOPES.made, outer
        for folder in made:
            where = spark._jvm.org.apache.hadoop.fs.Path(folder)
            where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, not yet existing path in a folder of its own under the shared
    checkpoint root (never machine-local on a cluster, since the root comes from
    the session).  The folder goes when the driver's JVM ends."""
    import uuid
    folder = f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    jvm = getattr(spark, "_jvm", None)  # absent under Spark Connect
    if jvm is not None:
        where = jvm.org.apache.hadoop.fs.Path(folder)
        fs = where.getFileSystem(spark._jsc.hadoopConfiguration())
        fs.mkdirs(where)
        fs.deleteOnExit(where)
        if getattr(_SCOPES, "made", None) is not None:
            _SCOPES.made.append(folder)
    return f"{folder}/data"


FREE_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_FREEING: dict = {}  # by session: executions inside of ``shuffles_freed``, and the setting before
_FREEING_LOCK = threading.Lock()


@contextmanager
def shuffles_freed(spark: SparkSession):
    """The shuffle files of an execution inside of the block go when it ends, not
    when the driver happens to collect its garbage: for results that are stored,
    so that nothing reads those files again."""
    jvm = getattr(spark, "_jsparkSession", None)  # absent under Spark Connect
    key = jvm.sessionUUID() if jvm is not None else ""
    with _FREEING_LOCK:
        n, before = _FREEING.get(key) or (0, spark.conf.get(FREE_SHUFFLES, "false"))
        _FREEING[key] = n + 1, before
        spark.conf.set(FREE_SHUFFLES, "true")
    try:
        yield
    finally:
        with _FREEING_LOCK:
            n, before = _FREEING.pop(key)
            if n > 1:
                _FREEING[key] = n - 1, before
            else:
                spark.conf.set(FREE_SHUFFLES, before)


def materialize(df, name: str, codec: str | None = None):
    """Write ``df`` as a parquet table under the shared checkpoint root and
    read it back: cuts the lineage (recomputation after a lost executor
    starts from the files) and gives the optimizer real size statistics.
    ``codec``: a compression other than the session's."""
    path = scratch_path(df.sparkSession, name)
    with shuffles_freed(df.sparkSession):
        df.write.parquet(path, compression=codec)
    return df.sparkSession.read.parquet(path)


def forget(stored) -> None:
    """Delete a table of ``materialize`` that nothing reads any more."""
    spark = stored.sparkSession
    for folder in {f.rsplit("/data/", 1)[0] for f in stored.inputFiles()}:
        where = spark._jvm.org.apache.hadoop.fs.Path(folder)
        where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)


_SHIPPED: set = set()


def ship_package(spark: SparkSession) -> None:
    """Make ``recolake`` importable in the Python workers (once per
    application): the package is zipped on the driver and distributed with
    ``addPyFile``, as for any job dependency.  Needed because the pandas
    kernels reference the package's modules."""
    import zipfile

    key = app_id(spark)
    if key in _SHIPPED:
        return
    pkg = os.path.dirname(os.path.abspath(__file__))
    fd, path = tempfile.mkstemp(prefix="recolake-", suffix=".zip")
    os.close(fd)
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as z:
        for root, _, files in os.walk(pkg):
            for f in files:
                if f.endswith(".py"):
                    full = os.path.join(root, f)
                    z.write(full, os.path.relpath(full, os.path.dirname(pkg)))
    sc = _context(spark)
    try:
        if sc is not None:
            sc.addPyFile(path)
        else:  # Spark Connect: artifacts instead of the context's file server
            spark.addArtifacts(path, pyfile=True)
    except Exception as e:  # workers may already have the package installed
        import warnings
        warnings.warn(f"could not ship recolake to the workers: {e}")
    _SHIPPED.add(key)
