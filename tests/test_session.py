"""Checkpoint root rules: the cluster's shared folder is used as given; a
machine-local folder is only ever created in local mode."""

import pytest

from recolake import session


class _Conf:
    def __init__(self, values):
        self.values = values

    def get(self, key, default=None):
        return self.values.get(key, default)


class _Context:
    def __init__(self, master):
        self.master, self.applicationId, self.dir = master, f"app-{master}", None

    def getCheckpointDir(self):
        return self.dir

    def setCheckpointDir(self, d):
        self.dir = d


class _Session:
    def __init__(self, master, conf):
        self.sparkContext, self.conf = _Context(master), _Conf(conf)


def test_cluster_root_is_used_as_given():
    s = _Session("yarn", {"spark.checkpoint.dir": "hdfs:///shared/ckpt"})
    assert session.ensure_checkpoint_dir(s) == "hdfs:///shared/ckpt"
    assert s.sparkContext.dir == "hdfs:///shared/ckpt"
    assert session.scratch_path(s, "x").startswith("hdfs:///shared/ckpt/x-")


def test_cluster_without_root_is_refused():
    with pytest.raises(RuntimeError):
        session.ensure_checkpoint_dir(_Session("yarn", {}))


def test_local_without_root_gets_one_scratch_folder():
    s = _Session("local[2]", {})
    d = session.ensure_checkpoint_dir(s)
    assert d == session.ensure_checkpoint_dir(s)  # same folder for the application


def test_scratch_folders_of_a_scope_go_at_its_end(spark):
    import os
    with session.scratch_scope(spark):
        inside = session.materialize(spark.range(3), "inner")
        folder = os.path.dirname(os.path.dirname(inside.inputFiles()[0]).replace("file://", "").replace("file:", ""))
        assert inside.count() == 3 and os.path.isdir(folder)
    outside = session.materialize(spark.range(3), "outer")
    assert not os.path.exists(folder) and outside.count() == 3


def test_scratch_folders_go_with_the_jvm(tmp_path):
    import os
    import subprocess
    import sys
    code = ("import sys; sys.path.insert(0, %r)\n"
            "from recolake.session import build_session, materialize, scratch_path\n"
            "s = build_session('scratch', master='local[1]', extra={'spark.checkpoint.dir': %r})\n"
            "materialize(s.range(5), 'table').count(); s.range(5).write.parquet(scratch_path(s, 'own') + '/x')\n"
            "s.stop()" % (os.path.dirname(os.path.dirname(os.path.abspath(__file__))), str(tmp_path)))
    subprocess.run([sys.executable, "-c", code], check=True, timeout=120, capture_output=True)
    assert not [f for f in os.listdir(tmp_path) if f.startswith(("table-", "own-"))]
