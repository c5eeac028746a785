"""The checkpoint folder comes from the session; a scratch one only if unset."""

import os

import pytest

from buyerlens.session import checkpoint_dir


class _Conf:
    def __init__(self, values):
        self.values = values

    def get(self, key, default=None):
        return self.values.get(key, default)


class _Context:
    def __init__(self, current=None, master="local[2]"):
        self.current = current
        self.set_to = None
        self.master = master

    def getCheckpointDir(self):
        return self.current

    def setCheckpointDir(self, d):
        self.set_to = d
        self.current = d


class _Session:
    def __init__(self, conf, sc=None):
        self.conf = _Conf(conf)
        self._sc = sc

    @property
    def sparkContext(self):
        if self._sc is None:
            raise RuntimeError("no context (Spark Connect)")
        return self._sc


def test_uses_the_cluster_setting():
    sc = _Context()
    d = checkpoint_dir(_Session({"spark.checkpoint.dir": "hdfs://shared/ckpt"}, sc))
    assert d == "hdfs://shared/ckpt" and sc.set_to == "hdfs://shared/ckpt"


def test_keeps_a_registered_folder():
    sc = _Context(current="s3a://bucket/ckpt/abc")
    assert checkpoint_dir(_Session({}, sc)) == "s3a://bucket/ckpt/abc"
    assert sc.set_to is None


def test_scratch_folder_only_when_unset():
    sc = _Context()
    d = checkpoint_dir(_Session({}, sc))
    assert d and "buyerlens-ckpt-" in d and sc.set_to == d


def test_a_cluster_must_name_its_folder():
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        checkpoint_dir(_Session({}, _Context(master="spark://host:7077")))


def test_connect_session_defers_to_server():
    assert checkpoint_dir(_Session({"spark.checkpoint.dir": "/shared/ckpt"})) == "/shared/ckpt"


def test_intermediate_tables_go_with_the_process():
    """A driver of its own writes a table and ends: nothing is left below the checkpoint folder but Spark's own."""
    import glob
    import subprocess
    import sys
    import tempfile

    root = tempfile.mkdtemp(prefix="scratch-")
    code = f"""
import sys
sys.path.insert(0, {os.path.dirname(os.path.dirname(os.path.abspath(__file__)))!r})
from buyerlens.session import build_session, materialize
spark = build_session("local[1]", 1, extra={{"spark.checkpoint.dir": {root!r}}})
df = materialize(spark.range(5))
import glob
assert df.count() == 5 and glob.glob({root!r} + "/**/tables-*", recursive=True)
"""
    subprocess.run([sys.executable, "-c", code], check=True, timeout=120, capture_output=True)
    assert not glob.glob(root + "/**/run-*", recursive=True)
