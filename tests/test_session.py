"""The shared checkpoint folder: read from the session, private only locally."""

import pytest

from churnkit.session import checkpoint_dir


class _Conf:
    def __init__(self, value):
        self.value = value

    def get(self, key, default=None):
        return self.value if key == "spark.checkpoint.dir" else default


class _Context:
    def __init__(self, master, conf_dir=None):
        self.master, self._conf, self.dir = master, _Conf(conf_dir), None

    def getCheckpointDir(self):
        return self.dir

    def getConf(self):
        return self._conf

    def setCheckpointDir(self, d):
        self.dir = d


class _Session:
    def __init__(self, ctx):
        self.sparkContext = ctx


def test_cluster_without_shared_folder_is_refused():
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        checkpoint_dir(_Session(_Context("yarn")))


def test_configured_folder_is_used():
    ctx = _Context("yarn", conf_dir="hdfs://nn/shared/ckpt")
    assert checkpoint_dir(_Session(ctx)) == "hdfs://nn/shared/ckpt"


def test_local_mode_gets_a_private_folder():
    ctx = _Context("local[2]")
    path = checkpoint_dir(_Session(ctx))
    assert path and ctx.dir == path
