"""The checkpoint folder comes from the session; a temp one only when unset."""

import pytest

from ledgerlake.session import ensure_checkpoint_dir


class _Conf:
    def __init__(self, values):
        self.values = values

    def get(self, key, default=None):
        return self.values.get(key, default)


class _Context:
    def __init__(self, conf, master="local[8]"):
        self._conf, self.dir, self.master = _Conf(conf), None, master

    def getCheckpointDir(self):
        return self.dir

    def getConf(self):
        return self._conf

    def setCheckpointDir(self, path):
        self.dir = path


class _Session:
    def __init__(self, session_conf, context_conf, master="local[8]"):
        self.conf = _Conf(session_conf)
        self.sparkContext = _Context(context_conf, master)


def test_configured_shared_folder_wins():
    s = _Session({}, {"spark.checkpoint.dir": "hdfs://shared/ckpt"})
    assert ensure_checkpoint_dir(s) == "hdfs://shared/ckpt"
    s2 = _Session({"spark.checkpoint.dir": "s3a://bucket/ckpt"}, {})
    assert ensure_checkpoint_dir(s2) == "s3a://bucket/ckpt"


def test_existing_checkpoint_dir_is_kept():
    s = _Session({"spark.checkpoint.dir": "s3a://other"}, {})
    s.sparkContext.dir = "hdfs://already/set"
    assert ensure_checkpoint_dir(s) == "hdfs://already/set"


def test_temp_folder_only_when_unset():
    s = _Session({}, {})
    path = ensure_checkpoint_dir(s)
    assert path.startswith("/tmp/ledgerlake-ckpt-")


@pytest.mark.parametrize("master", ["yarn", "spark://host:7077", "k8s://host", "local-cluster[3,2,1024]"])
def test_no_local_checkpoint_folder_on_a_cluster(master):
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        ensure_checkpoint_dir(_Session({}, {}, master))
    shared = _Session({}, {"spark.checkpoint.dir": "hdfs://shared"}, master)
    assert ensure_checkpoint_dir(shared) == "hdfs://shared"
