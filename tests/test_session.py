"""Where intermediate tables go."""

import pytest

from sparkrec.session import ensure_checkpoint_dir


class Conf(dict):
    def set(self, key, value):
        self[key] = value


class Session:
    def __init__(self, **conf):
        self.conf = Conf({k.replace("_", "."): v for k, v in conf.items()})
        self.sparkContext = None


def test_a_cluster_must_name_the_shared_folder():
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        ensure_checkpoint_dir(Session(spark_master="spark://host:7077"))
    assert ensure_checkpoint_dir(Session(spark_master="yarn", spark_checkpoint_dir="hdfs:/x")) == "hdfs:/x"


def test_local_sessions_get_a_folder():
    s = Session(spark_master="local[2]")
    assert ensure_checkpoint_dir(s) == s.conf["spark.checkpoint.dir"]
