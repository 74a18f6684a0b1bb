"""Where data that outlives a stage is kept, and how jobs are sized."""

from types import SimpleNamespace

import pytest

from ddlscope.session import apply_settings, scratch_path, shared_folder, sized_settings


class Context:
    """The parts of a context that are asked for the folder."""

    def __init__(self, master, configured=None):
        self.master, self.folder, self.configured = master, None, configured

    def getCheckpointDir(self):
        return self.folder

    def setCheckpointDir(self, folder):
        self.folder = folder

    def getConf(self):
        return SimpleNamespace(get=lambda key: self.configured)


def session(master, configured=None, at_runtime=None):
    return SimpleNamespace(sparkContext=Context(master, configured), conf=SimpleNamespace(get=lambda key, default: at_runtime))


def test_the_configured_folder_is_used():
    assert shared_folder(session("spark://host:1", "hdfs://a/b")) == "hdfs://a/b"
    assert shared_folder(session("spark://host:1", at_runtime="s3://c")) == "s3://c"
    assert shared_folder(session("local[2]", "/shared")) == "/shared"


def test_a_cluster_without_a_folder_is_an_error():
    with pytest.raises(RuntimeError):
        shared_folder(session("spark://host:1"))


def test_scratch_paths_are_new_and_in_the_folder():
    spark = session("local[2]", "/shared/")
    first, second = scratch_path(spark, "x"), scratch_path(spark, "x")
    assert first != second and first.startswith("/shared/x-")


def test_partitions_follow_the_data():
    assert sized_settings(1)["spark.sql.shuffle.partitions"] == "200"
    assert sized_settings(100 << 40)["spark.sql.shuffle.partitions"] == str((100 << 40) // (128 << 20))


def test_adaptive_settings_reach_a_session_from_elsewhere(spark):
    key = "spark.sql.adaptive.forceOptimizeSkewedJoin"
    spark.conf.set(key, "false")
    apply_settings(spark)
    assert spark.conf.get(key) == "true"
