"""Where intermediate tables go."""

import pytest

from tallyfit.sources import new_folder, scratch_folder, spread, write_once


class Conf:
    def __init__(self, folder):
        self.folder = folder

    def get(self, name, default):
        assert name == "spark.checkpoint.dir"
        return self.folder or default


class Context:
    def __init__(self, master, folder=None):
        self.master, self.folder = master, folder

    def getCheckpointDir(self):
        return self.folder

    def setCheckpointDir(self, folder):
        self.folder = folder


class Session:
    def __init__(self, folder, master, set_before=None):
        self.conf, self.sparkContext = Conf(folder), Context(master, set_before)


def test_the_named_folder_comes_first():
    assert scratch_folder(Session("hdfs://x/y/", "yarn", "/other")) == "hdfs://x/y"
    assert scratch_folder(Session(None, "yarn", "hdfs://x/z")) == "hdfs://x/z"


def test_no_local_folder_on_a_cluster():
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        scratch_folder(Session(None, "yarn"))


def test_a_local_session_keeps_one_folder():
    session = Session(None, "local[2]")
    folder = scratch_folder(session)
    assert folder == scratch_folder(session) == session.sparkContext.folder
    assert new_folder(session, "a").startswith(folder) and (
        new_folder(session, "a") != new_folder(session, "a"))


def test_write_once_keeps_rows_and_schema(spark):
    df = spark.range(10).selectExpr("id", "array(id) AS a", "cast(null AS string) AS s")
    saved = write_once(df, "test")
    assert saved.dtypes == df.dtypes
    assert sorted(map(tuple, saved.collect())) == sorted(map(tuple, df.collect()))


def test_spread_only_where_splits_are_few(spark):
    assert spread(spark.range(0, 10, 1, 1)).rdd.getNumPartitions() == 8
    assert spread(spark.range(0, 100, 1, 40)).rdd.getNumPartitions() == 40
