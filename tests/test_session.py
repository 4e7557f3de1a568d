"""The shared folder for checkpoints and written tables."""

import os

import pytest
from pyspark.sql import functions as F

from skytrace import session


class Context:
    def __init__(self, master, folder=None):
        self.master, self.folder = master, folder

    def getCheckpointDir(self):
        return self.folder

    def setCheckpointDir(self, folder):
        self.folder = folder


class Session:
    def __init__(self, master, named=None, folder=None):
        self.sparkContext, self.named, self.conf = Context(master, folder), named, self

    def get(self, key, default=None):
        return self.named or default


def test_shared_folder():
    assert session.shared_dir(Session("yarn", "hdfs:///shared")) == "hdfs:///shared"
    assert session.shared_dir(Session("yarn", None, "hdfs:///set")) == "hdfs:///set"
    with pytest.raises(RuntimeError):
        session.shared_dir(Session("spark://host:7077"))
    local = Session("local[2]")
    folder = session.shared_dir(local)
    assert os.path.isdir(folder) and session.shared_dir(local) == folder


def test_written_and_staged(spark):
    df = spark.range(10).withColumn("v", F.col("id") * 2)
    for copy in (session.written(df, "numbers"), session.stage(df)):
        assert sorted(copy.collect()) == sorted(df.collect())
    here = spark.conf.get("spark.checkpoint.dir")
    assert session.written(df, "numbers").inputFiles()[0].removeprefix("file://").startswith(here)
