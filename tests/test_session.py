"""Shared tables and the driver's entry module."""

import pytest
from pyspark.errors import AnalysisException

import __spark_entry__
from inkwell import session


def test_written_tables_come_back_and_go(spark):
    d = session.materialize(spark.createDataFrame([(1, None), (2, "x")], "a int, b string"), "t")
    assert sorted(tuple(r) for r in d.collect()) == [(1, None), (2, "x")]
    assert session.materialize(spark.createDataFrame([], "a int"), "t").collect() == []
    session.clear_shared(spark)
    with pytest.raises(AnalysisException):
        spark.read.parquet(f"{session.shared_dir(spark)}/inkwell")


def test_entry(spark):
    assert __spark_entry__.entry(spark).count() > 0
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())


class _Context:
    def __init__(self, master, held=None):
        self.master, self._held = master, held
        self._jsc = self

    def getConf(self):  # noqa: N802
        return {}

    def sc(self):
        return self

    def getCheckpointDir(self):  # noqa: N802
        return self

    def isDefined(self):  # noqa: N802
        return self._held is not None

    def get(self):
        return self._held

    def setCheckpointDir(self, path):  # noqa: N802
        self._held = path


class _Session:
    def __init__(self, master, setting=None):
        self.sparkContext = _Context(master)
        self.conf = {"spark.checkpoint.dir": setting} if setting else {}


def test_a_cluster_without_a_shared_folder_is_an_error():
    for master in ("spark://host:7077", "yarn", "local-cluster[2,1,1024]", "k8s://https://host"):
        with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
            session.shared_dir(_Session(master))
        assert session.shared_dir(_Session(master, "hdfs:///shared/")) == "hdfs:///shared"
    for master in ("local", "local[8]", "local[*]"):
        made = session.shared_dir(_Session(master))
        assert made.startswith("file:///tmp/spark-")
