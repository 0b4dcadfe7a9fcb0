import pytest

from galena import session


class Fake:
    def __init__(self, master):
        self.master = master
        self.applicationId = "x"

    def getConf(self):
        return {}

    def getCheckpointDir(self):
        return None


def test_a_cluster_needs_a_shared_folder():
    with pytest.raises(session.NoSharedFolder):
        session.shared_dir(type("S", (), {"sparkContext": Fake("yarn")})())


def test_bounded(spark):
    df = spark.range(5).toDF("k")
    assert session.bounded(df, 4) is df
    small = session.bounded(df, 5)
    assert sorted(r.k for r in small.collect()) == [0, 1, 2, 3, 4]
    assert "BroadcastHashJoin" in spark.range(100).toDF("k").join(small, "k")._jdf.queryExecution().toString()
    assert session.bounded(df.where("k < 0")).count() == 0
