import pytest

from gleanwork import session


class Conf(dict):
    def get(self, key, default=None):
        return super().get(key, default)


class Context:
    def __init__(self, master, folder=None):
        self.master, self.folder = master, folder

    def getCheckpointDir(self):
        return self.folder


class Session:
    def __init__(self, master, **conf):
        self.conf, self.sparkContext = Conf(conf), Context(master)


def test_shared_folder_comes_from_the_session():
    named = Session("spark://host:7077", **{"spark.checkpoint.dir": "hdfs://shared/x"})
    assert session.shared_dir(named) == "hdfs://shared/x"


def test_a_cluster_without_shared_folder_is_refused():
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        session.shared_dir(Session("spark://host:7077"))


def test_snapshot_bound_ignores_the_session_zone(spark):
    from gleanwork.operators import gates

    before = spark.conf.get("spark.sql.session.timeZone")
    try:
        for zone in ("UTC", "Asia/Tokyo", "America/New_York"):
            spark.conf.set("spark.sql.session.timeZone", zone)
            df = spark.createDataFrame(
                [("o/a", "a" * 40, "2026-01-01T00:00:00"), ("o/b", "a" * 40, "2025-12-31T23:59:59Z")],
                "name string, lastCommitSHA string, lastCommit string",
            )
            assert [r["key"] for r in gates.population_format(df).collect()] == ["o/b"], zone
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
