import pytest

from halfhourly import session as S


class Session:
    """Stands for a session on a cluster, with or without the shared folder named."""

    def __init__(self, folder=None, master="spark://host:7077"):
        self.folder = folder
        self.conf = self
        self.sparkContext = self
        self.master = master

    def get(self, name, default=None):
        return self.folder or default

    def getCheckpointDir(self):
        return None


def test_the_named_folder_is_used():
    assert S.checkpoint_dir(Session("hdfs://shared/check/")) == "hdfs://shared/check"
    one, two = (S.work_folder(Session("hdfs://shared"), "load") for _ in range(2))
    assert one.startswith("hdfs://shared/load-") and one != two


def test_a_cluster_without_one_is_refused():
    with pytest.raises(RuntimeError):
        S.checkpoint_dir(Session())


def test_local_sessions_get_a_folder(spark):
    folder = S.checkpoint_dir(spark)
    assert folder and S.checkpoint_dir(spark) == folder


def test_work_folders_can_be_dropped(spark, monkeypatch):
    monkeypatch.setattr(S, "_FOLDERS", [])
    table = S.staged(spark.range(5), "dropped")
    assert table.count() == 5
    S.work_folder(spark, "never-written")
    assert S.drop_work_folders(spark) == 1 and S.drop_work_folders(spark) == 0


def test_partitions_follow_the_input():
    from halfhourly.session import partitions_for
    assert partitions_for(0) == 200 and partitions_for(10**12) == -(-10**12 // (128 * 1024 * 1024))
    assert partitions_for(1000, partition_bytes=10, least=1) == 100
