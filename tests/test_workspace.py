import pytest
from pyspark.sql import functions as F

from tradewake.sources import release, scratch_path, stored
from tradewake.sources import workspace

from .helpers import folder_of_jobs, plan


def test_scratch_is_in_the_shared_folder(spark):
    setting = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    first, second = scratch_path(spark, "x"), scratch_path(spark, "x")
    assert first != second
    if setting:
        assert first.startswith(setting.rstrip("/"))


class _Conf:
    def get(self, key, default=None):
        return default


class _Context:
    applicationId = "app-1"

    def __init__(self, master, folder=None):
        self.master, self.folder = master, folder

    def getCheckpointDir(self):
        return self.folder


class _Session:
    def __init__(self, *args):
        self.conf, self.sparkContext = _Conf(), _Context(*args)


def test_a_cluster_without_shared_folder_is_an_error():
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        workspace.scratch_path(_Session("spark://host:7077"), "x")


def test_a_cluster_uses_the_folder_of_its_context():
    path = workspace.scratch_path(_Session("yarn", "hdfs:///shared"), "x")
    assert path.startswith("hdfs:///shared/tradewake/app-1/x-")


def test_a_local_session_gets_a_folder_once_and_keeps_its_setting():
    session = _Session("local[2]")
    first, second = (workspace.scratch_path(session, "x") for _ in range(2))
    assert first.rsplit("/", 1)[0] == second.rsplit("/", 1)[0]
    assert session.sparkContext.folder is None


def test_a_block_deletes_what_it_stored(spark):
    with workspace.job_folder(spark) as folder:
        kept = stored(spark.range(5), "test")
        assert kept.count() == 5 and all(folder in name for name in kept.inputFiles())
        with workspace.job_folder(spark) as inner:
            assert inner == folder
        assert kept.count() == 5
    assert not folder_of_jobs(spark)
    with pytest.raises(ZeroDivisionError), workspace.job_folder(spark):
        stored(spark.range(5), "test")
        raise ZeroDivisionError
    assert not folder_of_jobs(spark)


def test_stored_frame_is_a_scan(spark):
    rows = spark.range(100).select("id", (F.col("id") % 3).alias("part"), F.rand(1).alias("x"))
    kept = stored(rows, "test")
    assert kept.schema.names == rows.schema.names
    assert sorted(kept.collect()) == sorted(kept.collect())
    assert "ReadSchema: struct<id:bigint>" in plan(kept.select("id"))


def test_stored_by_partition_prunes(spark):
    rows = spark.range(100).select((F.col("id") % 3).alias("part"), "id")
    kept = stored(rows, "test", partition_by="part")
    one = kept.filter("part = 1")
    assert one.count() == 33
    assert "PartitionFilters: [isnotnull(part" in plan(one)


def test_release_deletes_what_the_application_stored(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(workspace, "_application_folder", lambda spark: f"{tmp_path}/app")
    stored(spark.range(3), "test")
    assert (tmp_path / "app").exists()
    release(spark)
    assert not (tmp_path / "app").exists()
