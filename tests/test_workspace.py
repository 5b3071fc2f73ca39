import pytest

from trendloom.sources import workspace


class FakeContext:
    def __init__(self, master):
        self.master, self.folder = master, None

    def getCheckpointDir(self):
        return self.folder

    def setCheckpointDir(self, folder):
        self.folder = folder


class FakeSession:
    def __init__(self, master):
        self.sparkContext = FakeContext(master)


def test_configured_folder_is_used(spark):
    folder = workspace.configured_dir(spark)
    assert folder and workspace.work_dir(spark) == folder.rstrip("/")
    assert workspace.new_path(spark, "x").startswith(folder)


def test_without_setting_only_local_mode_gets_a_temporary_folder(monkeypatch, tmp_path):
    monkeypatch.setattr(workspace, "configured_dir", lambda spark: None)
    monkeypatch.setattr(workspace.tempfile, "mkdtemp", lambda prefix: str(tmp_path))
    local = FakeSession("local[2]")
    assert workspace.work_dir(local) == str(tmp_path) == workspace.work_dir(local)
    with pytest.raises(RuntimeError):
        workspace.work_dir(FakeSession("spark://host:7077"))


def test_materialised_rows_are_pinned(spark):
    from pyspark.sql import functions as F

    pinned = workspace.materialise(spark.range(50).withColumn("r", F.rand()))
    assert pinned.collect() == pinned.collect()
    assert "Range" not in pinned._jdf.queryExecution().executedPlan().toString()
