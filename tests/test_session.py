"""Scratch folders: one for each application, removed as one."""

from pathlib import Path

import pytest

from tidegauge import session


class Stub:
    """A session of other settings; all else is the real one's."""

    def __init__(self, spark, **settings):
        self._spark, self.conf = spark, self
        self._settings = {f"spark.{k.replace('_', '.')}": v for k, v in settings.items()}

    def get(self, key, default=None):
        return self._settings.get(key, default)

    def __getattr__(self, name):
        return getattr(self._spark, name)


def test_scratch_of_one_application_is_removed_as_one(spark, tmp_path):
    stub = Stub(spark, checkpoint_dir=str(tmp_path))
    other = tmp_path / "tidegauge" / "another-application" / "rows"
    other.mkdir(parents=True)
    paths = [session.scratch_folder(stub, "rows") for _ in range(2)]
    assert len(set(paths)) == 2 and {Path(p).parent.name for p in paths} == {spark.sparkContext.applicationId}
    for path in paths:
        spark.range(3).write.parquet(path)
    assert spark.read.parquet(*paths).count() == 6
    session.clear_scratch(stub)
    assert not any(Path(p).exists() for p in paths) and other.exists()
    session.clear_scratch(stub)  # nothing left to remove


def test_one_process_without_the_setting_uses_its_warehouse(spark, tmp_path):
    stub = Stub(spark, master="local[4]", sql_warehouse_dir=str(tmp_path))
    path = session.scratch_folder(stub, "rows")
    assert path.startswith(f"{tmp_path}/checkpoints/tidegauge/")


@pytest.mark.parametrize("master", ["spark://host:7077", "yarn", "local-cluster[2,1,1024]"])
def test_a_cluster_must_name_its_shared_folder(spark, tmp_path, master):
    with pytest.raises(ValueError, match=session.CHECKPOINT_SETTING):
        session.scratch_folder(Stub(spark, master=master, sql_warehouse_dir=str(tmp_path)), "rows")
