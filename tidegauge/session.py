"""Session settings and the shared scratch folder."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

#: Settings every operator relies on. The time zone fixes minute, hour and day borders; the
#: adaptive settings let Spark split skewed join sides and merge small shuffle partitions.
SESSION_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.streaming.sessionWindow.merge.sessions.in.local.partition": "true",
}

#: Folders that a task writes side by side. Rows of more are sorted by folder first, which may spill.
OPEN_FOLDERS = 64
_WRITERS = "spark.sql.maxConcurrentOutputFileWriters"
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
CHECKPOINT_SETTING = "spark.checkpoint.dir"


def local_session(cores: str = "*", app: str = "tidegauge", **settings: str) -> SparkSession:
    """A session for tests and the bench; on a cluster the submitter makes the session."""
    builder = SparkSession.builder.master(f"local[{cores}]").appName(app)
    defaults = {
        **SESSION_SETTINGS,
        "spark.sql.shuffle.partitions": "8",
        "spark.ui.enabled": "false",
        "spark.driver.memory": "12g",
    }
    for key, value in {**defaults, **settings}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def prepare(spark: SparkSession) -> SparkSession:
    """Apply the settings the operators rely on to a session made elsewhere."""
    for key, value in SESSION_SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def _scratch(spark: SparkSession) -> str:
    """The folder of this application below the shared checkpoint folder of the cluster."""
    base = spark.conf.get(CHECKPOINT_SETTING, None)
    if not base:
        master = spark.conf.get("spark.master", "")
        if not master.startswith("local") or master.startswith("local-cluster"):
            raise ValueError(f"{CHECKPOINT_SETTING} must name a folder that all executors share")
        base = f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/checkpoints"
    return f"{base.rstrip('/')}/tidegauge/{spark.sparkContext.applicationId}"


def scratch_folder(spark: SparkSession, label: str) -> str:
    """A new folder for this application below the shared checkpoint folder of the cluster.

    A cluster must name one in ``spark.checkpoint.dir``. Where all tasks run in the driver's process, a
    session that names none uses one in its warehouse. It stays until ``clear_scratch``.
    """
    return f"{_scratch(spark)}/{label}-{uuid.uuid4().hex}"


def clear_scratch(spark: SparkSession) -> None:
    """Remove all scratch folders of this application; those of others stay.

    Results read them until they are written elsewhere, so this belongs at the end of a job. What is to
    outlive it, such as a stream's tables, wants a folder of its own.
    """
    remove(spark, _scratch(spark))


@contextmanager
def _set(spark: SparkSession, setting: str, value: str) -> Iterator[None]:
    before = spark.conf.get(setting)
    spark.conf.set(setting, value)
    try:
        yield
    finally:
        spark.conf.set(setting, before)


def open_folders(spark: SparkSession):
    """Tasks that write meanwhile keep some folders open instead of sorting their rows by folder."""
    return _set(spark, _WRITERS, str(OPEN_FOLDERS))


def brief_shuffles(spark: SparkSession):
    """What is shuffled meanwhile leaves the disks when its job ends, not when its plan is collected as garbage.

    For jobs that write their result; a frame that is read again would have to be shuffled again.
    """
    return _set(spark, _CLEANUP, "true")


def _hadoop(spark: SparkSession, path: str):
    """A path and its file system, as Spark itself sees them."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place, place.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())


def remove(spark: SparkSession, path: str) -> None:
    """Remove a folder with all it holds; nothing happens where there is none."""
    place, system = _hadoop(spark, path)
    system.delete(place, True)


def listed(spark: SparkSession, path: str) -> list[tuple[str, float]]:
    """Names in a folder that do not begin with a dot or underscore, and when each was last changed."""
    place, system = _hadoop(spark, path)
    if not system.exists(place):
        return []
    found = [(s.getPath().getName(), s.getModificationTime() / 1000) for s in system.listStatus(place)]
    return [(name, changed) for name, changed in found if not name.startswith((".", "_"))]
