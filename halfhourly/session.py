"""Session settings and the shared folder for written intermediate tables."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


PARTITION_BYTES = 128 * 1024 * 1024


def partitions_for(input_bytes: int, partition_bytes: int = PARTITION_BYTES, least: int = 200) -> int:
    """Shuffle partitions for an input of a size: as many as keep each near ``partition_bytes``."""
    return max(least, -(-input_bytes // partition_bytes))


def get_spark(app: str = "halfhourly", master: str | None = None, input_bytes: int = 0,
              **conf: str) -> SparkSession:
    """A session with the settings the library is written for.

    Adaptive execution merges small partitions and splits skewed joins at run time, but
    makes no more partitions than a shuffle starts with, so their number follows
    ``input_bytes``; timestamps carry no zone, so the session zone is pinned.
    """
    builder = (SparkSession.builder.appName(app)
               .config("spark.sql.adaptive.enabled", "true")
               .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
               .config("spark.sql.adaptive.skewJoin.enabled", "true")
               .config("spark.sql.shuffle.partitions", str(partitions_for(input_bytes)))
               .config("spark.sql.session.timeZone", "UTC")
               .config("spark.ui.enabled", "false"))
    if master:
        builder = builder.master(master)
    for name, value in conf.items():
        builder = builder.config(name, value)
    return builder.getOrCreate()


def checkpoint_dir(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``, which every executor can reach.

    Only a local session, where driver and executors share one machine, may go
    without the setting; it then gets a fresh folder of its own.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    context = spark.sparkContext
    current = context.getCheckpointDir()
    if current:
        return current.rstrip("/")
    if not context.master.startswith("local"):
        raise RuntimeError("spark.checkpoint.dir must name a shared folder on a cluster")
    context.setCheckpointDir(tempfile.mkdtemp(prefix="halfhourly-"))
    return context.getCheckpointDir().rstrip("/")


_FOLDERS: list[str] = []


def work_folder(spark: SparkSession, label: str) -> str:
    """A new, unused folder below the shared one."""
    folder = f"{checkpoint_dir(spark)}/{label}-{uuid.uuid4().hex}"
    _FOLDERS.append(folder)
    return folder


def _files(spark: SparkSession, path: str):
    """A place and the file system it is in."""
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return place, place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def path_exists(spark: SparkSession, path: str) -> bool:
    place, files = _files(spark, path)
    return bool(files.exists(place))


def delete_path(spark: SparkSession, path: str) -> bool:
    """Deletes a file or folder with all that is in it; whether there was one."""
    place, files = _files(spark, path)
    return bool(files.delete(place, True))


def drop_work_folders(spark: SparkSession, after: int = 0) -> int:
    """Deletes the folders that this process made for intermediate tables; returns how many it found.

    Results that were not written elsewhere can no longer be read then. ``after`` leaves as many of
    the oldest folders, see :func:`work_folders`.
    """
    found = 0
    while len(_FOLDERS) > after:
        found += delete_path(spark, _FOLDERS.pop())
    return found


def work_folders() -> int:
    """How many folders there are for intermediate tables; see :func:`drop_work_folders`."""
    return len(_FOLDERS)


def checkpointed(df: DataFrame) -> DataFrame:
    """``df`` written to the shared folder and read from there, its lineage cut."""
    spark = df.sparkSession
    folder = checkpoint_dir(spark)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(folder)
    return df.checkpoint()


def staged(df: DataFrame, label: str) -> DataFrame:
    """``df`` written as a Parquet table in the shared folder and read from there."""
    folder = work_folder(df.sparkSession, label)
    df.write.parquet(folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder)
