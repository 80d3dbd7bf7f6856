"""Session set-up and the shared work folder."""

import os
import re
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

WORK_DIR_KEY = "spark.checkpoint.dir"

# Hourly series and home dimensions are joined to much larger facts. Both limits are checks of
# the planner's size estimate, the second one of the measured shuffle output: above them the
# join falls back to a sort-merge join, and AQE splits its skewed partitions.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.autoBroadcastJoinThreshold": str(64 * 1024 * 1024),
    "spark.sql.adaptive.autoBroadcastJoinThreshold": str(64 * 1024 * 1024),
    # streams: large state on local disk, and sessions of a busy channel merged before the shuffle
    "spark.sql.streaming.stateStore.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    ),
    "spark.sql.streaming.sessionWindow.merge.sessions.in.local.partition": "true",
}


def prepare(spark: SparkSession) -> SparkSession:
    """Set the runtime options the library relies on; a session may be prepared many times."""
    for key, value in SETTINGS.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    return spark


@contextmanager
def setting(spark: SparkSession, key: str, value: str) -> Iterator[None]:
    """A runtime option for the jobs inside, as before afterwards."""
    before = spark.conf.get(key, None)
    spark.conf.set(key, value)
    try:
        yield
    finally:
        spark.conf.unset(key) if before is None else spark.conf.set(key, before)


def build(
    master: str = "local[*]", app: str = "hearthgrid", shuffle_partitions: int = 8, work: str | None = None
) -> SparkSession:
    """A local session for tests and the bench."""
    builder = (
        SparkSession.builder.master(master)
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", os.environ.get("SPARK_DRIVER_MEMORY", "8g"))
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.session.timeZone", "UTC")
    )
    if work:
        builder = builder.config(WORK_DIR_KEY, work)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return prepare(spark)


def work_dir(spark: SparkSession) -> str:
    """The folder all executors share, named by the cluster; a temporary one only for a local session without it."""
    folder = spark.conf.get(WORK_DIR_KEY, None)
    if not folder:
        if not spark.sparkContext.master.startswith("local") or spark.sparkContext.master.startswith("local-cluster"):
            raise ValueError(f"set {WORK_DIR_KEY} to a folder that all executors share")
        application = spark.sparkContext.applicationId
        if application not in _own_folders:
            _own_folders[application] = tempfile.mkdtemp(prefix="hearthgrid-")
        folder = _own_folders[application]
    return folder.rstrip("/")


_own_folders: dict[str, str] = {}


def qualified(spark: SparkSession, path: str) -> str:
    """A path with its file system, as `_metadata.file_path` names it once file_key() has been applied."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = target.getFileSystem(spark._jsc.hadoopConfiguration())
    return re.sub("^file:/+", "file:/", fs.makeQualified(target).toUri().toString()).rstrip("/")


def file_key(path: Column) -> Column:
    return F.regexp_replace(path, "^file:/+", "file:/")


def remove(spark: SparkSession, path: str, when_done: bool = False) -> None:
    """Delete a folder on any supported file system, now or when the application ends."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = target.getFileSystem(spark._jsc.hadoopConfiguration())
    fs.deleteOnExit(target) if when_done else fs.delete(target, True)


def scratch(spark: SparkSession, name: str) -> str:
    """A new folder below the shared one, which goes with all it holds when the application ends."""
    path = f"{work_dir(spark)}/{name}-{uuid.uuid4().hex[:12]}"
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = target.getFileSystem(spark._jsc.hadoopConfiguration())
    fs.mkdirs(target)
    fs.deleteOnExit(target)
    return path


def planned_bytes(df: DataFrame) -> int:
    """Size of a table as the planner estimates it."""
    return int(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())


def file_length(spark: SparkSession, path: str) -> int | None:
    """Length of a file on any supported file system, None if there is no such path."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = target.getFileSystem(spark._jsc.hadoopConfiguration())
    return fs.getFileStatus(target).getLen() if fs.exists(target) else None


def exists(spark: SparkSession, path: str) -> bool:
    return file_length(spark, path) is not None


def folders(spark: SparkSession, path: str) -> list[str]:
    """Names of the folders directly below a path, by one listing; none if there is no such path."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = target.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(target):
        return []
    return sorted(s.getPath().getName() for s in fs.listStatus(target) if s.isDirectory())
