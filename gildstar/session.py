"""Session defaults and the shared folder that written tables live in."""

from __future__ import annotations

import tempfile
import threading
import uuid
from collections.abc import Iterator
from contextlib import AbstractContextManager, contextmanager

from pyspark.sql import SparkSession

DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.ui.showConsoleProgress": "false",
}

_local_roots: dict[str, str] = {}
_lock = threading.Lock()
_holders: dict[tuple[int, str], tuple[int, str | None]] = {}


def build_session(app_name: str = "gildstar", master: str | None = None, **conf) -> SparkSession:
    """A session with this library's defaults; ``conf`` keys use ``__`` for dots."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in DEFAULTS.items():
        builder = builder.config(key, value)
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), str(value))
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can reach, as named by ``spark.checkpoint.dir``.

    Only a local session may run without the setting; it then gets a temporary
    folder of its own.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root.rstrip("/")
    sc = spark.sparkContext
    if not sc.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder all executors share")
    if sc.applicationId not in _local_roots:
        _local_roots[sc.applicationId] = tempfile.mkdtemp(prefix="gildstar-")
    return _local_roots[sc.applicationId]


def file_system(spark: SparkSession, path: str):
    """The Hadoop file system behind ``path`` and the path as a Hadoop object."""
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()), hadoop_path


@contextmanager
def _holding(spark: SparkSession, name: str, value: object) -> Iterator[None]:
    """A setting that holds for a while; of several threads the first sets it and the last restores it."""
    held = id(spark), name
    with _lock:
        count, before = _holders.get(held) or (0, spark.conf.get(name, None))
        _holders[held] = count + 1, before
        spark.conf.set(name, str(value))
    try:
        yield
    finally:
        with _lock:
            count, before = _holders.pop(held)
            if count > 1:
                _holders[held] = count - 1, before
            elif before is None:
                spark.conf.unset(name)
            else:
                spark.conf.set(name, before)


def whole_variants(spark: SparkSession) -> AbstractContextManager[None]:
    """Store VARIANT columns as they are, not as one Parquet column per field found in them.

    For payloads that are read as a whole or by their arrays and objects: fields
    of their own then cost time at writing and again when they are put together.
    """
    return _holding(spark, "spark.sql.variant.inferShreddingSchema", "false")


def few_listings(spark: SparkSession) -> AbstractContextManager[None]:
    """Open many folders of few files each: a task lists many of them, not one."""
    tasks = 2 * spark.sparkContext.defaultParallelism
    return _holding(spark, "spark.sql.sources.parallelPartitionDiscovery.parallelism", tasks)


def many_writers(spark: SparkSession) -> AbstractContextManager[None]:
    """Write many folders of few rows each: every core takes its share of the files, however few bytes they hold."""
    return _holding(spark, "spark.sql.adaptive.coalescePartitions.minPartitionSize", "16k")


def shed_shuffles(spark: SparkSession) -> AbstractContextManager[None]:
    """Remove a query's shuffle files when it ends, not when the driver happens to collect its garbage.

    For chains of tables that are each written once: a DataFrame that is run
    again shuffles again.
    """
    return _holding(spark, "spark.sql.classic.shuffleDependency.fileCleanup.enabled", "true")


def run_folder(spark: SparkSession, label: str) -> str:
    """A new folder under the shared one, removed when the session's JVM ends."""
    path = f"{shared_folder(spark)}/gildstar-{label}-{uuid.uuid4().hex}"
    fs, hadoop_path = file_system(spark, path)
    fs.mkdirs(hadoop_path)
    fs.deleteOnExit(hadoop_path)
    return path
