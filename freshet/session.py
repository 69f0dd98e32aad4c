"""Session set-up and the shared scratch folder."""

from __future__ import annotations

import functools
import re
import tempfile
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    # Spark's default type for times has no statistics, by which readers leave files out.
    "spark.sql.parquet.outputTimestampType": "TIMESTAMP_MICROS",
    # Bronze streams keep no state, so their batches may be re-planned too.
    "spark.sql.adaptive.streaming.stateless.enabled": "true",
    # Duplicate removal keeps its ids on disk, with incremental checkpoints.
    "spark.sql.streaming.stateStore.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    ),
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    # Reports of batches kept for the running totals between two polls.
    "spark.sql.streaming.numRecentProgressUpdates": "10000",
}

DELTA_SETTINGS = {
    "spark.sql.extensions": "io.delta.sql.DeltaSparkSessionExtension",
    "spark.sql.catalog.spark_catalog": "org.apache.spark.sql.delta.catalog.DeltaCatalog",
}


def session_settings(table_format: str = "parquet") -> dict[str, str]:
    return SETTINGS | (DELTA_SETTINGS if table_format == "delta" else {})


def build_session(app_name: str = "freshet", table_format: str = "parquet") -> SparkSession:
    """A session with the package's settings.

    The Delta classes are only named when Delta tables are asked for, so that a
    session without that connector still starts.
    """
    builder = SparkSession.builder.appName(app_name)
    for key, value in session_settings(table_format).items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def located_file(spark: SparkSession, path: str):
    """The file system a path lies on, and the path in its terms."""
    located = spark._jvm.org.apache.hadoop.fs.Path(path)
    conf = spark._jsparkSession.sessionState().newHadoopConf()
    return located.getFileSystem(conf), located


def path_exists(spark: SparkSession, path: str) -> bool:
    files, located = located_file(spark, path)
    return files.exists(located)


def qualified(spark: SparkSession, path: str) -> str:
    """The path with its file system, as Spark names files."""
    files, located = located_file(spark, path)
    return files.makeQualified(located).toString()


def list_folder(spark: SparkSession, path: str) -> list[str]:
    files, located = located_file(spark, path)
    return [status.getPath().toString() for status in files.listStatus(located)]


def remove_folder(spark: SparkSession, path: str) -> None:
    files, located = located_file(spark, path)
    files.delete(located, True)


def make_folder(spark: SparkSession, path: str) -> None:
    files, located = located_file(spark, path)
    files.mkdirs(located)


@contextmanager
def _set(spark: SparkSession, setting: str, value: str) -> Iterator[None]:
    before = spark.conf.get(setting)
    spark.conf.set(setting, value)
    try:
        yield
    finally:
        spark.conf.set(setting, before)


@contextmanager
def small_splits(spark: SparkSession, most: int) -> Iterator[None]:
    """What is run within reads files in splits of at most so many bytes, row groups kept whole.

    For tasks that hold more than they read, as sorts of rows made from compact ones do.
    Plans take the setting when they are run.
    """
    parts = spark._jsparkSession.sessionState().conf().filesMaxPartitionBytes()
    with _set(spark, "spark.sql.files.maxPartitionBytes", str(min(most, parts))):
        yield


@contextmanager
def open_files(spark: SparkSession, most: int) -> Iterator[None]:
    """Tasks run within write to so many folders at once before they sort their rows by folder."""
    with _set(spark, "spark.sql.maxConcurrentOutputFileWriters", str(most)):
        yield


@functools.cache
def _local_scratch() -> str:
    return tempfile.mkdtemp(prefix="freshet-")


# The scratch folders of the scope this code runs in; outside of one they are kept.
_scope: ContextVar[list[str] | None] = ContextVar("scratch", default=None)


def scratch_dir(spark: SparkSession, label: str) -> str:
    """A fresh path for intermediate tables, visible to every executor.

    It lies under ``spark.checkpoint.dir``. Where that is unset, only a session
    that is one process (``local[n]``) may fall back to a folder of this machine.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if shared is None:
        if not re.fullmatch(r"local(\[.*\])?", spark.conf.get("spark.master", "")):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        shared = _local_scratch()
    path = f"{shared.rstrip('/')}/freshet/{label}-{uuid.uuid4().hex}"
    if (made := _scope.get()) is not None:
        made.append(path)
    return path


@contextmanager
def scratch_scope(spark: SparkSession) -> Iterator[Callable[[], None]]:
    """Delete the scratch folders made within, and only those, at the end.

    Frames over them end with it. What it yields, when called, leaves the folder made
    last to the scope around this one, or to the session. Threads started within need a
    copy of the context.
    """
    made: list[str] = []
    outer = _scope.get()
    token = _scope.set(made)

    def keep_last() -> None:
        path = made.pop()
        if outer is not None:
            outer.append(path)

    try:
        yield keep_last
    finally:
        _scope.reset(token)
        for path in made:
            remove_folder(spark, path)
