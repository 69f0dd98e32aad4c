"""Intermediate tables in the folder that all executors share."""

from __future__ import annotations

import ctypes
import gc
import tempfile
import uuid
import zipfile
from collections.abc import Iterator
from contextlib import contextmanager
from pathlib import Path
from typing import TypeVar

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from freshet.session import scratch_dir


HANDED = 1024  # rows of texts handed to a worker at once; the session's own number holds ten times as much
Batch = TypeVar("Batch")

_shipped: set[str] = set()


def ship_code(spark: SparkSession) -> None:
    """Send this package's modules to the executors, once per application.

    Tasks import it, so that what a worker has learned (words, models) outlives a task.
    """
    context = spark.sparkContext
    if context.applicationId in _shipped:
        return
    package = Path(__file__).resolve().parents[1]
    archive = f"{tempfile.mkdtemp()}/{package.name}.zip"  # the driver serves it to all others
    with zipfile.ZipFile(archive, "w") as out:
        for module in sorted(package.rglob("*.py")):
            out.write(module, module.relative_to(package.parent))
    context.addPyFile(archive)
    _shipped.add(context.applicationId)


@contextmanager
def arrow_rows(spark: SparkSession, rows: int) -> Iterator[None]:
    """What is run within hands Python workers at most so many rows at once.

    For rows of some megabytes, of which Spark would put up to a quarter of a gigabyte in
    one batch. Plans take the setting when they are run, so run (stage) them within.
    """
    setting = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(setting)
    spark.conf.set(setting, str(min(rows, int(before)) if int(before) > 0 else rows))
    try:
        yield
    finally:
        spark.conf.set(setting, before)


def release_memory() -> None:
    """Hand back what this Python worker no longer uses but earlier tasks have left with it.

    Workers are kept from one step to the next, and with them all they ever allocated.
    """
    gc.collect()
    pa.default_memory_pool().release_unused()
    if trim := getattr(ctypes.CDLL(None), "malloc_trim", None):  # of the GNU C library
        trim(0)


def handing_back(batches: Iterator[Batch]) -> Iterator[Batch]:
    """A task's batches; before the first and after the last, the worker's idle memory goes back.

    Else the worker keeps what its largest task took while later steps need it elsewhere.
    """
    release_memory()
    yield from batches
    release_memory()


def staged(
    spark: SparkSession, df: DataFrame, label: str, compression: str = "snappy"
) -> DataFrame:
    """Write a frame to the shared scratch folder and return a scan of it.

    Cuts the lineage with files that outlive any executor, so that a later step
    neither repeats the work nor sees rows in another order.
    """
    path = scratch_dir(spark, label)
    df.write.option("compression", compression).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def bucketed(
    spark: SparkSession, df: DataFrame, key: str, label: str
) -> tuple[DataFrame, str]:
    """Stage a frame that is joined on its key again and again; also the table's name.

    It is shuffled once, here: joins on the key find it bucketed. Drop the table once
    it is no longer read; its files lie in the scratch folder like any others.
    """
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    name = f"{label}_{uuid.uuid4().hex}".replace("-", "_")
    writer = df.repartition(buckets, key).write.bucketBy(buckets, key).sortBy(key)
    writer.option("path", scratch_dir(spark, label)).format("parquet").saveAsTable(name)
    return spark.table(name), name


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")
