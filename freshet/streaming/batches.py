"""Plain Parquet tables, each batch written as a whole and entered in a ledger.

``{table}/_bronze_date={day}/_batch={epoch}-{number}`` holds what one batch brought for one
day. A batch that is run again replaces its own folders, so that a failure between the
write and the commit leaves no row twice; no file lists the others, and any engine that
knows partition folders reads the table.

The ledger beside the table holds a line per batch and topic partition, and the offsets
of the batch as runs. An epoch is the time of one checkpoint. When the checkpoint is lost,
the next stream opens a new one: batches that were written but not entered are entered as
incomplete, a broker is read on from where the complete batches end, and rows whose
positions the table already has are left out.
"""

from __future__ import annotations

import json
import logging
from collections.abc import Callable, Iterable
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from freshet.config import IngestConfig
from freshet.operators.intervals import LOG, RUN_SCHEMA, merged_runs, missing_ranges, single_runs
from freshet.registry import POSITION, TopicSpec
from freshet.session import list_folder, make_folder, path_exists
from freshet.streaming.notes import Notes
from freshet.streaming.sink import by_date

log = logging.getLogger(__name__)

OnBatch = Callable[[str, int, int], None]  # stream, rows, rows without event id

BATCH = "_batch"
LEDGER_SCHEMA = (
    "stream string, batch string, complete boolean, _kafka_topic string, _kafka_partition int,"
    " rows long, without_event_id long, first_offset long, last_offset long"
)
UNDATED = "__HIVE_DEFAULT_PARTITION__"
EARLIEST = -2  # a broker's word for the first offset there is


def batch_name(epoch: int, number: int) -> str:
    return f"{epoch:04d}-{number:012d}"


def ledger_notes(spark: SparkSession, cfg: IngestConfig, spec: TopicSpec) -> Notes:
    return Notes(spark, f"{cfg.ledger_path(spec.table)}/batches", LEDGER_SCHEMA)


def run_notes(spark: SparkSession, cfg: IngestConfig, spec: TopicSpec) -> Notes:
    return Notes(spark, f"{cfg.ledger_path(spec.table)}/offsets", RUN_SCHEMA)


def totals(spark: SparkSession, cfg: IngestConfig, specs: Iterable[TopicSpec]) -> DataFrame:
    """Batches, rows and rows without event id of each stream since its first run."""
    ledgers = (ledger_notes(spark, cfg, spec).read() for spec in specs)
    return (
        reduce(DataFrame.unionByName, ledgers)
        .groupBy("stream")
        .agg(
            F.countDistinct("batch").alias("batches"),
            F.sum("rows").alias("rows"),
            F.sum("without_event_id").alias("without_event_id"),
        )
    )


def offset_gap_ranges(spark: SparkSession, cfg: IngestConfig, spec: TopicSpec) -> DataFrame:
    """Every run of missing offsets, from the batches' runs; the table is not read."""
    return missing_ranges(run_notes(spark, cfg, spec).read())


def table_rows(spark: SparkSession, cfg: IngestConfig, spec: TopicSpec) -> DataFrame:
    """The table with the name of each row's batch, which is a folder name like the date."""
    schema = spec.stored_schema(cfg.keep_raw).add(BATCH, "string")
    return spark.read.schema(schema).parquet(cfg.table_path(spec.table))


def _batch_rows(spark: SparkSession, cfg: IngestConfig, spec: TopicSpec, name: str, days: list[str]) -> DataFrame:
    """What one batch has written, by its own folders."""
    table = cfg.table_path(spec.table)
    folders = [f"{table}/_bronze_date={day}/{BATCH}={name}" for day in days]
    return spark.read.schema(spec.stored_schema(cfg.keep_raw)).option("basePath", table).parquet(*folders)


def enter(
    spark: SparkSession, cfg: IngestConfig, spec: TopicSpec, name: str, days: list[str], complete: bool = True
) -> None:
    """Put a written batch into the ledger, from its files: position and id columns only."""
    rows = _batch_rows(spark, cfg, spec, name, days)
    lines = rows.groupBy(*LOG).agg(
        F.count("*").alias("rows"),
        F.count_if(F.col("_event_id").isNull()).alias("without_event_id"),
        F.min("_kafka_offset").alias("first_offset"),
        F.max("_kafka_offset").alias("last_offset"),
    )
    named = lines.select(
        F.lit(f"bronze_{spec.table}").alias("stream"),
        F.lit(name).alias("batch"),
        F.lit(complete).alias("complete"),
        *lines.columns,
    )
    run_notes(spark, cfg, spec).write(name, merged_runs(single_runs(rows)))
    ledger_notes(spark, cfg, spec).write(name, named.coalesce(1))  # a line per topic partition


def _settle(spark: SparkSession, cfg: IngestConfig, spec: TopicSpec) -> None:
    """Enter the batches that were written but not entered when their stream was lost."""
    if not path_exists(spark, cfg.table_path(spec.table)):
        return
    entered = ledger_notes(spark, cfg, spec).read().select(F.col("batch").alias(BATCH)).distinct()
    there = table_rows(spark, cfg, spec).select(BATCH, F.col("_bronze_date").cast("string")).distinct()
    # At most the last batch of each epoch.
    left = there.join(entered, BATCH, "left_anti").groupBy(BATCH).agg(
        F.collect_list(F.coalesce("_bronze_date", F.lit(UNDATED))).alias("days")
    )
    for row in left.collect():
        log.warning("%s: batch %s was written but not committed", spec.table, row[BATCH])
        enter(spark, cfg, spec, row[BATCH], row["days"], complete=False)


def open_epoch(spark: SparkSession, cfg: IngestConfig, spec: TopicSpec) -> int:
    """Which checkpoint of its table this one is; a new one finds the table in order."""

    def numbers(folder: str) -> list[int]:
        found = list_folder(spark, folder) if path_exists(spark, folder) else []
        return [int(path.rsplit("/", 1)[-1]) for path in found]

    mark = f"{cfg.checkpoint_path(spec.table)}/epoch"
    if known := numbers(mark):
        return max(known)
    opened = f"{cfg.ledger_path(spec.table)}/epochs"
    epoch = max(numbers(opened), default=-1) + 1
    make_folder(spark, f"{opened}/{epoch:04d}")
    if epoch:
        _settle(spark, cfg, spec)
    make_folder(spark, f"{mark}/{epoch:04d}")
    return epoch


def starting_offsets(spark: SparkSession, cfg: IngestConfig, spec: TopicSpec) -> str:
    """Where a broker's topic goes on: after the complete batches, at its start where there are none.

    One number per partition is taken to the driver.
    """
    complete = ledger_notes(spark, cfg, spec).read().where("complete")
    ends = complete.where(F.col("_kafka_topic") == spec.topic).groupBy("_kafka_partition")
    known = {r[0]: r[1] + 1 for r in ends.agg(F.max("last_offset")).collect()}
    places = range(max([spec.partitions, *(p + 1 for p in known)]))
    return json.dumps({spec.topic: {str(p): known.get(p, EARLIEST) for p in places}})


def without_known(spark: SparkSession, cfg: IngestConfig, spec: TopicSpec, epoch: int, rows: DataFrame) -> DataFrame:
    """The rows whose positions no earlier epoch has written.

    Positions are only compared where a batch begins below the end of the earlier epochs,
    which is soon past. Rows that a batch itself holds twice both stay.
    """
    ends = ledger_notes(spark, cfg, spec).read().where(F.col("batch") < f"{epoch:04d}")
    ends = ends.groupBy(*LOG).agg(F.max("last_offset").alias("end"))
    begins = rows.groupBy(*LOG).agg(F.min("_kafka_offset").alias("begin"))
    if begins.join(ends, LOG).where("begin <= end").isEmpty():
        return rows
    earlier = table_rows(spark, cfg, spec).where(F.col(BATCH) < f"{epoch:04d}")
    return rows.join(earlier.select(*POSITION), list(POSITION), "left_anti").select(*rows.columns)


def _day_name(day: Column) -> Column:
    return F.coalesce(day.cast("string"), F.lit(UNDATED))


class BatchWriter:
    """Writes the batches of one stream, called by Spark with each and its number.

    ``after_write`` is called with the batch's name between its write and its entry in the
    ledger, ``on_batch`` with the stream's name, rows and rows without event id after it.
    """

    def __init__(
        self,
        spec: TopicSpec,
        cfg: IngestConfig,
        epoch: int,
        on_batch: OnBatch | None = None,
        after_write: Callable[[str], None] | None = None,
    ) -> None:
        self.spec, self.cfg, self.epoch = spec, cfg, epoch
        self.on_batch, self.after_write = on_batch, after_write

    def __call__(self, rows: DataFrame, number: int) -> None:
        spark, spec, cfg = rows.sparkSession, self.spec, self.cfg
        name = batch_name(self.epoch, number)
        if self.epoch:
            rows = without_known(spark, cfg, spec, self.epoch, rows)
        if rows.isEmpty():  # nothing could be observed in a plan that Spark finds empty
            return
        seen = Observation()
        rows = rows.observe(
            seen,
            F.count(F.lit(1)).alias("rows"),
            F.count_if(F.col("_event_id").isNull()).alias("without_event_id"),
            F.collect_set(_day_name(F.col("_bronze_date"))).alias("days"),
        ).withColumn(BATCH, F.lit(name))
        if cfg.compact_dates:
            rows = by_date(rows)
        (
            rows.write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .options(**cfg.file_options)
            .partitionBy("_bronze_date", BATCH)
            .parquet(cfg.table_path(spec.table))
        )
        found = seen.get
        if self.after_write:
            self.after_write(name)
        enter(spark, cfg, spec, name, found["days"])
        ledger_notes(spark, cfg, spec).fold(lambda notes: notes.coalesce(1))
        run_notes(spark, cfg, spec).fold(merged_runs)
        if self.on_batch:
            self.on_batch(f"bronze_{spec.table}", found["rows"], found["without_event_id"])
