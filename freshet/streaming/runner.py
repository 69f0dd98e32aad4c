"""Starting, watching and stopping the set of bronze streams."""

from __future__ import annotations

import logging
from collections.abc import Callable, Iterable
from contextlib import nullcontext
from dataclasses import replace

from pyspark.errors import StreamingQueryException
from pyspark.sql import SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from freshet.config import IngestConfig
from freshet.operators.bronze import parse_bronze
from freshet.registry import TopicSpec
from freshet.session import open_files
from freshet.sources.records import read_topic
from freshet.streaming import batches
from freshet.streaming.sink import write_bronze

log = logging.getLogger(__name__)

DATES = 8  # whose files a task writes at once

Watcher = Callable[[StreamingQuery], None]


def start_stream(
    spark: SparkSession,
    spec: TopicSpec,
    cfg: IngestConfig,
    on_batch: batches.OnBatch | None = None,
    after_write: Callable[[str], None] | None = None,
) -> StreamingQuery:
    """One topic's stream; each batch reports its rows and those left unparsed.

    Spark's own sinks report through the query's progress; ``batches`` tables call
    ``on_batch``, and ``after_write`` between a batch's write and its entry in the ledger.
    """
    write_batch = None
    if cfg.table_format == "batches":
        epoch = batches.open_epoch(spark, cfg, spec)
        if epoch and cfg.source == "kafka":
            offsets = batches.starting_offsets(spark, cfg, spec)
            cfg = replace(cfg, starting_offsets=offsets, starting_time=None)
        write_batch = batches.BatchWriter(spec, cfg, epoch, on_batch, after_write)
    bronze = parse_bronze(read_topic(spark, spec, cfg), spec, cfg.keep_raw)
    if not write_batch:
        bronze = bronze.observe(
            spec.table,
            F.count(F.lit(1)).alias("rows"),
            F.count_if(F.col("_event_id").isNull()).alias("without_event_id"),
        )
    # Under the FAIR scheduler every topic gets its own share of the executors.
    context, pool = spark.sparkContext, "spark.scheduler.pool"
    before = context.getLocalProperty(pool)
    context.setLocalProperty(pool, spec.table)
    try:
        return write_bronze(bronze, spec, cfg, write_batch)
    finally:
        context.setLocalProperty(pool, before)


def start_all(
    spark: SparkSession,
    specs: Iterable[TopicSpec],
    cfg: IngestConfig,
    on_batch: batches.OnBatch | None = None,
) -> list[StreamingQuery]:
    """Start every topic's stream; if one cannot start, none is left running."""
    queries: list[StreamingQuery] = []
    try:
        for spec in specs:
            queries.append(start_stream(spark, spec, cfg, on_batch))
    except BaseException:
        stop_all(queries)
        raise
    return queries


def stop_all(queries: Iterable[StreamingQuery]) -> None:
    for query in queries:
        if query.isActive:
            query.stop()


def await_all(
    spark: SparkSession,
    queries: Iterable[StreamingQuery],
    watch: Watcher | None = None,
    poll_seconds: int = 10,
) -> None:
    """Wait until all streams end; raise the first failure.

    On a failure or an interrupt the other streams are stopped. ``watch`` is
    called for every running stream at each poll, and once more when it ends.
    """
    running = list(queries)
    try:
        while running:
            spark.streams.resetTerminated()
            # Only wait if no stream ended before the reset.
            if all(query.isActive for query in running):
                try:
                    spark.streams.awaitAnyTermination(poll_seconds)
                except StreamingQueryException:
                    log.debug("a stream failed; its own exception is raised below")
            still = []
            for query in running:
                # Before the look: a stream that ends after it is looked at once more.
                active = query.isActive
                if watch:
                    watch(query)
                if active:
                    still.append(query)
                elif failure := query.exception():
                    raise failure
            running = still
    finally:
        stop_all(running)


class Progress:
    """Running totals per stream of one run, read from the batches' own metrics.

    ``batches`` tables hand on every batch (``add``) and keep them in their ledger, whose
    totals outlive the run. Of other tables:

    An idle stream reports under the number its next batch will have, without metrics;
    only a report with metrics is a batch. Spark keeps the last reports only
    (``spark.sql.streaming.numRecentProgressUpdates``, raised by the package's session
    settings); should batches have been dropped between two polls, that is logged.
    """

    def __init__(self, every: int = 10_000):
        self.every = every
        self.rows: dict[str, int] = {}
        self.unparsed: dict[str, int] = {}
        self._last_batch: dict[str, int] = {}

    def __call__(self, query: StreamingQuery) -> None:
        for batch in query.recentProgress:
            last = self._last_batch.get(query.name)
            if not batch["observedMetrics"] or (last is not None and batch["batchId"] <= last):
                continue
            if last is not None and batch["batchId"] > last + 1:
                log.warning("%s: batches after %d were not counted", query.name, last)
            self._last_batch[query.name] = batch["batchId"]
            for metrics in batch["observedMetrics"].values():
                self.add(query.name, metrics["rows"], metrics["without_event_id"])

    def add(self, name: str, rows: int, unparsed: int) -> None:
        before = self.rows.get(name, 0)
        self.rows[name] = before + rows
        self.unparsed[name] = self.unparsed.get(name, 0) + unparsed
        if self.rows[name] // self.every > before // self.every:
            log.info("%s: %d rows", name, self.rows[name])


def run(
    spark: SparkSession, specs: Iterable[TopicSpec], cfg: IngestConfig, watch: Watcher | None = None
) -> Progress:
    """Run all streams to their end (``available_now``) or until interrupted."""
    progress = Progress()

    def watcher(query: StreamingQuery) -> None:
        progress(query)
        if watch:
            watch(query)

    # A task has few dates once they are gathered, and need not sort its rows to write them.
    gathered = cfg.compact_dates and cfg.table_format == "parquet"
    with open_files(spark, DATES) if gathered else nullcontext():
        await_all(spark, start_all(spark, specs, cfg, progress.add), watcher)
    return progress
