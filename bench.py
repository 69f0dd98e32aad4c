"""Times the headline work and prints one JSON line.

Inputs (topic logs, CSV exports) are written once beforehand and not timed.
Parsing is the median of five warm runs; everything else is one run.
"""

from __future__ import annotations

import dataclasses
import json
import os
import statistics
import tempfile
import time
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from freshet.operators import audit, replay
from freshet.operators.bronze import parse_bronze, quarantine
from freshet.plans import catalog
from freshet.plans.feeds import FEEDS, feed_records, payload_rows
from freshet.registry import registry
from freshet.session import scratch_dir, scratch_scope, session_settings
from freshet.sources import topic_log
from freshet.streaming import runner

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
ROWS_PER_FILE = 25_000  # of the topic logs; a file is read by one task


def session() -> SparkSession:
    builder = (
        SparkSession.builder.master(f"local[{CPUS}]")
        .appName("freshet-bench")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "16g")
        .config("spark.sql.shuffle.partitions", CPUS)
        .config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="bench-"))
    )
    for key, value in session_settings().items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def timed(work) -> float:
    begin = time.perf_counter()
    work()
    return time.perf_counter() - begin


def drain(df: DataFrame) -> None:
    df.write.format("noop").mode("overwrite").save()


def warm_median(df: DataFrame, runs: int = 5) -> float:
    drain(df)
    return statistics.median(timed(lambda: drain(df)) for _ in range(runs))


def file_count(spark: SparkSession, path: str) -> int:
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet")
    return files.option("recursiveFileLookup", True).load(path).select("path").count()


def main() -> None:
    spark = session()
    with scratch_scope(spark):
        result = measured(spark)
    print(json.dumps(result))
    spark.stop()


def dense_items(spark: SparkSession) -> DataFrame:
    """Line items at dense offsets, as topics have them, with one in a thousand missing."""
    number = F.col("_metadata.row_index")
    rows = spark.read.parquet(f"{SF_DIR}/lineitem.parquet").select(
        F.lit("shop.order_items").alias("_kafka_topic"),
        (number % 3).cast("int").alias("_kafka_partition"),
        F.floor(number / 3).alias("_kafka_offset"),
    )
    return rows.where("_kafka_offset % 1000 <> 7")


def measured(spark: SparkSession) -> dict:
    specs = list(registry().values())
    base = catalog.stream_config(spark)
    for spec in specs:
        records = feed_records(spark, SF_DIR, FEEDS[spec.table])
        topic_log.write_records(records, base.log_dir, ROWS_PER_FILE)
    rows = {s.table: topic_log.read_batch(spark, base.log_dir, s.topic).count() for s in specs}
    seconds: dict[str, float] = {}
    facts: dict[str, float] = {}

    def fresh(**settings):
        lake = scratch_dir(spark, "bench")
        return dataclasses.replace(
            base, lakehouse=f"{lake}/lake", checkpoints=f"{lake}/ckpt", **settings
        )

    for spec in specs:
        records = topic_log.read_batch(spark, base.log_dir, spec.topic)
        seconds[f"parse_{spec.table}"] = warm_median(parse_bronze(records, spec))
        rate = rows[spec.table] / seconds[f"parse_{spec.table}"]
        facts[f"parse_{spec.table}_rows_per_sec"] = rate
    items = next(spec for spec in specs if spec.table == "order_items")
    records = topic_log.read_batch(spark, base.log_dir, items.topic)
    seconds["quarantine_order_items"] = warm_median(quarantine(records, items))

    for name, settings in (("plain", {"compact_dates": False}), ("compact", {})):
        cfg = fresh(**settings)
        seconds[f"stream_order_items_{name}"] = timed(lambda: runner.run(spark, [items], cfg))
        facts[f"stream_order_items_{name}_files"] = file_count(spark, cfg.table_path("order_items"))
    facts["stream_order_items_rows_per_sec"] = (
        rows["order_items"] / seconds["stream_order_items_plain"]
    )

    together = fresh()
    seconds["five_streams_together"] = timed(lambda: runner.run(spark, specs, together))
    apart = fresh()
    seconds["five_streams_one_by_one"] = timed(
        lambda: [runner.run(spark, [spec], apart) for spec in specs]
    )

    bronze = audit.read_bronze(spark, together, items)
    seconds["duplicate_events"] = timed(lambda: drain(audit.duplicate_events(bronze)))
    seconds["dedup_events"] = timed(lambda: drain(audit.dedup_events(bronze)))
    seconds["offset_gaps"] = timed(lambda: drain(audit.offset_gaps(bronze)))
    seconds["offset_gap_ranges"] = timed(lambda: drain(audit.offset_gap_ranges(bronze)))
    dense = dense_items(spark)
    seconds["offset_gaps_dense"] = timed(lambda: drain(audit.offset_gaps(dense)))
    seconds["offset_gap_ranges_dense"] = timed(lambda: drain(audit.offset_gap_ranges(dense)))
    seconds["topic_mismatch"] = timed(lambda: drain(audit.topic_mismatch(bronze)))
    tables = [audit.read_bronze(spark, together, spec) for spec in specs]
    needed = ["_kafka_topic", "_kafka_timestamp", "_ingested_at", "_bronze_date"]
    every = reduce(DataFrame.unionByName, (table.select(*needed) for table in tables))
    seconds["ingest_lag"] = timed(lambda: drain(audit.ingest_lag(every)))
    seconds["reconcile"] = timed(lambda: drain(audit.reconcile(audit.count_by_day(every), every)))
    day = audit.bronze_day(spark, together, items, "2024-01-03")
    seconds["bronze_day"] = timed(lambda: drain(day))

    data_dir = scratch_dir(spark, "csv")
    for spec in specs:
        feed = FEEDS[spec.table]
        fields = [f"f_{name} as {name}" for name in feed.fields]
        export = payload_rows(spark, SF_DIR, feed).selectExpr(*fields)
        catalog.export_csv(export, f"{data_dir}/{spec.source_file}")
    log_dir = scratch_dir(spark, "log")

    def replay_all() -> None:
        records = replay.replay_records(spark, specs, data_dir)
        topic_log.append(records, log_dir, specs)

    seconds["replay_five_topics"] = timed(replay_all)
    facts["replay_rows_per_sec"] = sum(rows.values()) / seconds["replay_five_topics"]
    return {
        "metric": "total_seconds",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": {name: round(value, 3) for name, value in seconds.items()},
        "facts": {name: round(value) for name, value in facts.items()},
        "rows": rows,
        "sf": os.path.basename(SF_DIR.rstrip("/")).removeprefix("sf"),
    }


if __name__ == "__main__":
    main()
