import dataclasses
import datetime as dt
import os
import time

import pytest
from pyspark.errors import AnalysisException, StreamingQueryException
from pyspark.sql import functions as F

from freshet import IngestConfig, registry
from freshet.operators import audit
from freshet.operators.bronze import parse_bronze, quarantine
from freshet.registry import RECORD_SCHEMA
from freshet.sources import topic_log
from freshet.streaming import runner
from freshet.streaming.dedup import dedup_stream
from freshet.streaming.sink import write_bronze
from records import T0, bronze_frame, plan_text, record_frame

SPECS = registry("shop")
ORDERS = SPECS["shop.orders"]


@pytest.fixture
def cfg(tmp_path):
    return IngestConfig(
        lakehouse=str(tmp_path / "lake"),
        checkpoints=str(tmp_path / "checkpoints"),
        source="topic_log",
        log_dir=str(tmp_path / "log"),
        available_now=True,
    )


def log_rows(spark, cfg, first, last, day="2024-01-15", topic="shop.orders"):
    value = F.format_string(
        f'{{"order_id": "%d", "_topic": "{topic}", "_ingested_at": "{day}T00:00:00+00:00",'
        ' "_event_id": "e%d"}',
        "id",
        "id",
    )
    records = spark.range(first, last).select(
        F.col("id").cast("string").cast("binary").alias("key"),
        value.cast("binary").alias("value"),
        F.lit(topic).alias("topic"),
        F.lit(0).alias("partition"),
        F.col("id").alias("offset"),
        F.lit(T0).alias("timestamp"),
        F.lit(0).alias("timestampType"),
    )
    topic_log.write_records(records.select(*RECORD_SCHEMA.names), cfg.log_dir)


def bronze(spark, cfg, spec=ORDERS):
    return audit.read_bronze(spark, cfg, spec)


def test_stream_equals_batch(spark, cfg):
    log_rows(spark, cfg, 0, 100)
    topic_log.write_records(record_frame(spark, ["not json", "", None, "{}"], partition=1), cfg.log_dir)
    runner.run(spark, [ORDERS], cfg)
    streamed = bronze(spark, cfg)
    batch = parse_bronze(topic_log.read_batch(spark, cfg.log_dir, ORDERS.topic), ORDERS)
    assert streamed.columns == batch.columns == ORDERS.bronze_schema.names
    assert streamed.exceptAll(batch).isEmpty() and batch.exceptAll(streamed).isEmpty()


def test_undated_rows_have_a_partition_of_their_own(spark, cfg, tmp_path):
    log_rows(spark, cfg, 0, 10)
    topic_log.write_records(record_frame(spark, ["not json"], partition=1), cfg.log_dir)
    runner.run(spark, [ORDERS], cfg)
    folders = {p.name for p in (tmp_path / "lake/bronze/orders").glob("_bronze_date=*")}
    assert folders == {"_bronze_date=2024-01-15", "_bronze_date=__HIVE_DEFAULT_PARTITION__"}
    assert audit.bronze_day(spark, cfg, ORDERS, None).count() == 1


def test_resume_takes_only_new_records(spark, cfg):
    counts = []
    log_rows(spark, cfg, 0, 40)
    for extra in (0, 0, 5):
        if extra:
            log_rows(spark, cfg, 40, 40 + extra)
        progress = runner.run(spark, [ORDERS], cfg)
        counts.append((bronze(spark, cfg).count(), progress.rows.get("bronze_orders", 0)))
    assert counts == [(40, 40), (40, 0), (45, 5)]


def test_rate_limit_splits_the_backlog_into_batches(spark, cfg):
    for i in range(4):
        log_rows(spark, cfg, i * 10, i * 10 + 10)
    limited = dataclasses.replace(cfg, max_files_per_trigger=1)
    batches = []
    runner.run(spark, [ORDERS], limited, lambda q: batches.append(len(q.recentProgress)))
    assert bronze(spark, cfg).count() == 40 and max(batches) >= 4


def test_five_streams_have_own_tables_and_checkpoints(spark, cfg, tmp_path):
    for topic in SPECS:
        log_rows(spark, cfg, 0, 20, topic=topic)
    progress = runner.run(spark, SPECS.values(), cfg)
    assert progress.rows == {f"bronze_{spec.table}": 20 for spec in SPECS.values()}
    for spec in SPECS.values():
        assert bronze(spark, cfg, spec).where(F.col("_topic") == spec.topic).count() == 20
        assert (tmp_path / "checkpoints/bronze" / spec.table / "offsets").is_dir()


def test_progress_counts_rows_without_event_id(spark, cfg):
    topic_log.write_records(record_frame(spark, ["not json", "{}", '{"_event_id": "e"}']), cfg.log_dir)
    progress = runner.run(spark, [ORDERS], cfg)
    assert progress.unparsed == {"bronze_orders": 2}


def test_files_older_than_the_newest_are_read(spark, cfg, tmp_path):
    log_rows(spark, cfg, 0, 10)
    runner.run(spark, [ORDERS], cfg)
    known = set((tmp_path / "log").rglob("*.parquet"))
    log_rows(spark, cfg, 10, 15)
    for path in set((tmp_path / "log").rglob("*.parquet")) - known:
        os.utime(path, (0, time.time() - 40 * 86_400))
    runner.run(spark, [ORDERS], cfg)
    assert bronze(spark, cfg).count() == 15


def test_lost_files_fail_unless_told_otherwise(spark, cfg, tmp_path):
    def lose(first):
        log_rows(spark, cfg, first, first + 5)
        batch = topic_log.read_stream(spark, ORDERS, lenient if first else cfg)

        def drop(rows, number):
            for path in (tmp_path / "log").rglob("*.parquet"):
                path.unlink()
            rows.count()

        writer = batch.writeStream.foreachBatch(drop).trigger(availableNow=True)
        return writer.option("checkpointLocation", cfg.checkpoint_path(f"c{first}")).start()

    lenient = dataclasses.replace(cfg, fail_on_data_loss=False)
    with pytest.raises(StreamingQueryException):
        runner.await_all(spark, [lose(0)])


def test_progress_counts_after_an_idle_phase(spark, cfg):
    log_rows(spark, cfg, 0, 75)
    endless = dataclasses.replace(cfg, available_now=False, trigger_seconds=0.2)
    progress = runner.Progress()
    queries = runner.start_all(spark, [ORDERS], endless)
    begin = time.time()

    def watch(query):
        progress(query)
        if not sent and time.time() - begin > 14:  # Spark reports idle streams every 10 s
            sent.append(log_rows(spark, cfg, 75, 150))
        if progress.rows.get("bronze_orders") == 150 or time.time() - begin > 60:
            query.stop()

    sent = []
    runner.await_all(spark, queries, watch, poll_seconds=1)
    assert progress.rows == {"bronze_orders": 150}


def test_progress_counts_more_batches_than_spark_keeps_by_default(spark, cfg):
    records = topic_log.read_batch  # written as 120 files, read one by one
    log_rows(spark, cfg, 0, 120)
    rows = records(spark, cfg.log_dir, ORDERS.topic).repartition(120, "offset").collect()
    assert len(rows) == 120
    many = dataclasses.replace(cfg, log_dir=f"{cfg.log_dir}-many", max_files_per_trigger=1)
    frame = spark.createDataFrame(rows, RECORD_SCHEMA).repartitionByRange(120, "offset")
    topic_log.write_records(frame, many.log_dir)
    progress = runner.Progress()
    queries = runner.start_all(spark, [ORDERS], many)
    runner.await_all(spark, queries, poll_seconds=600)
    assert len(queries[0].recentProgress) > 100
    progress(queries[0])
    assert progress.rows == {"bronze_orders": 120}


def test_empty_topic_can_be_streamed(spark, cfg):
    topic_log.create_topics(spark, cfg.log_dir, [ORDERS])
    assert runner.run(spark, [ORDERS], cfg).rows == {}


def test_table_keeps_raw_values_on_request(spark, cfg):
    raw = dataclasses.replace(cfg, keep_raw=True)
    topic_log.write_records(record_frame(spark, ["not json"]), cfg.log_dir)
    runner.run(spark, [ORDERS], raw)
    assert bronze(spark, raw).first()._raw_value == "not json"


def test_daily_read_prunes_partitions(spark, cfg):
    for day in (14, 15, 16):
        log_rows(spark, cfg, day * 10, day * 10 + day, day=f"2024-01-{day}")
    runner.run(spark, [ORDERS], cfg)
    one = audit.bronze_day(spark, cfg, ORDERS, "2024-01-15")
    assert one.count() == 15
    plan = plan_text(one)
    assert "2024-01-15" in plan[plan.index("PartitionFilters") :].split("]")[0]


def test_compact_dates_split_a_dominating_date(spark, cfg, tmp_path):
    """Few files for small dates; the large one is still written by several tasks."""
    for i in range(8):
        log_rows(spark, cfg, i * 20_000, (i + 1) * 20_000, day="2024-01-15")
        log_rows(spark, cfg, 1_000_000 + i, 1_000_000 + i + 1, day="2024-01-16")
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "256k")
    try:
        runner.run(spark, [ORDERS], dataclasses.replace(cfg, compact_dates=True))
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")

    def files(day):
        return len(list((tmp_path / f"lake/bronze/orders/_bronze_date={day}").glob("*.parquet")))

    assert bronze(spark, cfg).count() == 160_008
    assert files("2024-01-16") == 1 and files("2024-01-15") > 2


@pytest.mark.parametrize("mode", ["update", "complete"])
def test_sink_only_appends(spark, cfg, mode):
    topic_log.create_topics(spark, cfg.log_dir, [ORDERS])
    rows = topic_log.read_stream(spark, ORDERS, cfg)
    writer = rows.writeStream.format("parquet").outputMode(mode)
    with pytest.raises(AnalysisException):
        writer.option("checkpointLocation", cfg.checkpoint_path("x")).start(cfg.table_path("x"))


def failing(spark, cfg, name="failing"):
    log_rows(spark, cfg, 0, 1, topic="t.bad")
    spec = dataclasses.replace(ORDERS, topic="t.bad", table=name)
    rows = parse_bronze(topic_log.read_stream(spark, spec, cfg), spec)
    broken = rows.withColumn("order_id", F.raise_error(F.lit("boom")).cast("string"))
    return write_bronze(broken, spec, dataclasses.replace(cfg, available_now=False))


def test_failure_of_a_later_stream_is_raised_and_stops_the_others(spark, cfg):
    log_rows(spark, cfg, 0, 5)
    endless = dataclasses.replace(cfg, available_now=False, trigger_seconds=1)
    queries = [*runner.start_all(spark, [ORDERS], endless), failing(spark, cfg)]
    with pytest.raises(StreamingQueryException, match="boom"):
        runner.await_all(spark, queries, poll_seconds=1)
    assert not any(query.isActive for query in queries)


def test_interrupt_stops_all_streams(spark, cfg):
    log_rows(spark, cfg, 0, 5)
    endless = dataclasses.replace(cfg, available_now=False, trigger_seconds=1)
    queries = runner.start_all(spark, [ORDERS], endless)

    def interrupt(query):
        raise KeyboardInterrupt

    with pytest.raises(KeyboardInterrupt):
        runner.await_all(spark, queries, interrupt, poll_seconds=1)
    assert not queries[0].isActive


def test_streams_started_before_a_bad_one_are_stopped(spark, cfg):
    log_rows(spark, cfg, 0, 5)
    endless = dataclasses.replace(cfg, available_now=False, trigger_seconds=1)
    with pytest.raises(AnalysisException):
        runner.start_all(spark, [ORDERS, SPECS["shop.customers"]], endless)
    assert not spark.streams.active


def test_dedup_on_a_stream_with_a_hot_id(spark, cfg, tmp_path):
    rows = [(0, i, "hot" if i % 3 == 0 else f"e{i % 50}") for i in range(300)]
    rows += [(1, i, None) for i in range(4)]
    source = bronze_frame(spark, rows).withColumn("_kafka_timestamp", F.lit(T0))
    source.write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(source.schema).parquet(str(tmp_path / "in"))
    query = (
        dedup_stream(stream, "1 hour")
        .writeStream.format("parquet")
        .option("checkpointLocation", str(tmp_path / "c"))
        .trigger(availableNow=True)
        .start(str(tmp_path / "out"))
    )
    runner.await_all(spark, [query])
    out = spark.read.parquet(str(tmp_path / "out"))
    assert out.columns == source.columns
    got = [r._event_id for r in out.collect()]
    expected = {e for _, _, e in rows if e}
    assert sorted(filter(None, got)) == sorted(expected) and got.count(None) == 4


def test_dedup_keeps_late_rows_and_drops_late_copies(spark, cfg, tmp_path):
    """Three runs on one checkpoint; the second brings records older than any delay."""

    def deliver(rows, when):
        frame = bronze_frame(spark, rows).withColumn("_kafka_timestamp", F.lit(when))
        frame.write.mode("append").parquet(str(tmp_path / "in"))
        stream = spark.readStream.schema(frame.schema).parquet(str(tmp_path / "in"))
        query = (
            dedup_stream(stream, "1 hour")
            .writeStream.format("parquet")
            .option("checkpointLocation", str(tmp_path / "c"))
            .trigger(availableNow=True)
            .start(str(tmp_path / "out"))
        )
        runner.await_all(spark, [query])

    deliver([(0, 0, "a"), (0, 1, "b")], T0 + dt.timedelta(days=40))
    deliver([(0, 2, "late"), (1, 0, None)], T0)
    deliver([(0, 3, "a"), (0, 4, "late"), (0, 5, "late"), (2, 0, "shop.orders|1|0")], T0)
    found = [r._event_id for r in spark.read.parquet(str(tmp_path / "out")).collect()]
    assert sorted(map(str, found)) == ["None", "a", "b", "late", "shop.orders|1|0"]


def test_quarantine_as_a_stream(spark, cfg, tmp_path):
    topic_log.write_records(record_frame(spark, ["not json", "{}", ""]), cfg.log_dir)
    query = (
        quarantine(topic_log.read_stream(spark, ORDERS, cfg), ORDERS)
        .writeStream.format("parquet")
        .option("checkpointLocation", str(tmp_path / "c"))
        .trigger(availableNow=True)
        .start(str(tmp_path / "bad"))
    )
    runner.await_all(spark, [query])
    bad = spark.read.parquet(str(tmp_path / "bad")).orderBy("_kafka_offset").collect()
    assert [(r._kafka_offset, r._raw_value) for r in bad] == [(0, "not json"), (2, "")]
