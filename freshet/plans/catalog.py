"""Registered queries: each reads whole test tables through the package's operators.

Timestamps leave as microseconds and dates as text, so that both engines agree on
their form. Queries that stream write their log and tables to scratch folders.
"""

from __future__ import annotations

import dataclasses
from collections.abc import Callable
from functools import partial, reduce

from pyspark.errors import StreamingQueryException
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from freshet.config import IngestConfig
from freshet.functions import bronze_date, ingested_at, ingested_instant, key_partition, utf8
from freshet.operators import audit, replay
from freshet.operators import lag as lags
from freshet.operators.content import content_differences
from freshet.operators.drift import undeclared_fields
from freshet.operators.bronze import parse_bronze, quarantine
from freshet.plans.feeds import EVENTS, FEEDS, SPECS, Feed, feed_records, payload_rows, table
from freshet.registry import RECORD_SCHEMA, TopicSpec, registry
from freshet.session import (
    list_folder,
    located_file,
    make_folder,
    qualified,
    remove_folder,
    scratch_dir,
)
from freshet.sources import kafka, topic_log
from freshet.sources.csv_records import FILE, ORDINAL, MissingInputs, read_csv, require_inputs
from freshet.streaming import batches, pace, runner
from freshet.streaming.dedup import dedup_stream
from freshet.streaming.sink import packed_id

Query = Callable[[SparkSession, str], DataFrame]

STAMP = "2024-01-15T08:23:11.432000+00:00"
CHUNK = 1 << 20  # rows per exported CSV file
COPY_STEP = 1 << 40  # offset distance between copies of a record
FILE_ROWS = 1 << 19  # rows of a log file, which one task writes
FILE_BYTES = 1 << 26  # text of a CSV file, which one task writes


def portable(df: DataFrame) -> DataFrame:
    columns = {
        "_kafka_timestamp": F.unix_micros("_kafka_timestamp").alias("_kafka_timestamp_us")
        if "_kafka_timestamp" in df.columns
        else None,
        "_bronze_date": F.col("_bronze_date").cast("string").alias("_bronze_date"),
    }
    return df.select(*(columns.get(c, c) for c in df.columns))


def parsed(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    feed = FEEDS[name]
    return parse_bronze(feed_records(spark, sf_dir, feed), feed.spec)


def bronze(name: str, spark: SparkSession, sf_dir: str) -> DataFrame:
    return portable(parsed(spark, sf_dir, name))


def bronze_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    feed = FEEDS["events"]
    rows = parse_bronze(feed_records(spark, sf_dir, feed), feed.spec, keep_raw=True)
    return portable(rows)


# -- streams -----------------------------------------------------------------


def stream_config(spark: SparkSession, **settings) -> IngestConfig:
    base = scratch_dir(spark, "ingest")
    return IngestConfig(
        lakehouse=f"{base}/lakehouse",
        checkpoints=f"{base}/checkpoints",
        source="topic_log",
        log_dir=f"{base}/log",
        available_now=True,
        **settings,
    )


def back_date(spark: SparkSession, path: str, days: int) -> None:
    """Set a file's time back, as restored or copied files have it."""
    files, located = located_file(spark, path)
    modified = files.getFileStatus(located).getModificationTime()
    files.setTimes(located, modified - days * 86_400_000, -1)


def logged(spark: SparkSession, sf_dir: str, cfg: IngestConfig, names: list[str]) -> None:
    for name in names:
        topic_log.write_records(feed_records(spark, sf_dir, FEEDS[name]), cfg.log_dir)


def streamed_orders(spark: SparkSession, sf_dir: str, **settings) -> DataFrame:
    cfg = stream_config(spark, **settings)
    logged(spark, sf_dir, cfg, ["orders"])
    runner.run(spark, [SPECS["orders"]], cfg)
    return portable(audit.read_bronze(spark, cfg, SPECS["orders"]))


def bronze_resume(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two deliveries and three runs on one checkpoint; the second run finds nothing."""
    cfg = stream_config(spark)
    orders = feed_records(spark, sf_dir, FEEDS["orders"])
    early = F.col("timestamp") < F.lit("2024-01-04T00:00:00+00:00").cast("timestamp")
    topic_log.write_records(orders.where(early), cfg.log_dir)
    runner.run(spark, [SPECS["orders"]], cfg)
    runner.run(spark, [SPECS["orders"]], cfg)
    topic_log.write_records(orders.where(~early), cfg.log_dir)
    runner.run(spark, [SPECS["orders"]], cfg)
    return portable(audit.read_bronze(spark, cfg, SPECS["orders"]))


def bronze_all_topics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows per topic and date after five streams ran side by side."""
    cfg = stream_config(spark)
    specs = list(registry().values())
    logged(spark, sf_dir, cfg, [spec.table for spec in specs])
    runner.run(spark, specs, cfg)
    counts = [audit.count_by_day(audit.read_bronze(spark, cfg, spec)) for spec in specs]
    return portable(reduce(DataFrame.unionByName, counts))


def bronze_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    cfg = stream_config(spark)
    logged(spark, sf_dir, cfg, ["events"])
    runner.run(spark, [EVENTS], cfg)
    return portable(audit.bronze_day(spark, cfg, EVENTS, "2024-01-03"))


def bronze_late_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two deliveries; the files of the second are dated ten days before the first."""
    cfg = stream_config(spark)
    orders = feed_records(spark, sf_dir, FEEDS["orders"])
    early = F.col("timestamp") < F.lit("2024-01-04T00:00:00+00:00").cast("timestamp")
    topic_log.write_records(orders.where(early), cfg.log_dir)
    runner.run(spark, [SPECS["orders"]], cfg)
    folder = topic_log.topic_path(cfg.log_dir, SPECS["orders"].topic)
    known = set(list_folder(spark, folder))
    topic_log.write_records(orders.where(~early), cfg.log_dir)
    for path in set(list_folder(spark, folder)) - known:
        back_date(spark, path, days=10)
    runner.run(spark, [SPECS["orders"]], cfg)
    return portable(audit.read_bronze(spark, cfg, SPECS["orders"]))


def bronze_trigger(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders by a stream that looks for new files every second, stopped once all are in."""
    cfg = dataclasses.replace(stream_config(spark), available_now=False, trigger_seconds=1)
    logged(spark, sf_dir, cfg, ["orders"])
    (query,) = runner.start_all(spark, [SPECS["orders"]], cfg)
    try:
        query.processAllAvailable()
    finally:
        runner.stop_all([query])
    return portable(audit.read_bronze(spark, cfg, SPECS["orders"]))


def files_each(rows: int, batches: int = 3) -> int:
    """Log files that one of some batches takes, so that a file has about ``FILE_ROWS`` rows."""
    return max(1, -(-rows // (batches * FILE_ROWS)))


def progress_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows and rows without event id that the streams report, each in three batches or some more."""
    specs = list(registry().values())
    topics = {spec: feed_records(spark, sf_dir, FEEDS[spec.table]) for spec in specs}
    rows = {spec: records.count() for spec, records in topics.items()}
    each = files_each(max(rows.values()))
    cfg = stream_config(spark, max_files_per_trigger=each)
    for spec, records in topics.items():
        topic_log.write_records(records, cfg.log_dir, max(1, -(-rows[spec] // (3 * each))))
    progress = runner.run(spark, specs, cfg)
    lines = [(name, rows, progress.unparsed[name]) for name, rows in progress.rows.items()]
    return spark.createDataFrame(lines, "stream string, rows long, without_event_id long")


# -- tables in batches ---------------------------------------------------------


ORDERS = SPECS["orders"]


def deliver(records: DataFrame, cfg: IngestConfig, batches: int = 3) -> None:
    """Append records to the log, spread over the files of some batches."""
    files = batches * cfg.max_files_per_trigger
    topic_log.write_records(records.repartition(files, "offset"), cfg.log_dir)


def in_batches(records: DataFrame, batches: int = 3, **settings) -> IngestConfig:
    """A table in batches, which takes the files of one of them at a time; few records are in one file."""
    each = files_each(records.count(), batches)
    spark = records.sparkSession
    return stream_config(spark, table_format="batches", max_files_per_trigger=each, **settings)


def run_failing(spark: SparkSession, cfg: IngestConfig, number: int) -> None:
    """Run the orders' stream, which fails between the write of one batch and its commit."""

    def fail(batch: str) -> None:
        if batch.endswith(f"{number:06d}"):
            raise RuntimeError("lost after the write")

    query = runner.start_stream(spark, ORDERS, cfg, after_write=fail)
    try:
        runner.await_all(spark, [query])
    except StreamingQueryException:
        return
    raise AssertionError("the stream was to fail")


def batch_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the ledger knows after two runs with a restart in between, each of three batches."""
    orders = feed_records(spark, sf_dir, FEEDS["orders"])
    cfg = in_batches(orders)
    early = F.col("timestamp") < F.lit("2024-01-04T00:00:00+00:00").cast("timestamp")
    for delivery in (orders.where(early), orders.where(~early)):
        deliver(delivery, cfg)
        runner.run(spark, [ORDERS], cfg)
    lines = batches.ledger_notes(spark, cfg, ORDERS).read()
    return lines.groupBy("stream", "_kafka_partition").agg(
        F.countDistinct("batch").alias("batches"),
        F.sum("rows").alias("rows"),
        F.sum("without_event_id").alias("without_event_id"),
        F.min("first_offset").alias("first_offset"),
        F.max("last_offset").alias("last_offset"),
    )


def bronze_failed_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A batch that fails after its write is run again and replaces itself."""
    orders = feed_records(spark, sf_dir, FEEDS["orders"])
    cfg = in_batches(orders)
    deliver(orders, cfg)
    run_failing(spark, cfg, 1)
    runner.run(spark, [ORDERS], cfg)
    return portable(audit.read_bronze(spark, cfg, ORDERS))


def bronze_lost_checkpoint(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The checkpoint is lost with a batch half done; the next run reads on from the table."""
    orders = feed_records(spark, sf_dir, FEEDS["orders"])
    cfg = in_batches(orders)
    early = F.col("timestamp") < F.lit("2024-01-04T00:00:00+00:00").cast("timestamp")
    deliver(orders.where(early), cfg)
    run_failing(spark, cfg, 1)
    remove_folder(spark, cfg.checkpoint_path(ORDERS.table))
    deliver(orders.where(~early), cfg)
    runner.run(spark, [ORDERS], cfg)
    return portable(audit.read_bronze(spark, cfg, ORDERS))


def offset_gaps_by_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Missing offsets of line items that came in eight batches, from the batches' runs."""
    spec = SPECS["order_items"]
    positions = gappy_items(spark, sf_dir)
    records = positions.select(
        F.lit(None).cast("binary").alias("key"),
        utf8(F.lit('{"_ingested_at": "2024-01-01T00:00:00+00:00"}')).alias("value"),
        F.col("_kafka_topic").alias("topic"),
        F.col("_kafka_partition").cast("int").alias("partition"),
        F.col("_kafka_offset").alias("offset"),
        F.lit("2024-01-01T00:00:00+00:00").cast("timestamp").alias("timestamp"),
        F.lit(0).alias("timestampType"),
    )
    cfg = in_batches(records, batches=8)
    deliver(records, cfg, batches=8)
    runner.run(spark, [spec], cfg)
    return batches.offset_gap_ranges(spark, cfg, spec)


def bronze_since(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders sent on the fourth day or later."""
    return streamed_orders(spark, sf_dir, starting_time="2024-01-04T00:00:00+00:00")


def find_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Where the events of some orders are, in a table with a Bloom filter on ids per row group."""
    orders = feed_records(spark, sf_dir, FEEDS["orders"])
    cfg = in_batches(orders, id_filters=10_000)
    deliver(orders, cfg)
    runner.run(spark, [ORDERS], cfg)
    wanted = parse_bronze(orders, ORDERS).where("cast(order_id as bigint) % 1499 = 7")
    path = scratch_dir(spark, "wanted")
    wanted.select("_event_id").write.parquet(path)  # one in 1,499
    found = audit.find_events(audit.read_bronze(spark, cfg, ORDERS), spark.read.parquet(path))
    return portable(found.select("_event_id", "_kafka_partition", "_kafka_offset", "_bronze_date"))


def deduplicated(spark: SparkSession, deliveries: list[DataFrame]) -> DataFrame:
    """What passes the stream's duplicate removal when rows come in several deliveries."""
    cfg = stream_config(spark)
    base = scratch_dir(spark, "copies")
    for rows in deliveries:
        rows.write.mode("append").parquet(f"{base}/in")
        copies = spark.readStream.schema(SPECS["orders"].bronze_schema).parquet(f"{base}/in")
        query = (
            dedup_stream(copies, "30 days")
            .writeStream.format("parquet")
            .option("path", f"{base}/out")
            .option("checkpointLocation", cfg.checkpoint_path("dedup"))
            .trigger(availableNow=True)
            .start()
        )
        runner.await_all(spark, [query])
    return spark.read.schema(SPECS["orders"].bronze_schema).parquet(f"{base}/out")


def dedup_on_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Event ids that pass the stream's duplicate removal."""
    return deduplicated(spark, [copied_orders(spark, sf_dir)]).select("_event_id")


def dedup_late(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three deliveries: records dated 40 days on, others never seen before, then copies.

    Ids and topics are compared, and that each row still has its position.
    """
    copies = copied_orders(spark, sf_dir)
    first = F.col("_kafka_offset") < COPY_STEP
    ahead = F.col("_kafka_timestamp") + F.expr("interval 40 days")
    odd = F.col("order_id").cast("bigint") % 2 == 1
    passed = deduplicated(
        spark,
        [
            copies.where(first & odd).withColumn("_kafka_timestamp", ahead),
            copies.where(first & ~odd),
            copies.where(~first),
        ],
    )
    return passed.select("_event_id", "_topic", F.col("_kafka_offset").isNotNull().alias("placed"))


# -- replay ------------------------------------------------------------------


def numbered_rows(spark: SparkSession, sf_dir: str, feed: Feed) -> DataFrame:
    """A table's payload fields, numbered by their row in the file."""
    rows = payload_rows(spark, sf_dir, feed)
    return rows.select(
        *(F.col(f"f_{name}").alias(name) for name in feed.fields),
        F.col("_metadata.file_name").alias(FILE),
        F.col("_metadata.row_index").alias(ORDINAL),
    )


def event_envelope(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Enriched records, with all fields read back from key and value."""
    feed = FEEDS["events"]
    rows = replay.enrich(numbered_rows(spark, sf_dir, feed), feed.spec.topic, F.lit(STAMP))
    records = replay.to_records(rows, feed.spec)
    value = F.from_json(F.col("value").cast("string"), feed.spec.payload_schema)
    return records.select(
        F.col("key").cast("string").alias("record_key"), "topic", value.alias("v")
    ).select("record_key", "topic", "v.*")


def event_ids_per_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files of one name in two folders, whose fields differ only in where a bar stands."""
    path = scratch_dir(spark, "csv")
    customers = table(spark, sf_dir, "customer").select(
        F.explode(F.array(F.lit(1), F.lit(2))).alias("day"), F.col("c_name").alias("name")
    )
    bar = F.col("day") == 1
    customers.select(
        "day",
        F.when(bar, F.concat("name", F.lit("|x"))).otherwise(F.col("name")).alias("customer_id"),
        F.when(bar, F.lit("y")).otherwise(F.lit("x|y")).alias("customer_city"),
    ).write.partitionBy("day").option("header", True).csv(path)
    rows = read_csv(spark, path, quoted_newlines=False)
    ids = replay.enrich(rows, "shop.customers", F.lit(STAMP), root=qualified(spark, path))
    return ids.agg(F.count("*").alias("rows"), F.countDistinct("_event_id").alias("event_ids"))


def missing_inputs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An export per market segment, of which only the first few are delivered."""
    path = scratch_dir(spark, "exports")
    customers = table(spark, sf_dir, "customer").select("c_custkey", "c_mktsegment")
    delivered = customers.where("c_mktsegment < 'H'").withColumn("segment", F.col("c_mktsegment"))
    delivered.write.partitionBy("segment").csv(path)
    segments = customers.select("c_mktsegment").distinct().collect()  # a handful
    try:
        require_inputs(spark, [f"{path}/segment={r.c_mktsegment}" for r in segments])
        absent = []
    except MissingInputs as error:
        absent = [(p.rsplit("=", 1)[-1],) for p in error.paths]
    return spark.createDataFrame(absent, "missing string")


def ingested_stamp(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The time of ingestion, read back: its form, its date, and that it is now."""
    stamped = table(spark, sf_dir, "events").select("event_id", ingested_at().alias("stamp"))
    written = r"^[0-9]{4}-[0-9]{2}-[0-9]{2}T[0-9]{2}:[0-9]{2}:[0-9]{2}\.[0-9]{6}\+00:00$"
    age = F.unix_seconds(F.current_timestamp()) - F.unix_seconds(ingested_instant(F.col("stamp")))
    return stamped.select(
        "event_id",
        F.col("stamp").rlike(written).alias("in_form"),
        (bronze_date(F.col("stamp")).cast("string") == F.left("stamp", F.lit(10))).alias("same_date"),
        age.between(0, 60).alias("now"),
    )


def record_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Keys from a field, from a field that is sometimes NULL, and from none."""
    rows = table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").cast("string").alias("order_id"),
        F.expr("nullif(o_orderstatus, 'P')").alias("order_status"),
        F.col("_metadata.row_index").alias(ORDINAL),
    )
    number = F.col(ORDINAL)
    return rows.select(
        "order_id",
        replay.record_key(rows.columns, "order_id", number).alias("key_present"),
        replay.record_key(rows.columns, "order_status", number).alias("key_nullable"),
        replay.record_key(rows.columns, "absent", number).alias("key_absent"),
        F.octet_length(utf8(F.col("order_id"))).alias("key_bytes"),
    )


def key_partitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The partition each order's key falls on, of three."""
    rows = payload_rows(spark, sf_dir, FEEDS["orders"])
    key = utf8(F.col("f_order_id"))
    return rows.select(
        F.col("f_order_id").alias("order_id"), key_partition(key, 3).alias("partition")
    )


def replay_schedule(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = numbered_rows(spark, sf_dir, FEEDS["orders"])
    start = F.lit("2024-01-15T00:00:00+00:00").cast("timestamp")
    return replay.replay_schedule(rows, start, 0.05).select(
        "order_id", F.unix_micros("arrival_ts").alias("arrival_us")
    )


def export_csv(rows: DataFrame, path: str, **options: str | int) -> str:
    """Write rows as CSV files the way spreadsheets quote them."""
    quoted = rows.write.option("header", True).option("escape", '"').option("emptyValue", "")
    quoted.options(**options).csv(path)
    return path


def csv_replay(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders exported in key order, chunk by chunk, and read back with ordinals."""
    feed = FEEDS["orders"]
    rows = payload_rows(spark, sf_dir, feed)
    chunk = F.floor(F.col("o_orderkey") / CHUNK)
    path = scratch_dir(spark, "csv")
    (
        rows.select(
            chunk.alias("chunk"),
            "o_orderkey",
            *(F.col(f"f_{name}").alias(name) for name in feed.fields),
        )
        .repartitionByRange("chunk")
        .sortWithinPartitions("chunk", "o_orderkey")
        .drop("o_orderkey")
        .write.partitionBy("chunk")
        .option("header", True)
        .csv(path)
    )
    return read_csv(spark, f"{path}/chunk=*").select(
        *feed.fields, F.col(ORDINAL).alias("row_in_file")
    )


def csv_quoted_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents, with their newlines and quotes, through CSV and back."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "lang", "source", "text")
    path = export_csv(docs, scratch_dir(spark, "csv"))
    return read_csv(spark, path).select("doc_id", "lang", "source", "text")


def csv_mixed_row_ends(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents through CSV whose rows end in lone returns, newlines, or both."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "lang", "source", "text")
    quote = F.lit('"')
    cells = (
        F.concat(quote, F.replace(F.coalesce(c, F.lit("")), quote, F.lit('""')), quote)
        for c in ("lang", "source", "text")
    )
    row = F.concat_ws(",", F.col("doc_id").cast("string"), *cells)
    # Four rows a line, joined by lone returns; every other line ends in a return and a newline.
    lines = docs.groupBy(F.expr("doc_id div 4").alias("part")).agg(
        F.array_sort(F.collect_list(F.struct("doc_id", row.alias("row")))).alias("rows")
    )
    joined = F.concat(F.array_join("rows.row", "\r"), F.when(F.col("part") % 2 == 0, "\r").otherwise(""))
    # A task writes a whole file, so their number grows with the texts.
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    file = (F.col("part") % (4 * (1 + size // (4 * FILE_BYTES)))).alias("file")
    body = lines.select(file, F.lit(1).alias("place"), joined.alias("value"))
    heads = body.select("file").distinct().select(
        "file", F.lit(0).alias("place"), F.lit("doc_id,lang,source,text\r").alias("value")
    )
    ordered = heads.unionByName(body).repartition("file").sortWithinPartitions("file", "place")
    path = scratch_dir(spark, "csv")
    ordered.select("value", "file").write.partitionBy("file").text(path)
    return read_csv(spark, f"{path}/file=*").select("doc_id", "lang", "source", "text")


def log_offsets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dense offsets per partition, counted in blocks of 1000 rows."""
    rows = numbered_rows(spark, sf_dir, FEEDS["orders"]).select(
        F.lit("shop.orders").alias("topic"),
        (F.col("order_id").cast("bigint") % 3).cast("int").alias("partition"),
        "order_id",
        FILE,
        ORDINAL,
    )
    return topic_log.assign_offsets(rows, block_rows=1000).select(
        "topic", "partition", "offset", "order_id"
    )


def export_topics(spark: SparkSession, sf_dir: str, specs: list[TopicSpec]) -> str:
    data_dir = scratch_dir(spark, "csv")
    for spec in specs:
        feed = FEEDS[spec.table]
        rows = payload_rows(spark, sf_dir, feed)
        fields = (F.col(f"f_{name}").alias(name) for name in feed.fields)
        # One task reads a packed file, so each has some rows only.
        packed = {"compression": "gzip", "maxRecordsPerFile": FILE_ROWS}
        export_csv(rows.select(*fields), f"{data_dir}/{spec.source_file}", **packed)
    return data_dir


def replayed_twice(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bronze keeps both replays of a file; equal event ids tell them apart from news."""
    cfg = stream_config(spark)
    specs = [SPECS["order_payments"], SPECS["customers"]]
    data_dir = export_topics(spark, sf_dir, specs)
    for _ in range(2):
        topic_log.append(replay.replay_records(spark, specs, data_dir), cfg.log_dir, specs)
    runner.run(spark, specs, cfg)

    def totals(spec: TopicSpec) -> DataFrame:
        rows = audit.read_bronze(spark, cfg, spec)
        counted = {
            "rows": rows,
            "duplicated ids": audit.duplicate_events(rows),
            "events": audit.dedup_events(rows),
        }
        return reduce(
            DataFrame.unionByName,
            (
                frame.agg(F.count("*").alias("count")).select(
                    F.lit(spec.topic).alias("_kafka_topic"), F.lit(what).alias("what"), "count"
                )
                for what, frame in counted.items()
            ),
        )

    return reduce(DataFrame.unionByName, map(totals, specs))


def replay_to_bronze(spark: SparkSession, sf_dir: str) -> DataFrame:
    """CSV files to topic log to tables, all five topics; totals per topic."""
    cfg = stream_config(spark)
    specs = list(registry().values())
    data_dir = export_topics(spark, sf_dir, specs)
    topic_log.append(replay.replay_records(spark, specs, data_dir), cfg.log_dir, specs)
    runner.run(spark, specs, cfg)

    def totals(spec: TopicSpec) -> DataFrame:
        rows = audit.read_bronze(spark, cfg, spec)
        gaps = audit.offset_gaps(rows).groupBy("_kafka_topic").agg(
            F.sum("missing").alias("missing_offsets"), F.sum("offsets").alias("offsets")
        )
        counts = rows.groupBy("_kafka_topic").agg(
            F.count("*").alias("rows"),
            F.countDistinct(packed_id(F.col("_event_id"))).alias("event_ids"),
            F.countDistinct(spec.key_field).alias("keys"),
        )
        return counts.join(gaps, "_kafka_topic")

    return reduce(DataFrame.unionByName, map(totals, specs))


def waves_keep_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders keyed by their status, few keys with many rows, sent in waves of 5,000 rows.

    Per key its rows and those that were sent after a later one, and whether any task had
    more than a wave and a block of rows.
    """
    rows = numbered_rows(spark, sf_dir, FEEDS["orders"])
    spec = dataclasses.replace(ORDERS, key_field="order_status")
    path = scratch_dir(spark, "sent")
    make_folder(spark, path)

    def send(part: DataFrame, lane: int, wave: int) -> None:
        # A row's place among those of its task says when it was sent.
        gathered = part.repartition("topic", "key").sortWithinPartitions(FILE, ORDINAL)
        gathered.select(
            F.col("key").cast("string").alias("key"),
            ORDINAL,
            F.lit(wave).alias("wave"),
            F.monotonically_increasing_id().alias("place"),
        ).write.mode("append").parquet(f"{path}/lane={lane}")

    kafka.send_waves(replay.to_records(rows, spec), send, 5000)
    schema = f"key string, {ORDINAL} long, wave int, place long, lane int"
    sent = spark.read.schema(schema).parquet(path)
    order = Window.partitionBy("key").orderBy("wave", "place")
    late = F.col(ORDINAL) < F.lag(ORDINAL).over(order)
    tasks = F.shiftright("place", 33).alias("task")
    loads = sent.groupBy("lane", "wave", tasks).agg(F.count("*").alias("load"))
    most = loads.agg(F.max("load")).first()[0] or 0
    return sent.withColumn("late", late).groupBy("key").agg(
        F.count("*").alias("rows"),
        F.count_if("late").alias("late"),
        F.lit(most > 10_000).alias("overloaded"),
    )


def paced_replay(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders released at a rate that takes some seconds: each once, none before it is due."""
    rows = numbered_rows(spark, sf_dir, FEEDS["orders"]).select("order_id", FILE, ORDINAL)
    base, rate = scratch_dir(spark, "paced-orders"), max(1, rows.count() // 3)
    pace.release(
        rows, rate, f"{base}/checkpoint", lambda due: due.write.mode("append").parquet(f"{base}/out")
    )
    out = spark.read.parquet(f"{base}/out")
    first = out.agg(F.min(F.unix_micros("released_at"))).first()[0]
    due = F.floor(F.col(ORDINAL) / rate) * 1_000_000
    return out.select(
        "order_id", (F.unix_micros("released_at") - F.lit(first) >= due - 1_000).alias("on_time")
    )


# -- audits ------------------------------------------------------------------


def mixed_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Topic records whose values are JSON objects, near misses and prose."""
    events = table(spark, sf_dir, "events").select(
        F.col("event_id").alias("id"),
        F.posexplode(
            F.array(
                F.col("props"),
                F.expr("left(props, length(props) - 1)"),
                F.concat(F.lit("["), "props", F.lit("]")),
                F.lit("{}"),
                F.lit("null"),
                F.lit(""),
                F.lit(None).cast("string"),
                F.concat(F.lit('{"event_id": '), F.col("value").cast("string"), F.lit("}")),
            )
        ).alias("form", "text"),
    )
    docs = table(spark, sf_dir, "documents").select(
        F.col("doc_id").alias("id"), F.lit(8).alias("form"), "text"
    )
    return (
        events.unionByName(docs)
        .select(
            F.lit(None).cast("binary").alias("key"),
            utf8(F.col("text")).alias("value"),
            F.lit(EVENTS.topic).alias("topic"),
            F.col("form").alias("partition"),
            F.col("id").alias("offset"),
            F.lit("2024-01-01T00:00:00+00:00").cast("timestamp").alias("timestamp"),
            F.lit(0).alias("timestampType"),
        )
        .select(*RECORD_SCHEMA.names)
    )


def quarantined(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quarantine(mixed_values(spark, sf_dir), EVENTS)


def copied_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders sent one to three times.

    The second copy keeps its id and the third gets a new one; all orders of
    status P share a single id.
    """
    copy = F.col("copy")
    event_id = (
        F.when(F.col("order_status") == "P", F.lit("shared"))
        .when(copy == 2, F.concat("_event_id", F.lit("-again")))
        .otherwise(F.col("_event_id"))
    )
    rows = parsed(spark, sf_dir, "orders")
    last_copy = (F.col("order_id").cast("bigint") % 3).cast("int")
    return (
        rows.withColumn("copy", F.explode(F.sequence(F.lit(0), last_copy)))
        .withColumn("_event_id", event_id)
        .withColumn("_kafka_offset", F.col("_kafka_offset") + copy * F.lit(COPY_STEP))
        .drop("copy")
    )


def duplicate_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit.duplicate_events(copied_orders(spark, sf_dir))


def dedup_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return portable(audit.dedup_events(copied_orders(spark, sf_dir)))


def gappy_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items at offsets given by their order, which leaves gaps and repeats."""
    return table(spark, sf_dir, "lineitem").select(
        F.lit("shop.order_items").alias("_kafka_topic"),
        (F.col("l_linenumber") % 3).alias("_kafka_partition"),
        F.col("l_orderkey").alias("_kafka_offset"),
    )


def offset_gaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit.offset_gaps(gappy_items(spark, sf_dir))


def offset_gap_ranges(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit.offset_gap_ranges(gappy_items(spark, sf_dir), block=1000)


def topic_mismatch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events that all arrive on one topic but name the topic of their type."""
    named = F.expr("nullif(concat('shop.', event_type), 'shop.error')")
    rows = parsed(spark, sf_dir, "events").select(
        F.lit("shop.click").alias("_kafka_topic"), named.alias("_topic")
    )
    return audit.topic_mismatch(rows)


def ingest_lag(spark: SparkSession, sf_dir: str) -> DataFrame:
    needed = ["_kafka_topic", "_kafka_timestamp", "_ingested_at"]
    topics = (parsed(spark, sf_dir, name).select(*needed) for name in FEEDS)
    return audit.ingest_lag(reduce(DataFrame.unionByName, topics))


def reconcile(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events by the day they happened against the days they landed on."""
    source = (
        table(spark, sf_dir, "events")
        .groupBy(F.col("ts").cast("date").alias("_bronze_date"))
        .agg(F.count("*").alias("rows"))
        .withColumn("_kafka_topic", F.lit(EVENTS.topic))
    )
    return portable(audit.reconcile(source, parsed(spark, sf_dir, "events")))


def differing_content(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events against themselves with some changed, some lost, some doubled."""
    rows = parsed(spark, sf_dir, "events")
    number = F.col("event_id").cast("bigint")
    landed = rows.where(number % 101 != 5).withColumn(
        "value", F.when(number % 97 == 3, F.concat("value", F.lit("0"))).otherwise(F.col("value"))
    )
    landed = landed.unionByName(landed.where(number % 103 == 9))
    fields = list(EVENTS.fields)
    return portable(content_differences(rows, landed, fields))


def drifting_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fields of the events' own JSON, and of errors with further ones, on a topic per type."""
    more = F.format_string('{"k": "%d", "event_id": "x", "seen": [%d, 1]}', "user_id", "user_id")
    records = table(spark, sf_dir, "events").select(
        F.concat(F.lit("shop."), "event_type").alias("topic"),
        utf8(F.when(F.col("event_type") == "error", more).otherwise(F.col("props"))).alias("value"),
    )
    return undeclared_fields(records, EVENTS)


def lag_quantiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quantiles of the lag from stored daily sketches, and whether their ranks are near enough."""
    needed = ["_kafka_topic", "_bronze_date", "_kafka_timestamp", "_ingested_at"]
    rows = reduce(DataFrame.unionByName, (parsed(spark, sf_dir, name).select(*needed) for name in FEEDS))
    # Parsed once, for the sketches and for the exact ranks.
    staged = scratch_dir(spark, "lags")
    rows.write.parquet(staged)
    rows = spark.read.schema(rows.schema).parquet(staged)
    path = scratch_dir(spark, "sketches")
    lags.lag_sketches(rows, accuracy=8 * lags.ACCURACY).write.partitionBy("_bronze_date").parquet(path)
    found = lags.lag_quantiles(spark.read.parquet(path), (0.1, 0.5, 0.9, 0.99))
    exact = rows.select("_kafka_topic", lags.lag_us().alias("lag")).groupBy("_kafka_topic", "lag").count()
    ranks = found.join(exact, "_kafka_topic").groupBy("_kafka_topic", "quantile", "timed").agg(
        (F.sum(F.when(F.col("lag") < F.col("lag_us"), F.col("count")).otherwise(0)) / F.sum("count")).alias("under"),
        (F.sum(F.when(F.col("lag") <= F.col("lag_us"), F.col("count")).otherwise(0)) / F.sum("count")).alias("upto"),
    )
    near = (F.col("upto") >= F.col("quantile") - lags.RANK_ERROR) & (
        F.col("under") <= F.col("quantile") + lags.RANK_ERROR
    )
    return ranks.select("_kafka_topic", "quantile", "timed", near.alias("near"))


def orders_by_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    return portable(audit.count_by_day(parsed(spark, sf_dir, "orders")))


QUERIES: dict[str, Query] = {
    **{f"bronze_{name}": partial(bronze, name) for name in FEEDS},
    "bronze_events_raw": bronze_raw,
    "bronze_orders_by_day": orders_by_day,
    "bronze_orders_stream": streamed_orders,
    "bronze_orders_compact": partial(streamed_orders, compact_dates=True),
    "bronze_resume": bronze_resume,
    "bronze_late_files": bronze_late_files,
    "bronze_trigger": bronze_trigger,
    "bronze_all_topics": bronze_all_topics,
    "progress_totals": progress_totals,
    "bronze_day": bronze_day,
    "event_envelope": event_envelope,
    "event_ids_per_file": event_ids_per_file,
    "missing_inputs": missing_inputs,
    "ingested_stamp": ingested_stamp,
    "record_keys": record_keys,
    "key_partitions": key_partitions,
    "replay_schedule": replay_schedule,
    "csv_replay": csv_replay,
    "csv_quoted_text": csv_quoted_text,
    "log_offsets": log_offsets,
    "replay_to_bronze": replay_to_bronze,
    "replayed_twice": replayed_twice,
    "quarantine": quarantined,
    "duplicate_events": duplicate_events,
    "dedup_events": dedup_events,
    "dedup_stream": dedup_on_stream,
    "dedup_stream_late": dedup_late,
    "offset_gaps": offset_gaps,
    "offset_gap_ranges": offset_gap_ranges,
    "topic_mismatch": topic_mismatch,
    "ingest_lag": ingest_lag,
    "reconcile": reconcile,
    "batch_ledger": batch_ledger,
    "bronze_failed_batch": bronze_failed_batch,
    "bronze_lost_checkpoint": bronze_lost_checkpoint,
    "offset_gaps_by_batch": offset_gaps_by_batch,
    "bronze_since": bronze_since,
    "find_events": find_events,
    "waves_keep_order": waves_keep_order,
    "paced_replay": paced_replay,
    "csv_mixed_row_ends": csv_mixed_row_ends,
    "differing_content": differing_content,
    "drifting_fields": drifting_fields,
    "lag_quantiles": lag_quantiles,
}
