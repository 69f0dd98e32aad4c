"""Queries spread their work where their input grows."""

from pyspark.sql import functions as F

from freshet.plans import catalog
from freshet.registry import registry
from freshet.session import list_folder, small_splits
from freshet.sources import kafka, topic_log
from freshet.sources.csv_records import FILE, ORDINAL
from freshet.streaming import batches, runner, sink
from records import plan_text

ORDERS = catalog.ORDERS


def orders_table(spark, path, count):
    spark.range(count).select(
        F.col("id").alias("o_orderkey"),
        F.lit(7).alias("o_custkey"),
        F.lit("O").alias("o_orderstatus"),
        F.lit(1.5).alias("o_totalprice"),
        F.lit("2024-01-01").cast("timestamp_ntz").alias("o_orderdate"),
        F.lit("1-URGENT").alias("o_orderpriority"),
    ).coalesce(1).write.parquet(f"{path}/orders.parquet")


def file_rows(spark, cfg, topic):
    rows = topic_log.read_batch(spark, cfg.log_dir, topic).groupBy("_metadata.file_path").count()
    return [r["count"] for r in rows.collect()]


def test_batches_take_more_files_as_rows_grow(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(catalog, "FILE_ROWS", 100)
    orders_table(spark, tmp_path, 3000)
    orders = catalog.feed_records(spark, str(tmp_path), catalog.FEEDS["orders"])
    cfg = catalog.in_batches(orders)
    catalog.deliver(orders, cfg)
    counts = file_rows(spark, cfg, ORDERS.topic)
    assert len(counts) == 30 and sum(counts) == 3000 and max(counts) < 300
    runner.run(spark, [ORDERS], cfg)
    ledger = batches.ledger_notes(spark, cfg, ORDERS).read()
    assert ledger.select("batch").distinct().count() == 3
    assert ledger.agg(F.sum("rows")).first()[0] == 3000


def test_progress_is_counted_over_files_of_bounded_rows(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(catalog, "FILE_ROWS", 100)
    orders_table(spark, tmp_path, 900)
    specs = {s.topic: s for s in registry().values() if s.table in ("orders", "order_payments")}
    monkeypatch.setattr(catalog, "registry", lambda: specs)
    made = []
    config = catalog.stream_config
    monkeypatch.setattr(catalog, "stream_config", lambda *a, **k: made.append(config(*a, **k)) or made[-1])
    lines = catalog.progress_totals(spark, str(tmp_path)).collect()
    assert {tuple(r) for r in lines} == {("bronze_orders", 900, 0), ("bronze_order_payments", 900, 0)}
    for topic in specs:
        assert file_rows(spark, made[0], topic) == [100] * 9
    assert made[0].max_files_per_trigger == 3


def test_lags_are_parsed_once(spark):
    plan = plan_text(catalog.lag_quantiles(spark, "/root/testdata/sf0.001"))
    assert "from_json" not in plan


def test_csv_files_grow_in_number(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(catalog, "FILE_BYTES", 1000)
    texts = [(k, "en", "web", f"text {k}\r\nends " + "x" * 100) for k in range(160)]
    docs = spark.createDataFrame(texts, "doc_id long, lang string, source string, text string")
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    made = []
    scratch = catalog.scratch_dir
    monkeypatch.setattr(catalog, "scratch_dir", lambda *a: made.append(scratch(*a)) or made[-1])
    rows = catalog.csv_mixed_row_ends(spark, str(tmp_path)).collect()
    assert {tuple(r) for r in rows} == {(str(k), *rest) for k, *rest in texts} and len(rows) == 160
    assert len([f for f in list_folder(spark, made[0]) if "/file=" in f]) == 20


def test_a_wave_looks_at_its_own_folder(spark):
    schema = f"topic string, key binary, value binary, {FILE} string, {ORDINAL} long"
    rows = spark.createDataFrame([("t", b"k", str(k).encode(), "a.csv", k) for k in range(40)], schema)
    waves = list(kafka.each_wave(rows, 10))
    files = [set(wave.inputFiles()) for wave in waves]
    assert len(files) == 4 and all(files) and not set.intersection(*files)
    assert [wave.columns for wave in waves] == [rows.columns] * 4
    assert [sorted(r[ORDINAL] for r in w.collect()) for w in waves] == [list(range(k, k + 10)) for k in range(0, 40, 10)]


def test_records_are_sorted_in_small_splits(spark, tmp_path, monkeypatch):
    """F8: one task sorted the records of a split of 128 MB, many times its bytes, and spilled."""
    orders_table(spark, tmp_path, 30)
    for part in range(4):  # row groups stay whole, so several files stand for a large one
        spark.read.parquet(f"{tmp_path}/orders.parquet").withColumn(
            "o_orderkey", F.col("o_orderkey") + 30 * (part + 1)
        ).coalesce(1).write.mode("append").parquet(f"{tmp_path}/more/orders.parquet")
    monkeypatch.setattr(topic_log, "SORTED_BYTES", 1000)
    cfg = catalog.stream_config(spark)
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    catalog.logged(spark, f"{tmp_path}/more", cfg, ["orders"])
    assert spark.conf.get("spark.sql.files.maxPartitionBytes") == before
    assert sorted(file_rows(spark, cfg, ORDERS.topic)) == [30] * 4
    with small_splits(spark, 1 << 40):  # never more than the session allows
        assert spark.conf.get("spark.sql.files.maxPartitionBytes") == str(128 << 20)


def test_event_ids_cross_the_shuffle_in_few_bytes(spark):
    """F4, F8: hexadecimal ids were shuffled digit by digit."""
    uuid = "0a1b2c3d-0000-4fff-8e9f-00112233aabb"
    ids = [uuid, uuid.replace("-", ""), uuid.upper(), "ab", "abc", "ab\n", "a-b", "-ab", "", "no id", None]
    ids += ["00112233-44556677-8899aabb-ccddeeff", "AB", "\u0661\u0662", uuid + "\n", uuid + uuid]
    rows = spark.createDataFrame(
        [(i, one, "2024-01-01") for i, one in enumerate(ids)], "n int, _event_id string, _bronze_date string"
    ).select("n", "_event_id", F.col("_bronze_date").cast("date"))
    gathered = sink.by_date(rows)
    assert gathered.columns == rows.columns and gathered.dtypes == rows.dtypes
    assert [r["_event_id"] for r in gathered.orderBy("n").collect()] == ids
    plan = plan_text(gathered)
    assert "REBALANCE_PARTITIONS_BY_COL" in plan and "unhex" in plan


def test_logs_and_tables_are_packed_by_an_entropy_coder(spark, tmp_path):
    """F4, F8: lz4 and snappy left the digits of ids as they were."""
    orders_table(spark, tmp_path, 50)
    cfg = catalog.stream_config(spark)
    catalog.logged(spark, str(tmp_path), cfg, ["orders"])
    runner.run(spark, [ORDERS], cfg)
    files = spark.read.parquet(cfg.table_path("orders")).inputFiles()
    files += topic_log.read_batch(spark, cfg.log_dir, ORDERS.topic).inputFiles()
    assert files and all(name.endswith(".zstd.parquet") for name in files)


def numbered_records(spark, places):
    """Records of two files at some places, three keys in turn."""
    rows = [("shop.orders", f"k{n % 3}".encode(), f"{file}/{n}".encode(), file, n) for file, n in places]
    return spark.createDataFrame(rows, f"topic string, key binary, value binary, {FILE} string, {ORDINAL} long")


def log_rows(spark, log_dir):
    rows = topic_log.read_batch(spark, str(log_dir), ORDERS.topic).orderBy("partition", "offset").collect()
    return [(r.partition, r.offset, bytes(r.value).decode()) for r in rows]


def test_records_are_numbered_where_they_are_written(spark, tmp_path, monkeypatch):
    """all records were written once more and shuffled to be numbered."""
    places = [(f, n) for f in ("a.csv", "b.csv") for n in (*range(0, 300, 2), *range(40_000, 70_000, 111))]
    records = numbered_records(spark, places).repartition(5)
    labels = []
    scratch = topic_log.scratch_dir
    monkeypatch.setattr(topic_log, "scratch_dir", lambda s, label: labels.append(label) or scratch(s, label))
    for _ in range(2):
        assert topic_log.append(records, str(tmp_path / "log"), [ORDERS])["shop.orders"] == len(places)
    assert "placed" not in labels
    kept = log_rows(spark, tmp_path / "log")
    monkeypatch.setattr(topic_log, "MARK_BYTES", 1)  # as if the bitmaps were too large
    for _ in range(2):
        topic_log.append(records, str(tmp_path / "shuffled"), [ORDERS])
    assert "placed" in labels
    assert kept == log_rows(spark, tmp_path / "shuffled")
    per_key = {}
    for partition, offset, value in kept:
        per_key.setdefault(partition, []).append((offset, value))
    for rows in per_key.values():
        assert [offset for offset, _ in rows] == list(range(len(rows)))
        first = [(v.split("/")[0], int(v.split("/")[1])) for _, v in rows[: len(rows) // 2]]
        assert first == sorted(first) and [v for _, v in rows[len(rows) // 2 :]] == [v for _, v in rows[: len(rows) // 2]]


def test_records_at_one_place_get_offsets_of_their_own(spark, tmp_path):
    places = [("a.csv", n) for n in (0, 3, 3, 3, 6, 9)]
    assert topic_log.append(numbered_records(spark, places), str(tmp_path / "log"), [ORDERS])["shop.orders"] == 6
    assert [offset for _, offset, _ in log_rows(spark, tmp_path / "log")] == list(range(6))


def test_records_that_change_from_reading_to_reading_are_written_once(spark, tmp_path):
    records = numbered_records(spark, [("a.csv", n) for n in range(500)])
    records = records.withColumn("key", F.uuid().cast("binary"))
    topic_log.append(records, str(tmp_path / "log"), [ORDERS])
    rows = log_rows(spark, tmp_path / "log")
    parts = {p: [offset for q, offset, _ in rows if p == q] for p in {p for p, _, _ in rows}}
    assert len(rows) == 500 and all(offsets == list(range(len(offsets))) for offsets in parts.values())


def test_any_text_crosses_the_shuffle_by_date(spark):
    """numbers and times crossed it a byte a sign."""
    odd = [None, "", "e", "f", "ff", "0", "007", "-1.50", "1996-09-13 00:00:00", "1\n", "é", "a\x01b", "\x01", "abcd", "12e5", " "]
    ids = [None, "", "0f" * 16, "0F" * 16, "0f0f0f0f-0f0f-0f0f-0f0f-0f0f0f0f0f0f", "xyz", "-", "abc"]
    names = ORDERS.bronze_schema.names
    rows = []
    for n in range(48):
        texts = [odd[(n * k + k) % len(odd)] for k in range(1, len(names) + 1)]
        row = dict(zip(names, texts), _kafka_topic="t", _kafka_partition=n, _kafka_offset=n, _kafka_timestamp=None)
        row |= {"_event_id": ids[n % len(ids)], "_bronze_date": None}
        rows.append(tuple(row[name] for name in names))
    bronze = spark.createDataFrame(rows, ORDERS.bronze_schema)
    gathered = sink.by_date(bronze)
    assert "_numbers" in plan_text(gathered)
    assert gathered.schema.names == names
    assert sorted(map(str, gathered.collect())) == sorted(map(str, bronze.collect()))
    packed = bronze.select("_event_id", sink.packed_id(F.col("_event_id")).alias("packed")).distinct().collect()
    assert len({r.packed and bytes(r.packed) for r in packed}) == len(packed) == len(ids)
    assert max(len(r.packed) for r in packed if r._event_id in ids[2:5:2]) == 17
