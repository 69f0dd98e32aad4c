import json

import pytest
from pyspark.sql import functions as F

from freshet.functions import bronze_date, ingested_at
from freshet.operators.bronze import parse_bronze, quarantine
from freshet.registry import TopicSpec, registry
from records import plan_text, record_frame

SPEC = registry()["shop.orders"]
AB = TopicSpec("t.ab", "ab", "a", ("a", "b"))

# value, expected fields a and b, whether quarantined
JSON_CASES = [
    ('{"a": "x", "b": "y"}', ("x", "y"), False),
    ('{"a": 1.50, "b": true}', ("1.5", "true"), False),
    ('{"a": {"k": [1, 2]}, "b": [1, "z"]}', ('{"k":[1,2]}', '[1,"z"]'), False),
    ('{"a": "x"}', ("x", None), False),
    ('{"a": null, "b": "y"}', (None, "y"), False),
    ('{"a": "x", "other": "o"}', ("x", None), False),
    ('{"A": "x", "b": "y"}', (None, "y"), False),
    ('{"a": "x", "a": "z"}', ("z", None), False),
    ('{"a": "x"} trailing', ("x", None), False),
    ('{"a": "ão"}', ("ão", None), False),
    ('{"a": "\\u00e3o"}', ("ão", None), False),
    ("{}", (None, None), False),
    ('{"a": "x", ', (None, None), True),
    ("not json", (None, None), True),
    ('["x"]', (None, None), True),
    ("null", (None, None), True),
    ("", (None, None), True),
    (None, (None, None), True),
]

DATE_CASES = [
    ("2024-01-15T00:30:11+02:00", "2024-01-15"),
    ("2024-01-15T23:30:11-05:00", "2024-01-15"),
    ("2024-01-15T08:23:11.432Z", "2024-01-15"),
    ("2024-01-15 01:00:00", "2024-01-15"),
    ("2024-01-15", "2024-01-15"),
    ("garbage", None),
    ("", None),
    (None, None),
]


@pytest.fixture(params=["true", "false"])
def ansi(request, spark):
    before = spark.conf.get("spark.sql.ansi.enabled")
    spark.conf.set("spark.sql.ansi.enabled", request.param)
    yield
    spark.conf.set("spark.sql.ansi.enabled", before)


@pytest.fixture(params=["UTC", "America/Sao_Paulo", "Asia/Tokyo"])
def zone(request, spark):
    spark.conf.set("spark.sql.session.timeZone", request.param)
    yield
    spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_json_edges_keep_every_row(spark, ansi):
    records = record_frame(spark, [value for value, _, _ in JSON_CASES])
    rows = parse_bronze(records, AB).orderBy("_kafka_offset").collect()
    assert [(r.a, r.b) for r in rows] == [fields for _, fields, _ in JSON_CASES]


def test_quarantine_holds_exactly_the_unparseable(spark, ansi):
    records = record_frame(spark, [value for value, _, _ in JSON_CASES])
    rows = quarantine(records, AB).orderBy("_kafka_offset").collect()
    expected = [(i, v) for i, (v, _, bad) in enumerate(JSON_CASES) if bad]
    assert [(r._kafka_offset, r._raw_value) for r in rows] == expected
    assert rows[0].asDict().keys() == {
        "_kafka_topic",
        "_kafka_partition",
        "_kafka_offset",
        "_raw_value",
    }


def test_dates_are_as_written_in_any_zone(spark, ansi, zone):
    values = [json.dumps({"_ingested_at": text}) for text, _ in DATE_CASES]
    rows = parse_bronze(record_frame(spark, values), SPEC).orderBy("_kafka_offset").collect()
    got = [str(r._bronze_date) if r._bronze_date else None for r in rows]
    assert got == [date for _, date in DATE_CASES]


def test_schema_and_raw_value(spark):
    records = record_frame(spark, ['{"order_id": "1", "more": 2}'])
    plain = parse_bronze(records, SPEC)
    assert [(f.name, f.dataType) for f in plain.schema] == [
        (f.name, f.dataType) for f in SPEC.bronze_schema
    ]
    kept = parse_bronze(records, SPEC, keep_raw=True).first()
    assert kept._raw_value == '{"order_id": "1", "more": 2}'


def test_value_is_parsed_once_and_only_for_wanted_fields(spark):
    parsed = parse_bronze(record_frame(spark, ["{}"]), SPEC)
    assert plan_text(parsed).count("from_json(") == 1
    narrow = plan_text(parsed.select("order_id"))
    assert "order_status" not in narrow and "Exchange" not in narrow


def test_unused_record_columns_are_not_read(spark, tmp_path):
    record_frame(spark, ["{}"]).write.parquet(str(tmp_path / "log"))
    plan = plan_text(parse_bronze(spark.read.parquet(str(tmp_path / "log")), SPEC))
    schema = plan[plan.index("ReadSchema") :]
    assert "key" not in schema and "timestampType" not in schema


def test_ingested_at_is_utc_text_in_any_zone(spark, zone):
    row = spark.range(1).select(
        ingested_at().alias("text"),
        bronze_date(ingested_at()).alias("date"),
        F.unix_micros(F.current_timestamp()).alias("now"),
        F.unix_micros(F.to_timestamp(ingested_at())).alias("named"),
    ).first()
    assert row.text.endswith("+00:00") and len(row.text) == len("2024-01-15T08:23:11.432000+00:00")
    assert abs(row.now - row.named) < 60_000_000
    assert str(row.date) == row.text[:10]
