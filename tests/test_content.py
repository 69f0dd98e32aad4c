"""Comparison by content, undeclared fields, and the lag's distribution."""

import datetime as dt

import pytest

from freshet import registry
from freshet.operators.content import content_differences, content_hashes
from freshet.operators.drift import undeclared_fields
from freshet.operators.lag import lag_quantiles, lag_sketches
from records import T0, plan_text, record_frame

ORDERS = registry("shop")["shop.orders"]
DAY = dt.date(2024, 1, 15)
SCHEMA = "_kafka_topic string, _bronze_date date, a string, b string"


def frame(spark, rows, day=DAY):
    return spark.createDataFrame([("t", day, a, b) for a, b in rows], SCHEMA)


def differences(source, bronze):
    rows = content_differences(source, bronze, ["a", "b"]).collect()
    return {(r.a, r.b, r.source_copies, r.bronze_copies) for r in rows}


def test_nulls_borders_and_copies_are_told_apart(spark):
    source = frame(spark, [("x", None), ("", "x"), ("ab", "c"), ("one", "1"), ("one", "1")])
    bronze = frame(spark, [("x", ""), (None, "x"), ("a", "bc"), ("one", "1")])
    assert differences(source, bronze) == {
        ("x", None, 1, 0),
        ("", "x", 1, 0),
        ("ab", "c", 1, 0),
        ("x", "", 0, 1),
        (None, "x", 0, 1),
        ("a", "bc", 0, 1),
        ("one", "1", 2, 1),
    }


def test_equal_sides_have_equal_hashes_in_any_order(spark):
    rows = [(str(k % 40), str(k % 7)) for k in range(300)]
    one, other = frame(spark, rows), frame(spark, rows[::-1])
    assert content_hashes(one, ["a", "b"]).collect() == content_hashes(other.repartition(5), ["a", "b"]).collect()
    assert differences(one, other) == set()


def test_one_changed_field_among_many_days(spark):
    days = [None, *(DAY + dt.timedelta(days=k) for k in range(5))]
    source = bronze = frame(spark, [])
    for day in days:
        rows = [(str(k), "same") for k in range(50)]
        source = source.unionByName(frame(spark, rows, day))
        if day is None:
            rows[7] = ("7", "changed")
        bronze = bronze.unionByName(frame(spark, rows, day))
    assert differences(source, bronze) == {("7", "same", 1, 0), ("7", "changed", 0, 1)}
    assert differences(frame(spark, []), frame(spark, [])) == set()


def test_undeclared_fields(spark):
    values = [
        '{"order_id": "1", "new": 1, "Order_ID": true}',
        '{"new": 2.5, "nested": {"order_id": 1}, "_topic": "t"}',
        '{"new": "text", "nothing": null}',
        '["new"]', "17", "not json", "", None, "{}", '{"new": 1, "new": 2}',
    ]
    rows = undeclared_fields(record_frame(spark, values), ORDERS).collect()
    assert {(r.topic, r.field, r.rows, r.type) for r in rows} == {
        ("shop.orders", "new", 3, "VARIANT"),
        ("shop.orders", "Order_ID", 1, "BOOLEAN"),
        ("shop.orders", "nested", 1, "OBJECT<order_id: BIGINT>"),
        ("shop.orders", "nothing", 1, "VOID"),
    }


def test_undeclared_fields_shuffle_counts_only(spark):
    plan = plan_text(undeclared_fields(record_frame(spark, ["{}"]), ORDERS)).split("== Initial Plan ==")[-1]
    assert plan.count("Exchange") == 1 and "partial_count" in plan


@pytest.fixture
def lags(spark):
    stamp = (T0 - dt.timedelta(seconds=1)).isoformat(timespec="microseconds")
    rows = [("t", DAY + dt.timedelta(days=k % 3), T0 + dt.timedelta(microseconds=k), stamp) for k in range(30_000)]
    rows += [("t", None, T0, "no time"), ("u", DAY, T0, None), ("v", DAY, T0, stamp)]
    return spark.createDataFrame(
        rows, "_kafka_topic string, _bronze_date date, _kafka_timestamp timestamp, _ingested_at string"
    )


def test_quantiles_from_merged_sketches(spark, lags, tmp_path):
    lag_sketches(lags).write.parquet(str(tmp_path / "sketches"))
    stored = spark.read.parquet(str(tmp_path / "sketches"))
    assert {(r._kafka_topic, r.rows, r.timed) for r in stored.collect()} == {
        ("t", 10_000, 10_000), ("t", 1, 0), ("u", 1, 0), ("v", 1, 1)
    }
    found = {(r._kafka_topic, r.quantile): (r.timed, r.lag_us) for r in lag_quantiles(stored, (0.5, 0.99)).collect()}
    assert found["v", 0.5] == (1, 1_000_000) and not any(topic == "u" for topic, _ in found)
    for quantile in (0.5, 0.99):
        timed, lag = found["t", quantile]
        assert timed == 30_000 and abs((lag - 1_000_000) / 30_000 - quantile) < 0.03
