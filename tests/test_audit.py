import datetime as dt

import pytest
from pyspark.sql import functions as F

from freshet.operators import audit
from records import T0, bronze_frame, plan_text


def rows_of(df):
    return sorted(map(tuple, df.collect()), key=str)


@pytest.fixture
def copies(spark):
    """Ids e0 to e9 twice, e10 to e12 once, and two rows without id."""
    once = [(0, i, f"e{i}") for i in range(13)]
    again = [(0, 20 + i, f"e{i}") for i in range(10)]
    return bronze_frame(spark, once + again + [(1, 0, None), (1, 1, None)])


def test_duplicates_and_their_counts(copies):
    assert rows_of(audit.duplicate_events(copies)) == sorted((f"e{i}", 2) for i in range(10))


def test_dedup_keeps_lowest_position_and_rows_without_id(copies):
    kept = audit.dedup_events(copies)
    assert kept.columns == copies.columns
    got = rows_of(kept.select("_kafka_partition", "_kafka_offset", "_event_id"))
    expected = [(0, i, f"e{i}") for i in range(13)] + [(1, 0, None), (1, 1, None)]
    assert got == sorted(expected, key=str)


def test_dedup_by_other_columns(copies):
    assert audit.dedup_events(copies, by=("_kafka_topic", "_kafka_partition")).count() == 2


def test_hot_id_is_reduced_before_the_shuffle(spark):
    rows = spark.range(30_000).select(
        F.lit("t").alias("_kafka_topic"),
        F.lit(0).alias("_kafka_partition"),
        F.col("id").alias("_kafka_offset"),
        F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.col("id").cast("string")).alias("_event_id"),
    )
    kept = audit.dedup_events(rows)
    plan = plan_text(kept)
    assert plan.index("Final") < plan.index("Exchange") < plan.index("Partial")
    assert kept.count() == 20_001
    assert kept.where("_event_id = 'hot'").first()._kafka_offset == 0


def test_offset_gaps(spark):
    log = bronze_frame(spark, [(0, o, "e") for o in (0, 1, 4, 5, 5)] + [(1, 7, "e")])
    assert rows_of(audit.offset_gaps(log)) == [
        ("shop.orders", 0, 0, 5, 4, 2),
        ("shop.orders", 1, 7, 7, 1, 0),
    ]


@pytest.mark.parametrize("block", [2, 3, 10, 1_000_000])
def test_gap_ranges_inside_and_across_blocks(spark, block):
    offsets = [0, 1, 4, 5, 9, 9, 10, 31, 32, 40]
    log = bronze_frame(spark, [(0, o, "e") for o in offsets] + [(1, 3, "e"), (1, 5, "e")])
    assert rows_of(audit.offset_gap_ranges(log, block)) == sorted(
        [
            ("shop.orders", 0, 2, 3),
            ("shop.orders", 0, 6, 8),
            ("shop.orders", 0, 11, 30),
            ("shop.orders", 0, 33, 39),
            ("shop.orders", 1, 4, 4),
        ],
        key=str,
    )


def test_misrouted_rows(spark):
    rows = spark.createDataFrame(
        [("t.a", "t.a"), ("t.a", "t.b"), ("t.a", "t.b"), ("t.a", None)],
        "_kafka_topic string, _topic string",
    )
    assert rows_of(audit.topic_mismatch(rows)) == [("t.a", "t.b", 2), ("t.a", None, 1)]


def test_lag_of_timed_rows(spark):
    rows = spark.createDataFrame(
        [
            ("t", T0, "2024-01-15T07:59:59.500000+00:00"),
            ("t", T0, "2024-01-15T07:59:58Z"),
            ("t", T0 + dt.timedelta(seconds=1), "garbage"),
            ("u", T0, None),
        ],
        "_kafka_topic string, _kafka_timestamp timestamp, _ingested_at string",
    )
    assert rows_of(audit.ingest_lag(rows)) == [
        ("t", 3, 2, 500_000, 1_250_000.0, 2_000_000),
        ("u", 1, 0, None, None, None),
    ]


def test_reconcile_keeps_one_sided_and_undated_counts(spark):
    day = dt.date(2024, 1, 1)
    schema = "_kafka_topic string, _bronze_date date"
    source = spark.createDataFrame(
        [("t", day, 3), ("t", None, 2), ("u", day, 1)], schema + ", rows long"
    )
    landed = spark.createDataFrame([("t", day)] * 3 + [("t", None), ("v", day)], schema)
    assert rows_of(audit.reconcile(source, landed)) == sorted(
        [
            ("t", day, 3, 3, 0),
            ("t", None, 2, 1, 1),
            ("u", day, 1, 0, 1),
            ("v", day, 0, 1, -1),
        ],
        key=str,
    )
