"""Plans keep the shape they are meant to have on large inputs."""

import pytest
from pyspark.sql import functions as F

from freshet.operators import audit, replay
from freshet.plans.catalog import numbered_rows, parsed
from freshet.plans.feeds import FEEDS, SPECS
from freshet.sources import topic_log
from records import plan_text

SF = "/root/testdata/sf0.001"


@pytest.fixture
def orders(spark, tmp_path):
    parsed(spark, SF, "orders").write.parquet(str(tmp_path / "orders"))
    return spark.read.parquet(str(tmp_path / "orders"))


def initial(df) -> str:
    return plan_text(df).split("== Initial Plan ==")[-1]


@pytest.mark.parametrize("name", FEEDS)
def test_feeds_and_parsing_are_map_only(spark, name):
    plan = initial(parsed(spark, SF, name))
    assert "Exchange" not in plan and plan.count("from_json(") == 1


def test_enriched_records_are_map_only(spark):
    rows = numbered_rows(spark, SF, FEEDS["orders"])
    plan = initial(replay.to_records(replay.enrich(rows, "shop.orders"), SPECS["orders"]))
    assert "Exchange" not in plan and "Python" not in plan


def test_offsets_shuffle_and_sort_the_records_once(spark):
    rows = replay.to_records(numbered_rows(spark, SF, FEEDS["orders"]), SPECS["orders"])
    placed = rows.withColumn("partition", F.lit(0))
    plan = initial(topic_log.assign_offsets(placed).sortWithinPartitions(*topic_log.BLOCK))
    with_value = [line for line in plan.splitlines() if "to_json" in line or "ToJson" in line]
    assert len(with_value) == 1
    above_records = plan[: plan.index("StructsToJson")]
    assert above_records.count("Sort [") == 1
    assert above_records.count("Exchange hashpartitioning") == 1


def test_duplicates_combine_before_one_shuffle(orders):
    plan = initial(audit.duplicate_events(orders))
    assert plan.count("Exchange") == 1 and "partial_count" in plan
    assert "ReadSchema: struct<_event_id:string>" in plan


def test_gap_counts_shuffle_narrow_rows_without_windows(orders):
    plan = initial(audit.offset_gaps(orders))
    assert "Window" not in plan
    # First by offset, so that a partition's offsets spread over tasks.
    deepest = plan[plan.rindex("Exchange hashpartitioning") :].splitlines()[0]
    assert "_kafka_offset" in deepest


def test_gap_ranges_shuffle_the_offsets_once(orders):
    ranges = audit.offset_gap_ranges(orders)
    ranges.collect()
    plan = plan_text(ranges).split("== Initial Plan ==")[0]
    scans = [line for line in plan.splitlines() if "FileScan" in line or "Scan parquet" in line]
    assert len(scans) == 1 and "ReusedExchange" in plan
    assert "distinct" not in plan and plan.count("Window [lag(high") <= 6


@pytest.mark.parametrize("block", [0, 1])
def test_gap_ranges_refuse_blocks_without_neighbours(orders, block):
    with pytest.raises(ValueError):
        audit.offset_gap_ranges(orders, block)


def test_reconcile_joins_counts_by_hash(orders):
    counts = audit.count_by_day(orders)
    plan = initial(audit.reconcile(counts, orders))
    assert "Cartesian" not in plan and "NestedLoop" not in plan
    assert plan.count("partial_count") == 2


def test_lag_and_routing_read_only_what_they_need(orders):
    lag = initial(audit.ingest_lag(orders))
    assert "order_id" not in lag and "partial_max" in lag
    routing = initial(audit.topic_mismatch(orders))
    assert "order_id" not in routing and "partial_count" in routing
