"""Hand-made topic records and bronze rows."""

from __future__ import annotations

import datetime as dt

from freshet.registry import RECORD_SCHEMA

T0 = dt.datetime(2024, 1, 15, 8, 0, tzinfo=dt.timezone.utc)


def record_frame(spark, values, topic="shop.orders", partition=0):
    """One record per value, at offsets 0, 1, 2, ..."""
    rows = [
        (None, None if v is None else bytearray(v, "utf-8"), topic, partition, i, T0, 0)
        for i, v in enumerate(values)
    ]
    return spark.createDataFrame(rows, RECORD_SCHEMA)


def bronze_frame(spark, rows):
    """Rows of (partition, offset, event id)."""
    return spark.createDataFrame(
        [("shop.orders", p, o, e, f"row {p}/{o}") for p, o, e in rows],
        "_kafka_topic string, _kafka_partition int, _kafka_offset bigint, _event_id string,"
        " note string",
    )


def plan_text(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()
