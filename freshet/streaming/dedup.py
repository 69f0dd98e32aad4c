"""Duplicate removal on a stream."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from freshet.registry import POSITION

SALTS = 16


def dedup_stream(bronze: DataFrame, delay: str, salts: int = SALTS) -> DataFrame:
    """One row per event id among rows that arrive within ``delay`` of each other.

    Time is that of arrival, so no row is ever late, however old its record: a copy
    that arrives after ``delay`` passes, a row seen once always does. Copies are first
    dropped inside ``salts`` subsets of each id, so that a much-repeated id spreads over
    tasks, then across the few that are left. Rows without an id go by their position
    and all pass. The ids of ``delay`` are kept in the state store, best RocksDB (the
    package's session settings), as Spark's default store holds them in memory.
    """
    position = F.when(F.col("_event_id").isNull(), F.struct(*POSITION))
    return (
        bronze.withColumn("dedup_id", F.struct("_event_id", position.alias("position")))
        .withColumn("salt", F.pmod(F.xxhash64("_kafka_partition", "_kafka_offset"), F.lit(salts)))
        .withColumn("arrived", F.current_timestamp())
        .withWatermark("arrived", delay)
        .dropDuplicatesWithinWatermark(["dedup_id", "salt"])
        .dropDuplicatesWithinWatermark(["dedup_id"])
        .drop("dedup_id", "salt", "arrived")
    )
