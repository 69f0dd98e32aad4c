"""Counts taken while a frame is written."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F


def count_by_topic(records: DataFrame, topics: list[str]) -> tuple[DataFrame, Observation]:
    """The records, and an observation that knows each topic's count once they are written."""
    counts = Observation()
    named = (F.count_if(F.col("topic") == topic).alias(topic) for topic in topics)
    return records.observe(counts, *named), counts
