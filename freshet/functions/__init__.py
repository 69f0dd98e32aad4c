"""Column expressions; all are Spark built-ins."""

from freshet.functions.audit import (
    bronze_date,
    event_id,
    ingested_at,
    ingested_instant,
    random_event_id,
)
from freshet.functions.records import json_payload, key_partition, record_key, utf8

__all__ = [
    "bronze_date",
    "event_id",
    "ingested_at",
    "ingested_instant",
    "json_payload",
    "key_partition",
    "random_event_id",
    "record_key",
    "utf8",
]
