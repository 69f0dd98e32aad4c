"""Keys and values of topic records."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def json_payload(columns: list[str]) -> Column:
    """The columns as one JSON object; NULL fields are written, not left out."""
    return F.to_json(F.struct(*(F.col(f"`{c}`") for c in columns)), {"ignoreNullFields": "false"})


def record_key(columns: list[str], key_field: str, ordinal: Column) -> Column:
    """The key field's text, or the row ordinal where there is none."""
    number = ordinal.cast("string")
    return F.coalesce(F.col(f"`{key_field}`"), number) if key_field in columns else number


def key_partition(key: Column, partitions: Column | int) -> Column:
    """CRC32 of the key bytes modulo the partition count."""
    return F.pmod(F.crc32(key), F.lit(partitions)).cast("int")


def utf8(text: Column) -> Column:
    return text.cast("binary")
