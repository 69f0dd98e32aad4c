"""Records to bronze rows. Map-only, and the same for batch and stream."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from freshet.functions import bronze_date
from freshet.registry import ENVELOPE, TopicSpec

CORRUPT = "_corrupt_record"


def parse_bronze(records: DataFrame, spec: TopicSpec, keep_raw: bool = False) -> DataFrame:
    """Envelope, declared payload fields and partition date of every record.

    Unparseable values give NULL payload fields and keep their row; see
    ``quarantine``. ``keep_raw`` adds the value's text as ``_raw_value``.
    The value is parsed once: the outer projection only takes fields out.
    """
    text = F.col("value").cast("string")
    envelope = [F.col(source).alias(name) for source, name, _ in ENVELOPE]
    payload = F.from_json(text, spec.payload_schema).alias("payload")
    raw = [text.alias("_raw_value")] if keep_raw else []
    return records.select(*envelope, *raw, payload).select(
        *(name for _, name, _ in ENVELOPE),
        *(F.col("payload").getField(f.name).alias(f.name) for f in spec.payload_schema),
        *(["_raw_value"] if keep_raw else []),
        bronze_date(F.col("payload._ingested_at")).alias("_bronze_date"),
    )


def quarantine(records: DataFrame, spec: TopicSpec) -> DataFrame:
    """Position and text of every record whose value is not a JSON object.

    Only the key field is materialised: malformed text is found while the
    parser skips the rest.
    """
    probe = StructType(
        [StructField(spec.key_field, StringType()), StructField(CORRUPT, StringType())]
    )
    text = F.col("value").cast("string")
    parsed = F.from_json(text, probe, {"columnNameOfCorruptRecord": CORRUPT})
    return (
        records.select(
            F.col("topic").alias("_kafka_topic"),
            F.col("partition").alias("_kafka_partition"),
            F.col("offset").alias("_kafka_offset"),
            text.alias("_raw_value"),
            parsed.alias("payload"),
        )
        .where(F.col("payload").isNull() | F.col(f"payload.{CORRUPT}").isNotNull())
        .drop("payload")
    )
