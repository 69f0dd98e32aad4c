"""The topic registry: what each topic carries, how it is keyed, where it lands."""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass
from itertools import chain

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import (
    BinaryType,
    DateType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampType,
)

# Audit fields, table names, key fields and payload field names
# are the wire format (including the dataset's own spelling of "lenght").
AUDIT_FIELDS = ("_topic", "_ingested_at", "_event_id")

TABLES = {
    "orders": (
        "order_id",
        (
            "order_id",
            "customer_id",
            "order_status",
            "order_purchase_timestamp",
            "order_approved_at",
            "order_delivered_carrier_date",
            "order_delivered_customer_date",
            "order_estimated_delivery_date",
        ),
    ),
    "order_items": (
        "order_id",
        (
            "order_id",
            "order_item_id",
            "product_id",
            "seller_id",
            "shipping_limit_date",
            "price",
            "freight_value",
        ),
    ),
    "order_payments": (
        "order_id",
        (
            "order_id",
            "payment_sequential",
            "payment_type",
            "payment_installments",
            "payment_value",
        ),
    ),
    "customers": (
        "customer_id",
        (
            "customer_id",
            "customer_unique_id",
            "customer_zip_code_prefix",
            "customer_city",
            "customer_state",
        ),
    ),
    "products": (
        "product_id",
        (
            "product_id",
            "product_category_name",
            "product_name_lenght",
            "product_description_lenght",
            "product_photos_qty",
            "product_weight_g",
            "product_length_cm",
            "product_height_cm",
            "product_width_cm",
        ),
    ),
}

TOPIC_PARTITIONS = 3

# Record shape of a topic, identical for the broker connector and the topic log.
RECORD_SCHEMA = StructType(
    [
        StructField("key", BinaryType()),
        StructField("value", BinaryType()),
        StructField("topic", StringType()),
        StructField("partition", IntegerType()),
        StructField("offset", LongType()),
        StructField("timestamp", TimestampType()),
        StructField("timestampType", IntegerType()),
    ]
)

# Record columns kept in bronze, as (record column, bronze column, type).
ENVELOPE = (
    ("topic", "_kafka_topic", StringType()),
    ("partition", "_kafka_partition", IntegerType()),
    ("offset", "_kafka_offset", LongType()),
    ("timestamp", "_kafka_timestamp", TimestampType()),
)

POSITION = ("_kafka_topic", "_kafka_partition", "_kafka_offset")


@dataclass(frozen=True)
class TopicSpec:
    """One topic: its table, key, declared payload fields and CSV source."""

    topic: str
    table: str
    key_field: str
    fields: tuple[str, ...]
    source_file: str = ""
    partitions: int = TOPIC_PARTITIONS
    # False declares that no CSV field holds a newline.
    quoted_newlines: bool = True

    @property
    def payload_schema(self) -> StructType:
        """Every payload and audit field is text; typing is left to readers."""
        return StructType(
            [StructField(name, StringType()) for name in (*self.fields, *AUDIT_FIELDS)]
        )

    @property
    def bronze_schema(self) -> StructType:
        envelope = [StructField(name, dtype) for _, name, dtype in ENVELOPE]
        return StructType(
            [
                *envelope,
                *self.payload_schema.fields,
                StructField("_bronze_date", DateType()),
            ]
        )

    def stored_schema(self, keep_raw: bool) -> StructType:
        """The bronze columns, with the raw value's text if the table keeps it."""
        schema = StructType(self.bronze_schema.fields)
        return schema.add("_raw_value", StringType()) if keep_raw else schema


def partition_count(specs: Iterable[TopicSpec], topic: Column) -> Column:
    """The number of partitions of the topic a record is for."""
    counts = ((F.lit(spec.topic), F.lit(spec.partitions)) for spec in specs)
    return F.create_map(*chain.from_iterable(counts))[topic]


def registry(prefix: str = "shop") -> dict[str, TopicSpec]:
    """The five shop topics, named and sourced under ``prefix``."""
    specs = (
        TopicSpec(
            topic=f"{prefix}.{table}",
            table=table,
            key_field=key_field,
            fields=fields,
            source_file=f"{prefix}_{table}_dataset.csv",
        )
        for table, (key_field, fields) in TABLES.items()
    )
    return {spec.topic: spec for spec in specs}
