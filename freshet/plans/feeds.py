"""Test tables as topic records, with a deterministic envelope.

Each feed says, in SQL both engines read, how a table's columns become payload
fields; ``{text}`` stands for the engine's text type.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from freshet.functions import json_payload, utf8
from freshet.registry import RECORD_SCHEMA, TopicSpec, registry


@dataclass(frozen=True)
class Feed:
    """How one test table feeds one topic."""

    spec: TopicSpec
    source: str  # test table
    fields: dict[str, str]  # payload field -> SQL over the table
    number: str  # integer column the envelope is derived from
    identity: tuple[str, ...]  # columns that tell rows apart
    timestamps: tuple[str, ...] = ()  # fields cast from timestamps
    dense: bool = True  # ``number`` counts rows from 0


EVENTS = TopicSpec(
    topic="shop.events",
    table="events",
    key_field="event_id",
    fields=("event_id", "user_id", "event_type", "value", "props"),
    source_file="shop_events_dataset.csv",
)

SPECS = {spec.table: spec for spec in registry().values()} | {"events": EVENTS}

LINEITEM_COLUMNS = (
    "l_orderkey",
    "l_partkey",
    "l_suppkey",
    "l_linenumber",
    "l_quantity",
    "l_extendedprice",
    "l_discount",
    "l_tax",
    "l_returnflag",
    "l_linestatus",
    "l_shipdate",
)

FEEDS = {
    "orders": Feed(
        SPECS["orders"],
        "orders",
        {
            "order_id": "o_orderkey",
            "customer_id": "o_custkey",
            "order_status": "o_orderstatus",
            "order_purchase_timestamp": "o_orderdate",
        },
        "o_orderkey",
        ("o_orderkey",),
        ("order_purchase_timestamp",),
    ),
    "order_items": Feed(
        SPECS["order_items"],
        "lineitem",
        {
            "order_id": "l_orderkey",
            "order_item_id": "l_linenumber",
            "product_id": "l_partkey",
            "seller_id": "l_suppkey",
            "shipping_limit_date": "l_shipdate",
            "price": "l_extendedprice",
            "freight_value": "l_tax",
        },
        "l_orderkey",
        LINEITEM_COLUMNS,
        ("shipping_limit_date",),
        dense=False,
    ),
    "order_payments": Feed(
        SPECS["order_payments"],
        "orders",
        {
            "order_id": "o_orderkey",
            "payment_sequential": "1",
            "payment_type": "o_orderpriority",
            "payment_installments": "1",
            "payment_value": "o_totalprice",
        },
        "o_orderkey",
        ("o_orderkey",),
    ),
    "customers": Feed(
        SPECS["customers"],
        "customer",
        {
            "customer_id": "c_custkey",
            "customer_unique_id": "md5(cast(c_custkey as {text}))",
            "customer_city": "c_mktsegment",
            "customer_state": "c_nationkey",
        },
        "c_custkey",
        ("c_custkey",),
    ),
    "products": Feed(
        SPECS["products"],
        "part",
        {
            "product_id": "p_partkey",
            "product_category_name": "p_type",
            "product_name_lenght": "length(p_name)",
            "product_weight_g": "p_size",
        },
        "p_partkey",
        ("p_partkey",),
    ),
    "events": Feed(
        SPECS["events"],
        "events",
        {
            "event_id": "event_id",
            "user_id": "user_id",
            "event_type": "event_type",
            "value": "value",
            "props": "props",
        },
        "event_id",
        ("event_id",),
    ),
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def payload_rows(spark: SparkSession, sf_dir: str, feed: Feed) -> DataFrame:
    """The feed's payload fields as text, beside the table's own columns."""
    fields = (
        F.expr(sql.format(text="string")).cast("string").alias(f"f_{name}")
        for name, sql in feed.fields.items()
    )
    return table(spark, sf_dir, feed.source).select("*", *fields)


def feed_records(spark: SparkSession, sf_dir: str, feed: Feed) -> DataFrame:
    """The table as a topic's records; map-only.

    Partition and offset come from the dense row number by arithmetic. A table
    without one takes its offsets from the event id, which leaves gaps.
    """
    spec = feed.spec
    number = F.col(feed.number)
    identity = [F.col(c).cast("string") for c in feed.identity]
    ingested = F.concat(
        F.lit("2024-01-0"), (1 + number % 7).cast("string"), F.lit("T00:00:00+00:00")
    )
    sent = F.timestamp_add("SECOND", (number % 60).cast("int"), F.to_timestamp(ingested))
    sparse_offset = F.conv(F.substring("_event_id", 1, 15), 16, 10).cast("bigint")
    enriched = (
        payload_rows(spark, sf_dir, feed)
        .select(
            *(F.col(f"f_{name}").alias(name) for name in feed.fields),
            F.lit(spec.topic).alias("_topic"),
            ingested.alias("_ingested_at"),
            F.md5(F.concat_ws("|", F.lit(spec.topic), *identity)).alias("_event_id"),
            (number % 3).cast("int").alias("partition"),
            F.expr(f"{feed.number} div 3").alias("number"),
            sent.alias("timestamp"),
        )
        .withColumn("offset", F.col("number") if feed.dense else sparse_offset)
    )
    payload = [*feed.fields, "_topic", "_ingested_at", "_event_id"]
    records = enriched.select(
        utf8(F.col(spec.key_field)).alias("key"),
        utf8(json_payload(payload)).alias("value"),
        F.col("_topic").alias("topic"),
        "partition",
        "offset",
        "timestamp",
        F.lit(0).alias("timestampType"),
    )
    return records.select(*RECORD_SCHEMA.names)
