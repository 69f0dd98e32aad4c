"""Fields that arrive without being declared. Parsing drops them without a trace."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from freshet.registry import TopicSpec


def undeclared_fields(records: DataFrame, spec: TopicSpec) -> DataFrame:
    """Rows topic, field, rows, type: each top-level field that ``spec`` does not name.

    ``type`` is the one type that holds all its values, VARIANT where they have nothing
    in common. Names are compared as written. Values that are no JSON objects have no
    fields, nor have objects that name a field twice; see ``quarantine``. The values are
    parsed once and each field is counted where it is met; only counts are shuffled.
    """
    values = records.select("topic", F.try_parse_json(F.col("value").cast("string")).alias("v"))
    fields = values.lateralJoin(records.sparkSession.tvf.variant_explode(F.col("v").outer()))
    return (
        fields.where(F.col("key").isNotNull() & ~F.col("key").isin(spec.payload_schema.names))
        .groupBy("topic", F.col("key").alias("field"))
        .agg(F.count("*").alias("rows"), F.schema_of_variant_agg("value").alias("type"))
    )
