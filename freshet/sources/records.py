"""One stream per topic, from whichever source is configured."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from freshet.config import IngestConfig
from freshet.registry import TopicSpec
from freshet.sources import kafka, topic_log


def read_topic(spark: SparkSession, spec: TopicSpec, cfg: IngestConfig) -> DataFrame:
    source = kafka if cfg.source == "kafka" else topic_log
    return source.read_stream(spark, spec, cfg)
