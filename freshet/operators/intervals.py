"""Sets of offsets as runs, which can be merged batch by batch.

A run is a row (topic, partition, low, high) of offsets that are all there. Merging is
idempotent: a run that comes twice, or overlaps another, changes nothing.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from freshet.operators.audit import GAP_BLOCK

LOG = ["_kafka_topic", "_kafka_partition"]
RUN_SCHEMA = "_kafka_topic string, _kafka_partition int, low long, high long"


def single_runs(bronze: DataFrame) -> DataFrame:
    """Every row as a run of one offset."""
    offset = F.col("_kafka_offset")
    return bronze.select(*LOG, offset.alias("low"), offset.alias("high"))


def _starts(runs: DataFrame, block: int) -> tuple[DataFrame, DataFrame]:
    """Runs that continue no other, with how far all lower ones reach; and each block's reach.

    Runs are compared within blocks of ``block`` offsets, blocks by their reach, so that
    no window sees more rows than a block has runs or a partition has blocks.
    """
    cut = runs.select(*LOG, "low", "high", F.expr(f"low div {block}").alias("block"))
    extents = cut.groupBy(*LOG, "block").agg(F.max("high").alias("top"))
    lower = Window.unboundedPreceding, -1
    blocks = Window.partitionBy(*LOG).orderBy("block").rowsBetween(*lower)
    inside = Window.partitionBy(*LOG, "block").orderBy("low", "high").rowsBetween(*lower)
    reach = extents.select(*LOG, "block", F.max("top").over(blocks).alias("reach"))
    seen = cut.withColumn("inner", F.max("high").over(inside)).join(reach, [*LOG, "block"])
    before = F.greatest("inner", "reach")
    starts = seen.withColumn("before", before).where("before is null or low - before > 1")
    return starts.select(*LOG, "block", "low", "before"), extents


def merged_runs(runs: DataFrame, block: int = GAP_BLOCK) -> DataFrame:
    """The fewest runs that hold the same offsets."""
    starts, extents = _starts(runs, block)
    following = F.lead("before").over(Window.partitionBy(*LOG, "block").orderBy("low"))
    firsts = starts.groupBy(*LOG, "block").agg(F.min_by("before", "low").alias("first"))
    onwards = F.lead("first").over(Window.partitionBy(*LOG).orderBy("block"))
    later = firsts.select(*LOG, "block", onwards.alias("later"))
    tops = extents.groupBy(*LOG).agg(F.max("top").alias("top"))
    return (
        starts.withColumn("following", following)
        .join(later, [*LOG, "block"])
        .join(tops, LOG)
        .select(*LOG, "low", F.coalesce("following", "later", "top").alias("high"))
    )


def missing_ranges(runs: DataFrame, block: int = GAP_BLOCK) -> DataFrame:
    """What lies between the runs of each partition, as first and last missing offset."""
    starts, _ = _starts(runs, block)
    return starts.where("before is not null").select(
        *LOG,
        (F.col("before") + 1).alias("first_missing"),
        (F.col("low") - 1).alias("last_missing"),
    )
