"""Checks on bronze tables. Built-in aggregates throughout, nothing is collected.

Hot values are expected: one event id, topic or partition may hold a large share
of a table. Counts and minima are combined before each shuffle, and windows only
run over groups bounded by construction.
"""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce
from operator import or_

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from freshet.config import IngestConfig
from freshet.functions import ingested_instant
from freshet.registry import POSITION, TopicSpec

# Offsets compared with their neighbours inside one group.
GAP_BLOCK = 1_000_000
# Ids compared one by one; a plan with many more comparisons is too deep for Spark.
FEW_IDS = 200


def duplicate_events(bronze: DataFrame, by: tuple[str, ...] = ("_event_id",)) -> DataFrame:
    """Event ids seen more than once, with their number of copies.

    Rows without an id are not events; ``quarantine`` reports them.
    """
    return (
        bronze.dropna(subset=list(by))
        .groupBy(*by)
        .agg(F.count("*").alias("copies"))
        .where("copies > 1")
    )


def dedup_events(bronze: DataFrame, by: tuple[str, ...] = ("_event_id",)) -> DataFrame:
    """One row per event: the copy at the lowest topic, partition and offset.

    Rows lacking an id are all kept, each under its own position. As only the
    first row of a group is wanted, Spark cuts every task's copies of an id down
    to one before the shuffle, so that a much-copied id stays small.
    """
    unidentified = reduce(or_, (F.col(name).isNull() for name in by))
    own_position = F.when(unidentified, F.struct(*POSITION))
    copies = Window.partitionBy(*by, own_position).orderBy(*POSITION)
    return bronze.withColumn("copy", F.row_number().over(copies)).where("copy = 1").drop("copy")


def offset_gaps(bronze: DataFrame) -> DataFrame:
    """Offsets missing between the first and last seen, per topic and partition."""
    span = F.max("_kafka_offset") - F.min("_kafka_offset") + 1
    return bronze.groupBy("_kafka_topic", "_kafka_partition").agg(
        F.min("_kafka_offset").alias("first_offset"),
        F.max("_kafka_offset").alias("last_offset"),
        F.countDistinct("_kafka_offset").alias("offsets"),
        (span - F.countDistinct("_kafka_offset")).alias("missing"),
    )


def offset_gap_ranges(bronze: DataFrame, block: int = GAP_BLOCK) -> DataFrame:
    """Every run of missing offsets, as first and last missing offset.

    Offsets are compared with their predecessor inside blocks of ``block``
    offsets, in the one shuffle that all rows take. Each block goes on as one run from
    its lowest to its highest offset; runs are compared inside blocks of ``block``
    squared, and what is left of those across a whole partition. So no window sees
    many rows, be offsets dense or sparse, if ``block`` is not chosen small: the last
    window has a row per ``block`` squared offsets.
    """
    if block < 2:
        raise ValueError("a block needs at least two offsets")
    log = ["_kafka_topic", "_kafka_partition"]
    offset = F.col("_kafka_offset")
    runs = bronze.select(*log, offset.alias("low"), offset.alias("high"))
    gaps = []
    for width in (block, block * block):
        steps = _steps(runs.withColumn("block", F.expr(f"low div {width}")), [*log, "block"])
        gaps.append(steps.where(GAP).select(*log, "before", "low"))
        # The first and last run of a block lie where the window has put them: no shuffle.
        ends = F.min("low").alias("low"), F.max("high").alias("high")
        runs = steps.where("before is null or following is null").groupBy(*log, "block").agg(*ends)
    gaps.append(_steps(runs, log).where(GAP).select(*log, "before", "low"))
    return reduce(DataFrame.unionByName, gaps).select(
        *log,
        (F.col("before") + 1).alias("first_missing"),
        (F.col("low") - 1).alias("last_missing"),
    )


GAP = "low - before > 1"


def _steps(runs: DataFrame, within: list[str]) -> DataFrame:
    """Runs with the end of the one before them in their group, and the start of the next."""
    order = Window.partitionBy(*within).orderBy("low")
    return runs.select(
        *within,
        "low",
        "high",
        F.lag("high").over(order).alias("before"),
        F.lead("low").over(order).alias("following"),
    )


def find_events(bronze: DataFrame, ids: Iterable[str] | DataFrame) -> DataFrame:
    """All rows of some events, wherever in the history they are.

    ``ids`` is a list, or a frame whose first column they are, which stays with the executors.
    Up to ``FEW_IDS`` are pushed down as comparisons one by one, for which Parquet asks the
    Bloom filters of a table written with ``id_filters``: row groups without any of the ids
    are not read. More are joined.
    """
    spark = bronze.sparkSession
    if isinstance(ids, DataFrame):
        wanted = ids.select(F.col(f"`{ids.columns[0]}`").alias("_event_id"))
        few = [row["_event_id"] for row in wanted.limit(FEW_IDS + 1).collect()]
    else:
        few = list(ids)
        if len(few) > FEW_IDS:
            wanted = spark.createDataFrame([(one,) for one in few], "_event_id string")
    if len(few) > FEW_IDS:
        return bronze.join(wanted, "_event_id", "left_semi").select(*bronze.columns)
    return bronze.where(reduce(or_, (F.col("_event_id") == one for one in few), F.lit(False)))


def topic_mismatch(bronze: DataFrame) -> DataFrame:
    """Rows whose payload names another topic, or none, than they arrived on."""
    return (
        bronze.where(~F.col("_kafka_topic").eqNullSafe(F.col("_topic")))
        .groupBy("_kafka_topic", "_topic")
        .agg(F.count("*").alias("rows"))
    )


def ingest_lag(bronze: DataFrame) -> DataFrame:
    """Microseconds from ``_ingested_at`` to the record's timestamp, per topic.

    ``rows`` counts all rows, ``timed`` those whose ``_ingested_at`` is a time.
    """
    ingested = ingested_instant(F.col("_ingested_at"))
    lag = F.unix_micros("_kafka_timestamp") - F.unix_micros(ingested)
    return (
        bronze.select("_kafka_topic", lag.alias("lag"))
        .groupBy("_kafka_topic")
        .agg(
            F.count("*").alias("rows"),
            F.count("lag").alias("timed"),
            F.min("lag").alias("min_lag_us"),
            # An exact sum, so that the mean does not depend on the order of rows.
            (F.sum(F.col("lag").cast("decimal(38,0)")).cast("double") / F.count("lag")).alias(
                "avg_lag_us"
            ),
            F.max("lag").alias("max_lag_us"),
        )
    )


def read_bronze(spark: SparkSession, cfg: IngestConfig, spec: TopicSpec) -> DataFrame:
    """The whole table, with its declared column types."""
    path = cfg.table_path(spec.table)
    if cfg.table_format == "delta":
        return spark.read.format("delta").load(path)
    schema = spec.stored_schema(cfg.keep_raw)
    last = ["_bronze_date"]
    # The folders of a table in batches have the batch's name too, which is no bronze column.
    table = spark.read.schema(schema).parquet(path)
    return table.select(*(c for c in schema.names if c not in last), *last)


def bronze_day(
    spark: SparkSession, cfg: IngestConfig, spec: TopicSpec, day: str | None
) -> DataFrame:
    """One ingestion date; only its partition is read. ``None`` takes undated rows."""
    date = F.lit(day).cast("date")
    return read_bronze(spark, cfg, spec).where(F.col("_bronze_date").eqNullSafe(date))


def count_by_day(bronze: DataFrame) -> DataFrame:
    return bronze.groupBy("_kafka_topic", "_bronze_date").agg(F.count("*").alias("rows"))


def reconcile(source_counts: DataFrame, bronze: DataFrame) -> DataFrame:
    """Source against bronze rows per topic and date, absent sides as 0.

    ``source_counts`` has ``(_kafka_topic, _bronze_date, rows)``.
    """
    source = source_counts.select(
        F.col("_kafka_topic").alias("s_topic"),
        F.col("_bronze_date").alias("s_date"),
        F.col("rows").alias("source_rows"),
    )
    landed = count_by_day(bronze).withColumnRenamed("rows", "bronze_rows")
    same = F.col("s_topic").eqNullSafe(F.col("_kafka_topic")) & F.col("s_date").eqNullSafe(
        F.col("_bronze_date")
    )
    sent = F.coalesce("source_rows", F.lit(0))
    arrived = F.coalesce("bronze_rows", F.lit(0))
    return source.join(landed, same, "full").select(
        F.coalesce("s_topic", "_kafka_topic").alias("_kafka_topic"),
        F.coalesce("s_date", "_bronze_date").alias("_bronze_date"),
        sent.alias("source_rows"),
        arrived.alias("bronze_rows"),
        (sent - arrived).alias("missing"),
    )
