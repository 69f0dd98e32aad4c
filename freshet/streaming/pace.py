"""Releasing rows at a pace, by Spark's clock of rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from freshet.session import scratch_dir
from freshet.sources.csv_records import ORDINAL


def release(
    records: DataFrame,
    rows_per_second: int,
    checkpoint: str,
    send: Callable[[DataFrame], None],
    trigger_seconds: float = 1,
) -> None:
    """Hand rows to ``send`` when they are due, until the last one is out.

    Row n of every file is due ``n / rows_per_second`` after the start, as a rate source
    counts; ``released_at`` is that time. Each batch takes what has become due from a copy
    of the records in order of their numbers, of which it reads the range that it needs.
    On the same checkpoint a run goes on where the one before stopped; a batch that failed
    is handed over again.
    """
    spark = records.sparkSession
    path = scratch_dir(spark, "paced")
    records.repartitionByRange(ORDINAL).sortWithinPartitions(ORDINAL).write.parquet(path)
    staged = spark.read.schema(records.schema).parquet(path)
    last = staged.agg(F.max(ORDINAL)).first()[0]
    if last is None:
        return
    out = []

    def batch(due: DataFrame, number: int) -> None:
        low, high = due.agg(F.min("value"), F.max("value")).first()
        if low is None or low > last:
            return
        times = due.select(F.col("value").alias(ORDINAL), F.col("timestamp").alias("released_at"))
        send(staged.where(F.col(ORDINAL).between(low, high)).join(times, ORDINAL))
        if high >= last:
            out.append(high)

    ticks = spark.readStream.format("rate").option("rowsPerSecond", rows_per_second).load()
    query = (
        ticks.writeStream.foreachBatch(batch)
        .option("checkpointLocation", checkpoint)
        .trigger(processingTime=f"{trigger_seconds} seconds")
        .start()
    )
    try:
        while not out and not query.awaitTermination(0.2):
            pass
    finally:
        query.stop()
