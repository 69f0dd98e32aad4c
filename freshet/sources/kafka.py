"""Broker topics; needs Spark's Kafka connector on the class path."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from concurrent.futures import ThreadPoolExecutor
from contextvars import copy_context
from datetime import datetime
from itertools import chain
from threading import Event
from typing import TypeVar

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from freshet.config import IngestConfig
from freshet.functions import key_partition
from freshet.operators.counts import count_by_topic
from freshet.registry import TopicSpec, partition_count
from freshet.session import list_folder, scratch_dir
from freshet.sources.csv_records import FILE, ORDINAL

T = TypeVar("T")

WAVE_ROWS = 10_000_000  # of a topic's lane, sent before the next ones
BLOCK_ROWS = 100_000  # of a file, counted together
LANES = 64  # of keys, a power of two
LANES_AT_ONCE = 8

# Producer batching window and compression.
PRODUCER_OPTIONS = {"kafka.linger.ms": "10", "kafka.compression.type": "lz4"}


def read_options(spec: TopicSpec, cfg: IngestConfig) -> dict[str, str]:
    options = {
        "kafka.bootstrap.servers": cfg.broker,
        "subscribe": spec.topic,
        "failOnDataLoss": str(cfg.fails_on_data_loss).lower(),
    }
    if cfg.starting_time:
        since = datetime.fromisoformat(cfg.starting_time)
        options["startingTimestamp"] = str(round(since.timestamp() * 1000))
        # A partition without records of that time is read from its end.
        options["startingOffsetsByTimestampStrategy"] = "latest"
    else:
        options["startingOffsets"] = cfg.starting_offsets
    if cfg.max_offsets_per_trigger:
        options["maxOffsetsPerTrigger"] = str(cfg.max_offsets_per_trigger)
    if cfg.min_partitions:
        options["minPartitions"] = str(cfg.min_partitions)
    return options


def read_stream(spark: SparkSession, spec: TopicSpec, cfg: IngestConfig) -> DataFrame:
    return spark.readStream.format("kafka").options(**read_options(spec, cfg)).load()


def write_options(broker: str) -> dict[str, str]:
    return {"kafka.bootstrap.servers": broker, **PRODUCER_OPTIONS}


def outgoing(
    records: DataFrame,
    specs: Iterable[TopicSpec],
    place_by_crc32: bool = False,
    keep_order: bool = False,
) -> DataFrame:
    """The columns the sink takes.

    The client places records by key in its own way. ``place_by_crc32`` places
    them by ``key_partition``, for topics with as many partitions as declared. Many tasks
    send at once, so a key's records arrive in any order unless ``keep_order`` first
    gathers each key's records, in file and row order, in one task; see ``send_waves``.
    """
    if keep_order:
        records = records.repartition("topic", "key").sortWithinPartitions(FILE, ORDINAL)
    partition = key_partition(F.col("key"), partition_count(specs, F.col("topic")))
    place = [partition.alias("partition")] if place_by_crc32 else []
    return records.select("topic", "key", "value", *place)


def in_waves(records: DataFrame, wave_rows: int = WAVE_ROWS) -> DataFrame:
    """Records with a ``lane`` and a ``wave``.

    A lane has all rows of its keys, a wave about ``wave_rows`` rows of a topic's lane in
    file and row order. A topic has no more lanes than its rows fill waves. Taken from a
    histogram of slices, a lane's rows in a block of rows, each of which lies in one wave.
    """
    spark = records.sparkSession
    block_rows = max(1, min(wave_rows, BLOCK_ROWS))
    sliced = records.withColumn("_block", F.expr(f"{ORDINAL} div {block_rows}")).withColumn(
        "_slice", F.pmod(F.xxhash64("topic", "key"), F.lit(LANES))
    )
    # Written once: it is small, so that the records need no shuffle to meet it.
    path = scratch_dir(spark, "slices")
    slices = sliced.groupBy("topic", FILE, "_block", "_slice").agg(F.count("*").alias("_rows"))
    slices.write.parquet(path)
    slices = spark.read.schema(slices.schema).parquet(path)
    # Halved and halved again, so that slices of one lane stay together.
    full = F.greatest(F.lit(1), F.sum("_rows") / wave_rows)
    fit = F.pow(2, F.floor(F.log2(full))).cast("long")
    topics = slices.groupBy("topic").agg(F.least(F.lit(LANES), fit).alias("_lanes"))
    slices = slices.join(F.broadcast(topics), "topic").withColumn("lane", F.col("_slice") % F.col("_lanes"))
    earlier = Window.unboundedPreceding, -1
    in_file = Window.partitionBy("topic", "lane", FILE).orderBy("_block", "_slice").rowsBetween(*earlier)
    in_lane = Window.partitionBy("topic", "lane").orderBy(FILE).rowsBetween(*earlier)
    files = slices.groupBy("topic", "lane", FILE).agg(F.sum("_rows").alias("_rows"))
    bases = files.select("topic", "lane", FILE, F.coalesce(F.sum("_rows").over(in_lane), F.lit(0)).alias("_base"))
    before = F.col("_base") + F.coalesce(F.sum("_rows").over(in_file), F.lit(0))
    waves = slices.join(bases, ["topic", "lane", FILE]).select(
        "topic", FILE, "_block", "_slice", "lane", F.floor(before / wave_rows).alias("wave")
    )
    path = scratch_dir(spark, "wave-slices")
    waves.write.parquet(path)
    waves = spark.read.schema(waves.schema).parquet(path)
    return sliced.join(waves, ["topic", FILE, "_block", "_slice"]).drop("_block", "_slice")


def _numbered(spark: SparkSession, path: str, column: str) -> list[tuple[int, str]]:
    """Number and path of the folders of a column's values, in order."""
    names = (folder.rsplit("/", 1)[-1] for folder in list_folder(spark, path))
    start = f"{column}="
    numbers = sorted(int(name.removeprefix(start)) for name in names if name.startswith(start))
    return [(number, f"{path}/{start}{number}") for number in numbers]


def each_lane(records: DataFrame, wave_rows: int = WAVE_ROWS) -> dict[int, Iterator[DataFrame]]:
    """The records in lanes that share no key, each in waves, to be sent one after the other.

    All rows of a key that lie in one wave come before those in the next, so that a key's
    order needs no task to hold more of it than a wave has. The records are written once,
    in a folder per wave, and each wave reads its own.
    """
    spark = records.sparkSession
    path = scratch_dir(spark, "waves")
    in_waves(records, wave_rows).write.partitionBy("lane", "wave").parquet(path)

    def waves(lane: str) -> Iterator[DataFrame]:
        for _, folder in _numbered(spark, lane, "wave"):
            # Its folder alone is looked at, so that a wave costs the same however many there are.
            yield spark.read.schema(records.schema).parquet(folder)

    return {number: waves(lane) for number, lane in _numbered(spark, path, "lane")}


def each_wave(records: DataFrame, wave_rows: int = WAVE_ROWS) -> Iterator[DataFrame]:
    """The waves of all lanes, one lane after the other."""
    yield from chain.from_iterable(each_lane(records, wave_rows).values())


def send_waves(
    records: DataFrame, send: Callable[[DataFrame, int, int], T], wave_rows: int = WAVE_ROWS
) -> list[T]:
    """What ``send(records, lane, number)`` gives for every wave.

    A lane's waves are sent one after the other, the lanes side by side: a key's rows keep
    their order, and the wait for one lane's job is spent on another's. If one fails, no
    further wave is begun.
    """
    failed = Event()

    def sent(lane: int, waves: Iterator[DataFrame]) -> list[T]:
        results = []
        try:
            for number, wave in enumerate(waves):
                if failed.is_set():
                    break
                results.append(send(wave, lane, number))
        except BaseException:
            failed.set()
            raise
        return results

    with ThreadPoolExecutor(LANES_AT_ONCE) as pool:
        run = inheritable_thread_target(records.sparkSession)(sent)
        lanes = each_lane(records, wave_rows).items()
        # Each thread needs a context of its own, all with the caller's scratch scope.
        jobs = [pool.submit(copy_context().run, run, *lane) for lane in lanes]
        return [result for job in jobs for result in job.result()]


def publish(
    records: DataFrame,
    broker: str,
    specs: Iterable[TopicSpec],
    place_by_crc32: bool = False,
    keep_order: bool = False,
) -> dict[str, int]:
    """Send records in one job, or with ``keep_order`` in a job per wave; counts per topic.

    A job fails if a delivery fails.
    """
    specs = list(specs)
    topics = list(dict.fromkeys(spec.topic for spec in specs))

    def send(part: DataFrame, *_: int) -> dict[str, int]:
        counted, counts = count_by_topic(outgoing(part, specs, place_by_crc32, keep_order), topics)
        counted.write.format("kafka").options(**write_options(broker)).save()
        return counts.get

    sent = send_waves(records, send) if keep_order else [send(records)]
    return {topic: sum(counts[topic] for counts in sent) for topic in topics}
