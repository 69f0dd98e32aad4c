"""Topics as Parquet folders of records, where no broker is at hand.

``{log_dir}/log={topic}`` holds files in the record schema of the broker
connector. Spark's file source reads such a folder as a stream, oldest file
first, and never needs the whole log in one place. One writer at a time.
"""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from freshet.config import IngestConfig
from freshet.functions import key_partition
from freshet.operators.counts import count_by_topic
from freshet.registry import RECORD_SCHEMA, TopicSpec, partition_count
from freshet.session import (
    list_folder,
    make_folder,
    path_exists,
    remove_folder,
    scratch_dir,
    small_splits,
)
from freshet.sources.csv_records import FILE, ORDINAL

# Rows numbered together; bounds the groups offsets are counted in.
OFFSET_BLOCK = 200_000
BLOCK = ["topic", "partition", FILE, "block"]
# Rows marked in one bitmap, which is Spark's size of them; bytes of bitmaps that meet the records at once.
MARKED = 1 << 15
MARK_BYTES = 128 << 20
# Of input files, taken by a task that sorts their records, which are many times as large.
SORTED_BYTES = 8 << 20
# Beside the topics: the first free offset of each partition.
STATE = "_next_offsets"
STATE_SCHEMA = "topic string, partition int, next long"


def topic_path(log_dir: str, topic: str) -> str:
    return f"{log_dir}/log={topic}"


def create_topics(spark: SparkSession, log_dir: str, specs: Iterable[TopicSpec]) -> None:
    """Make empty topics, which streams may read at once; existing ones stay as they are."""
    for spec in specs:
        make_folder(spark, topic_path(log_dir, spec.topic))


def read_options(cfg: IngestConfig) -> dict[str, str]:
    options = {
        "ignoreMissingFiles": str(not cfg.fails_on_data_loss).lower(),
        "maxFileAge": cfg.max_file_age,
    }
    if cfg.max_files_per_trigger:
        options["maxFilesPerTrigger"] = str(cfg.max_files_per_trigger)
    if cfg.max_bytes_per_trigger:
        options["maxBytesPerTrigger"] = cfg.max_bytes_per_trigger
    return options


def read_stream(spark: SparkSession, spec: TopicSpec, cfg: IngestConfig) -> DataFrame:
    """The topic's records, from ``starting_time`` on if that is set.

    Files and row groups that end before it are left out by their statistics, which the
    package's session settings write.
    """
    reader = spark.readStream.schema(RECORD_SCHEMA).options(**read_options(cfg))
    return since(reader.parquet(topic_path(cfg.log_dir, spec.topic)), cfg.starting_time)


def since(records: DataFrame, time: str | None) -> DataFrame:
    """Records sent at ``time`` or later, all if it is None."""
    return records if time is None else records.where(F.col("timestamp") >= F.lit(time).cast("timestamp"))


def read_batch(spark: SparkSession, log_dir: str, topic: str) -> DataFrame:
    return spark.read.schema(RECORD_SCHEMA).parquet(topic_path(log_dir, topic))


def _states(spark: SparkSession, log_dir: str) -> list[str]:
    """Folders of notes of the first free offsets, oldest first, unfinished ones too."""
    base = f"{log_dir}/{STATE}"
    return sorted(list_folder(spark, base)) if path_exists(spark, base) else []


def next_offsets(spark: SparkSession, log_dir: str) -> DataFrame | None:
    """First free offset of each ``(topic, partition)``, as the last append left them.

    The last finished note counts: one whose writer was lost has no ``_SUCCESS`` file. A log
    without any, as one written some other way, has the records of all its topics looked
    through, since the next note is to hold them all.
    """
    if states := [note for note in _states(spark, log_dir) if path_exists(spark, f"{note}/_SUCCESS")]:
        return spark.read.schema(STATE_SCHEMA).parquet(states[-1])
    folders = list_folder(spark, log_dir) if path_exists(spark, log_dir) else []
    names = [folder.rsplit("/", 1)[-1] for folder in folders]
    logs = [
        read_batch(spark, log_dir, name.removeprefix("log=")).select("topic", "partition", "offset")
        for name in names
        if name.startswith("log=")
    ]
    if not logs:
        return None
    return (
        reduce(DataFrame.unionByName, logs)
        .groupBy("topic", "partition")
        .agg((F.max("offset") + 1).alias("next"))
    )


def _note_offsets(
    spark: SparkSession, log_dir: str, bases: DataFrame, start: DataFrame | None
) -> None:
    """Write the first free offsets after an append, then drop the note before it.

    A line per partition. It is written before the records: an append that fails in
    between leaves a gap, never two records at one offset.
    """
    ends = bases.groupBy("topic", "partition").agg(F.max(F.col("base") + F.col("count")).alias("next"))
    if start is not None:
        ends = start.unionByName(ends).groupBy("topic", "partition").agg(F.max("next").alias("next"))
    states = _states(spark, log_dir)
    number = int(states[-1].rsplit("-", 1)[-1]) + 1 if states else 0
    ends.coalesce(1).write.parquet(f"{log_dir}/{STATE}/note-{number:09d}")
    for old in states:
        remove_folder(spark, old)


def block_bases(records: DataFrame, start: DataFrame | None = None) -> DataFrame:
    """First offset and number of records of every block; reads narrow columns only."""
    return _based(records.groupBy(*BLOCK).count(), start)


def _based(blocks: DataFrame, start: DataFrame | None) -> DataFrame:
    earlier = (
        Window.partitionBy("topic", "partition")
        .orderBy(FILE, "block")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    bases = blocks.withColumn("base", F.coalesce(F.sum("count").over(earlier), F.lit(0)))
    if start is None:
        return bases
    first = F.col("base") + F.coalesce("next", F.lit(0))
    return bases.join(start, ["topic", "partition"], "left").withColumn("base", first).drop("next")


def blocked(records: DataFrame, block_rows: int = OFFSET_BLOCK) -> DataFrame:
    return records.withColumn("block", F.expr(f"{ORDINAL} div {block_rows}"))


def assign_offsets(
    records: DataFrame, start: DataFrame | None = None, block_rows: int = OFFSET_BLOCK
) -> DataFrame:
    """Number records densely per ``(topic, partition)`` in file and row order.

    A partition's rows are counted in blocks of ``block_rows`` source rows, so
    one partition spreads over many tasks however large its share is. The
    records are shuffled once, to their block; block totals are a side table.
    ``start`` gives the first offset per ``(topic, partition)``, 0 where absent.
    """
    rows = blocked(records, block_rows)
    return _numbered(rows, block_bases(rows, start))


def _numbered(rows: DataFrame, bases: DataFrame) -> DataFrame:
    """Rows with their offsets, counted in their block, or by its bitmap if ``bases`` have one."""
    if "seen" in bases.columns:
        return _numbered_by_marks(rows, bases)
    rank = F.row_number().over(Window.partitionBy(*BLOCK).orderBy(ORDINAL))
    return (
        rows.withColumn("rank", rank)
        .join(bases.drop("count"), BLOCK)
        .withColumn("offset", F.col("base") + F.col("rank") - 1)
        .drop("base", "rank")
    )


def _marked(records: DataFrame) -> DataFrame:
    """Records with the block and the place in it that a bitmap marks."""
    place = F.pmod(F.col(ORDINAL), F.lit(MARKED))
    return records.withColumn("place", place).withColumn("block", F.expr(f"({ORDINAL} - place) div {MARKED}"))


def _marks(records: DataFrame) -> DataFrame:
    """Per block the number of its records and a bitmap of their places, as long as it must be."""
    marked = _marked(records.select("topic", "partition", FILE, ORDINAL)).dropna(subset=BLOCK)
    blocks = marked.groupBy(*BLOCK).agg(
        F.count("*").alias("count"),
        F.bitmap_construct_agg("place").alias("seen"),
        F.max("place").alias("last"),
    )
    return blocks.select(*BLOCK, "count", F.expr("substring(seen, 1, cast(last div 8 + 1 as int))").alias("seen"))


def _numbered_by_marks(records: DataFrame, bases: DataFrame) -> DataFrame:
    """Records with their offsets: the base of their block and the places marked before their own."""
    numbered = _marked(records).join(F.broadcast(bases.drop("count")), BLOCK)
    byte = F.expr("substring(seen, cast(place div 8 + 1 as int), 1)")
    earlier = F.ascii(F.decode(byte, "ISO-8859-1")).bitwiseAND(F.expr("shiftleft(1, cast(place % 8 as int)) - 1"))
    whole = F.expr("bitmap_count(substring(seen, 1, cast(place div 8 as int)))")
    offset = F.col("base") + whole + F.bit_count(earlier)
    return numbered.withColumn("offset", offset).drop("base", "seen", "place", "block")


def _marked_topics(bases: DataFrame) -> tuple[dict[str, int], list[list[str]]]:
    """Records per topic, and the topics that bitmaps can number, in lots of ``MARK_BYTES``.

    Not those with several records at one place, nor any whose bitmaps are larger.
    """
    sizes = bases.groupBy("topic").agg(
        F.sum("count").alias("rows"),
        F.sum(F.expr("bitmap_count(seen)")).alias("places"),
        F.sum(F.octet_length("seen") + F.octet_length(FILE) + 100).alias("bytes"),
    )
    sizes = sizes.orderBy("topic").collect()  # a line per topic
    lots, room = [], 0
    for size in sizes:
        if size.rows != size.places or size.bytes > MARK_BYTES:
            continue
        if not lots or size.bytes > room:
            lots.append([])
            room = MARK_BYTES
        lots[-1].append(size.topic)
        room -= size.bytes
    return {size.topic: size.rows for size in sizes}, lots


def _staged(spark: SparkSession, rows: DataFrame, label: str) -> DataFrame:
    path = scratch_dir(spark, label)
    rows.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(rows.schema).parquet(path)


def append(
    records: DataFrame,
    log_dir: str,
    specs: Iterable[TopicSpec],
    max_rows_per_file: int = 0,
) -> dict[str, int]:
    """Append ``(topic, key, value, __file, __ordinal)`` to the log.

    Records keep the ``timestamp`` they come with, or get the time of the write. They are read
    twice, first for their places alone, by which the tasks that write them number them: rows
    are neither shuffled nor written elsewhere. Where places repeat, or their bitmaps are too
    large to broadcast, the topic's records are written once and shuffled to their blocks.
    Returns the records written per topic.
    """
    specs = list(specs)
    topics = [spec.topic for spec in specs]
    spark = records.sparkSession
    partitions = partition_count(specs, F.col("topic"))
    placed = records.withColumn("partition", key_partition(F.col("key"), partitions))
    if "timestamp" not in placed.columns:
        placed = placed.withColumn("timestamp", F.current_timestamp())
    if not records._jdf.queryExecution().analyzed().deterministic():
        placed = _staged(spark, placed, "placed")  # a second reading may find other rows
    start = next_offsets(spark, log_dir)
    # The note replaces the one that ``start`` reads, so the bases are settled first.
    bases = _staged(spark, _based(_marks(placed), start), "bases")
    _note_offsets(spark, log_dir, bases, start)
    rows, lots = _marked_topics(bases)
    written = dict.fromkeys(topics, 0)

    def write(numbered: DataFrame, order: list[str]) -> None:
        counted, counts = count_by_topic(numbered.withColumn("timestampType", F.lit(0)), topics)
        _write(counted.sortWithinPartitions(*order), log_dir, max_rows_per_file)
        for topic, count in counts.get.items():
            written[topic] += count

    for lot in lots:
        among = F.col("topic").isin(lot)
        with small_splits(spark, SORTED_BYTES):
            write(_numbered(placed.where(among), bases.where(among)), ["topic", "partition", "offset"])
    if others := sorted(set(rows).difference(*lots)):
        blocks = _staged(spark, blocked(placed.where(F.col("topic").isin(others))), "placed")
        numbered = _numbered(blocks, _staged(spark, block_bases(blocks, start_of(bases)), "bases"))
        # Rows leave the numbering in this order already, so Spark drops the sort.
        write(numbered, BLOCK)
    if changed := [topic for topic, count in rows.items() if written.get(topic, count) != count]:
        raise RuntimeError(f"records changed between their numbering and their writing: {changed}")
    return written


def start_of(bases: DataFrame) -> DataFrame:
    """First offset of an append per ``(topic, partition)``."""
    return bases.groupBy("topic", "partition").agg(F.min("base").alias("next"))


def write_records(records: DataFrame, log_dir: str, max_rows_per_file: int = 0) -> None:
    """Write records that have their positions, in position order per file."""
    for note in _states(records.sparkSession, log_dir):
        remove_folder(records.sparkSession, note)  # it may not know these positions
    ordered = records.sortWithinPartitions("topic", "partition", "offset")
    with small_splits(records.sparkSession, SORTED_BYTES):
        _write(ordered, log_dir, max_rows_per_file)


def _write(ordered: DataFrame, log_dir: str, max_rows_per_file: int) -> None:
    (
        ordered.select(*RECORD_SCHEMA.names, F.col("topic").alias("log"))
        .write.mode("append")
        .partitionBy("log")
        .option("compression", "zstd")
        .option("parquet.compression.codec.zstd.level", 6)
        .option("maxRecordsPerFile", max_rows_per_file)
        .parquet(log_dir)
    )
