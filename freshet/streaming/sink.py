"""Bronze tables as streaming sinks."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StringType

from freshet.config import IngestConfig
from freshet.registry import TopicSpec

BETWEEN = "\x01"  # texts that cross a shuffle as one
SIGNS, HALVES = ".-: ", "abcd"  # of numbers and times, and the half bytes they cross it as


def _dashed(digits: Column) -> Column:
    """32 digits in the groups of a UUID; null stays null."""
    starts = {1: 8, 9: 4, 13: 4, 17: 4, 21: 12}
    groups = F.array(*(F.substring(digits, at, n) for at, n in starts.items()))
    return F.when(digits.isNotNull(), F.array_join(groups, "-"))


def _hexadecimal(event: Column) -> tuple[Column, Column]:
    """Whether an event id is the digits of bytes in groups of a UUID, and without dashes."""
    return event.rlike(r"\A[0-9a-f]{8}(-[0-9a-f]{4}){3}-[0-9a-f]{12}\z"), event.rlike(r"\A([0-9a-f]{2})+\z")


def packed_id(event: Column) -> Column:
    """Bytes that differ where event ids do, half as many where an id is hexadecimal digits."""
    uuid, plain = _hexadecimal(event)
    kind = [F.unhex(F.lit(number)) for number in ("00", "01", "02")]
    digits = F.unhex(F.replace(event, F.lit("-"), F.lit("")))
    packed = F.when(uuid, F.concat(kind[2], digits)).when(plain, F.concat(kind[1], digits))
    return packed.otherwise(F.concat(kind[0], event.cast("binary")))


def _narrow_texts(rows: DataFrame, texts: list[str]) -> DataFrame:
    """The texts in two columns, ``_numbers`` and ``_texts``; only a row that does not fit keeps its own.

    Digits and the signs of numbers and times go by the half byte, an ``e`` between two texts;
    an ``f`` is a null. ``ff`` is another text, which is in ``_texts``, between two signs.
    """
    fits = {f"_fits_{n}": F.col(f"`{c}`").rlike(r"\A[0-9.: -]*\z") for n, c in enumerate(texts)}
    tested = rows.select("*", *(fit.alias(name) for name, fit in fits.items()))
    parts, others = [], []
    for fit, name in zip(fits, texts):
        text = F.col(f"`{name}`")
        parts.append(F.when(F.col(fit), text).when(text.isNull(), F.lit("f")).otherwise(F.lit("ff")))
        others.append(F.when(F.col(fit) | text.isNull(), F.lit("")).otherwise(text))
    numbers = F.translate(F.concat_ws("e", *parts), SIGNS, HALVES)
    # Of even length, with a last ``e`` or two.
    numbers = F.concat(numbers, F.when(F.length(numbers) % 2 == 0, F.lit("ee")).otherwise(F.lit("e")))
    joined = F.concat_ws(BETWEEN, *others)
    joins = F.size(F.split(joined, BETWEEN, -1)) == len(texts)
    return tested.select(
        *(c for c in rows.columns if c not in texts),
        F.unhex(numbers).alias("_numbers"),
        F.when(joins, joined).alias("_texts"),
        *(F.when(~joins, F.col(f"`{c}`")).alias(c) for c in texts),
    )


def _whole_texts(rows: DataFrame, texts: list[str]) -> DataFrame:
    """Undoes ``_narrow_texts``."""
    apart = rows.withColumns(
        {
            "_numbers": F.split(F.translate(F.lower(F.hex("_numbers")), HALVES, SIGNS), "e", -1),
            "_texts": F.split("_texts", BETWEEN, -1),
        }
    )

    def text(place: int, name: str) -> Column:
        number = F.get("_numbers", F.lit(place))
        found = F.when(number == "ff", F.get("_texts", F.lit(place))).when(number != "f", number)
        return F.when(F.col("_texts").isNull(), F.col(f"`{name}`")).otherwise(found)

    return apart.withColumns({name: text(place, name) for place, name in enumerate(texts)})


def by_date(bronze: DataFrame) -> DataFrame:
    """The rows gathered by date, in one shuffle.

    An event id of hexadecimal digits, as a UUID or without dashes, crosses it in about
    half its bytes, as lz4 cannot shorten it; any other goes as it is. So do numbers and
    times, see ``_narrow_texts``.
    """
    event = F.col("_event_id")
    uuid, plain = _hexadecimal(event)
    narrow = {
        "_id_digits": F.when(uuid | plain, F.unhex(F.replace(event, F.lit("-"), F.lit("")))),
        "_id_dashed": uuid,
        "_event_id": F.when(~(uuid | plain), event),
    }
    alone = ("_kafka_topic", "_event_id", "_raw_value")
    texts = [f.name for f in bronze.schema if f.dataType == StringType() and f.name not in alone]
    rest = (F.col(f"`{c}`") for c in bronze.columns if c != "_event_id")
    gathered = bronze.select(*rest, *(column.alias(name) for name, column in narrow.items()))
    gathered = _narrow_texts(gathered, texts).hint("rebalance", "_bronze_date")
    packed = F.lower(F.hex("_id_digits"))
    whole = F.coalesce(F.when(F.col("_id_dashed"), _dashed(packed)).otherwise(packed), event)
    back = _whole_texts(gathered, texts)
    return back.select(*(whole.alias(c) if c == "_event_id" else F.col(f"`{c}`") for c in bronze.columns))


def write_bronze(
    bronze: DataFrame,
    spec: TopicSpec,
    cfg: IngestConfig,
    write_batch: Callable[[DataFrame, int], None] | None = None,
) -> StreamingQuery:
    """Append a stream to its date-partitioned table.

    Each batch writes about one file per task and date. With ``compact_dates``
    rows are first gathered by date; adaptive execution splits a dominating
    date over several tasks, so none has to write it alone. ``write_batch``, if given,
    writes the batches instead of Spark's own sink.
    """
    if write_batch:
        writer = bronze.writeStream.foreachBatch(write_batch)
    else:
        if cfg.compact_dates:
            bronze = by_date(bronze)
        writer = (
            bronze.writeStream.format(cfg.table_format)
            .outputMode("append")
            .partitionBy("_bronze_date")
            .options(**cfg.file_options)
            .option("path", cfg.table_path(spec.table))
        )
    writer = writer.queryName(f"bronze_{spec.table}").option(
        "checkpointLocation", cfg.checkpoint_path(spec.table)
    )
    if cfg.available_now:
        writer = writer.trigger(availableNow=True)
    else:
        writer = writer.trigger(processingTime=f"{cfg.trigger_seconds} seconds")
    return writer.start()
