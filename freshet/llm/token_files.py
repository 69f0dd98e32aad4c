"""Token ids in files: frequent ids in one byte, lengths apart from the bytes.

An id is stored as its rank by frequency, in the fewest bytes that hold it. A
separate control stream has two bits per id, its number of bytes less one, four ids
to a byte, so that a reader finds all places by table lookup and running sums,
without a loop over ids. The files are Parquet: control and data bytes are columns,
thus separate on disk, with one row per document in ascending order of its id. A
second table, the codebook, has the id of each rank.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from freshet.llm.byte_pieces import SLICE_BYTES, column_of, piece_ids, rows_of, slices
from freshet.llm.staging import ship_code, staged
from freshet.session import scratch_scope

LITTLE = 1 << 16  # vocabularies below this are staged in two bytes an id
PACKED_BYTES = 2 << 20  # of ids or files that are packed or unpacked at once

#: Bytes of each of the four ids that a control byte speaks of.
LENGTHS = np.array([[(c >> 2 * k & 3) + 1 for k in range(4)] for c in range(256)], dtype=np.uint8)


def _quads(begins: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where each row's control bytes begin, then the end, and each number's place in quarters."""
    length = np.diff(begins)
    controls = np.append(0, np.cumsum(length + 3 >> 2))
    part = np.repeat(4 * controls[:-1] - begins[:-1], length)
    part += np.arange(len(part))
    return controls, part


def pack_rows(
    ranks: np.ndarray, begins: np.ndarray
) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Control bytes of rows of unsigned 32-bit numbers and where each row's begin; data bytes too.

    A row's numbers are those from its place in ``begins`` up to the next.
    """
    top = int(ranks.max(initial=0))
    width = 1 + (top > 0xFF) + (top > 0xFFFF) + (top > 0xFFFFFF)  # of the longest
    size = np.zeros(len(ranks), dtype=np.uint8)
    for k in range(1, width):
        size += ranks >= 1 << 8 * k
    # Four lengths of two bits each go from the low ends of four bytes into one.
    controls, part = _quads(begins)
    quads = np.zeros(4 * int(controls[-1]), dtype=np.uint8)
    quads[part] = size
    quads = quads.view("<u4")
    control = (quads | quads >> 6 | quads >> 12 | quads >> 18).astype(np.uint8)
    wide = width if width < 3 else 4
    stored = np.ones((len(ranks), wide), dtype=bool)
    for k in range(1, wide):
        stored[:, k] = size >= k
    data = ranks.astype(f"<u{wide}").view(np.uint8)[stored.ravel()]
    longer = np.append(0, np.cumsum(size, dtype=np.int64))
    return control, controls, data, begins + longer[begins]


def pack_ranks(ranks: np.ndarray) -> tuple[bytes, bytes]:
    """Control and data bytes of unsigned 32-bit numbers."""
    control, _, data, _ = pack_rows(ranks, np.array([0, len(ranks)]))
    return control.tobytes(), data.tobytes()


def unpack_rows(control: np.ndarray, data: np.ndarray, begins: np.ndarray) -> np.ndarray:
    """The numbers that ``pack_rows`` was given, whose rows began there."""
    size = LENGTHS[control].reshape(-1)[_quads(begins)[1]]
    start = np.cumsum(size, dtype=np.int64) - size
    padded = np.append(data, np.zeros(3, dtype=np.uint8))
    ranks = padded[start].astype(np.uint32)
    for k in range(1, int(size.max(initial=0))):
        longer = np.flatnonzero(size > k)
        ranks[longer] |= padded[start[longer] + k].astype(np.uint32) << np.uint32(8 * k)
    return ranks


def unpack_ranks(control: bytes, data: bytes, n: int) -> np.ndarray:
    """The numbers that ``pack_ranks`` was given, of which there were ``n``."""
    raw = [np.frombuffer(x, dtype=np.uint8) for x in (control, data)]
    return unpack_rows(*raw, np.array([0, n]))


def _id_type(vocabulary: int) -> str:
    return "<u2" if vocabulary < LITTLE else "<u4"


def staged_ids(
    spark: SparkSession, docs: DataFrame, tokenizer: str, end_id: int, vocabulary: int
) -> DataFrame:
    """Ids of every document, tokenised once, as a table of doc_id and id bytes."""
    kind = _id_type(vocabulary)

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = piece_ids(tokenizer)
        for batch in batches:
            data, begins = rows_of(batch["text"])
            for at, to in slices(begins, SLICE_BYTES):
                texts = data[begins[at] : begins[to]]
                ids, places = encoder.encode(texts, begins[at : to + 1] - begins[at], end_id, kind)
                column = column_of(ids.view(np.uint8), places * ids.itemsize)
                yield pa.RecordBatch.from_arrays(
                    [batch["doc_id"][at:to], column], names=["doc_id", "ids"]
                )

    rows = docs.select(F.col("doc_id").cast("long"), "text")
    return staged(spark, rows.mapInArrow(encode, "doc_id long, ids binary"), "ids", "zstd")


def id_counts(ids: DataFrame, vocabulary: int) -> DataFrame:
    """How often each id occurs; counted per task, then summed."""
    kind = _id_type(vocabulary)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(vocabulary, dtype=np.int64)
        for batch in batches:
            data, begins = rows_of(batch["ids"])
            for at, to in slices(begins, PACKED_BYTES):
                found = data[begins[at] : begins[to]].view(kind)
                total += np.bincount(found, minlength=vocabulary)
        met = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(met), pa.array(total[met])], names=["id", "n"])

    counted = ids.select("ids").mapInArrow(count, "id long, n long")
    return counted.groupBy("id").agg(F.sum("n").alias("n"))


def write_token_files(
    spark: SparkSession,
    docs: DataFrame,
    path: str,
    tokenizer: str,
    vocabulary: int,
    end_id: int = 2,
) -> None:
    """Tokenise documents (doc_id, text) and write their ids below ``path``.

    A null or empty text has the end id alone. Repeated rows are written each for
    itself; rows of one doc_id lie side by side, null ids first; other columns are
    not read. ``vocabulary`` bounds the ids; the codebook passes through the driver.
    """
    with scratch_scope(spark):  # the staged ids go once the files are there
        _write(spark, docs, path, tokenizer, vocabulary, end_id)


def _write(
    spark: SparkSession, docs: DataFrame, path: str, tokenizer: str, vocabulary: int, end_id: int
) -> None:
    ship_code(spark)
    ids = staged_ids(spark, docs, tokenizer, end_id, vocabulary)
    order = id_counts(ids, vocabulary).orderBy(F.desc("n"), "id")
    order = order.select(F.monotonically_increasing_id().alias("line"), "id").collect()
    codebook = np.array([r["id"] for r in order], dtype=np.int64)
    rank = np.zeros(vocabulary, dtype=np.uint32)
    rank[codebook] = np.arange(len(codebook))
    kind = _id_type(vocabulary)

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, begin = TaskContext.get().partitionId(), 0
        for batch in batches:
            data, begins = rows_of(batch["ids"])
            for at, to in slices(begins, PACKED_BYTES):
                found = rank[data[begins[at] : begins[to]].view(kind)]
                places = (begins[at : to + 1] - begins[at]) // np.dtype(kind).itemsize
                control, controls, packed, packs = pack_rows(found, places)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch["doc_id"][at:to],
                        pa.array(np.full(to - at, part, dtype=np.int32)),
                        pa.array(begin + places[:-1]),
                        pa.array(np.diff(places)),
                        column_of(control, controls),
                        column_of(packed, packs),
                    ],
                    names=names,
                )
                begin += len(found)

    schema = "doc_id long, part int, begin long, n_tokens long, control binary, data binary"
    names = [field.split()[0] for field in schema.split(", ")]
    ordered = ids.repartitionByRange("doc_id").sortWithinPartitions("doc_id", "ids")
    files = ordered.mapInArrow(encode, schema)
    files.write.option("compression", "zstd").parquet(f"{path}/ids")
    lines = spark.createDataFrame(
        pd.DataFrame({"rank": np.arange(len(codebook)), "id": codebook}), "rank long, id long"
    )
    lines.coalesce(1).write.parquet(f"{path}/codebook")


def read_token_files(spark: SparkSession, path: str) -> DataFrame:
    """The documents of such files: doc_id, start, n_tokens, ids.

    ``start`` counts the ids of all documents before it; ``ids`` are little-endian
    32-bit integers.
    """
    ship_code(spark)
    files = spark.read.parquet(f"{path}/ids")
    lines = spark.read.parquet(f"{path}/codebook").collect()  # at most the vocabulary
    codebook = np.zeros(max([0, *(r["rank"] for r in lines)]) + 1, dtype="<u4")
    for r in lines:
        codebook[r["rank"]] = r["id"]

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            control, controls = rows_of(batch["control"])
            data, begins = rows_of(batch["data"])
            n_tokens = batch["n_tokens"].to_numpy()
            for at, to in slices(begins, PACKED_BYTES):
                places = np.append(0, np.cumsum(n_tokens[at:to]))
                ranks = unpack_rows(
                    control[controls[at] : controls[to]], data[begins[at] : begins[to]], places
                )
                ids = column_of(codebook[ranks].view(np.uint8), 4 * places)
                kept = [batch[name][at:to] for name in ("doc_id", "part", "begin", "n_tokens")]
                yield pa.RecordBatch.from_arrays([*kept, ids], names=names)

    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = (
        files.groupBy("part")  # one line per shuffle partition, hence the broadcast below
        .agg(F.sum("n_tokens").alias("_n"))
        .select("part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    )
    schema = "doc_id long, part int, begin long, n_tokens long, ids binary"
    names = [field.split()[0] for field in schema.split(", ")]
    return (
        files.mapInArrow(decode, schema)
        .join(F.broadcast(parts), "part")
        .select("doc_id", (F.col("_before") + F.col("begin")).alias("start"), "n_tokens", "ids")
    )
