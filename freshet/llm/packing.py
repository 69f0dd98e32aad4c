"""Packing of tokenised documents into fixed-length sequences, best-two-fit.

Which documents share a sequence depends on their lengths only. So the plan is made
from the number of pieces of each length (as many numbers as a sequence has tokens,
whatever the corpus holds), and the pieces are dealt to the plan's places by their
number among the pieces of their length.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from freshet.llm.ranks import ranked, spread
from freshet.llm.staging import HANDED, arrow_rows, handing_back, ship_code, staged
from freshet.llm.tokens import word_ids

SLICE = 256  # texts encoded at once


@dataclass
class Plan:
    """Places for pieces, one line per kind of sequence and length in it.

    The pieces numbered ``first`` and on of a length go to the line; each of its
    ``times`` sequences takes ``each`` of them, side by side from ``offset``.
    """

    length: np.ndarray
    first: np.ndarray
    each: np.ndarray
    sequence: np.ndarray
    offset: np.ndarray
    sequences: int


def _largest_fitting(free: np.ndarray) -> np.ndarray:
    """For every room, the largest length not above it of which a piece is left (0: none)."""
    lengths = np.arange(len(free))
    return np.maximum.accumulate(np.where(free > 0, lengths, 0))


def _best_pair(free: np.ndarray, room: int) -> tuple[int, int]:
    """The two free lengths with the largest sum within the room."""
    fitting = _largest_fitting(free[: room + 1])
    a = np.flatnonzero(free[:room])
    if not len(a):
        return 0, 0
    b = fitting[room - a]
    alone = (a == b) & (free[a] < 2)
    b[alone] = fitting[a[alone] - 1]
    total = np.where(b > 0, a + b, 0)
    best = int(total.argmax())
    return (int(a[best]), int(b[best])) if total[best] else (0, 0)


def _fill(left: np.ndarray, capacity: int) -> list[int]:
    """The lengths of the next sequence.

    Greedy: the largest piece that still fits, again and again. Then the smallest
    gives way to two that fill the gap it leaves more tightly, as long as there are
    such two.
    """
    free = left.copy()
    chosen: list[int] = []
    gap = capacity
    fitting = _largest_fitting(free)
    while (piece := int(fitting[gap])) > 0:
        # As many of this length as fit, without asking for each.
        take = min(int(free[piece]), gap // piece)
        chosen += [piece] * take
        free[piece] -= take
        gap -= take * piece
        if not free[piece]:
            fitting = _largest_fitting(free[: gap + 1])
    while gap and len(chosen) > 1:
        smallest = chosen[-1]
        room = gap + smallest
        a, b = _best_pair(free, room)
        if a + b <= smallest:
            break
        chosen.pop()
        free[smallest] += 1
        free[a] -= 1
        free[b] -= 1
        chosen = sorted([*chosen, a, b], reverse=True)
        gap = room - a - b
    return chosen


def best_two_fit(counts: dict[int, int], capacity: int) -> Plan:
    """Pack ``counts[length]`` pieces of each length, none longer than ``capacity``.

    A filling that can be repeated with what is left is repeated as often as that
    lasts, so the number of lines depends on the capacity, not on the pieces.
    """
    left = np.zeros(capacity + 1, dtype=np.int64)
    for length, n in counts.items():
        left[length] = n
    used = np.zeros_like(left)
    lines, sequences = [], 0
    while left.any():
        lengths, each = np.unique(_fill(left, capacity), return_counts=True)
        lengths, each = lengths[::-1], each[::-1]
        times = int((left[lengths] // each).min())
        offset = 0
        for length, n in zip(lengths.tolist(), each.tolist(), strict=True):
            lines.append((length, used[length], n, sequences, offset))
            offset += length * n
        used[lengths] += times * each
        left[lengths] -= times * each
        sequences += times
    table = np.array(sorted(lines), dtype=np.int64).reshape(-1, 5)
    return Plan(*table.T, sequences)


def tokenised(
    docs: DataFrame, tokenizer: str, end_id: int, capacity: int, keep_ids: bool = False
) -> DataFrame:
    """The pieces of every document: its ids and the end id, cut only if above ``capacity``.

    Columns doc_id, piece, start, length, ids_crc32 (of the ids as little-endian
    32-bit integers) and, if asked for, ids in that form.
    """

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encoder = word_ids(tokenizer, spaces=False)
        for batch in handing_back(batches):
            for at in range(0, len(batch), SLICE):
                part = batch.iloc[at : at + SLICE]
                rows = []
                encoded = encoder.encode(part["text"], end_id)
                for doc_id, ids in zip(part["doc_id"], encoded, strict=True):
                    for piece, start in enumerate(range(0, len(ids), capacity)):
                        raw = ids[start : start + capacity].tobytes()
                        row = (doc_id, piece, start, len(raw) // 4, zlib.crc32(raw))
                        rows.append((*row, raw) if keep_ids else row)
                out = pd.DataFrame(rows, columns=names)
                out["doc_id"] = out["doc_id"].astype("Int64")
                yield out

    schema = "doc_id long, piece int, start long, length long, ids_crc32 long"
    schema += ", ids binary" if keep_ids else ""
    names = [field.split()[0] for field in schema.split(", ")]
    return docs.select(F.col("doc_id").cast("long"), "text").mapInPandas(cut, schema)


def placed(pieces: DataFrame, plan: Plan) -> DataFrame:
    """Sequence and offset of every piece, given its number ``nth`` among those of its length."""
    shift = 1 << 44
    key = plan.length * shift + plan.first

    def place(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            length, nth = batch["length"].to_numpy(), batch["nth"].to_numpy()
            line = np.searchsorted(key, length * shift + nth, side="right") - 1
            within = nth - plan.first[line]
            sequence = plan.sequence[line] + within // plan.each[line]
            offset = plan.offset[line] + within % plan.each[line] * length
            yield batch.drop(columns="nth").assign(sequence_id=sequence, offset=offset)

    fields = [f"{f.name} {f.dataType.simpleString()}" for f in pieces.schema if f.name != "nth"]
    return pieces.mapInPandas(place, ", ".join([*fields, "sequence_id long", "offset long"]))


def pack(spark: SparkSession, pieces: DataFrame, capacity: int) -> DataFrame:
    """Add sequence_id and offset to a staged table of pieces."""
    ship_code(spark)
    histogram = pieces.groupBy("length").agg(F.count("*").alias("n")).collect()
    counts = {r["length"]: r["n"] for r in histogram}  # at most ``capacity`` lines
    plan = best_two_fit(counts, capacity)
    spread_pieces = pieces.withColumn("_position", spread("doc_id", "piece"))
    ties = ["doc_id", "piece", "start", "ids_crc32"]
    numbered = ranked(spread_pieces, ["length"], "_position", ties, sum(counts.values()), "nth")
    return placed(numbered.drop("_position"), plan)


def pack_documents(
    spark: SparkSession,
    docs: DataFrame,
    tokenizer: str,
    end_id: int = 1,
    capacity: int = 4096,
    keep_ids: bool = False,
) -> DataFrame:
    """Tokenise documents (doc_id, text) and pack them into sequences.

    A null or empty text is the end id alone. Repeated rows are packed each for
    itself; other columns are not read. An empty table gives no rows.
    """
    ship_code(spark)
    pieces = tokenised(docs, tokenizer, end_id, capacity, keep_ids)
    with arrow_rows(spark, HANDED):
        pieces = staged(spark, pieces, "pieces")
    return pack(spark, pieces, capacity)
