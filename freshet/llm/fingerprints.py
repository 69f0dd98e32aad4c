"""Document fingerprints: a quartile bucket digest of hashed byte triplets.

A window of five bytes slides over the text; each position counts triplets of its
bytes into 128 buckets. The digest says for every bucket in which quarter of the
counts it lies, and carries the length on a logarithmic scale and a checksum of the
quartiles' spread. Two digests are compared by a sum of bounded steps, so texts
that share most of their bytes, wherever they lie, have close digests.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from freshet.llm.staging import ship_code, staged

BUCKETS = 128
#: Places, within five bytes, of the second and third byte of each counted triplet.
TRIPLETS = ((1, 2), (1, 3), (2, 3), (1, 4), (2, 4), (3, 4))
#: Odd multipliers that hash a triplet's bytes.
MIX = (0x9E3779B1, 0x85EBCA6B, 0xC2B2AE35)
LENGTH_STEP = math.log(1.3)
#: Steps of a bucket by the distance of its quarters; the last counts double.
STEPS = np.array([0, 1, 2, 6])
#: A difference at and above which two texts have nothing in common.
FARTHEST = 300
HALF_BYTES = 1 << 22  # of a text hashed at once
SCHEMA = (
    "doc_id long, n_chars long, edited_sha256 string, fingerprint string, "
    "edited_fingerprint string, near_edited double, near_next double"
)


def bucket_counts(raw: bytes) -> np.ndarray:
    """Counts of hashed byte triplets in each bucket."""
    counts = np.zeros(BUCKETS, dtype=np.int64)
    for at in range(0, max(1, len(raw)), HALF_BYTES):
        part = np.frombuffer(raw[at : at + HALF_BYTES + 4], dtype=np.uint8).astype(np.uint32)
        n = len(part) - 4
        if n <= 0:
            break
        first, *others = (part * np.uint32(m) for m in MIX)
        for salt, (b, c) in enumerate(TRIPLETS):
            mixed = first[:n] + others[0][b : b + n] + others[1][c : c + n]
            mixed ^= mixed >> np.uint32(15)
            mixed *= np.uint32(MIX[salt % 3] + 2 * salt)
            counts += np.bincount(mixed >> np.uint32(25), minlength=BUCKETS)
    return counts


def digest(raw: bytes) -> np.ndarray:
    """Length and spread codes, then the quarter (0 to 3) of each bucket's count."""
    counts = bucket_counts(raw)
    low, mid, high = np.sort(counts)[[BUCKETS // 4 - 1, BUCKETS // 2 - 1, 3 * BUCKETS // 4 - 1]]
    quarters = (counts > low).astype(np.uint8) + (counts > mid) + (counts > high)
    length = min(255, int(math.log(len(raw)) / LENGTH_STEP) + 1) if raw else 0
    spread = (int(low * 100 // high) % 16 << 4 | int(mid * 100 // high) % 16) if high else 0
    return np.concatenate([np.array([length, spread], dtype=np.uint8), quarters.astype(np.uint8)])


def to_text(code: np.ndarray) -> str:
    """A digest as hexadecimal digits: length, spread, then four buckets to a byte."""
    quads = code[2:].reshape(-1, 4)
    packed = quads[:, 0] | quads[:, 1] << 2 | quads[:, 2] << 4 | quads[:, 3] << 6
    return (code[:2].tobytes() + packed.tobytes()).hex()


def from_text(text: str) -> np.ndarray:
    raw = np.frombuffer(bytes.fromhex(text), dtype=np.uint8)
    quads = np.stack([raw[2:] >> 2 * k & 3 for k in range(4)], axis=1)
    return np.concatenate([raw[:2], quads.reshape(-1)])


def difference(a: np.ndarray, b: np.ndarray) -> int:
    """Bounded steps between two digests: 0 for equal ones."""

    def around(x: int, y: int) -> int:
        step = abs(x - y)
        return min(step, 16 - step)

    length = abs(int(a[0]) - int(b[0]))
    total = min(length, 12) if length <= 1 else min(12 * length, 60)
    for shift in (4, 0):
        step = around(int(a[1]) >> shift & 15, int(b[1]) >> shift & 15)
        total += step if step <= 1 else min(2 * step, 12)
    apart = np.abs(a[2:].astype(np.int16) - b[2:].astype(np.int16))
    return total + int(STEPS[apart].sum())


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    """1 for equal digests, falling evenly to 0 at the farthest difference."""
    return max(0.0, 1.0 - difference(a, b) / FARTHEST)


def edited(text: str, following: str) -> str:
    """The last half of a text replaced by as much of the beginning of the next."""
    half = len(text) // 2
    return text[: len(text) - half] + following[:half]


def _compared(doc_id, text: str, following: str, code: np.ndarray, next_code: np.ndarray) -> tuple:
    changed = edited(text, following).encode()
    changed_code = digest(changed)
    return (
        doc_id,
        len(text),
        hashlib.sha256(changed).hexdigest(),
        to_text(code),
        to_text(changed_code),
        likeness(code, changed_code),
        likeness(code, next_code),
    )


def _frame(rows: list[tuple], names: list[str]) -> pd.DataFrame:
    return pd.DataFrame(rows, columns=names).astype({"doc_id": "Int64"})


def fingerprint_documents(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """Fingerprints of all documents and of their edited texts (see ``edited``).

    The next document is the one below in descending order of doc_id, null ids
    last; after the last comes the first. Rows that share an id are ordered by text.
    Null texts count as empty; a single document is its own next. Texts under five
    bytes have the digest of an empty count. Other columns are not read.

    The rows are dealt out by ranges of doc_id once. A task knows the next document of
    each of its rows but the last; it leaves that one and its first row open, and the
    open rows, two per task, are matched afterwards.
    """
    names = [field.split()[0] for field in SCHEMA.split(", ")]
    open_names = [*names, "part", "place", "text"]
    nothing = (None,) * (len(names) - 1)

    def compare(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        part, held = TaskContext.get().partitionId(), None
        for batch in batches:
            rows = []
            for doc_id, text in zip(batch["doc_id"], batch["text"], strict=True):
                code = digest(text.encode())
                if held is None:
                    rows.append((doc_id, *nothing, part, "first", text))
                else:
                    rows.append((*_compared(*held[:2], text, held[2], code), part, "done", None))
                held = (doc_id, text, code)
            yield _frame(rows, open_names)
        if held is not None:
            yield _frame([(held[0], *nothing, part, "last", held[1])], open_names)

    def close(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for doc_id, text, following in zip(
                batch["doc_id"], batch["text"], batch["following"], strict=True
            ):
                codes = digest(text.encode()), digest(following.encode())
                rows.append(_compared(doc_id, text, following, *codes))
            yield _frame(rows, names)

    ship_code(spark)
    rows = docs.select(
        F.col("doc_id").cast("long"), F.coalesce("text", F.lit("")).alias("text")
    )
    down = F.col("doc_id").desc_nulls_last()
    ordered = rows.repartitionByRange(down).sortWithinPartitions(down, "text")
    schema = SCHEMA + ", part int, place string, text string"
    matched = staged(spark, ordered.mapInPandas(compare, schema), "fingerprints")
    # One line per task: which task's first document follows its last.
    parts = matched.where("place = 'first'").select("part")
    everything, onward = Window.orderBy(F.lit(1)), Window.orderBy("part")
    follows = parts.select(
        "part",
        F.coalesce(F.lead("part").over(onward), F.min("part").over(everything)).alias("next_part"),
    )
    heads = matched.where("place = 'first'").select(
        F.col("part").alias("next_part"), F.col("text").alias("following")
    )
    tails = matched.where("place = 'last'").select("part", "doc_id", "text")
    pairs = tails.join(follows, "part").join(heads, "next_part")
    closed = pairs.select("doc_id", "text", "following").mapInPandas(close, SCHEMA)
    return matched.where("place = 'done'").select(*names).unionByName(closed)
