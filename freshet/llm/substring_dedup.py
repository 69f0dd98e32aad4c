"""Repeated passages by content-defined cuts with a gear rolling hash.

A text is cut after the word whose gear hash, of the last 16 bytes, is the least among 20
words in a row. A cut depends on the bytes near it alone, not on the cut before. The 20
words up to a cut are compared by a 128-bit digest; where they occur elsewhere too, the
match is extended word by word to both sides on the texts themselves.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Iterable, Iterator
from contextlib import contextmanager
from itertools import groupby

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from freshet.llm.staging import ship_code, staged
from freshet.session import scratch_scope

WINDOW = 16  # bytes the rolling hash sees, one bit of shift each
CUT_BITS = 5  # zeros that make a cut where there are no words: one byte in 32
LONG_WORD = 64  # bytes without a space, after which cuts need no word end
LEAST, MOST = 1, 512  # bytes of a chunk; a least size would tie a cut to the one before
LEAST_WORDS = 20  # of a repeated passage
AMONG = 20  # words, the least hash of which makes a cut
SLICE = 20_000  # rows handed on at once
TOGETHER = 1 << 17  # bytes of neighbouring texts that are cut at once, or one longer text
LAST_BITS = 40
LAST = (1 << LAST_BITS) - 1  # place of a word, counted down

GEAR = np.random.Generator(np.random.PCG64(606)).integers(0, 1 << WINDOW, 256, dtype=np.uint16)
GAP = b" " * WINDOW
SPACE = np.isin(np.arange(256), list(b" \t\n\r\x0b\x0c"))  # what bytes.split() takes


def gear_hashes(codes: np.ndarray, fresh: np.ndarray | None = None) -> np.ndarray:
    """The gear hash at every byte. It shifts by a bit a byte: 16 bits see 16 bytes.

    Bytes that are ``fresh`` count as none.
    """
    rolled = GEAR[codes]
    if fresh is not None:
        rolled[fresh] = 0
    seen = 1
    while seen < min(WINDOW, len(rolled)):  # each turn adds as many bytes as were seen
        earlier = rolled[:-seen] << np.uint16(seen)
        rolled[seen:] += earlier
        seen *= 2
    return rolled


def words_of(codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the words in bytes."""
    word = np.concatenate([[False], ~SPACE[codes], [False]])
    turns = np.flatnonzero(word[1:] != word[:-1])
    return turns[::2], turns[1::2]


def marked(hashes: np.ndarray, text: np.ndarray | None = None) -> np.ndarray:
    """Words that hold the least hash, the last of equals, among ``AMONG`` in a row.

    ``text`` has the number of each word's text; words of several are not in a row.
    """
    if len(hashes) < AMONG:
        return np.empty(0, dtype=np.int64)
    # The least hash and, of equals, the last place, in one number.
    least = hashes.astype(np.uint64) << np.uint64(LAST_BITS)
    least |= np.arange(LAST, LAST - len(hashes), -1).astype(np.uint64)
    seen = 1
    while seen < AMONG:  # each turn looks at as many words as were seen, or those that lack
        step = min(seen, AMONG - seen)
        least = np.minimum(least[:-step], least[step:])
        seen += step
    if text is not None:
        least = least[text[: len(least)] == text[AMONG - 1 :]]
    held = np.zeros(len(hashes), dtype=bool)
    held[LAST - (least & np.uint64(LAST)).astype(np.int64)] = True
    return np.flatnonzero(held)


def cut_points(raw: bytes) -> list[int]:
    """Ends of the chunks: after marked words, or by the hash where words are very long."""
    codes = np.frombuffer(raw, dtype=np.uint8)
    hashes, (starts, ends) = gear_hashes(codes), words_of(codes)
    cuts = [ends[marked(hashes[ends - 1])]]
    for start, end in zip(*(side[ends - starts > LONG_WORD] for side in (starts, ends)), strict=True):
        inside = hashes[start + LONG_WORD : end] >> np.uint16(WINDOW - CUT_BITS) == 0
        cuts.append(np.flatnonzero(inside) + start + LONG_WORD + 1)
    points, last = [], 0
    for at in [*np.unique(np.concatenate(cuts)).tolist(), len(raw)]:
        while at - last > MOST:
            last += MOST
            points.append(last)
        if at > last:
            points.append(at)
            last = at
    return points


Words = tuple[bytes, np.ndarray, np.ndarray, np.ndarray]


def anchors(texts: Iterable[str | None]) -> Iterator[Words]:
    """Per text: its bytes, starts and ends of all words, and the words at which 20 words are looked up.

    These are the marked words and the text's last word. Neighbouring texts are cut in one go.
    """
    raws: list[bytes] = []
    size = 0
    for text in texts:
        raw = (text or "").encode()
        size += len(raw) + WINDOW
        if raws and size > TOGETHER:
            yield from _anchors(raws)
            raws, size = [], len(raw) + WINDOW
        raws.append(raw)
    if raws:
        yield from _anchors(raws)


def _anchors(raws: list[bytes]) -> Iterator[Words]:
    # Between texts, as many spaces as the hash sees, which count as no bytes.
    codes = np.frombuffer(GAP.join([b"", *raws]), dtype=np.uint8)
    sizes = np.array([len(raw) + WINDOW for raw in raws])
    after = np.cumsum(sizes)
    begins = after - sizes
    fresh = (begins[:, None] + np.arange(WINDOW)).ravel()
    starts, ends = words_of(codes)
    bounds = np.searchsorted(starts, after).tolist()  # of the words of each text
    counts = np.diff([0, *bounds])
    hashes = gear_hashes(codes, fresh)[ends - 1] if len(ends) else np.empty(0, dtype=np.uint16)
    text = np.repeat(np.arange(len(raws)), counts)
    looked_up = np.zeros(len(ends), dtype=bool)
    looked_up[marked(hashes, text)] = True
    last = np.array(bounds)[counts >= LEAST_WORDS] - 1
    looked_up[last] = True
    found = np.flatnonzero(looked_up)
    # Only words with 19 before them in their text.
    found = found[found - np.repeat(np.cumsum(counts) - counts, counts)[found] >= LEAST_WORDS - 1]
    parts = np.searchsorted(found, bounds).tolist()
    shift = np.repeat(begins + WINDOW, counts)
    starts, ends = starts - shift, ends - shift
    low = first = 0
    for raw, high, upto in zip(raws, bounds, parts, strict=True):
        yield raw, starts[low:high], ends[low:high], found[first:upto] - low
        low, first = high, upto


def digests(raw: bytes, starts: np.ndarray, ends: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Two 64-bit numbers for the 20 words up to each of the words ``at``."""
    spans = zip(starts[at - LEAST_WORDS + 1].tolist(), ends[at].tolist(), strict=True)
    joined = b"".join([hashlib.blake2b(raw[a:b], digest_size=16).digest() for a, b in spans])
    return np.frombuffer(joined, dtype=np.int64).reshape(-1, 2)


def places(docs: DataFrame) -> DataFrame:
    """Every anchor of every text: doc_id, and d1, the first half of its digest."""

    def look(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            ids, found, many = [], [], 0
            for k, (raw, starts, ends, at) in enumerate(anchors(batch["text"])):
                if len(at):
                    ids.append(np.full(len(at), k))
                    found.append(digests(raw, starts, ends, at)[:, 0])
                    many += len(at)
                if many > SLICE or (many and k == len(batch) - 1):
                    doc_ids = batch["doc_id"].astype("Int64").iloc[np.concatenate(ids)]
                    yield pd.DataFrame({"doc_id": doc_ids.array, "d1": np.concatenate(found)})
                    ids, found, many = [], [], 0

    return docs.select(F.col("doc_id").cast("long"), "text").mapInPandas(
        look, "doc_id long, d1 long"
    )


def surroundings(docs: DataFrame) -> DataFrame:
    """The anchors among ``met`` (values of d1) of every text, with the words around them.

    ``before`` and ``after`` hold the bytes of 19 words on either side: a passage that reaches
    further has another cut there. Near its ends a copy may have cuts the other lacks, so
    contexts do not stop at cuts. ``word`` is the number of the last word.
    """
    names = ["d1", "d2", "doc_id", "start", "end", "word", "before", "after"]
    reach = AMONG - 1

    def look(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rows: list[tuple] = []
        for batch in batches:
            found = zip(batch["doc_id"], batch["met"], anchors(batch["text"]), strict=True)
            for doc_id, met, (raw, starts, ends, at) in found:
                both = digests(raw, starts, ends, at)
                kept = np.isin(both[:, 0], met)
                at, first = at[kept], at[kept] - LEAST_WORDS + 1
                bounds = (
                    starts[np.maximum(first - reach, 0)],
                    starts[first],
                    ends[at],
                    ends[np.minimum(at + reach, len(ends) - 1)],
                )
                columns = (x.tolist() for x in (*both[kept].T, at, *bounds))
                for d1, d2, word, left, start, end, right in zip(*columns, strict=True):
                    rows.append((d1, d2, doc_id, start, end, word, raw[left:start], raw[end:right]))
                if len(rows) > SLICE:
                    yield pd.DataFrame(rows, columns=names).astype({"doc_id": "Int64"})
                    rows = []
        yield pd.DataFrame(rows, columns=names).astype({"doc_id": "Int64"})

    schema = (
        "d1 long, d2 long, doc_id long, start long, end long, word long,"
        " before binary, after binary"
    )
    return docs.mapInPandas(look, schema)


def steps(context: bytes, side: int) -> list[bytes]:
    """The words of a context with the space towards the anchor, from the anchor on."""
    return re.findall(rb"\S+\s*", context)[::-1] if side == 0 else re.findall(rb"\s*\S+", context)


def extended(contexts: DataFrame) -> DataFrame:
    """How far each context of an anchor agrees with another one, and with an earlier one.

    Takes d1, d2, side, hash, context, the first place that has it, and whether others do.
    Contexts that differ in the next word never agree, so that word is part of the key they
    are dealt by.
    """
    keys = ["d1", "d2", "side", "near"]
    names = [
        *("d1", "d2", "side", "hash", "doc", "at", "whole"),
        *("any_bytes", "any_words", "early_bytes"),
    ]

    def near(texts: pd.Series, sides: pd.Series) -> pd.Series:
        words = (re.search(rb"\s*\S+" if s else rb"\S+\s*$", x) for x, s in zip(texts, sides, strict=True))
        return pd.Series([word.group() if word else b"" for word in words])

    def compare(group: list[tuple]) -> Iterator[tuple]:
        if len(group) == 1:
            d1, d2, side, _, number, context, place, copied = group[0]
            far = (len(context), len(steps(context, side))) if copied else (0, 0)
            yield d1, d2, side, number, place, place[2], len(context), *far, 0
            return
        side, seen, counts, walks = group[0][2], {}, {}, []
        for *_, context, _, _ in group:
            path = b""
            walks.append([path := (path + x if side else x + path) for x in steps(context, side)])
        for (*_, place, _), walk in zip(group, walks, strict=True):
            for path in walk:
                counts[path] = counts.get(path, 0) + 1
                seen[path] = min(seen.get(path, place), place)
        for (d1, d2, _, _, number, context, place, copied), walk in zip(group, walks, strict=True):
            any_words = len(walk) if copied else sum(counts[x] > 1 for x in walk)
            early = sum(seen[x] < place for x in walk)
            far = [len(walk[n - 1]) if n else 0 for n in (any_words, early)]
            yield d1, d2, side, number, place, place[2], len(context), far[0], any_words, far[1]

    def rows(batches: Iterator[pd.DataFrame]) -> Iterator[tuple]:
        for batch in batches:
            place = [
                (a is not pd.NA, 0 if a is pd.NA else a, b)
                for a, b in zip(batch["doc"].astype("Int64"), batch["at"], strict=True)
            ]
            columns = [batch[c] for c in (*keys, "hash", "context")]
            yield from zip(*columns, place, batch["copied"], strict=True)

    def frame(out: list[tuple]) -> pd.DataFrame:
        found = pd.DataFrame(out, columns=names)
        # A place is (has an id, id or 0, position): ids that are null come first.
        return found.assign(doc=[x[1] if x[0] else None for x in found["doc"]]).astype({"doc": "Int64"})

    def agree(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        out: list[tuple] = []
        for _, group in groupby(rows(batches), key=lambda row: row[:4]):
            out += compare(list(group))
            if len(out) > SLICE:
                yield frame(out)
                out = []
        yield frame(out)

    dealt = contexts.select(
        "d1",
        "d2",
        "side",
        F.pandas_udf(near, "binary")("context", "side").alias("near"),
        "hash",
        "context",
        F.col("first.doc_id").alias("doc"),
        F.col("first.end").alias("at"),
        "copied",
    )
    schema = (
        "d1 long, d2 long, side int, hash long, doc long, at long, whole long,"
        " any_bytes long, any_words long, early_bytes long"
    )
    return dealt.repartition(*keys).sortWithinPartitions(*keys).mapInPandas(agree, schema)


@contextmanager
def shuffles_dropped(spark: SparkSession) -> Iterator[None]:
    """Within, Spark deletes the shuffle files of every written table once it is written."""
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(key)
    spark.conf.set(key, "true")
    try:
        yield
    finally:
        spark.conf.set(key, before)


def spans(spark: SparkSession, docs: DataFrame, keep_last: Callable[[], None]) -> DataFrame:
    """Spans of at least 20 words that occur at several places, overlapping ones among them.

    Columns doc_id, side, end_mark, from_byte, to_byte, from_word, to_word, and early_from and
    early_to: the part that an earlier place (by doc_id, then position) has too, or null.
    """
    with scratch_scope(spark) as keep_around:  # the places go before the next steps
        found = staged(spark, places(docs), "places", "zstd")
        # Half a digest counted by rows lets a few through that have one place; they go below.
        # Staged, so that the join has shuffles of its own: a very common digest is split there.
        repeated = found.groupBy("d1").count().where("count > 1").select("d1")
        repeated = staged(spark, repeated, "repeated", "zstd")
        met = found.join(repeated, "d1").groupBy("doc_id").agg(F.collect_set("d1").alias("met"))
        met = met.withColumnRenamed("doc_id", "met_id")
        texts = docs.select(F.col("doc_id").cast("long"), "text")
        texts = texts.join(met, F.col("doc_id").eqNullSafe(F.col("met_id"))).drop("met_id")
        around = staged(spark, surroundings(texts), "surroundings", "zstd")
        keep_around()
    place, key = F.struct("doc_id", "end"), ["d1", "d2", "side", "hash"]
    contexts = F.array(
        F.struct(F.lit(0).alias("side"), F.col("before").alias("context")),
        F.struct(F.lit(1).alias("side"), F.col("after").alias("context")),
        F.struct(F.lit(2).alias("side"), F.lit(b"").alias("context")),
    )
    sides = around.select("d1", "d2", "doc_id", "start", "end", "word", F.inline(contexts))
    sides = sides.where("side = 2 or length(context) > 0").withColumn("hash", F.xxhash64("context"))
    known = sides.groupBy(*key).agg(
        F.min(place).alias("first"),
        (~F.min(place).eqNullSafe(F.max(place))).alias("copied"),
        F.max("context").alias("context"),
    )
    known = staged(spark, known, "contexts", "zstd")
    zero = F.lit(0).cast("long")
    alone = known.where("side = 2 and copied").select(
        *key,
        F.col("first.doc_id").alias("doc"),
        F.col("first.end").alias("at"),
        *(zero.alias(c) for c in ("whole", "any_bytes", "any_words", "early_bytes")),
    )
    known = alone.unionByName(extended(known.where("side < 2")).where("any_bytes > 0"))
    met = sides.drop("context").join(known, key)
    met = met.withColumn("is_first", place.eqNullSafe(F.struct("doc", "at")))
    early = F.when(F.col("is_first"), F.col("early_bytes")).otherwise(F.col("whole"))
    dropped = (early > 0) | ((F.col("side") == 2) & ~F.col("is_first"))
    back, on = F.col("side") == 0, F.col("side") == 1

    def moved(column: str, by: Column, where: Column) -> Column:
        return F.col(column) + F.when(where, by).otherwise(0)

    met = met.select(
        "doc_id",
        "side",
        F.col("end").alias("end_mark"),
        moved("start", -F.col("any_bytes"), back).alias("from_byte"),
        moved("end", F.col("any_bytes"), on).alias("to_byte"),
        (moved("word", -F.col("any_words"), back) - (LEAST_WORDS - 1)).alias("from_word"),
        moved("word", F.col("any_words"), on).alias("to_word"),
        F.when(dropped, moved("start", -early, back)).alias("early_from"),
        F.when(dropped, moved("end", early, on)).alias("early_to"),
    )
    met = staged(spark, met, "spans", "zstd")
    keep_last()
    return met


def repeated_passages(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """Passages of ``docs`` (doc_id, text) that occur at several places.

    Returns doc_id, start and end in UTF-8 bytes, n_words, n_chunks, and dropped_bytes: the
    bytes of it that an earlier place (by doc_id, then position) has too. A passage is a run
    of whole words any 20 of which, or more, occur elsewhere byte for byte; spans that
    overlap are one passage. Every passage of 39 words is found, to its ends: 20 words in a
    row end 20 words of it, so that one of them is a cut at both places. Shorter ones, of 20
    to 38 words, are found where a cut falls on their last words. n_chunks counts the cuts
    with 20 repeated words before them. Null and empty texts have none. Rows repeated with
    one doc_id count as one place. Copies are counted before the shuffle; other columns are
    not read; an empty table gives no rows.
    """
    ship_code(spark)
    order = Window.partitionBy("doc_id").orderBy("from_byte", "to_byte")
    reach = F.max("to_byte").over(order.rowsBetween(Window.unboundedPreceding, -1))
    begins = F.coalesce(reach <= F.col("from_byte"), F.lit(True)).cast("long")
    # All that the search writes goes when it is over, but for the spans.
    with shuffles_dropped(spark), scratch_scope(spark) as keep_last:
        found = spans(spark, docs, keep_last)
    runs = found.withColumn("begins", begins)
    runs = runs.withColumn("run", F.sum("begins").over(order.rowsBetween(Window.unboundedPreceding, 0)))
    early = Window.partitionBy("doc_id", "run").orderBy("early_from", "early_to")
    done = F.max("early_to").over(early.rowsBetween(Window.unboundedPreceding, -1))
    fresh = F.col("early_to") - F.greatest("early_from", done)  # greatest() skips nulls
    return (
        runs.withColumn("fresh", F.greatest(fresh, F.lit(0)))
        .groupBy("doc_id", "run")
        .agg(
            F.min("from_byte").alias("start"),
            F.max("to_byte").alias("end"),
            (F.max("to_word") - F.min("from_word") + 1).alias("n_words"),
            F.count_distinct(F.when(F.col("side") == 2, F.col("end_mark"))).alias("n_chunks"),
            F.coalesce(F.sum("fresh"), F.lit(0)).alias("dropped_bytes"),
        )
        .drop("run")
    )
