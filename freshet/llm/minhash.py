"""Near-duplicate documents by circulant MinHash, banding and exact verification.

All coordinates of a signature come from two permutations of [0, 2^32): the first
scatters the shingles, the second is applied after a circular shift by k for
coordinate k, and the coordinate is the smallest value over the set. Documents that
agree on all rows of a band are candidates; a candidate pair becomes a link only if
the full shingle sets overlap enough.

Candidates are not compared as all pairs of a bucket. First each member is compared with
the smallest of its buckets, then, in buckets that still hold several components, with
a pivot. Then the shingles of the members left are counted: a document whose own
words leave it too few that any other has cannot link and leaves. What remains are
groups alike but not alike enough: small buckets are listed pair by pair, large ones
are joined into families and compared block against block, a matrix product for
two blocks, of which only links leave the task. So every pair of a bucket ends linked,
in one component, or shown to be no link.
"""

from __future__ import annotations

import hashlib
import pickle
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from freshet.llm.components import components
from freshet.llm.shingles import mix, shingle_sets
from freshet.llm.staging import arrow_rows, bucketed, handing_back, ship_code, staged
from freshet.session import scratch_scope

BANDS = 50
ROWS = 5  # of a band: a pair at 0.75 shares none of 50 bands once in 700,000 times
PERCENT = 75  # of the union that the intersection must reach
SLICE = 256  # texts hashed at once
CELLS = 1 << 20  # of shingles times coordinates, permuted at once
SMALL = 32  # members of a bucket whose pairs are listed; larger ones are compared in blocks
BLOCK = 500_000  # shingles of a block, about
BLOCK_SETS = 2000  # sets of a block at most, about
COLUMNS = 2048  # shingles of a block that are compared at once
SETS = 1000  # full sets, or pairs of them, a worker takes at once

_rng = np.random.Generator(np.random.PCG64(71))
_SCATTER = np.uint64(int(_rng.integers(1, 1 << 63)) | 1)
_ROW = _rng.integers(1, 1 << 63, ROWS, dtype=np.uint64) | np.uint64(1)


def _second_permutation(x: np.ndarray) -> np.ndarray:
    """A bijection of 32-bit numbers, in place."""
    x ^= x >> np.uint32(16)
    x *= np.uint32(0x85EBCA6B)
    x ^= x >> np.uint32(13)
    x *= np.uint32(0xC2B2AE35)
    x ^= x >> np.uint32(16)
    return x


def signatures(sets: list[np.ndarray], coordinates: int) -> np.ndarray:
    """One row of coordinates per set; an empty set has the largest value throughout."""
    out = np.full((len(sets), coordinates), 0xFFFFFFFF, dtype=np.uint32)
    sizes = np.array([len(s) for s in sets])
    if not sizes.sum():
        return out
    # The first permutation: sorted hashes of 64 bits fall anywhere in 32.
    scattered = ((np.concatenate(sets) * _SCATTER) >> np.uint64(32)).astype(np.uint32)
    owner = np.repeat(np.arange(len(sets)), sizes)
    shifts = np.arange(coordinates, dtype=np.uint32)
    step = max(1, CELLS // coordinates)
    for at in range(0, len(scattered), step):
        values = _second_permutation(scattered[at : at + step, None] + shifts)
        whose = owner[at : at + step]
        first = np.flatnonzero(np.concatenate([[True], whose[1:] != whose[:-1]]))
        lowest = np.minimum.reduceat(values, first, axis=0)
        out[whose[first]] = np.minimum(out[whose[first]], lowest)
    return out


def band_keys(signature: np.ndarray, rows: int = ROWS) -> np.ndarray:
    """One 64-bit key per band of each signature; bands do not share keys."""
    bands = signature.reshape(len(signature), -1, rows).astype(np.uint64)
    keys = (bands * _ROW[:rows]).sum(axis=2, dtype=np.uint64)
    return mix(keys + np.arange(keys.shape[1], dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))


def signed(docs: DataFrame, bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """Per document: a hash of its text, n_shingles, a digest of the set (null if empty) and its band keys."""

    def sign(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in handing_back(batches):
            for at in range(0, len(batch), SLICE):
                part = batch.iloc[at : at + SLICE]
                sets = shingle_sets(list(part["text"]))
                keys = band_keys(signatures(sets, bands * rows), rows).view(np.int64)
                yield pd.DataFrame(
                    {
                        "doc_id": part["doc_id"].astype("Int64").to_numpy(),
                        "text_hash": part["text_hash"].to_numpy(),
                        "n_shingles": [len(s) for s in sets],
                        "digest": [
                            hashlib.blake2b(s.tobytes(), digest_size=16).digest() if len(s) else None
                            for s in sets
                        ],
                        "bands": list(keys),
                    }
                )

    schema = "doc_id long, text_hash long, n_shingles long, digest binary, bands array<long>"
    told = docs.select(F.col("doc_id").cast("long"), F.xxhash64("text").alias("text_hash"), "text")
    return told.mapInPandas(sign, schema)


def full_sets(texts: DataFrame) -> DataFrame:
    """Columns id and shingles (sorted hashes as bytes) for id, text."""

    def expand(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in handing_back(batches):
            for at in range(0, len(batch), SLICE):
                part = batch.iloc[at : at + SLICE]
                sets = [s.tobytes() for s in shingle_sets(list(part["text"]))]
                yield pd.DataFrame({"id": part["id"], "shingles": sets})

    return texts.mapInPandas(expand, "id long, shingles binary")


def verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose sets' intersection reaches ``percent`` of their union."""

    def check(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in handing_back(batches):
            good = []
            for x, y in zip(batch["x"], batch["y"], strict=True):
                both = np.concatenate([np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)])
                both.sort(kind="stable")
                common = int((both[1:] == both[:-1]).sum())
                good.append(100 * common >= percent * (len(both) - common))
            yield batch.loc[good, ["a", "b"]]

    with_a = pairs.join(sets.select(F.col("id").alias("a"), F.col("shingles").alias("x")), "a")
    with_b = with_a.join(sets.select(F.col("id").alias("b"), F.col("shingles").alias("y")), "b")
    return with_b.select("a", "b", "x", "y").mapInPandas(check, "a long, b long")


def _ordered(pairs: DataFrame, percent: int) -> DataFrame:
    """Distinct pairs a < b that may link, from id, n, shared and the same of the other.

    Two sets of n and m shingles link only if percent / (100 + percent) * (n + m) of them are
    common, and no more can be than either has in common with any document.
    """
    common = F.least("shared", "other_shared")
    return (
        pairs.where(common * (100 + percent) >= (F.col("n") + F.col("other_n")) * percent)
        .select(F.least("id", "other").alias("a"), F.greatest("id", "other").alias("b"))
        .distinct()
    )


def _shared_counts(sets: DataFrame, ids: DataFrame) -> DataFrame:
    """Per id, how many of its shingles some other of the ids has too."""

    def explode(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in handing_back(batches):
            for at in range(0, len(batch), SLICE):
                part = batch.iloc[at : at + SLICE]
                sets = [np.frombuffer(raw, dtype=np.int64) for raw in part["shingles"]]
                owner = np.repeat(part["id"].to_numpy(), [len(s) for s in sets])
                yield pd.DataFrame({"shingle": np.concatenate(sets), "id": owner})

    each = sets.join(ids, "id", "left_semi").mapInPandas(explode, "shingle long, id long")
    alone = each.groupBy("shingle").agg(F.count("*").alias("docs"), F.min("id").alias("id"))
    alone = alone.where("docs = 1").groupBy("id").agg(F.count("*").alias("alone"))
    return ids.join(alone, "id", "left").select("id", F.coalesce("alone", F.lit(0)).alias("alone"))


def _capable(state: DataFrame, percent: int) -> DataFrame:
    """Members that share enough with other documents to link with the smallest of their bucket."""
    least = staged(state.sparkSession, state.groupBy("key").agg(F.min("n").alias("least_n")), "least")
    enough = F.col("shared") * (100 + percent) >= (F.col("n") + F.col("least_n")) * percent
    return state.join(least, "key").where(enough).drop("least_n")


def _open_buckets(state: DataFrame) -> DataFrame:
    """Buckets with members of several components: their size and a pivot."""
    pivot = F.min(F.struct(F.xxhash64("id", F.lit(1)), "id", "n", "shared", "component"))
    return (
        state.groupBy("key")
        .agg(
            F.count("*").alias("size"),
            F.min("component").alias("least"),
            F.max("component").alias("most"),
            pivot.alias("pivot"),
        )
        .where("least <> most")
        .select("key", "size", "pivot")
    )


def _blocks(members: DataFrame) -> DataFrame:
    """Sets of a family, a task's worth at a time: family, block and the pickled sets.

    The block of a set follows from its id; a block has some ``BLOCK`` shingles
    and no more than some ``BLOCK_SETS`` sets.
    """
    blocks = F.greatest(F.ceil(F.sum("n") / BLOCK), F.ceil(F.count("*") / BLOCK_SETS))
    sizes = members.groupBy("family").agg(blocks.alias("blocks"))
    dealt = members.join(sizes, "family").withColumn(
        "block", F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int")
    )

    def gather(part: pd.DataFrame) -> pd.DataFrame:
        part = part.sort_values("id")
        sets = [np.frombuffer(x, dtype=np.uint64) for x in part["shingles"]]
        packed = pickle.dumps((part["id"].to_numpy(), part["component"].to_numpy(), sets))
        return pd.DataFrame(
            {"family": part["family"].iloc[:1], "block": part["block"].iloc[:1], "sets": [packed]}
        )

    schema = "family long, block int, sets binary"
    return dealt.groupBy("family", "block").applyInPandas(gather, schema)


def overlaps(left: list[np.ndarray], right: list[np.ndarray]) -> np.ndarray:
    """Sizes of all intersections, by products of 0/1 matrices, some shingles at a time."""
    shingles = [np.concatenate(side) for side in (left, right)]
    known = np.intersect1d(np.unique(shingles[0]), np.unique(shingles[1]), assume_unique=True)
    cells = []
    for side, joined in zip((left, right), shingles, strict=True):
        owner = np.repeat(np.arange(len(side)), [len(s) for s in side])
        at = np.searchsorted(known, joined)
        at[at == len(known)] = 0
        there = known[at] == joined if len(known) else np.zeros(len(joined), dtype=bool)
        order = np.argsort(at[there], kind="stable")
        cells.append((at[there][order], owner[there][order]))
    out = np.zeros((len(left), len(right)), dtype=np.float32)
    for first in range(0, len(known), COLUMNS):
        parts = []
        for (at, owner), side in zip(cells, (left, right), strict=True):
            lo, hi = np.searchsorted(at, [first, first + COLUMNS])
            part = np.zeros((len(side), COLUMNS), dtype=np.float32)
            part[owner[lo:hi], at[lo:hi] - first] = 1
            parts.append(part)
        out += parts[0] @ parts[1].T
    return out


def _linked_blocks(blocks: DataFrame, percent: int) -> DataFrame:
    """Links between different components of a family, by comparing its blocks in pairs."""

    def compare(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in handing_back(batches):
            for x, y in zip(batch["sets"], batch["other_sets"], strict=True):
                (ids, of, left), (other_ids, other_of, right) = pickle.loads(x), pickle.loads(y)
                overlap, sizes = overlaps(left, right), np.array([len(s) for s in right])
                for k, own in enumerate(left):
                    common = overlap[k].astype(np.int64)
                    good = 100 * common >= percent * (len(own) + sizes - common)
                    partners = other_ids[good & (other_of != of[k])]
                    if len(partners):
                        yield pd.DataFrame({"a": ids[k], "b": partners})

    # Pairs of numbers first, so that a family's pairs of blocks spread over tasks.
    numbers = blocks.select("family", "block")
    pairs = numbers.join(numbers.withColumnRenamed("block", "other_block"), "family")
    others = blocks.select("family", *(F.col(c).alias(f"other_{c}") for c in ("block", "sets")))
    both = pairs.where("block <= other_block").join(blocks, ["family", "block"])
    both = both.join(others, ["family", "other_block"])
    return both.select("sets", "other_sets").mapInPandas(compare, "a long, b long")


def link_components(
    spark: SparkSession, members: DataFrame, sets: DataFrame, percent: int
) -> DataFrame:
    """Components (node, component) of the links between members (key, id, n, lead, lead_n).

    ``members`` holds the buckets with several members, ``lead`` is the smallest.
    """
    links: list[DataFrame] = []

    def linked(pairs: DataFrame) -> None:
        links.append(staged(spark, verified(staged(spark, pairs, "pairs"), sets, percent), "links"))

    def grouped() -> DataFrame:
        return components(spark, reduce(DataFrame.unionByName, links))

    def placed(state: DataFrame) -> DataFrame:
        known = grouped().select(F.col("node").alias("id"), "component")
        joined = state.select("key", "id", "n", "shared").join(known, "id", "left")
        return staged(
            spark, joined.withColumn("component", F.coalesce("component", "id")), "members"
        )

    # Each member with one leader, which settles most copies.
    nearest = members.where("id <> lead").groupBy("id", "n").agg(
        F.min(F.struct("lead", "lead_n")).alias("to")
    )
    nearest = nearest.select(
        "id",
        "n",
        F.col("n").alias("shared"),
        F.col("to.lead").alias("other"),
        F.col("to.lead_n").alias("other_n"),
        F.col("to.lead_n").alias("other_shared"),
    )
    linked(_ordered(nearest, percent))
    # Then with a pivot of each bucket that still has several components.
    state = placed(members.withColumn("shared", F.col("n")))
    buckets = staged(spark, _open_buckets(state).select("key", "pivot"), "open-buckets")
    pivots = [F.col(f"pivot.{c}").alias(o) for c, o in OTHER.items()]
    pairs = state.join(buckets, "key").where(F.col("component") != F.col("pivot.component"))
    linked(_ordered(pairs.select("id", "n", "shared", *pivots), percent))
    # Documents that share too little with any other leave the buckets that are open yet.
    state = placed(state)
    buckets = staged(spark, _open_buckets(state).select("key"), "open-buckets")
    state = staged(spark, state.join(buckets, "key"), "open-members")
    counts = _shared_counts(sets, staged(spark, state.select("id").distinct(), "open-ids"))
    counted = state.drop("shared").join(counts, "id")
    counted = counted.withColumn("shared", F.col("n") - F.col("alone")).drop("alone")
    state = staged(spark, _capable(counted, percent), "capable")
    buckets = staged(spark, _open_buckets(state), "open-buckets")
    # Small buckets: all pairs of different components.
    small = state.join(buckets.where(F.col("size") <= SMALL).select("key"), "key")
    others = small.select("key", F.col("component").alias("other_component"), *_others())
    apart = (F.col("id") < F.col("other")) & (F.col("component") != F.col("other_component"))
    linked(_ordered(small.join(others, "key").where(apart), percent))
    # Large ones, joined into families where they share members: block against block.
    large = buckets.where(F.col("size") > SMALL).select("key", F.col("pivot.id").alias("pivot"))
    in_large = staged(spark, state.join(large, "key").select("id", "n", "component", "pivot"), "large")
    families = components(spark, in_large.select(F.col("id").alias("a"), F.col("pivot").alias("b")))
    families = families.select(F.col("node").alias("id"), F.col("component").alias("family"))
    kin = in_large.select("id", "n", "component").distinct().join(families, "id").join(sets, "id")
    blocks = staged(spark, _blocks(kin), "blocks")
    with arrow_rows(spark, 2):
        links.append(staged(spark, _linked_blocks(blocks, percent), "links"))
    return grouped()


# A member's columns and what they are called for the other of a pair.
OTHER = {"id": "other", "n": "other_n", "shared": "other_shared"}


def _others() -> list[Column]:
    return [F.col(c).alias(o) for c, o in OTHER.items()]


def document_groups(
    spark: SparkSession,
    docs: DataFrame,
    percent: int = PERCENT,
    bands: int = BANDS,
    rows: int = ROWS,
) -> DataFrame:
    """Link documents (doc_id, text) whose shingle sets overlap by ``percent`` of their union.

    Returns doc_id, text_hash (``F.xxhash64`` of the text), n_shingles, component_id (the smallest doc_id reachable by links) and
    kept (doc_id = component_id). Texts without words, null ones too, are linked with
    nothing. Equal sets are one node, however many copies there are. Rows that share a
    doc_id but not a text follow their own texts. A row without doc_id takes no part: its
    component is null and it is kept. Other columns are not read; an empty table gives no
    rows.
    """
    ship_code(spark)
    with arrow_rows(spark, SETS):
        hashed = staged(spark, signed(docs, bands, rows), "signatures")
    linkable = hashed.where("doc_id is not null and digest is not null")
    # One representative per set, the smallest id; copies are counted out before the shuffle.
    # What is joined to a hot key is staged first, as Spark only splits joins of bare shuffles.
    classes = staged(spark, linkable.groupBy("digest").agg(F.min("doc_id").alias("id")), "classes")
    classed = linkable.select("doc_id", "text_hash", "n_shingles", "digest").join(classes, "digest")
    classed = staged(spark, classed.select("doc_id", "text_hash", "n_shingles", "id", "digest"), "classes")
    # All that the search writes goes when it is over, but for the components.
    with scratch_scope(spark) as keep_last, arrow_rows(spark, SETS):
        leaders = classed.where("doc_id = id").select("id", "digest").distinct()
        own = linkable.select(
            F.col("doc_id").alias("id"), "digest", F.col("n_shingles").alias("n"), "bands"
        )
        keyed = own.join(leaders, ["id", "digest"], "left_semi").select(
            "id", "n", F.explode("bands").alias("key")
        )
        keyed = staged(spark, keyed, "bands")
        shared = (
            keyed.groupBy("key")
            .agg(F.count("*").alias("size"), F.min(F.struct("id", "n")).alias("lead"))
            .where("size > 1")
            .select("key", F.col("lead.id").alias("lead"), F.col("lead.n").alias("lead_n"))
        )
        members = staged(spark, keyed.join(staged(spark, shared, "shared"), "key"), "members")
        candidates = members.select("id").distinct()
        texts = docs.select(F.col("doc_id").cast("long").alias("id"), "text").join(candidates, "id")
        sets, table = bucketed(spark, full_sets(texts), "id", "sets")
        groups = staged(spark, link_components(spark, members, sets, percent), "groups")
        keep_last()
        spark.sql(f"drop table {table}")
    found = classed.join(groups.withColumnRenamed("node", "id"), "id", "left").select(
        "doc_id", "text_hash", "n_shingles", F.coalesce("component", "id").alias("component_id")
    )
    alone = hashed.where("doc_id is null or digest is null").select(
        "doc_id", "text_hash", "n_shingles", F.col("doc_id").alias("component_id")
    )
    kept = F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True))
    return found.unionByName(alone).withColumn("kept", kept)


def near_duplicates(
    spark: SparkSession,
    docs: DataFrame,
    percent: int = PERCENT,
    bands: int = BANDS,
    rows: int = ROWS,
) -> DataFrame:
    """The rows of ``document_groups`` without the hash of the text."""
    return document_groups(spark, docs, percent, bands, rows).drop("text_hash")
