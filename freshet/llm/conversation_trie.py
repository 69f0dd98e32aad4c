"""The prefix trie of conversations, by collapsing whole sequences.

A node of the trie is a distinct sequence of first turns. Conversations are never held
as one value: each is a set of rows (conversation, depth, key of the prefix that ends
here), so that one of any length spreads over tasks. A prefix key is the exclusive or of
two 64-bit hashes of (depth, MD5 of role and text) over its turns, which can be taken
block by block.

1. Conversations with equal last keys are one weighted sequence, with the list of those
   that end there; it goes by its smallest conversation.
2. A sequence that is a proper prefix of another is no leaf (anti-join on its key).
3. The smallest sequence through a node owns it. A sequence owns the nodes of its path
   from one depth on, so that a sum over the distinct nodes of a subtree becomes a sum
   over the weighted sequences through its top, one group-by over their prefixes.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from freshet.llm.staging import staged

HEADS = 9  # a rebuilt conversation takes fewer turns than this from another
FAMILY = 5  # conversations that share the first turns of one

KEY = ["depth", "k1", "k2"]


def _turns(conversations: DataFrame) -> DataFrame:
    """Narrow rows: what orders a turn, what tells it apart, how many bytes its text has."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    told = F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text)
    return conversations.where("conv_id is not null").select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.col("turn").cast("long").alias("turn"),
        F.unhex(F.md5(told)).alias("digest"),
        F.octet_length(text).cast("long").alias("bytes"),
    )


def _taken(conv_id: Column) -> Column:
    """Turns that a conversation takes from the first of its family, if that has as many."""
    return F.crc32(conv_id.cast("string")) % HEADS


def rebuilt_turns(spark: SparkSession, conversations: DataFrame) -> DataFrame:
    """Rows conv_id, length, part, depth, digest, bytes of all rebuilt conversations.

    Conversation c becomes the first turns of conversation c - c % 5, as many as
    crc32(c) % 9 says or there are, then its own turns after as many. A conversation
    without any turn has one row, at depth 0. ``part`` numbers stretches of a
    conversation in their order; no stretch is larger than a partition.
    """
    rows = staged(spark, _turns(conversations), "turns")
    order = [F.col("turn").asc_nulls_first(), F.col("digest")]
    dealt = rows.repartitionByRange("conv_id", *order).withColumn("part", F.spark_partition_id())
    rows = staged(spark, dealt, "turns")
    # Stretches of a conversation: rows before each, and turns of the whole.
    of_one = Window.partitionBy("conv_id")
    earlier = of_one.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    stretches = (
        rows.groupBy("conv_id", "part")
        .agg(F.count("*").alias("_rows"))
        .withColumn("_start", F.coalesce(F.sum("_rows").over(earlier), F.lit(0)))
        .withColumn("_turns", F.sum("_rows").over(of_one))
        .drop("_rows")
    )
    stretches = staged(spark, stretches, "stretches")
    sizes = stretches.where("_start = 0").select("conv_id", "_turns")
    first = sizes.select(F.col("conv_id").alias("_first"), F.col("_turns").alias("_there"))
    wanted = sizes.select(
        "conv_id",
        _taken(F.col("conv_id")).alias("_skip"),
        (F.col("conv_id") - F.col("conv_id") % FAMILY).alias("_first"),
        "_turns",
    )
    heads = F.least("_skip", F.coalesce("_there", F.lit(0)))
    own = F.greatest(F.col("_turns") - F.col("_skip"), F.lit(0))
    families = wanted.join(first, "_first", "left").select(
        "conv_id", "_skip", "_first", heads.alias("_heads"), (heads + own).alias("length")
    )
    families = staged(spark, families, "families")
    within = Window.partitionBy("conv_id", "part").orderBy(*order)
    placed = (
        rows.withColumn("_nth", F.row_number().over(within))
        .join(stretches.select("conv_id", "part", "_start"), ["conv_id", "part"])
        .withColumn("_nth", F.col("_nth") + F.col("_start"))
        .drop("_start", "turn")
    )
    placed = staged(spark, placed, "placed-turns")
    kept = placed.join(families, "conv_id").where("_nth > _skip").select(
        "conv_id",
        "length",
        "part",
        (F.col("_nth") - F.col("_skip") + F.col("_heads")).alias("depth"),
        "digest",
        "bytes",
    )
    lent = (
        placed.where(F.col("_nth") < HEADS)
        .select(F.col("conv_id").alias("_first"), "_nth", "digest", "bytes")
        .join(families, "_first")
        .where("_nth <= _heads")
        .select("conv_id", "length", F.lit(-1).alias("part"), F.col("_nth").alias("depth"), "digest", "bytes")
    )
    bare = families.where("length = 0").select(
        "conv_id",
        "length",
        F.lit(-1).alias("part"),
        F.lit(0).alias("depth"),
        F.lit(None).cast("binary").alias("digest"),
        F.lit(0).alias("bytes"),
    )
    return kept.unionByName(lent).unionByName(bare)


def prefix_keys(spark: SparkSession, turns: DataFrame) -> DataFrame:
    """Rows conv_id, length, depth, k1, k2, before, bytes: one per conversation and prefix.

    ``before`` counts the bytes of the texts before the last. The prefix without turns
    (depth 0) is left out, but for conversations that have no other.
    """
    none = F.lit(0).cast("long")
    told = turns.select(
        "conv_id",
        "length",
        "part",
        F.col("depth").cast("long").alias("depth"),
        F.when(F.col("depth") > 0, F.xxhash64("depth", "digest")).otherwise(none).alias("k1"),
        F.when(F.col("depth") > 0, F.xxhash64("digest", "depth")).otherwise(none).alias("k2"),
        F.col("bytes").cast("long").alias("bytes"),
    )
    told = staged(spark, told, "rebuilt-turns")
    stretch = Window.partitionBy("conv_id", "part").orderBy("depth")
    upto = stretch.rowsBetween(Window.unboundedPreceding, 0)
    earlier = Window.partitionBy("conv_id").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    totals = told.groupBy("conv_id", "part").agg(
        F.bit_xor("k1").alias("_k1"), F.bit_xor("k2").alias("_k2"), F.sum("bytes").alias("_bytes")
    )
    sums = totals.select(
        "conv_id",
        "part",
        F.coalesce(F.bit_xor("_k1").over(earlier), none).alias("_k1"),
        F.coalesce(F.bit_xor("_k2").over(earlier), none).alias("_k2"),
        F.coalesce(F.sum("_bytes").over(earlier), none).alias("_bytes"),
    )
    running = told.select(
        "conv_id",
        "length",
        "part",
        "depth",
        F.bit_xor("k1").over(upto).alias("k1"),
        F.bit_xor("k2").over(upto).alias("k2"),
        (F.sum("bytes").over(upto) - F.col("bytes")).alias("before"),
        "bytes",
    )
    return running.join(sums, ["conv_id", "part"]).select(
        "conv_id",
        "length",
        "depth",
        F.col("k1").bitwiseXOR(F.col("_k1")).alias("k1"),
        F.col("k2").bitwiseXOR(F.col("_k2")).alias("k2"),
        (F.col("before") + F.col("_bytes")).alias("before"),
        "bytes",
    )


def _listed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Rows sorted by sequence and conversation, as pieces (an Arrow batch at most) of comma-joined lists."""
    for rows in batches:
        if rows.empty:
            continue
        key, ids = rows[KEY], rows["conv_id"].astype(str).tolist()
        new = (key != key.shift()).any(axis=1).to_numpy()
        starts = np.flatnonzero(new).tolist()
        cuts = list(zip(starts, [*starts[1:], len(rows)], strict=True))
        lines = rows.iloc[starts].rename(columns={"conv_id": "first"})
        yield lines.assign(
            n=[end - start for start, end in cuts],
            listed=[",".join(ids[start:end]) for start, end in cuts],
        )


def _ended(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """One row per sequence from the pieces of its list, which come in order."""
    key, line = None, None
    for pieces in batches:
        done = []
        for depth, k1, k2, first, n, listed in pieces.itertuples(index=False):
            if (depth, k1, k2) != key:
                if line:
                    done.append((*key, line[0], line[1], line[2].hexdigest()))
                key, line = (depth, k1, k2), [first, 0, hashlib.sha256()]
            else:
                line[2].update(b",")
            line[1] += n
            line[2].update(listed.encode())
        if done:
            yield pd.DataFrame(done, columns=["depth", "k1", "k2", "seq", "weight", "ends"])
    if line:
        row = (*key, line[0], line[1], line[2].hexdigest())
        yield pd.DataFrame([row], columns=["depth", "k1", "k2", "seq", "weight", "ends"])


def weighted_sequences(spark: SparkSession, paths: DataFrame) -> DataFrame:
    """Rows depth, k1, k2, seq, weight, ends: one per distinct whole sequence.

    ``seq`` is its smallest conversation, ``weight`` their number, ``ends`` the digest
    of their list. The ids of a sequence are sorted and joined in pieces by many tasks;
    the digest is fed piece after piece, so that a sequence of any weight needs no more
    memory than a piece.
    """
    whole = paths.where("depth = length").select("conv_id", *KEY)
    sorted_ids = whole.repartitionByRange(*KEY, "conv_id").sortWithinPartitions(*KEY, "conv_id")
    pieces = sorted_ids.select(*KEY, "conv_id").mapInPandas(
        _listed, "depth long, k1 long, k2 long, first long, n long, listed string"
    )
    gathered = pieces.repartition(*KEY).sortWithinPartitions(*KEY, "first")
    return gathered.mapInPandas(
        _ended, "depth long, k1 long, k2 long, seq long, weight long, ends string"
    )


def prefix_trie(spark: SparkSession, conversations: DataFrame) -> DataFrame:
    """One row per node of the trie of rebuilt conversations.

    Columns conv_id (smallest member), depth, parent_conv_id, n_convs, n_children,
    n_leaves, saved_tokens, ends_sha256, and the node's key k1, k2.

    Turns are taken in order of ``turn``, null first, then of the MD5 of role and text;
    rows that repeat are turns of their own. A null role or text is an empty one. Rows
    without conv_id belong to no conversation and are left out; without any row there is
    no node, not even the root. Other columns are not read.
    """
    paths = staged(spark, prefix_keys(spark, rebuilt_turns(spark, conversations)), "paths")
    sequences = staged(spark, weighted_sequences(spark, paths), "sequences")
    chosen = sequences.select(F.col("seq").alias("conv_id"))
    one_each = paths.join(chosen, "conv_id", "leftsemi")
    steps = staged(
        spark,
        one_each.select(
            F.col("conv_id").alias("seq"), "length", *KEY, "before", "bytes"
        ),
        "steps",
    )
    total = steps.where("depth = length").select("seq", (F.col("before") + F.col("bytes")).alias("total"))
    # The root is a step of every sequence that has turns.
    zero = F.lit(0).cast("long")
    roots = sequences.where("depth > 0").select(
        "seq", F.col("depth").alias("length"), *(zero.alias(c) for c in (*KEY, "before", "bytes"))
    )
    steps = steps.unionByName(roots)
    inner = F.col("depth") < F.col("length")
    nodes = steps.groupBy(*KEY).agg(
        F.min(F.struct("seq", "before")).alias("owner"), F.bool_or(inner).alias("inner")
    )
    nodes = staged(spark, nodes, "trie-nodes")
    tops = nodes.groupBy(F.col("owner.seq").alias("seq")).agg(
        F.min(F.struct("depth", F.col("owner.before").alias("before"))).alias("top")
    )
    tops = staged(spark, tops.select("seq", "top.depth", "top.before"), "tops")
    # The parent of a sequence's topmost node is another sequence's.
    above = (
        steps.select("seq", (F.col("depth") + 1).alias("depth"), "k1", "k2")
        .join(tops.where("depth > 1").select("seq", "depth"), ["seq", "depth"])
        .select("seq", (F.col("depth") - 1).alias("depth"), "k1", "k2")
    )
    above = staged(spark, above, "above")
    root = nodes.where("depth = 0").select(F.min("owner.seq").alias("seq")).first()["seq"]
    parents = above.join(nodes.select(*KEY, F.col("owner.seq").alias("over")), KEY).select("seq", "over")
    leaves = sequences.join(nodes.where("inner").select(*KEY), KEY, "leftanti").select(
        "seq", F.lit(1).alias("leaf")
    )
    told = (
        sequences.select("seq", "weight", "ends")
        .join(total, "seq")
        .join(leaves, "seq", "left")
        .join(tops.select("seq", F.col("depth").alias("top"), F.col("before").alias("top_before")), "seq", "left")
        .join(parents, "seq", "left")
        .withColumn("over", F.when(F.col("top") == 1, F.lit(root)).otherwise(F.col("over")))
    )
    told = staged(spark, told, "sequences")
    owns = F.col("top").isNotNull()
    below = F.col("total") - F.when(F.col("top") > F.col("depth"), F.col("top_before")).otherwise(F.col("before"))
    return (
        steps.join(told, "seq")
        .groupBy(*KEY)
        .agg(
            F.min(F.struct("seq", "top", "over")).alias("owner"),
            F.sum("weight").alias("n_convs"),
            F.count_if(inner & (F.col("top") <= F.col("depth") + 1)).alias("n_children"),
            F.count("leaf").alias("n_leaves"),
            (
                F.sum(F.col("weight") * (F.col("total") - F.col("before")))
                - F.coalesce(F.sum(F.when(owns, below)), F.lit(0))
            ).alias("saved_tokens"),
            F.max(F.when(~inner, F.col("ends"))).alias("ends"),
        )
        .select(
            F.col("owner.seq").alias("conv_id"),
            "depth",
            F.when(F.col("depth") == 0, F.lit(None))
            .when(F.col("owner.top") < F.col("depth"), F.col("owner.seq"))
            .otherwise(F.col("owner.over"))
            .alias("parent_conv_id"),
            "n_convs",
            "n_children",
            "n_leaves",
            "saved_tokens",
            F.coalesce("ends", F.lit(hashlib.sha256(b"").hexdigest())).alias("ends_sha256"),
            "k1",
            "k2",
        )
    )
