"""Shards of near-equal bytes by k-d tree partitioning, equal texts together.

Copies of one text are one point, weighted by their bytes, in a space of metadata
dimensions. Each level of the tree splits every node at the weighted median of its
widest dimension, at the side of it that is nearer, until the leaves have the target
weight. Points of more than a 32nd of a shard are dealt out first, heaviest first, and
each median is taken for the room that they leave. All steps are DataFrame
aggregations: a median is found by counting bytes per bin of a node's value range
and zooming into the bin that holds the half, so no node is ever sorted or
gathered. The driver holds one line per node, and one per heavy point.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from freshet.llm.ranks import ranked
from freshet.llm.staging import staged

BINS = 1 << 16  # of a node's range in one counting pass
MIX_RANGE = 1 << 32
HEAVY = 32  # points of more than this part of a shard: at most so many a shard
DIMS = ["length", "lang_code", "source_code", "id_code"]


def mixed_id(doc_id: Column) -> Column:
    """A tie-break spread over [0, 2^32) that any SQL engine can compute."""
    low = F.pmod(F.coalesce(doc_id, F.lit(0)), F.lit(1 << 31))
    return F.pmod(low * F.lit(2654435761), F.lit(MIX_RANGE))


def category(name: str) -> Column:
    """A text column as a dimension: the first 8 hexadecimal digits of its MD5; null as 0."""
    return F.coalesce(F.conv(F.substring(F.md5(F.col(name)), 1, 8), 16, 10).cast("long"), F.lit(0))


def _per_node(rows: DataFrame, **columns: dict[int, int]) -> DataFrame:
    """Rows with one number per node attached; the driver's table has a line per node."""
    nodes = next(iter(columns.values()))
    lines = ", ".join(
        f"({node}L, {', '.join(f'{values[node]}L' for values in columns.values())})"
        for node in nodes
    )
    table = rows.sparkSession.sql(f"select * from values {lines} as t(node, {', '.join(columns)})")
    return rows.join(F.broadcast(table), "node")


def _medians(keyed: DataFrame, low: dict, high: dict, goal: dict) -> dict[int, tuple]:
    """Per node: the smallest ``key`` by which ``goal`` bytes are reached, the bytes below, and with it.

    Each pass counts bytes in up to ``BINS`` bins of every node's open range and
    keeps the bin that reaches the goal, until the bins hold a single value.
    """
    low, high = dict(low), dict(high)
    below, upto_it = dict.fromkeys(low, 0), dict.fromkeys(low, 0)
    while any(low[n] < high[n] for n in low):
        width = {n: max(1, -(-(high[n] - low[n] + 1) // BINS)) for n in low}
        inside = _per_node(keyed, low=low, high=high, width=width).where(
            F.col("key").between(F.col("low"), F.col("high"))
        )
        bins = (
            inside.withColumn("bin", F.floor((F.col("key") - F.col("low")) / F.col("width")))
            .groupBy("node", "bin")
            .agg(F.sum("size").alias("bytes"))
        )
        upto = Window.partitionBy("node").orderBy("bin")
        reached = (
            _per_node(bins.withColumn("upto", F.sum("bytes").over(upto)), goal=goal, below=below)
            .withColumn("upto", F.col("upto") + F.col("below"))
            .where(F.col("upto") >= F.col("goal"))
            .groupBy("node")
            .agg(F.min_by(F.struct("bin", "upto", (F.col("upto") - F.col("bytes")).alias("below")), "bin").alias("first"))
            .select("node", "first.*")
        )
        for found in reached.collect():
            n = found["node"]
            low[n] += found["bin"] * width[n]
            high[n] = min(high[n], low[n] + width[n] - 1)
            below[n], upto_it[n] = found["below"], found["upto"]
    return {n: (low[n], below[n], upto_it[n]) for n in low}


def _level(
    rows: DataFrame, dims: list[str], extents: list[tuple[int, int]], part: Callable[[int], float]
) -> DataFrame:
    """Rows moved to the children of their node, split along its widest dimension.

    ``part`` gives the share of a node's bytes that its left child has room for.
    """
    ranges = [f(d).alias(f"{f.__name__}_{d}") for d in dims for f in (F.min, F.max)]
    nodes = {
        r["node"]: r
        for r in rows.groupBy("node").agg(F.sum("size").alias("bytes"), *ranges).collect()
    }

    def width(node, k: int) -> float:
        low, high = extents[k]
        return (node[f"max_{dims[k]}"] - node[f"min_{dims[k]}"]) / max(1, high - low)

    widest = {n: max(range(len(dims)), key=lambda k: width(r, k)) for n, r in nodes.items()}
    chosen = F.element_at(F.array(*dims), (F.col("dim") + 1).cast("int"))
    keyed = _per_node(rows, dim=widest).withColumn("key", chosen)
    low = {n: r[f"min_{dims[widest[n]]}"] for n, r in nodes.items()}
    high = {n: r[f"max_{dims[widest[n]]}"] for n, r in nodes.items()}
    goal = {n: round(r["bytes"] * part(n)) for n, r in nodes.items()}
    values = _medians(keyed.select("node", "key", "size"), low, high, goal)
    at = {n: value for n, (value, _, _) in values.items()}
    tied = _per_node(keyed, at=at).where(F.col("key") == F.col("at"))
    tied = tied.select("node", F.col("mix").alias("key"), "size")
    rest = {n: goal[n] - below for n, (_, below, _) in values.items()}
    ends = (dict.fromkeys(nodes, end) for end in (0, MIX_RANGE - 1))
    mixes = {  # the point at the median goes left if that is nearer to the goal
        n: mix if upto - rest[n] <= rest[n] - below else mix - 1
        for n, (mix, below, upto) in _medians(tied, *ends, rest).items()
    }
    key, at_key = F.struct("key", "mix"), F.struct(F.col("at").alias("key"), F.col("at_mix").alias("mix"))
    child = F.col("node") * 2 + F.when(key > at_key, 1).otherwise(0)
    return _per_node(keyed, at=at, at_mix=mixes).select(
        *(c for c in rows.columns if c != "node"), child.alias("node")
    )


def kd_leaves(rows: DataFrame, dims: list[str], room: list[float]) -> DataFrame:
    """Add ``leaf`` to rows with ``size``, ``mix`` and long ``dims``.

    ``room`` has a leaf's room each, in proportion to which leaves get bytes; their number is
    a power of two. The rows should be a staged table, in which ``node`` is 1, the root: each
    level scans it some six times.
    """
    ends = rows.agg(*(f(d).alias(f"{f.__name__}_{d}") for d in dims for f in (F.min, F.max)))
    found = ends.first()
    if found[0] is None:
        return rows.withColumn("leaf", F.lit(0)).drop("node")
    extents = [(found[f"min_{d}"], found[f"max_{d}"]) for d in dims]
    rooms = dict(enumerate(room, start=len(room)))  # by node; leaves are the last ones
    for node in range(len(room) - 1, 0, -1):
        rooms[node] = rooms[2 * node] + rooms[2 * node + 1]
    placed = rows
    for _ in range(len(room).bit_length() - 1):
        placed = _level(
            placed, dims, extents, lambda n: rooms[2 * n] / rooms[n] if rooms[n] > 0 else 0.5
        )
    return placed.withColumn("leaf", (F.col("node") - len(room)).cast("int")).drop("node")


def deal(heavy: list[tuple], shards: int) -> tuple[list[tuple], list[int]]:
    """Points (key..., size) dealt to the emptiest shard, heaviest first; also every shard's load."""
    emptiest = [(0, shard) for shard in range(shards)]
    dealt = []
    for *key, size in sorted(heavy, key=lambda point: (-point[-1], point)):
        load, shard = emptiest[0]
        heapq.heapreplace(emptiest, (load + size, shard))
        dealt.append((*key, shard))
    return dealt, [load for load, _ in sorted(emptiest, key=lambda x: x[1])]


def room_left(loads: list[int], rest: int) -> list[float]:
    """What each shard takes of ``rest`` so that all come as near to one level as they can."""
    upto = 0
    for n, load in enumerate(sorted(loads), start=1):
        upto += load
        level = (rest + upto) / n
        if n == len(loads) or level <= sorted(loads)[n]:
            break
    return [max(0.0, level - load) for load in loads]


def shard_documents(
    spark: SparkSession, docs: DataFrame, shards: int | None = 16, target_bytes: int | None = None
) -> DataFrame:
    """Shard and slot of every document.

    ``docs`` has doc_id, text, lang and source; other columns are not read. The size
    of a document is its UTF-8 bytes plus 1 (null text: 1), its dimensions are size,
    language, source and id. The tree splits the bytes until there are ``shards``
    leaves (rounded up to a power of two) or, with ``target_bytes``, until the mean
    leaf is no larger. Documents of equal text (null as empty) share a shard, with the least
    language, source and id among them, unless together they are larger than the mean
    shard: such groups are split like any others, by id. Null values count as 0 in their
    dimension. Ties at a median are split by a hash of the id. An empty table gives no rows.
    Returns doc_id, size, text_crc32, shard, and slot: the row's number in its shard, gapless
    from 0.
    """
    text = F.encode(F.coalesce("text", F.lit("")), "utf-8")
    points = docs.select(
        "doc_id",
        (F.octet_length(text) + 1).cast("long").alias("size"),
        F.crc32(text).alias("text_crc32"),
        F.md5(text).alias("copy"),
        category("lang").alias("lang_code"),
        category("source").alias("source_code"),
        F.coalesce(F.col("doc_id").cast("long"), F.lit(0)).alias("id_code"),
        mixed_id(F.col("doc_id").cast("long")).alias("mix"),
    )
    points = staged(spark, points, "kd-points")
    totals = points.agg(F.count("*").alias("rows"), F.sum("size").alias("bytes")).first()
    size = totals["bytes"] or 0
    leaves = shards if target_bytes is None else max(1, size / target_bytes)
    leaves = 1 << max(0, math.ceil(math.log2(leaves)))
    # Fewer groups than shards can be larger than the mean shard.
    groups = points.groupBy("copy").agg(F.sum("size").alias("size")).where(F.col("size") * leaves > size)
    large = [r["copy"] for r in groups.collect()]
    points = points.withColumn("part", F.when(F.col("copy").isin(large), F.col("mix")).otherwise(0))
    atoms = points.groupBy("copy", "part").agg(
        F.sum("size").alias("size"),
        F.min("size").alias("length"),
        *(F.min(c).alias(c) for c in (*DIMS[1:], "mix")),
        F.lit(1).cast("long").alias("node"),
    )
    atoms = staged(spark, atoms, "kd-atoms")
    is_heavy = F.col("size") * (leaves * HEAVY) > size
    heavy = [tuple(r) for r in atoms.where(is_heavy).select("copy", "part", "size").collect()]
    dealt, loads = deal(heavy, leaves)
    room = room_left(loads, size - sum(loads))
    homes = kd_leaves(atoms.where(~is_heavy), DIMS, room).select("copy", "part", F.col("leaf").alias("shard"))
    if dealt:
        lines = ", ".join(f"('{copy}', {part}L, {shard})" for copy, part, shard in dealt)
        homes = homes.unionByName(spark.sql(f"select * from values {lines} as t(copy, part, shard)"))
    homes = staged(spark, homes, "kd-homes")
    placed = points.join(homes, ["copy", "part"])
    placed = staged(spark, placed.select("doc_id", "size", "text_crc32", "shard", "mix"), "kd-leaves")
    ties = ["doc_id", "size", "text_crc32"]
    return ranked(placed, ["shard"], "mix", ties, totals["rows"], "slot").drop("mix")
