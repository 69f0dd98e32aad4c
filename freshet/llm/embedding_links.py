"""Exact near-duplicate vectors by dual traversal of a distributed cover tree.

Vectors of a label are divided level by level: a node with more points than a task
should hold gets a few centres, at least half the last radius apart, and its points go
to the nearest. Every node keeps the radius that covers its points. The traversal
starts with each label paired with itself and replaces a pair of nodes by the pairs of
their children unless the covering radii rule out any link. What remains are pairs of
tiles, nodes small enough for a task, which hold cover trees of their own and are
traversed there.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from freshet.llm.components import components
from freshet.llm.cover_tree import SLACK, CoverTree, Links, distance
from freshet.llm.staging import ship_code, staged

COSINE = 0.98
TILE = 2048  # points of a tile at most
FANOUT = 24  # centres a node is divided by at most, about
LEVELS = 12  # after which the points of a node that is still too large are dealt by hash


def _units(lists) -> np.ndarray:
    rows = np.array([np.asarray(x, dtype=np.float64) for x in lists])
    # Scaled by a power of two, which is exact, so that no square is too large or too small.
    rows = np.ldexp(rows, -np.frexp(np.abs(rows).max(axis=1, keepdims=True))[1])
    return rows / np.sqrt((rows * rows).sum(axis=1, keepdims=True))


def _unit_rows(raw: pd.Series) -> np.ndarray:
    return np.stack([np.frombuffer(x) for x in raw])


def usable(vector: str, label: str) -> Column:
    """Whether a vector can link: it and its label there, all numbers finite, not all zero."""
    x = F.col(vector)
    return F.coalesce(
        F.col(label).isNotNull()
        & F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
        & F.exists(x, lambda v: v != 0),
        F.lit(False),
    )


def vector_classes(vectors: DataFrame) -> DataFrame:
    """One row per label and vector: its smallest id, copies and unit vector; label 0 is a node.

    The classes are told apart by 128 bits of hash; copies are counted before the shuffle.
    """
    classes = vectors.groupBy("h1", "h2").agg(
        F.min("vec_id").alias("id"),
        F.count("*").alias("copies"),
        F.first("embedding").alias("embedding"),
        F.first("group").alias("node"),
    )

    def norm(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for size, part in batch.groupby(batch["embedding"].map(len)):
                units = [u.tobytes() for u in _units(part["embedding"])]
                yield part[["h1", "h2", "id", "copies", "node"]].assign(unit=units)

    return classes.mapInPandas(norm, "h1 long, h2 long, id long, copies long, node long, unit binary")


def _centres(candidates: DataFrame, apart: float) -> DataFrame:
    """Per node, candidates that are at least ``apart`` from each other, as bytes."""

    def thin(part: pd.DataFrame) -> pd.DataFrame:
        units = _unit_rows(part.sort_values("id")["unit"])
        chosen = [0]
        for k in range(1, len(units)):
            if (distance(units[chosen] @ units[k]) >= apart).all():
                chosen.append(k)
        if len(chosen) == 1:  # all close together: any two points divide the node
            chosen = list(range(min(2, len(units))))
        return pd.DataFrame(
            {"node": part["node"].iloc[:1], "centres": [units[chosen].tobytes()], "dim": units.shape[1]}
        )

    return candidates.groupBy("node").applyInPandas(thin, "node long, centres binary, dim int")


def _nearest(points: DataFrame) -> DataFrame:
    """Points (with their node's centres) moved to the child of the nearest centre."""

    def move(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for _, part in batch.groupby("node"):
                raw, units = part["centres"].iloc[0], _unit_rows(part["unit"])
                # A node that no candidate fell on passes its points on, uncovered.
                centres = np.frombuffer(raw).reshape(-1, units.shape[1]) if raw else 0 * units[:1]
                cosines = units @ centres.T
                child = cosines.argmax(axis=1)
                away = distance(cosines[np.arange(len(part)), child]) if raw else 2.0
                yield part[["id", "copies", "unit", "node"]].assign(
                    child=child,
                    away=away,
                    centre=[centres[c].tobytes() if raw else None for c in child],
                )

    schema = "id long, copies long, unit binary, node long, child int, away double, centre binary"
    return points.mapInPandas(move, schema)


def divided(spark: SparkSession, points: DataFrame) -> tuple[DataFrame, DataFrame | None, int]:
    """Points with their tile as ``node``; all nodes below the roots; the number of levels.

    A node has its parent, the radius that covers its points, and its centre (null: none).
    """
    tiles: list[DataFrame] = []
    nodes: list[DataFrame] = []
    apart = 1.0
    for level in range(LEVELS + 1):
        large = points.groupBy("node").agg(F.count("*").alias("n")).where(F.col("n") > TILE)
        large = staged(spark, large, "large-nodes")
        if not large.limit(1).count():
            break
        tiles.append(points.join(large, "node", "left_anti"))
        moving = points.join(large, "node")
        if level == LEVELS:
            parts = F.ceil(F.col("n") * 2 / TILE)
            dealt = moving.withColumn("child", F.pmod(F.xxhash64("id"), parts).cast("int"))
            moved = dealt.drop("n").withColumn("away", F.lit(2.0))
            moved = moved.withColumn("centre", F.lit(None).cast("binary"))
        else:
            wanted = F.least(F.lit(FANOUT), 4 + 2 * F.col("n") / TILE) / F.col("n")
            mixed = F.pmod(F.xxhash64("id", F.lit(level)), F.lit(1 << 32))
            candidates = moving.where(mixed < wanted * (1 << 32)).select("node", "id", "unit")
            centres = _centres(candidates, apart)
            moved = _nearest(moving.drop("n").join(centres, "node", "left"))
        child = F.xxhash64("node", "child", F.lit(level))
        moved = moved.withColumn("parent", F.col("node")).withColumn("node", child)
        moved = staged(spark, moved, "points")
        children = moved.groupBy("node", "parent").agg(
            F.max("away").alias("radius"), F.first("centre").alias("centre")
        )
        nodes.append(staged(spark, children, "nodes"))
        points = moved.select(*points.columns)
        apart /= 2
    every = reduce(DataFrame.unionByName, [*tiles, points])
    return every, reduce(DataFrame.unionByName, nodes) if nodes else None, len(nodes)


def _near(pairs: DataFrame, reach: float) -> DataFrame:
    """Pairs of nodes whose covering radii allow a link; a node without centre allows all."""

    def prune(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            good = []
            columns = (batch[c] for c in ("a_centre", "b_centre", "a_radius", "b_radius"))
            for x, y, rx, ry in zip(*columns, strict=True):
                apart = distance(np.frombuffer(x) @ np.frombuffer(y)) if x and y else 0.0
                good.append(bool(apart - rx - ry <= reach + SLACK))
            yield batch.loc[good]

    return pairs.mapInPandas(prune, pairs.schema)


def tile_pairs(
    spark: SparkSession, roots: DataFrame, nodes: DataFrame | None, levels: int, reach: float
) -> DataFrame:
    """Pairs of tiles (a, b) that may hold links, by traversal from the roots down."""

    def side(name: str, node: Column, radius: Column, centre: Column) -> list[Column]:
        return [node.alias(name), radius.alias(f"{name}_radius"), centre.alias(f"{name}_centre")]

    start = [F.col("node"), F.lit(2.0), F.lit(None).cast("binary")]
    pairs = roots.select(*side("a", *start), *side("b", *start))
    for _ in range(levels):
        for name in "ab":
            children = nodes.select(
                F.col("parent").alias(f"{name}_parent"),
                *side(f"{name}_new", F.col("node"), F.col("radius"), F.col("centre")),
            )
            pairs = pairs.join(children, F.col(name) == F.col(f"{name}_parent"), "left")
        # A node that is a tile already stays; below a node paired with itself, each pair once.
        same, fields = F.col("a") == F.col("b"), ("", "_radius", "_centre")
        new = [
            F.when(F.col(f"{n}_parent").isNull(), F.col(n + f)).otherwise(F.col(f"{n}_new{f}")).alias(n + f)
            for n in "ab"
            for f in fields
        ]
        pairs = pairs.select(same.alias("same"), *new).where("not same or a <= b").drop("same")
        pairs = staged(spark, _near(pairs, reach), "node-pairs")
    return pairs.select("a", "b")


def _trees(points: DataFrame) -> DataFrame:
    """The cover tree of every tile, with its ids and copies, as bytes."""

    def build(part: pd.DataFrame) -> pd.DataFrame:
        part = part.sort_values("id")
        tree = CoverTree.of(_unit_rows(part["unit"]))
        packed = pickle.dumps((tree, part["id"].to_numpy(), part["copies"].to_numpy()))
        return pd.DataFrame({"node": part["node"].iloc[:1], "tree": [packed]})

    return points.groupBy("node").applyInPandas(build, "node long, tree binary")


def _traversed(pairs: DataFrame, cosine: float) -> DataFrame:
    """Per pair of trees: linked points, their partners there, and their component there."""

    def traverse(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for a, b, x, y in batch[["a", "b", "x", "y"]].itertuples(index=False):
                left, ids, copies = pickle.loads(x)
                right, other_ids, other_copies = pickle.loads(y) if a != b else (left, ids, copies)
                links = Links(left, right, copies, other_copies, cosine).find()
                rows = links.found(ids, other_ids)
                yield pd.DataFrame(rows, columns=["id", "partners", "least"])

    return pairs.mapInPandas(traverse, "id long, partners long, least long")


def link_vectors(spark: SparkSession, vectors: DataFrame, cosine: float = COSINE) -> DataFrame:
    """Link all vectors (vec_id, embedding, label) of a label whose cosine reaches ``cosine``.

    Returns vec_id, n_links (other rows linked directly), component_id (the smallest vec_id
    reachable) and kept (vec_id = component_id). A vector links with nothing if it or its
    label is null, if it is empty or all zeros, or has a null or non-finite number; vectors
    of different lengths do not link. Equal vectors are one node with so many copies. A
    row without vec_id takes no part: its component is null and it is kept. Other columns
    are not read; an empty table gives no rows.
    """
    ship_code(spark)
    rows = vectors.select(
        F.col("vec_id").cast("long"),
        F.col("embedding").cast("array<double>").alias("embedding"),
        F.col("label").cast("string").alias("label"),
    )
    usable_row = usable("embedding", "label") & F.col("vec_id").isNotNull()
    length = F.size("embedding")
    rows = rows.withColumn("usable", usable_row).select(
        "vec_id",
        "usable",
        F.xxhash64("label", length, "embedding").alias("h1"),
        F.xxhash64("embedding", "label", length, F.lit(1)).alias("h2"),
        F.xxhash64("label", length).alias("group"),
        F.when(F.col("usable"), F.col("embedding")).alias("embedding"),
    )
    classes = staged(spark, vector_classes(rows.where("usable")), "vector-classes")
    points = classes.select("id", "copies", "unit", "node")
    roots = points.select("node").distinct()
    tiled, nodes, levels = divided(spark, points)
    trees = staged(spark, _trees(tiled), "trees")
    pairs = tile_pairs(spark, roots, nodes, levels, float(distance(np.array(cosine))))
    both = pairs.join(trees.select(F.col("node").alias("a"), F.col("tree").alias("x")), "a").join(
        trees.select(F.col("node").alias("b"), F.col("tree").alias("y")), "b"
    )
    found = staged(spark, _traversed(both, cosine), "vector-links")
    partners = found.groupBy("id").agg(F.sum("partners").alias("partners"))
    groups = components(spark, found.select(F.col("id").alias("a"), F.col("least").alias("b")))
    of_class = (
        classes.select("h1", "h2", "id", "copies")
        .join(partners, "id", "left")
        .join(groups.withColumnRenamed("node", "id"), "id", "left")
        .select(
            "h1",
            "h2",
            (F.coalesce("partners", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
            F.coalesce("component", "id").alias("component_id"),
        )
    )
    linked = rows.where("usable").select("vec_id", "h1", "h2").join(of_class, ["h1", "h2"])
    alone = rows.where("not usable").select(
        "vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id")
    )
    both = linked.select("vec_id", "n_links", "component_id").unionByName(alone)
    kept = F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(True))
    return both.withColumn("kept", kept)
