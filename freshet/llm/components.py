"""Connected components of a link table of any size."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from freshet.llm.staging import staged


def _centred(edges: DataFrame) -> DataFrame:
    """Every node's smallest neighbour, itself included."""
    return edges.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("u", "m"))


def components(spark: SparkSession, links: DataFrame) -> DataFrame:
    """Columns node and component (its smallest reachable node) for the links a, b.

    Turns between tying larger neighbours and smaller neighbours to a node's smallest
    one, until every component is a star around its smallest node. Nodes are never
    gathered: each turn is two minima and two joins over the links, which shrink to one
    per node. Turns grow as the logarithm of the longest path.
    """
    both = links.select(F.col("a").cast("long").alias("x"), F.col("b").cast("long").alias("y"))
    edges = staged(
        spark,
        both.where("x <> y").select(F.greatest("x", "y").alias("u"), F.least("x", "y").alias("v")).distinct(),
        "edges",
    )
    seen = None
    while True:
        # Large star: all neighbours, those above the node move to its smallest.
        around = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = (
            around.join(_centred(around), "u")
            .where(F.col("v") > F.col("u"))
            .select(F.col("v").alias("u"), F.col("m").alias("v"))
            .distinct()
        )
        # Small star: the node and its smaller neighbours move to the smallest.
        low = _centred(large)
        moved = large.join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        moved = moved.unionByName(low.select("u", F.col("m").alias("v")))
        edges = staged(spark, moved.where("u <> v").distinct(), "edges")
        now = edges.agg(
            F.count("*"), F.sum(F.pmod(F.xxhash64("u", "v"), F.lit(1 << 31)))
        ).first()
        if now == seen or not now[0]:
            break
        seen = now
    stars = edges.select(F.col("u").alias("node"), F.col("v").alias("component"))
    centres = edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return staged(spark, stars.unionByName(centres), "components")
