"""Numbering rows within groups of any size."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

BLOCK_ROWS = 50_000


def spread(*columns: str) -> Column:
    """A number in [0, 2^32) that depends on the row's values only."""
    return F.pmod(F.xxhash64(*columns), F.lit(1 << 32))


def ranked(
    df: DataFrame,
    keys: list[str],
    position: str,
    ties: list[str],
    rows: int,
    out: str,
    block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """Add ``out``: the row's number from 0 within its keys, by position, then ties.

    ``position`` is spread evenly over [0, 2^32). Its range is cut into blocks, so
    that even a group of all rows is sorted in parts of about ``block_rows``; one
    count per block then places the blocks. ``df`` is scanned twice and should be a
    staged table of ``rows`` rows. Rows equal in all the named columns may swap.
    """
    blocks = max(1, -(-rows // block_rows))
    cut = df.withColumn("_block", F.floor(F.col(position) * blocks / (1 << 32)))
    within = Window.partitionBy(*keys, "_block").orderBy(position, *ties)
    before = Window.partitionBy(*keys).orderBy("_block").rowsBetween(
        Window.unboundedPreceding, -1
    )
    starts = (
        cut.groupBy(*keys, "_block")
        .agg(F.count("*").alias("_n"))
        .withColumn("_start", F.coalesce(F.sum("_n").over(before), F.lit(0)))
        .drop("_n")
    )
    numbered = cut.withColumn("_nth", F.row_number().over(within) - 1)
    return (
        numbered.join(starts, [*keys, "_block"])
        .withColumn(out, (F.col("_start") + F.col("_nth")).cast("long"))
        .drop("_block", "_nth", "_start")
    )
