"""Comparing two sides by content, where equal counts may hide a changed field."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

DAY = ["_kafka_topic", "_bronze_date"]
RANGES = 256


def _content(columns: list[str]) -> Column:
    """A hash of the row in which NULLs, empty texts and borders between fields count."""
    told = F.to_json(F.struct(*(F.col(f"`{c}`") for c in columns)), {"ignoreNullFields": "false"})
    return F.xxhash64(told)


def content_hashes(rows: DataFrame, columns: list[str], by: list[str] = DAY) -> DataFrame:
    """Rows and the sum of their hashes per group: equal multisets, whatever their order, are equal.

    Sums are taken task by task before the shuffle; a group of any size is one line.
    """
    hashed = rows.select(*by, _content(columns).alias("_h"))
    return hashed.groupBy(*by).agg(
        F.count("*").alias("rows"), F.sum(F.col("_h").cast("decimal(38,0)")).alias("content")
    )


def _unlike(source: DataFrame, bronze: DataFrame, by: list[str]) -> DataFrame:
    """The groups whose lines differ, or that one side lacks."""
    both = source.withColumn("_side", F.lit(1)).unionByName(bronze.withColumn("_side", F.lit(-1)))
    # A line of each side at most, so that equal ones cancel out.
    sums = both.groupBy(*by).agg(
        F.sum(F.col("_side") * F.col("rows")).alias("_rows"),
        F.sum(F.col("_side") * F.col("content")).alias("_content"),
    )
    return sums.where("_rows <> 0 or _content <> 0").select(*by)


def _within(rows: DataFrame, groups: DataFrame, by: list[str]) -> DataFrame:
    named = groups.select(*(F.col(c).alias(f"_g{n}") for n, c in enumerate(by)))
    same = [F.col(c).eqNullSafe(F.col(f"_g{n}")) for n, c in enumerate(by)]
    return rows.join(named, same, "left_semi")


def content_differences(source: DataFrame, bronze: DataFrame, columns: list[str]) -> DataFrame:
    """Rows that one side holds more often: topic, date, the columns, and how often each side has them.

    Both sides have ``_kafka_topic``, ``_bronze_date`` and ``columns``. Topics and days are
    compared first, by one line each; then the ranges of hashes within unlike days; rows
    are only compared within unlike ranges. If all is equal, rows are read once and none
    is shuffled.
    """
    days = _unlike(content_hashes(source, columns), content_hashes(bronze, columns), DAY)
    ranged = [*DAY, "_range"]
    spot = F.pmod(F.shiftrightunsigned(_content(columns), 40), F.lit(RANGES))

    def narrowed(rows: DataFrame) -> DataFrame:
        return _within(rows.select(*DAY, *columns), days, DAY).withColumn("_range", spot)

    sides = [narrowed(source), narrowed(bronze)]
    ranges = _unlike(*(content_hashes(side, columns, ranged) for side in sides), ranged)
    left, right = (_within(side, ranges, ranged) for side in sides)
    copies = left.withColumn("_side", F.lit(True)).unionByName(right.withColumn("_side", F.lit(False)))
    counted = copies.groupBy(*DAY, *columns).agg(
        F.count_if("_side").alias("source_copies"), F.count_if(~F.col("_side")).alias("bronze_copies")
    )
    return counted.where("source_copies <> bronze_copies")
