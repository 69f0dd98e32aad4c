"""Runs a registered query and its SQL twin and compares all rows.

``python tests/compare.py [sf] [query ...]`` prints one line per query.
"""

from __future__ import annotations

import sys
import tempfile
import time
from collections import Counter
from pathlib import Path

import duckdb

ROOT = Path(__file__).resolve().parents[1]
sys.path.insert(0, str(ROOT))
TESTDATA = Path("/root/testdata")
TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def oracle_rows(sql: str, sf_dir: Path) -> tuple[list[str], Counter]:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"create view {name} as select * from '{sf_dir}/{name}.parquet'")
    result = con.execute(sql)
    names = [d[0] for d in result.description]
    order = sorted(range(len(names)), key=names.__getitem__)
    rows = Counter(tuple(row[i] for i in order) for row in result.fetchall())
    return sorted(names), rows


def spark_rows(df) -> tuple[list[str], Counter]:
    names = sorted(df.columns)
    return names, Counter(tuple(row) for row in df.select(*names).collect())


def differences(spark, name: str, sf: str) -> list[str]:
    import __spark_entry__ as entry

    sf_dir = TESTDATA / f"sf{sf}"
    names, got = spark_rows(entry.queries()[name](spark, str(sf_dir)))
    expected_names, expected = oracle_rows(entry.oracle_sql()[name], sf_dir)
    if names != expected_names:
        return [f"columns {names} expected {expected_names}"]
    out = []
    if got != expected:
        out.append(f"rows {got.total()} expected {expected.total()}")
        out += [f"extra {row}" for row in list(got - expected)[:2]]
        out += [f"lacks {row}" for row in list(expected - got)[:2]]
    return out + ([] if got else ["no rows"])


if __name__ == "__main__":
    from pyspark.sql import SparkSession

    import __spark_entry__ as entry

    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.driver.memory", "8g")
        .config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="compare-"))
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    sf, chosen = (sys.argv[1:2] or ["0.01"])[0], sys.argv[2:]
    for name in chosen or entry.queries():
        begin = time.time()
        try:
            problems = differences(spark, name, sf)
        except Exception as error:  # report and go on with the next query
            problems = [f"{type(error).__name__}: {str(error)[:1500]}"]
        print(f"{'ok  ' if not problems else 'FAIL'} {name} {time.time() - begin:.1f}s", *problems, sep="\n     ", flush=True)
