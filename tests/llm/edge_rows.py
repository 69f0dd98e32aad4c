"""Small tables with the cases that every operator must stand."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

SCHEMA = (
    "doc_id long, text string, lang string, source string, n_chars long, kept boolean, "
    "component_id string, shard array<int>, _language string"
)

WORDS = "the quick brown fox jumps over a lazy dog near the old stone bridge at dawn"
TEXTS = [
    (0, WORDS, "en", "b"),
    (1, WORDS, "en", "b"),
    (1, WORDS, "en", "b"),
    (2, WORDS.upper(), "en", None),
    (3, None, "en", "a"),
    (4, "", None, "a"),
    (5, " \n\t ", "en", "a"),
    (6, "hi", "en", None),
    (7, "Größe und Straße über alles und noch viel mehr als das", "de", "c"),
    (8, "123 456 !!", None, "c"),
    (9, WORDS + " and then some more words follow here to end it", "en", "c"),
    (10, "lorem ipsum " * 4000, "la", "b"),
    (11, "x" * 30_000, None, "b"),
    (12, "write to ann.lee@mail.example.com or +1 (415) 555-0132 now", "en", "a"),
    (None, "no id at all but quite some words in it", "en", "a"),
    (None, None, None, None),
    (-7, "negative ids are ids as well, you know", "en", "d"),
    (1 << 40, WORDS, "en", "\U0001f600"),
]


def edge_documents(spark: SparkSession, rows: list | None = None) -> DataFrame:
    """The table above, with columns whose names operators might use themselves."""
    chosen = TEXTS if rows is None else rows
    full = [(i, t, lang, s, None if t is None else len(t), True, "x", [1], "y") for i, t, lang, s in chosen]
    return spark.createDataFrame(full, SCHEMA)


def whole_rows(df: DataFrame) -> list[tuple]:
    return sorted(map(tuple, df.collect()), key=repr)
