"""Spelling variants: words one edit apart, found by PartEnum signatures of their letters.

A word is taken as the multiset of its letters, a binary vector with a dimension for
every (letter, how often so far). One inserted, deleted or replaced letter changes at
most two dimensions. The dimensions are dealt over ``PARTS`` parts by hash; two words
that differ in two dimensions agree on all parts but two at most, so that they share the
signature of at least one choice of ``PARTS - 2`` parts. The choices are enumerated,
words are joined on equal signatures and every pair that meets is compared.

Anagrams and words of few different letters share signatures without being near. A
signature therefore also holds three letters of one end of the word: an edit leaves the
first three or the last three letters of a word of seven as they are. This splits large
groups and loses no pair.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from freshet.llm.shingles import mix
from freshet.llm.staging import ship_code, staged

LETTERS = 7  # of the shortest word
PARTS = 4
APART = 2  # dimensions that one edit may change
END = (LETTERS - 1) // 2  # letters that are the same at one end

KEPT = np.array(
    [
        [part in chosen for part in range(PARTS)]
        for chosen in itertools.combinations(range(PARTS), PARTS - APART)
    ]
)


def _lower(run: Column) -> Column:
    """A-Z in lower case, all else as it is."""
    plain = F.octet_length(run) == F.char_length(run)
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    return F.when(plain, F.lower(run)).otherwise(F.translate(run, upper, lower))


def word_counts(documents: DataFrame, delete_every: int = 31) -> DataFrame:
    """Rows word, n: the runs of letters of all texts, with their number.

    Where ``delete_every`` divides the CRC32 of ``<doc_id>:<run>``, one letter of the run
    is left out, at the place the same number says: so misspellings are planted. A null
    doc_id is written as an empty one. Runs that stay shorter than seven are left out.
    """
    runs = documents.select(
        F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("doc"),
        F.explode(
            F.regexp_extract_all("text", F.lit(f"([A-Za-zÀ-ÿ]{{{LETTERS},}})"), 1)
        ).alias("run"),
    ).select("doc", _lower(F.col("run")).alias("run"))
    number = F.crc32(F.concat("doc", F.lit(":"), "run"))
    at = (F.col("h") % F.char_length("run")).cast("int")
    cut = F.concat(F.substr("run", F.lit(1), at), F.substr("run", at + 2))
    word = F.when(F.col("h") % delete_every == 0, cut).otherwise(F.col("run"))
    words = runs.withColumn("h", number).select(word.alias("word"))
    return words.where(F.char_length("word") >= LETTERS).groupBy("word").agg(F.count("*").alias("n"))


def _part_sums(words: list[str]) -> np.ndarray:
    """Per word and part a 64-bit sum over the dimensions that the word has there."""
    lengths = np.fromiter(map(len, words), dtype=np.int64, count=len(words))
    points = np.frombuffer("".join(words).encode("utf-32-le"), dtype=np.uint32).astype(np.uint64)
    owner = np.repeat(np.arange(len(words)), lengths)
    order = np.lexsort((points, owner))
    points = points[order]
    first = np.ones(len(points), dtype=bool)
    first[1:] = (points[1:] != points[:-1]) | (owner[1:] != owner[:-1])
    starts = np.flatnonzero(first)
    nth = np.arange(len(points)) - np.repeat(starts, np.diff([*starts, len(points)]))
    dimension = mix(points << np.uint64(32) | nth.astype(np.uint64))
    part = (dimension % np.uint64(PARTS)).astype(np.int64)
    sums = np.zeros(len(words) * PARTS, dtype=np.uint64)
    np.add.at(sums, owner * PARTS + part, mix(dimension + np.uint64(1)))
    return sums.reshape(len(words), PARTS)


def signatures(words: list[str]) -> np.ndarray:
    """One row per word: a 64-bit signature per choice of parts and end of the word."""
    sums = _part_sums(words)
    ends = np.empty((len(words), 2), dtype=np.uint64)
    for side, cut in enumerate((slice(0, END), slice(-END, None))):
        letters = np.frombuffer("".join(w[cut] for w in words).encode("utf-32-le"), dtype=np.uint32)
        letters = letters.reshape(len(words), END).astype(np.uint64)
        folded = np.full(len(words), side + 1, dtype=np.uint64)
        for k in range(END):
            folded = mix(folded * np.uint64(0x9E3779B97F4A7C15) + letters[:, k])
        ends[:, side] = folded
    out = np.empty((len(words), len(KEPT), 2), dtype=np.uint64)
    for k, kept in enumerate(KEPT):
        chosen = mix(sums[:, kept].sum(axis=1, dtype=np.uint64) + np.uint64(k))
        out[:, k] = mix(chosen[:, None] + ends)
    return out.reshape(len(words), -1).view(np.int64)


def _signed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for rows in batches:
        if len(rows):
            found = signatures(rows["word"].tolist())
            each = found.shape[1]
            yield pd.DataFrame(
                {"signature": found.ravel(), "word": np.repeat(rows["word"].to_numpy(), each)}
            )


def near_words(spark: SparkSession, words: DataFrame) -> DataFrame:
    """Pairs a < b of words (of seven letters or more) one edit apart, each once."""
    ship_code(spark)
    signed = words.select("word").mapInPandas(_signed, "signature long, word string")
    signed = staged(spark, signed, "signatures", compression="zstd")
    a = signed.select("signature", F.col("word").alias("a"))
    b = signed.select("signature", F.col("word").alias("b"))
    near = F.levenshtein("a", "b", 1) == 1
    return a.join(b, "signature").where((F.col("a") < F.col("b")) & near).select("a", "b").distinct()


def last_forms(spark: SparkSession, forms: DataFrame) -> DataFrame:
    """Rows word, root: where the forms lead, for every word that has one.

    Every turn follows as many forms at once as all turns before. A chain is as long as
    the logarithm of its last word's number, for each form is ten times as frequent.
    """
    roots = staged(spark, forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        further = roots.select(F.col("word").alias("root"), F.col("root").alias("next"))
        followed = roots.join(further, "root", "left").select(
            "word",
            F.coalesce("next", "root").alias("root"),
            F.col("next").isNotNull().alias("moved"),
        )
        followed = staged(spark, followed, "roots")
        roots = followed.drop("moved")
        if followed.where("moved").isEmpty():
            return roots


def spelling_variants(
    spark: SparkSession, documents: DataFrame, least: int = 2, ratio: int = 10
) -> DataFrame:
    """Rows word, form, root, n, n_near, form_n: the words of all texts and what they vary.

    Words are runs of letters as ``word_counts`` finds them, at least ``least`` of each.
    ``form`` is the most frequent word one edit apart (the first in code-point order of
    several), if it is ``ratio`` times as frequent; ``root`` is where forms lead. Null
    and empty texts have no words; repeated rows count again; other columns are not
    read; an empty table gives no row.
    """
    words = staged(spark, word_counts(documents).where(F.col("n") >= least), "words")
    pairs = staged(spark, near_words(spark, words), "near-words")
    other = words.select(F.col("word").alias("other"), F.col("n").alias("other_n"))
    both = pairs.select(F.col("a").alias("word"), F.col("b").alias("other")).unionByName(
        pairs.select(F.col("b").alias("word"), F.col("a").alias("other"))
    )
    nearest = (
        both.join(other, "other")
        .groupBy("word")
        .agg(
            F.count("*").alias("n_near"),
            F.min(F.struct((-F.col("other_n")).alias("less"), "other")).alias("best"),
        )
    )
    best_n = -F.col("best.less")
    varies = best_n >= ratio * F.col("n")
    judged = staged(
        spark,
        words.join(nearest, "word", "left").select(
            "word",
            "n",
            F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
            F.when(varies, F.col("best.other")).alias("form"),
            F.when(varies, best_n).alias("form_n"),
        ),
        "judged-words",
    )
    roots = last_forms(spark, judged.where("form is not null"))
    return judged.join(roots, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"
    )
