"""Language identification by rank-order profiles of character n-grams.

A language's profile is the list of its most frequent n-grams, most frequent first.
A document gets such a list too, and its out-of-place distance to a profile is the
sum, over its n-grams, of how far apart their two places are; an n-gram that a profile
lacks counts as far as can be. The nearest profile names the language.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StringType, StructField, StructType

from freshet.llm.ranks import spread
from freshet.llm.staging import HANDED, arrow_rows, handing_back, ship_code

PROFILE = 300  # n-grams in a language's profile and, at most, in a document's
LEARNED_FROM = 2000  # labelled documents per language, about, that profiles are learned from
UNDETERMINED = "und"
SIGN_BITS = 21  # of a code point; three of them make an n-gram's number

PREDICTION = StructType([StructField("lang_pred", StringType()), StructField("score", DoubleType())])


@functools.cache
def _letters() -> np.ndarray:
    return np.fromiter((chr(c).isalpha() for c in range(0x110000)), dtype=bool, count=0x110000)


def ngrams(text: str) -> np.ndarray:
    """Numbers of the 1- to 3-grams of a text's lower-cased words, with repeats.

    Words are runs of letters with a blank on either side; no n-gram spans two words,
    and the blank alone is none.
    """
    raw = text.lower().encode("utf-32-le", "surrogatepass")
    signs = np.frombuffer(raw, dtype="<u4").astype(np.int64)
    signs = np.where(_letters()[signs], signs, 0)
    signs = np.concatenate([[0], signs, [0]])
    signs = signs[np.concatenate([[True], (signs[1:] != 0) | (signs[:-1] != 0)])]
    if len(signs) < 3:
        return np.empty(0, dtype=np.int64)
    ones, inner = signs[signs != 0], signs[1:-1] != 0
    signs = np.maximum(signs, 1)  # a blank is 1, so that the number also tells the size
    twos = signs[:-1] << SIGN_BITS | signs[1:]
    threes = (signs[:-2] << 2 * SIGN_BITS | signs[1:-1] << SIGN_BITS | signs[2:])[inner]
    return np.concatenate([ones, twos, threes])


def ranking(grams: np.ndarray) -> np.ndarray:
    """The most frequent n-grams in order; ties by number."""
    met, counts = np.unique(grams, return_counts=True)
    return met[np.lexsort((met, -counts))[:PROFILE]]


@dataclass
class Profiles:
    """Places of n-grams: ``places[language, k]`` for the k-th of the sorted ``grams``."""

    languages: list[str]
    grams: np.ndarray
    places: np.ndarray

    @classmethod
    def of(cls, ranked: dict[str, list[int]]) -> Profiles:
        languages = sorted(ranked)
        grams = np.unique(np.array([g for lang in languages for g in ranked[lang]], dtype=np.int64))
        places = np.full((len(languages), len(grams)), -1, dtype=np.int64)
        for k, lang in enumerate(languages):
            places[k, np.searchsorted(grams, ranked[lang])] = np.arange(len(ranked[lang]))
        return cls(languages, grams, places)

    def distances(self, document: np.ndarray) -> np.ndarray:
        """Out-of-place distance of a document's ranking to every language."""
        at = np.minimum(np.searchsorted(self.grams, document), len(self.grams) - 1)
        known = self.grams[at] == document
        places = np.where(known, self.places[:, at], -1)
        apart = np.abs(places - np.arange(len(document)))
        return np.where(places < 0, PROFILE, np.minimum(apart, PROFILE)).sum(axis=1)

    def predict(self, text: str | None) -> tuple[str, float]:
        """Language and nearness (1: no n-gram out of place, 0: none in the profile)."""
        document = ranking(ngrams(text)) if text else np.empty(0)
        if not len(document) or not self.languages:
            return UNDETERMINED, 0.0
        distances = self.distances(document)
        nearest = int(distances.argmin())
        return self.languages[nearest], 1.0 - float(distances[nearest]) / (PROFILE * len(document))


def held_out(doc_id: str) -> Column:
    """Whether a document is kept from learning: CRC32 of its id as text, modulo 3, is 1."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")), F.lit(0)) % 3 == 1


def learn_profiles(
    spark: SparkSession, docs: DataFrame, learned_from: int = LEARNED_FROM
) -> Profiles:
    """Profiles of the languages in ``docs`` (doc_id, text, lang), without held-out rows.

    Each language is learned from about ``learned_from`` documents, picked by a hash of
    id and text, or from all it has if they are fewer. N-grams are counted per task and
    language before they are shuffled. The driver holds the profiles.
    """
    ship_code(spark)
    labelled = docs.select("doc_id", "text", F.col("lang").cast("string")).where(
        F.col("lang").isNotNull() & F.col("text").isNotNull() & ~held_out("doc_id")
    )
    share = labelled.groupBy("lang").agg(F.least(F.lit(1.0), learned_from / F.count("*")).alias("share"))
    shares = {r["lang"]: r["share"] for r in share.collect()}  # a line per language
    if not shares:
        return Profiles.of({})

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in handing_back(batches):
            for lang, texts in batch.groupby("lang")["text"]:
                # One sort per slice bounds memory whatever the batch holds.
                for at in range(0, len(texts), 200):
                    grams = np.concatenate([ngrams(t) for t in texts.iloc[at : at + 200]])
                    met, counts = np.unique(grams, return_counts=True)
                    yield pd.DataFrame({"lang": lang, "gram": met, "n": counts})

    bound = F.lit(0.0)
    for lang, part in shares.items():
        bound = F.when(F.col("lang") == lang, F.lit(part)).otherwise(bound)
    picked = labelled.where(spread("doc_id", "text") < bound * (1 << 32)).select("lang", "text")
    counted = picked.mapInPandas(count, "lang string, gram long, n long")
    order = Window.partitionBy("lang").orderBy(F.desc("n"), "gram")
    top = (
        counted.groupBy("lang", "gram")
        .agg(F.sum("n").alias("n"))
        .withColumn("place", F.row_number().over(order))
        .where(F.col("place") <= PROFILE)
    )
    ranked: dict[str, list[int]] = {}
    with arrow_rows(spark, HANDED):
        lines = top.collect()
    for r in sorted(lines, key=lambda r: (r["lang"], r["place"])):
        ranked.setdefault(r["lang"], []).append(r["gram"])
    return Profiles.of(ranked)


def predicted(text: str, profiles: Profiles) -> Column:
    """A struct of lang_pred and score for a text column."""

    @F.pandas_udf(PREDICTION)
    def predict(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for texts in handing_back(batches):
            yield pd.DataFrame([profiles.predict(t) for t in texts], columns=["lang_pred", "score"])

    return predict(F.col(text))


def identify_languages(
    spark: SparkSession, docs: DataFrame, learned_from: int = LEARNED_FROM
) -> DataFrame:
    """Learn from the labelled rows of ``docs`` (doc_id, text, lang) and predict all.

    Returns doc_id, held_out, lang_pred and score. A text that is null or has no letter is
    ``und`` with score 0, and so is every text if no row is labelled. The prediction
    reads the text alone. Repeated rows get equal predictions; equally near profiles
    are told apart by name. Other columns are not read.
    """
    profiles = learn_profiles(spark, docs, learned_from)
    return docs.select("doc_id", held_out("doc_id").alias("held_out"), "text").select(
        "doc_id", "held_out", predicted("text", profiles).alias("_found")
    ).select("doc_id", "held_out", "_found.lang_pred", "_found.score")
