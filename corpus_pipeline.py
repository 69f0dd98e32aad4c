"""The corpus pipeline: from raw documents to packed training sequences.

Each stage takes (spark, docs, sf_dir) and works on all rows that the stage before it
kept; all but the last return the columns of ``docs``, in their order. Rows may have
null values anywhere, repeat, and carry further columns of any name.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from freshet.llm.catalog import vocabulary_file
from freshet.llm.language_id import UNDETERMINED, learn_profiles, predicted
from freshet.llm.minhash import document_groups
from freshet.llm.mixing import mix_documents, word_count
from freshet.llm.packing import pack_documents
from freshet.llm.pii import found_in
from freshet.llm.staging import HANDED, arrow_rows, documents, ship_code, staged

LEAST_SCORE = 0.25  # of language identification; a text less near to any profile goes


def _free_name(docs: DataFrame, name: str) -> str:
    """A column name that ``docs`` does not have."""
    taken = {c.lower() for c in docs.columns}
    while name.lower() in taken:
        name += "_"
    return name


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a known language; those without letters or unlike any profile go.

    Profiles are learned from the stage's own labelled rows. Where there are none,
    nothing can be told apart and only documents without a letter go.
    """
    profiles = learn_profiles(spark, docs)
    if not profiles.languages:
        return docs.where(F.col("text").rlike(r"\p{L}"))
    found = _free_name(docs, "_language")
    judged = docs.withColumn(found, predicted("text", profiles))
    near = (F.col(f"{found}.lang_pred") != UNDETERMINED) & (F.col(f"{found}.score") >= LEAST_SCORE)
    with arrow_rows(spark, HANDED):
        return staged(spark, judged.where(near).select(*docs.columns), "judged", "zstd")


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document of smallest doc_id of each group of near copies, once.

    Rows equal in doc_id and text are copies too. Rows that share a doc_id but not a text
    stay or go each by its own text. Documents without words, and rows without doc_id,
    belong to no group and stay.
    """
    kept, told = _free_name(docs, "_kept"), _free_name(docs, "_told")
    chosen = document_groups(spark, docs).where("kept and doc_id is not null")
    chosen = chosen.select(F.col("doc_id").alias(kept), F.col("text_hash").alias(told)).distinct()
    same = (docs["doc_id"] == chosen[kept]) & (F.xxhash64(docs["text"]) == chosen[told])
    once = docs.join(chosen, same, "left_semi").dropDuplicates(["doc_id", "text"])
    return once.unionByName(docs.where(F.col("doc_id").isNull())).select(*docs.columns)


def mask_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, personal data replaced by its kind in brackets; n_chars follows the text."""
    ship_code(spark)
    found = _free_name(docs, "_found")
    masked = docs.withColumn(found, found_in("text")["masked"])
    text = F.when(F.col("text").isNotNull(), F.col(found))
    new = {"text": text, "n_chars": F.coalesce(F.length(text).cast("long"), F.col("n_chars"))}
    masked = masked.select(*(new[c].alias(c) if c in new else F.col(c) for c in docs.columns))
    with arrow_rows(spark, HANDED):
        return staged(spark, masked, "masked", "zstd")


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them: not at all, once or twice.

    Rows alike in doc_id, source and size share their copies in order of their text.
    """
    name = {c: _free_name(docs, f"_{c}") for c in ("id", "source", "size", "copies", "rows", "nth")}
    mixed = mix_documents(spark, docs, weights=(3, 1, 2), share=1.5, limit=2)
    taken = mixed.groupBy(
        F.col("doc_id").alias(name["id"]),
        F.col("source").alias(name["source"]),
        F.col("size").alias(name["size"]),
    ).agg(F.sum("copies").alias(name["copies"]), F.count("*").alias(name["rows"]))
    sized = docs.withColumn(name["nth"], word_count("text"))
    same = (
        F.col("doc_id").cast("long").eqNullSafe(F.col(name["id"]))
        & F.col("source").eqNullSafe(F.col(name["source"]))
        & (F.col(name["nth"]) == F.col(name["size"]))
    )
    alike = Window.partitionBy(name["id"], name["source"], name["size"]).orderBy("text")
    rows = sized.join(taken.where(F.col(name["copies"]) > 0), same)
    rows = rows.withColumn(name["nth"], F.row_number().over(alike))
    copies, of, nth = (F.col(name[c]) for c in ("copies", "rows", "nth"))
    each = (F.floor(copies * nth / of) - F.floor(copies * (nth - 1) / of)).cast("int")
    return rows.withColumn(name["nth"], F.explode(F.array_repeat(F.lit(1), each))).select(*docs.columns)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents, placed in sequences of at most 4096 tokens."""
    return pack_documents(spark, docs, vocabulary_file("word_bpe_49k.json"), end_id=1, capacity=4096)


STAGES = [
    ("language_id", identify_language),
    ("minhash_dedup", drop_near_duplicates),
    ("personal_data", mask_personal_data),
    ("source_mixing", mix_sources),
    ("packing", pack_sequences),
]

#: No SQL: learned profiles, a learned field, Newton's method and a tokenizer's ids.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the table of documents; each result is written and read again."""
    docs = documents(spark, sf_dir)
    for name, stage in STAGES:
        docs = staged(spark, stage(spark, docs, sf_dir), name.replace("_", "-"))
    return docs
