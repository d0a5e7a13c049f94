"""From raw documents to packed sequences: each stage calls one operator, on what the stage before kept."""

from __future__ import annotations

import os
import sys

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from feedcheck.llm import exact, langid, minhash, packing, suffixes  # noqa: E402
from feedcheck.llm.common import table  # noqa: E402
from feedcheck.llm.queries import END_ID, tokenizer_file  # noqa: E402
from feedcheck.session import delete_table, materialise, scratch  # noqa: E402


def numbered(docs: DataFrame, tag: str) -> DataFrame:
    """One column ``row`` with all columns of ``docs``, and ``number``, which no two rows share: the id, or
    where ids are repeated or null, the place of the row in order of id (null ids last) and text."""
    odd = docs.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n")).filter("n > 1 or doc_id is null")
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))
    if odd.isEmpty():
        return rows.withColumn("number", F.col("row.doc_id"))
    order = [F.col("row.doc_id").asc_nulls_last(), F.sha2(F.coalesce(F.col("row.text"), F.lit("")).cast("binary"), 256)]
    return materialise(rows.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("number", F.monotonically_increasing_id()), tag, keep=True)


def judged_by_number(rows: DataFrame) -> DataFrame:
    """The texts, with the number as id."""
    return rows.select(F.col("number").alias("doc_id"), F.col("row.text").alias("text"))


def only(rows: DataFrame, numbers: DataFrame) -> DataFrame:
    """The rows whose number is among ``numbers``, as they came."""
    return rows.join(numbers, "number", "left_semi").select("row.*")


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a language that the labelled ones teach; those without any go, as do null and empty texts.
    Rows are judged one by one, also where ids are repeated or null; all columns stay, whatever their names;
    of an empty table nothing is left."""
    with scratch(spark):
        rows = numbered(docs, "numbered")
        judged = langid.predict(judged_by_number(rows), langid.fit(docs))
        known = materialise(judged.filter(F.col("lang_pred") != langid.UNKNOWN).select(F.col("doc_id").alias("number")), "language", keep=True)
    return only(rows, known)


def exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each text, the one with the smallest id, a null id only where no other is there; a null
    text equals the empty one. All columns stay; of an empty table nothing is left."""
    return exact.without_copies(docs, keep="smallest")


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates (a similarity of 0.8 or more), the one with the
    smallest id; null ids are outranked by any other, and rows that share an id are documents of their own.
    Texts without words have no duplicates. All columns stay; of an empty table nothing is left."""
    with scratch(spark):
        rows = numbered(docs, "numbered")
        judged = minhash.near_duplicates(judged_by_number(rows), percent=80)
        kept = materialise(judged.filter("kept").select(F.col("doc_id").alias("number")), "near", keep=True)
    return only(rows, kept)


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without passages of over 50 words, and without strings of 400 bytes, that are met more than once;
    texts of which nothing is left go. Ids decide nothing; null texts stay as they are, all columns stay, and
    of an empty table nothing is left."""
    return suffixes.without_repeats(docs, size=400, words=51)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of sequences of at most 4096 ids. A null text is an end alone; rows that share an id, or have none,
    are packed one after another; other columns are ignored, and an empty table gives no rows."""
    return packing.pack_documents(docs, tokenizer_file("word_bpe_49k.json"), END_ID, size=4096)


STAGES = [
    ("language", language),
    ("exact_copies", exact_copies),
    ("near_copies", near_copies),
    ("repeated_passages", repeated_passages),
    ("packing", packed),
]

#: The stages are not all expressible in SQL; tests/llm holds them against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages to ``documents``; each result is written and read again, and what only
    earlier stages read is deleted."""
    docs = given = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        with scratch(spark):
            after = materialise(stage(spark, docs, sf_dir), name, keep=True)
        if docs is not given:
            delete_table(docs)
        docs = after
    return STAGES[-1][1](spark, docs, sf_dir)
