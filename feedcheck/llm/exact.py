"""Exact duplicates by a content sort, in DataFrame operations only."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from feedcheck.session import materialise


def exact_duplicates(docs: DataFrame, keep: str = "smallest", salts: int = 64, head_bytes: int = 32) -> DataFrame:
    """One row per row of ``docs`` (``doc_id``, ``text``): doc_id, keep_id, group_size, kept,
    text_sha256.

    Spark samples splitters and range-partitions the rows by the first bytes of the text,
    its SHA-256 and a salt of the id; each partition is sorted externally, so equal texts
    are neighbours, and each row is compared in full with the one before it. Two different
    texts of one digest would stop the job instead of being merged. The salt splits a text
    with very many copies over partitions; the sort key has a fixed length, so samples sent
    to the driver are small whatever the texts are. Counts per text are added up before
    they are shuffled, and rows without texts meet them in a join that Spark can split.

    ``keep`` is ``smallest`` or ``largest``. A null text equals the empty text. Null ids are
    outranked by any other; of rows that agree in id and text one is kept. Other columns are
    ignored, and an empty table gives an empty result.
    """
    if keep not in ("smallest", "largest"):
        raise ValueError("keep is smallest or largest")
    body = F.coalesce(F.col("text"), F.lit(""))
    rows = docs.select(
        F.col("doc_id"),
        body.alias("body"),
        F.sha2(body.cast("binary"), 256).alias("text_sha256"),
        F.substring(body.cast("binary"), 1, head_bytes).alias("head"),
        F.pmod(F.xxhash64("doc_id"), F.lit(salts)).alias("salt"),
    )
    key = ["head", "text_sha256", "salt"]
    side = Window.partitionBy(*key).orderBy("body", "doc_id")
    before, after = F.lag("body").over(side), F.lead(F.struct("doc_id")).over(side)
    same = F.when(before.isNull() | (before == F.col("body")), F.lit(1)).otherwise(F.raise_error(F.lit("two texts share a SHA-256")).cast("int"))
    sorted_rows = rows.repartitionByRange(*key).select(
        "doc_id",
        "text_sha256",
        same.alias("counted"),
        F.coalesce(~after["doc_id"].eqNullSafe(F.col("doc_id")) | after.isNull(), F.lit(True)).alias("last_of_id"),
    )
    staged = materialise(sorted_rows, "exact")
    pick = F.min if keep == "smallest" else F.max
    # Written, so that both sides of the join are plain shuffles and Spark may split a hot one.
    groups = materialise(staged.groupBy("text_sha256").agg(pick("doc_id").alias("keep_id"), F.sum("counted").alias("group_size")), "groups")
    return staged.join(groups, "text_sha256").select(
        "doc_id",
        "keep_id",
        "group_size",
        (F.col("last_of_id") & F.col("doc_id").eqNullSafe(F.col("keep_id"))).alias("kept"),
        "text_sha256",
    )


def without_copies(docs: DataFrame, keep: str = "smallest") -> DataFrame:
    """The rows of ``docs`` that :func:`exact_duplicates` keeps, with all their columns, whatever their
    names. Odd cases as there."""
    kept = exact_duplicates(docs, keep).filter("kept").select(F.col("doc_id").alias("kept_id"), F.col("text_sha256").alias("kept_sha"))
    # The caller's row is one column, so that none of its names can clash.
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))
    rows = rows.withColumn("sha", F.sha2(F.coalesce(F.col("row.text"), F.lit("")).cast("binary"), 256))
    rows = rows.join(kept, F.col("sha").eqNullSafe(F.col("kept_sha")) & F.col("row.doc_id").eqNullSafe(F.col("kept_id")), "left_semi")
    # Of rows that agree in id and text one stays; they are combined before they are shuffled.
    return rows.groupBy("sha", F.col("row.doc_id").alias("id")).agg(F.first("row").alias("row")).select("row.*")
