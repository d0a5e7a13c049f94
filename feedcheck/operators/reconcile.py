"""Actual against claimed record counts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import as_long


def actual_counts(lines: DataFrame, header_n="header_n", footer_n="footer_n") -> DataFrame:
    """Records per file less header and footer; can go negative and then never matches."""
    keys = ["file_key"] + [c for c in (header_n, footer_n) if isinstance(c, str)]

    def n(v):
        return F.col(v) if isinstance(v, str) else F.lit(v)

    counts = lines.groupBy(*keys).agg(F.count(F.lit(1)).alias("records"))
    return counts.select("file_key", "records", (F.col("records") - n(header_n) - n(footer_n)).alias("actual_count"))


def claimed_text(text: Column, pattern) -> tuple[Column, Column]:
    """Whether the pattern is found anywhere in the text, and what it matched.

    Both are needed: an empty match is found, yet is no number.
    """
    pattern = F.lit(pattern) if isinstance(pattern, str) else pattern
    return F.rlike(text, pattern), F.call_function("regexp_extract", text, pattern, F.lit(0))


def claim_status(text: Column, pattern) -> tuple[Column, Column]:
    """``(status, count)`` of a claim in free text; status is null when it is usable."""
    found, match = claimed_text(text, pattern)
    count = as_long(match)
    status = F.when(text.isNull(), F.lit("no_text")).when(~found, F.lit("not_found")).when(count.isNull(), F.lit("unparsed"))
    return status, F.when(found, count)


def compare(claimed: Column, actual: Column) -> Column:
    return F.when(claimed == actual, F.lit("matched")).otherwise(F.lit("mismatched"))


def reconcile(claims: DataFrame, counts: DataFrame, key: str = "file_key") -> DataFrame:
    """Status per file that makes a claim; a file without lines counts 0.

    ``claims`` has ``key, claimed_text`` and optionally ``location``; ``counts`` has
    ``key, actual_count``.
    """
    joined = claims.join(counts.select(key, "actual_count"), key, "left").withColumn(
        "actual_count", F.coalesce("actual_count", F.lit(0).cast("bigint"))
    )
    claimed = as_long(F.col("claimed_text"))
    status = (
        F.when(F.col("claimed_text").isNull(), F.lit("not_found"))
        .when(claimed.isNull(), F.lit("unparsed"))
        .otherwise(compare(claimed, F.col("actual_count")))
    )
    if "location" in claims.columns:
        status = F.when(F.lower("location") == "none", F.lit("skipped")).otherwise(status)
    return joined.withColumns({"claimed_count": claimed, "status": status})


def reconcile_manifest(manifest: DataFrame, data: DataFrame, key: str, claimed: str, actual: str) -> DataFrame:
    """Both sides of a manifest: expected files that are absent, files nobody expected,
    and whether the counts of the others agree. Each side has one row per key."""
    m = manifest.select(key, F.col(claimed).alias("claimed_count"))
    a = data.select(key, F.col(actual).alias("actual_count"))
    status = (
        F.when(F.col("claimed_count").isNull(), F.lit("unexpected"))
        .when(F.col("actual_count").isNull(), F.lit("absent"))
        .otherwise(compare(F.col("claimed_count"), F.col("actual_count")))
    )
    return m.join(a, key, "full_outer").withColumn("status", status)
