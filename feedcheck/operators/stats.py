"""Statistics of timed operations on files."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialise

# Limits and defaults.
MAX_AGE_MS = 15 * 60 * 1000
MAX_OPERATION_MS = 10_000
MAX_LISTING_MS = 180_000


def operation_stats(timings: DataFrame) -> DataFrame:
    """Count, least, greatest, mean and population deviation per operation, over entries
    that took place; zeros where there are none."""
    took = F.when(F.col("duration_ms") >= 0, F.col("duration_ms"))
    zero = F.lit(0)
    return timings.groupBy("operation").agg(
        F.count(took).alias("n"),
        F.coalesce(F.min(took), zero).alias("min_ms"),
        F.coalesce(F.max(took), zero).alias("max_ms"),
        F.coalesce(F.avg(took), zero.cast("double")).alias("mean_ms"),
        F.coalesce(F.stddev_pop(took), zero.cast("double")).alias("std_ms"),
    )


def operation_outliers(timings: DataFrame) -> DataFrame:
    """Entries above 2 ms and above the mean plus two deviations of their operation.

    The statistics, one row per kind of operation, are written out, so that Spark knows
    their size and the timings stay where they are.
    """
    cut = operation_stats(timings).select("operation", (F.col("mean_ms") + 2 * F.col("std_ms")).alias("cutoff"))
    cut = materialise(cut, "cutoffs")
    directory = F.col("directory")
    full_path = F.concat(directory, F.when(directory.endswith("/"), F.lit("")).otherwise(F.lit("/")), F.col("filename"))
    found = timings.join(cut, "operation").filter((F.col("duration_ms") > 2) & (F.col("duration_ms") > F.col("cutoff")))
    return found.select("operation", full_path.alias("full_path"), "duration_ms")


def slow_operations(timings: DataFrame, limit_ms: int = MAX_OPERATION_MS, listing_ms: int = MAX_LISTING_MS) -> DataFrame:
    """Entries above their limit; listing a directory has its own."""
    limit = F.when(F.col("operation") == "LISTING", F.lit(listing_ms)).otherwise(F.lit(limit_ms))
    return timings.filter(F.col("duration_ms") > limit)


def first_rows(df: DataFrame, order: list[Column], n: int) -> DataFrame:
    """The first ``n`` rows in an order, without a task that holds them all.

    A sort ranges the rows over partitions, where each has its place. One row per
    partition, its size, says how many rows come before it.
    """
    place = F.monotonically_increasing_id()
    rows = materialise(df.orderBy(*order).withColumns({"__part": F.shiftright(place, 33), "__place": place.bitwiseAND(F.lit((1 << 33) - 1))}), "ordered")
    sizes = rows.groupBy("__part").agg(F.count(F.lit(1)).alias("__size"))
    # As many rows as the sort has partitions.
    before = F.coalesce(F.sum("__size").over(Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    starts = sizes.withColumn("__before", before).filter(F.col("__before") < n).drop("__size")
    return rows.join(F.broadcast(starts), "__part").filter(F.col("__before") + F.col("__place") < n).drop("__part", "__place", "__before")


def retain(timings: DataFrame, now: Column, max_age_ms: int = MAX_AGE_MS, max_entries: int | None = None) -> DataFrame:
    """Latest value per file and operation, of the files created since the cut-off; with
    ``max_entries`` only that many files, the newest first.

    A file's creation is its first timing. The latest value is an aggregate, combined
    before the shuffle. The entry limit may be of any size: see :func:`first_rows`.
    """
    cutoff = F.unix_millis(now) - max_age_ms
    files = timings.groupBy("directory", "filename").agg(F.min("created_at").alias("first_at"))
    files = files.filter(F.unix_millis("first_at") >= cutoff)
    if max_entries is not None:
        files = first_rows(files, [F.col("first_at").desc(), F.col("directory"), F.col("filename")], max_entries)
    latest = timings.groupBy("directory", "filename", "operation").agg(
        F.max(F.struct("created_at", "duration_ms")).alias("last")
    )
    return latest.join(files, ["directory", "filename"]).select(
        "directory", "filename", "operation", F.col("last.duration_ms").alias("duration_ms"), F.col("last.created_at").alias("created_at")
    )
