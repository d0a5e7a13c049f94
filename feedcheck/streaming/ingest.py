"""Continuous validation of landing files, and windowed statistics."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.dialect import Dialect
from ..operators.audit import write_audit
from ..operators.reconcile import compare
from ..plans.validation import validate_files
from ..session import pin_splits
from ..sources.lines import number_splits


def stream_lines(spark: SparkSession, directory: str, max_files: int | None = None) -> DataFrame:
    """Lines of new files as they land, with the split each came from."""
    pin_splits(spark)
    reader = spark.readStream.format("text")
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.load(directory).select(
        F.col("_metadata.file_path").alias("file_key"),
        F.col("_metadata.file_block_start").alias("chunk"),
        F.col("_metadata.file_block_length").alias("chunk_len"),
        F.col("_metadata.file_size").alias("file_size"),
        F.col("value").alias("line"),
    )


def validate_stream(lines: DataFrame, settings: dict, profile: str, d: Dialect, out: str, **options):
    """Validate every batch of whole files; returns the stream writer, not yet started.

    A file is never divided between batches, so its verdict is complete. A repeated
    batch replaces its own folders under ``out``, so results are written once.
    """

    def batch(df: DataFrame, batch_id: int) -> None:
        files = df.groupBy("file_key").agg(F.max("file_size").alias("actual_file_size"))
        name = F.element_at(F.split("file_key", "/"), -1)
        files = files.withColumn("file_name", name) if "file_name" not in settings else files
        src = number_splits(df.drop("file_size"), d)
        run = validate_files(src, files, profile, settings=settings, dialect=d, **options)
        run.decided.write.mode("overwrite").parquet(f"{out}/verdicts/batch_id={batch_id}")
        run.success_lines().write.mode("overwrite").parquet(f"{out}/success/batch_id={batch_id}")
        run.original_lines("failure").write.mode("overwrite").parquet(f"{out}/failure/batch_id={batch_id}")
        write_audit(run.audit("INFO"), f"{out}/audit", "INFO", batch_id)

    return lines.writeStream.foreachBatch(batch).option("checkpointLocation", f"{out}/_checkpoint")


def stream_operation_stats(timings: DataFrame, window: str = "15 minutes", delay: str = "15 minutes") -> DataFrame:
    """Statistics per operation and window of a stream of timings; late data beyond the
    delay is dropped, as the retention limit does."""
    took = F.when(F.col("duration_ms") >= 0, F.col("duration_ms"))
    return (
        timings.withWatermark("created_at", delay)
        .groupBy(F.window("created_at", window), "operation")
        .agg(
            F.count(took).alias("n"),
            F.min(took).alias("min_ms"),
            F.max(took).alias("max_ms"),
            F.avg(took).alias("mean_ms"),
            F.stddev_pop(took).alias("std_ms"),
        )
    )


def paired_arrivals(expected: DataFrame, landed: DataFrame, within: str = "1 day", delay: str = "1 hour") -> DataFrame:
    """Both sides of a manifest as they arrive, in any batch and order: file_name, expected_at, landed_at,
    claimed_count, actual_count, status.

    ``expected`` (``file_name``, ``expected_at``, ``claimed_count``) and ``landed`` (``file_name``, ``landed_at``,
    ``actual_count``) are streams. A file belongs to an expectation of its name if it lands no more than
    ``within`` before or after it. Pairs come out when the second side arrives; what is still alone when both
    watermarks (``delay`` behind the newest time of each side) have passed comes out once, as ``absent`` or
    ``unexpected``, and leaves the state. A null name meets nothing. Repeated rows give a pair each.
    """
    e = expected.withWatermark("expected_at", delay).withColumnRenamed("file_name", "expected_name")
    a = landed.withWatermark("landed_at", delay).withColumnRenamed("file_name", "landed_name")
    near = F.expr(f"expected_name = landed_name AND landed_at >= expected_at - INTERVAL {within} AND landed_at <= expected_at + INTERVAL {within}")
    status = (
        F.when(F.col("landed_at").isNull(), F.lit("absent"))
        .when(F.col("expected_at").isNull(), F.lit("unexpected"))
        .otherwise(compare(F.col("claimed_count"), F.col("actual_count")))
    )
    name = F.coalesce("expected_name", "landed_name").alias("file_name")
    return e.join(a, near, "full_outer").select(name, "expected_at", "landed_at", "claimed_count", "actual_count", status.alias("status"))
