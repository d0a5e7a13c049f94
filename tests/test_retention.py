"""The stream keeps what the batch keeps, whatever the batches."""

from datetime import datetime, timedelta

from pyspark.sql import functions as F

from feedcheck.operators.stats import retain
from feedcheck.streaming.retention import KEYS, retained, stream_retain, write_retained

SCHEMA = "directory string, filename string, operation string, duration_ms int, created_at timestamp"
START = datetime(2024, 5, 1)


def _at(minutes):
    return START + timedelta(minutes=minutes)


def _run(spark, folder, batch, n):
    spark.createDataFrame(batch, SCHEMA).coalesce(1).write.mode("append").parquet(f"{folder}/in")
    stream = spark.readStream.schema(SCHEMA).parquet(f"{folder}/in")
    write_retained(stream_retain(stream, 60 * 60_000, "5 minutes"), f"{folder}/out", availableNow=True).awaitTermination()
    return sorted(((r.directory, r.filename, r.operation, r.duration_ms, r.created_at) for r in retained(spark, f"{folder}/out").collect()), key=repr)


def test_stream_keeps_what_the_batch_keeps(spark, folder):
    batches = [
        [("/d", "a", "READ", 5, _at(0)), ("/d", "b", "READ", 6, _at(10)), ("/d", "a", "READ", 7, _at(1)), ("/d", "a", None, None, _at(2)), (None, "n", "READ", 1, _at(3)), ("/d", "x", "READ", 1, None)],
        # An earlier timing of b within the delay moves its timer; equal times: the longest counts.
        [("/d", "b", "WRITE", 1, _at(6)), ("/d", "c", "READ", 2, _at(20)), ("/d", "c", "READ", 3, _at(20)), ("/d", "a", "READ", 9, _at(12))],
        # The watermark becomes 66 minutes: files that began before 6 leave, b stays.
        [("/d", "e", "READ", 4, _at(71))],
        [("/d", "e", "READ", 5, _at(72))],
    ]
    seen = []
    for n, batch in enumerate(batches):
        got = _run(spark, folder, batch, n)
        seen += [r for r in batch if r[4] is not None]
        newest = max(r[4] for r in seen)
        want = retain(spark.createDataFrame(seen, SCHEMA).na.fill("none", ["directory"]), F.lit(newest - timedelta(minutes=5)), 60 * 60_000)
        rows = [(None if r.directory == "none" else r.directory, r.filename, r.operation, r.duration_ms, r.created_at) for r in want.collect()]
        assert got == sorted(rows, key=repr), n
    # A late row is dropped; a file that left begins anew.
    got = _run(spark, folder, [("/d", "a", "READ", 8, _at(80)), ("/d", "c", "READ", 9, _at(30))], 5)
    assert [r for r in got if r[1] in "ac"] == [("/d", "a", "READ", 8, _at(80)), ("/d", "c", "READ", 3, _at(20))]


def test_files_share_a_call(spark, folder):
    """One call merges all files of a bucket; a call for every file would take minutes for these."""
    def rows(n, plus):
        return spark.range(n).select(
            F.lit("/d").alias("directory"), F.concat(F.lit("f"), F.col("id") % (n // 2)).alias("filename"), F.when(F.col("id") % 3 > 0, F.lit("READ")).alias("operation"),
            F.col("id").cast("int").alias("duration_ms"), (F.lit(_at(plus)) + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), F.col("id") % 50)).alias("created_at"),
        )

    seen = None
    for plus in (0, 1):
        batch = rows(40_000, plus)
        batch.write.mode("append").parquet(f"{folder}/in")
        seen = batch if seen is None else seen.union(batch)
        stream = stream_retain(spark.readStream.schema(SCHEMA).parquet(f"{folder}/in"), 60 * 60_000, "5 minutes", buckets=3)
        assert "bucket" in stream._jdf.queryExecution().toString()
        write_retained(stream, f"{folder}/out", availableNow=True).awaitTermination()
    got = retained(spark, f"{folder}/out").select(*KEYS, "operation", "duration_ms", "created_at")
    want = retain(seen, F.lit(_at(2)), 60 * 60_000).select(got.columns)
    assert got.count() == want.count() >= 30_000 and got.exceptAll(want).count() == 0
