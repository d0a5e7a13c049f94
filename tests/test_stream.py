"""The stream gives the batch results, once."""

from datetime import datetime, timedelta

from feedcheck.functions.dialect import dialect
from feedcheck.streaming.ingest import stream_lines, stream_operation_stats, validate_stream
from pyspark.sql import functions as F

from .feeds import D2, settings


def test_files_are_validated_as_they_land(spark, folder):
    landing, out = f"{folder}/landing", f"{folder}/out"
    import os

    os.makedirs(landing)
    d = dialect(sep="|")
    s = {k: v for k, v in settings(header=1, location="header").items() if k != "file_name" and v is not None}

    def land(name, lines):
        with open(f"{landing}/{name}", "w") as f:
            f.write("\n".join(lines))

    def run():
        q = validate_stream(stream_lines(spark, landing, max_files=1), s, "data_only", d, out).trigger(availableNow=True).start()
        q.awaitTermination()

    land("a.txt", ["2", *D2])
    run()
    land("b.txt", ["3", *D2])
    run()
    run()
    v = {r.file_name: (r.code, r.actual_file_size is not None) for r in spark.read.parquet(f"{out}/verdicts").collect()}
    assert v == {"a.txt": ("225304", True), "b.txt": ("325306", False)}
    assert sorted(r.line for r in spark.read.parquet(f"{out}/success").collect()) == D2
    assert spark.read.parquet(f"{out}/failure").count() == 3
    assert sorted(r.log_type_id for r in spark.read.parquet(f"{out}/audit").collect()) == ["225304", "325306"]


def test_windowed_statistics(spark, folder):
    t0 = datetime(2024, 1, 1)
    rows = [("READ", 10, t0), ("READ", 30, t0 + timedelta(minutes=1)), ("READ", -1, t0), ("READ", 5, t0 + timedelta(hours=2))]
    spark.createDataFrame(rows, "operation string, duration_ms int, created_at timestamp").coalesce(1).write.parquet(f"{folder}/t")
    stream = spark.readStream.schema("operation string, duration_ms int, created_at timestamp").parquet(f"{folder}/t")
    q = stream_operation_stats(stream).writeStream.format("memory").queryName("op_stats").outputMode("complete").start()
    q.processAllAvailable()
    q.stop()
    got = spark.table("op_stats").orderBy(F.col("window.start")).collect()
    assert [(r.n, r.min_ms, r.max_ms, r.mean_ms, r.std_ms) for r in got] == [(2, 10, 30, 20.0, 10.0), (1, 5, 5, 5.0, 0.0)]
