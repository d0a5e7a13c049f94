"""What several operators share: tables, bounded Arrow batches and bounded memos."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

BATCH_ROWS = 256
BATCH_BYTES = 8 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def small_batches(spark: SparkSession) -> None:
    """Bound what one Arrow batch of texts holds; the defaults count rows only, and
    thousands of long texts do not fit a Python worker."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))


def record_batches(rows: Iterator[tuple], schema: pa.Schema, size: int = 4096) -> Iterator[pa.RecordBatch]:
    """Tuples as record batches of at most ``size`` rows."""
    columns: list[list] = [[] for _ in schema]
    for row in rows:
        for c, v in zip(columns, row):
            c.append(v)
        if len(columns[0]) >= size:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)
            columns = [[] for _ in schema]
    if columns[0]:
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)


class Memo(dict):
    """A dictionary that computes what it lacks and holds two generations of half the limit: when the young
    one is full it becomes the old one, and what is asked for again moves back. So its memory is bounded,
    and frequent keys stay. Keys over ``longest`` are computed each time."""

    def __init__(self, compute: Callable, limit: int = 300_000, longest: int = 64):
        self.compute, self.limit, self.longest = compute, limit // 2, longest
        self.older: dict = {}

    def __missing__(self, key):
        value = self.older.get(key)
        if value is None:
            value = self.compute(key)
        if len(key) <= self.longest:
            if len(self) >= self.limit:
                self.older = dict(self)
                self.clear()
            self[key] = value
        return value
