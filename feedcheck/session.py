"""Shared folder, written intermediate tables and checked broadcasts."""

from __future__ import annotations

import contextvars
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def work_dir(spark: SparkSession) -> str:
    """The shared folder for written intermediates: ``spark.checkpoint.dir``, which every
    executor reaches, else a folder in the warehouse, which is shared as well."""
    configured = spark.conf.get("spark.checkpoint.dir", None)
    return (configured or spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/feedcheck-work").rstrip("/")


_scopes: contextvars.ContextVar[tuple[list[str], ...]] = contextvars.ContextVar("scopes", default=())


def new_folder(spark: SparkSession, tag: str, keep: bool = False) -> str:
    """A new folder in the shared folder. Within :func:`scratch` it is deleted at the end, or with
    ``keep`` at the end of the scope around that one."""
    path = f"{work_dir(spark)}/{tag}-{uuid.uuid4().hex}"
    scopes = _scopes.get()[:-1] if keep else _scopes.get()
    if scopes:
        scopes[-1].append(path)
    return path


def delete_folder(spark: SparkSession, path: str) -> None:
    """Delete a folder that this library wrote, on whatever file system it lies."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).delete(target, True)


def delete_table(df: DataFrame) -> None:
    """Delete the folder of a table that :func:`materialise` wrote and that nothing reads any more."""
    for path in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
        delete_folder(df.sparkSession, path)


@contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """Delete the tables that :func:`materialise` writes within the block when it ends, but those written
    with ``keep``. Nothing lazy that reads them may leave the block."""
    mine: list[str] = []
    token = _scopes.set((*_scopes.get(), mine))
    try:
        yield
    finally:
        _scopes.reset(token)
        for path in mine:
            delete_folder(spark, path)


def materialise(df: DataFrame, tag: str, keep: bool = False) -> DataFrame:
    """Write ``df`` as a table in the shared folder and read it back; ``keep`` as in :func:`new_folder`.

    Cuts the lineage with data that survives a lost executor, and gives later
    joins a true size: Spark broadcasts the table only if its files are small.
    """
    spark = df.sparkSession
    path = new_folder(spark, tag, keep)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def broadcast_if_small(df: DataFrame, max_rows: int = 200_000, max_bytes: int = 64 << 20) -> DataFrame:
    """Add a broadcast hint after measuring rows and bytes; larger frames stay as
    they are, so Spark shuffles the join and splits skewed partitions at run time."""
    width = F.length(F.to_json(F.struct(*df.columns)))
    seen = df.agg(F.count(F.lit(1)).alias("n"), F.sum(width).alias("b")).first()
    if seen.n <= max_rows and (seen.b or 0) <= max_bytes:
        return F.broadcast(df)
    return df


def pin_splits(spark: SparkSession) -> None:
    """Keep file splits equal between two scans of the same files.

    Spark derives the split size from the cores it sees, and those change under
    dynamic allocation; a fixed minimum partition count removes that dependency.
    """
    if spark.conf.get("spark.sql.files.minPartitionNum", None) is None:
        spark.conf.set("spark.sql.files.minPartitionNum", str(spark.sparkContext.defaultParallelism))
