"""Latest timings of files as keyed state, which a timeout drops once the file is too old.

Files are dealt to buckets, and a bucket is one key: its files are merged by columns, in one call a batch, where a call
and several look-ups for every file would take most of the time.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from ..operators.stats import MAX_AGE_MS

KEYS = ["directory", "filename"]
BUCKETS = 1024
_PROVIDER = "spark.sql.streaming.stateStore.providerClass"
_ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
_FILE = "directory string, filename string"
_OUT = "file string, operation string, duration_ms int, at long, first_at long, kept boolean"
_HELD = pa.schema([("file", pa.string()), ("operation", pa.string()), ("duration_ms", pa.int32()), ("at", pa.int64()), ("first_at", pa.int64())])


def _packed(held: pd.DataFrame) -> bytes:
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, _HELD) as out:
        out.write_table(pa.Table.from_pandas(held, _HELD, preserve_index=False))
    return sink.getvalue().to_pybytes()


def _unpacked(data: bytes) -> pd.DataFrame:
    return _frame(pa.ipc.open_stream(data).read_all().to_pandas())


def _frame(rows: pd.DataFrame) -> pd.DataFrame:
    return rows.astype({"duration_ms": "Int32", "at": "int64", "first_at": "int64"})[_HELD.names]


def _merged(held: pd.DataFrame | None, batch: pd.DataFrame) -> pd.DataFrame:
    """The latest timing of each operation of each file, with the first time of the file (times in microseconds)."""
    batch = _frame(batch.assign(first_at=batch.groupby("file")["at"].transform("min")))
    # Of equal times the longest counts, and in a batch any before none.
    newest = batch.sort_values(["at", "duration_ms"], na_position="first", kind="stable").drop_duplicates(["file", "operation"], keep="last")
    if held is None:
        return newest
    both = pd.concat([newest, held], ignore_index=True)
    # A batch replaces what is held if it is later, or as late and longer.
    ranked = both.assign(took=both["duration_ms"].fillna(-1)).sort_values(["at", "took"], kind="stable")
    out = ranked.drop_duplicates(["file", "operation"], keep="last").drop(columns="took")
    return out.assign(first_at=out["file"].map(both.groupby("file")["first_at"].min()))


def _retention(max_age_ms: int):
    def of_bucket(key, batches, state: GroupState) -> Iterator[pd.DataFrame]:
        held = _unpacked(state.get[0]) if state.exists else None
        rows = [] if state.hasTimedOut else list(batches)
        if rows:
            batch = pd.concat(rows, ignore_index=True)
            held = _merged(held, batch)
            yield held[held["file"].isin(batch["file"])].assign(kept=True)
        if held is None:
            return
        # The last millisecond in which a file is young enough, and one more.
        leaves, now = held["first_at"] // 1000 + max_age_ms + 1, state.getCurrentWatermarkMs()
        gone = held[leaves <= now].drop_duplicates("file")
        if len(gone):
            none = pd.array([None] * len(gone), "Int32")
            yield gone.assign(operation=None, duration_ms=none, at=gone["first_at"], kept=False)
        stays = held[leaves > now]
        if len(stays):
            state.update((_packed(stays),))
            state.setTimeoutTimestamp(int(leaves[leaves > now].min()))
        else:
            state.remove()

    return of_bucket


def stream_retain(timings: DataFrame, max_age_ms: int = MAX_AGE_MS, delay: str = "0 seconds", buckets: int = BUCKETS) -> DataFrame:
    """What ``stats.retain`` keeps, as a stream of changes: the latest value of every operation of a file whenever
    the file is timed, and one row that is not ``kept`` (and has no operation) once the file's first timing is more
    than ``max_age_ms`` behind the watermark, ``delay`` behind the newest timing.

    State is one entry per file and operation, and leaves with the file. A file that is timed again after that
    begins anew. Timings behind the watermark are late and dropped, as are those without a time. A missing operation
    is one of its own. A call holds one of ``buckets`` shares of the files; their number stays for the life of a
    checkpoint, as state lies by it.
    """
    known = timings.filter("created_at is not null").withWatermark("created_at", delay)
    # The mark is no operation's name, as names hold no control character.
    rows = known.select(
        F.pmod(F.xxhash64(*KEYS), F.lit(buckets)).cast("int").alias("bucket"), F.to_json(F.struct(*KEYS)).alias("file"), F.coalesce("operation", F.lit("\x00")).alias("operation"),
        F.col("duration_ms").cast("int").alias("duration_ms"), F.unix_micros("created_at").alias("at"), "created_at",
    )
    out = rows.groupBy("bucket").applyInPandasWithState(_retention(max_age_ms), _OUT, "held binary", "update", GroupStateTimeout.EventTimeTimeout)
    times = [F.timestamp_micros(c).alias(n) for c, n in (("at", "created_at"), ("first_at", "first_at"))]
    out = out.withColumn("file", F.from_json("file", _FILE))
    return out.select("file.*", F.when(F.col("operation") != "\x00", F.col("operation")).alias("operation"), "duration_ms", *times, "kept")


@contextmanager
def _keyed_state(spark: SparkSession):
    """Streams started within keep their state in RocksDB, beside the heap."""
    before = spark.conf.get(_PROVIDER, None)
    spark.conf.set(_PROVIDER, _ROCKS)
    try:
        yield
    finally:
        spark.conf.set(_PROVIDER, before) if before else spark.conf.unset(_PROVIDER)


def write_retained(changes: DataFrame, out: str, **trigger):
    """Start a stream of :func:`stream_retain` that writes its changes under ``out``, a folder per batch. A repeated
    batch replaces its own."""

    def batch(df: DataFrame, batch_id: int) -> None:
        df.write.mode("overwrite").parquet(f"{out}/changes/batch_id={batch_id}")

    with _keyed_state(changes.sparkSession):
        writer = changes.writeStream.outputMode("update").foreachBatch(batch).option("checkpointLocation", f"{out}/_checkpoint")
        return writer.trigger(**trigger).start()


def retained(spark: SparkSession, out: str) -> DataFrame:
    """The timings that are kept by now: of every file the rows of its last batch, if it did not leave in it."""
    changes = spark.read.parquet(f"{out}/changes")
    # Within a batch, timers go off after the rows.
    last = changes.groupBy(*KEYS, "batch_id").agg(F.bool_and("kept").alias("stays")).groupBy(*KEYS).agg(F.max(F.struct("batch_id", "stays")).alias("last"))
    last = last.select(*KEYS, F.col("last.batch_id").alias("last_batch"), "last.stays").filter("stays")
    same = [changes[k].eqNullSafe(last[k]) for k in KEYS] + [changes["batch_id"] == last["last_batch"]]
    return changes.join(last, same, "left_semi").select(*KEYS, "operation", "duration_ms", "created_at", "first_at")
