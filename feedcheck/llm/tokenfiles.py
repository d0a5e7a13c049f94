"""Token ids as length-delimited binary records with an offset index.

A file is a sequence of records: length (unsigned 64-bit), masked checksum of the length
(unsigned 32-bit), payload, masked checksum of the payload. The payload is one sequence of
ids, two bytes each where the vocabulary has at most 65536 ids, else four; all integers are
little-endian. The checksum is CRC-32, rotated right by 15 bits plus a constant, so that a
checksum over data that holds checksums stays useful.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyarrow import fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from feedcheck.llm.bpe import codec
from feedcheck.llm.common import record_batches, small_batches
from feedcheck.session import new_folder

_MASK_DELTA = 0xA282EAD8
_HEAD = struct.Struct("<QI")
_FOOT = struct.Struct("<I")
FILE_BYTES = 128 << 20

INDEX_SCHEMA = "doc_id long, shard int, part int, nth long, file string, offset long, n_tokens long, before long, width int"


def masked_crc(data: bytes) -> int:
    c = zlib.crc32(data)
    return ((c >> 15 | c << 17) + _MASK_DELTA) & 0xFFFFFFFF


def frame(payload: bytes) -> bytes:
    head = struct.pack("<Q", len(payload))
    return head + _FOOT.pack(masked_crc(head)) + payload + _FOOT.pack(masked_crc(payload))


def read_frame(stream) -> bytes:
    """The payload of the record at the stream's position; a wrong checksum raises."""
    head = stream.read(_HEAD.size)
    if len(head) < _HEAD.size:
        raise ValueError("record cut off")
    size, check = _HEAD.unpack(head)
    if masked_crc(head[:8]) != check:
        raise ValueError("wrong checksum of a record's length")
    payload = stream.read(size)
    foot = stream.read(_FOOT.size)
    if len(payload) < size or len(foot) < _FOOT.size or masked_crc(payload) != _FOOT.unpack(foot)[0]:
        raise ValueError("wrong checksum of a record")
    return payload


def _store(uri: str) -> tuple[pafs.FileSystem, str]:
    return pafs.FileSystem.from_uri(uri) if ":" in uri else (pafs.LocalFileSystem(), uri)


def write_token_files(docs: DataFrame, tokenizer: str, end_id: int, folder: str | None = None) -> str:
    """Encode ``docs`` (``doc_id``, ``text``), add ``end_id`` to each sequence and write them in
    ascending doc_id order; returns the folder, with record files in ``data/`` and the offset
    index as Parquet in ``index/``.

    Texts are range-partitioned by id and encoded in order within each task, which writes its
    own files. A file is written under a name of its attempt and renamed when complete, so a
    task that runs again leaves the same files. ``folder`` must be reachable by all executors;
    by default it lies in the shared folder.

    A null text counts as empty and gives a sequence of ``end_id`` alone. Null ids come first;
    rows that share an id are all written, in order of their texts. An empty table gives an
    empty index.
    """
    spark = docs.sparkSession
    small_batches(spark)
    folder = folder or new_folder(spark, "tokens")
    out = pa.schema([("doc_id", pa.int64()), ("shard", pa.int32()), ("part", pa.int32()), ("nth", pa.int64()), ("file", pa.string()), ("offset", pa.int64()), ("n_tokens", pa.int64()), ("before", pa.int64()), ("width", pa.int32())])

    def rows(batches: Iterator[pa.RecordBatch]):
        enc, task = codec(tokenizer, library=True), TaskContext.get()
        end = np.array([end_id], enc.dtype).tobytes()
        store, base = _store(f"{folder}/data")
        shard, part, nth, before, offset, stream, name = task.partitionId(), 0, 0, 0, 0, None, ""
        attempt = f".attempt-{task.taskAttemptId()}"

        def close():
            stream.close()
            if store.get_file_info(f"{base}/{name}").type != pafs.FileType.NotFound:
                store.delete_file(f"{base}/{name}")
            store.move(f"{base}/{name}{attempt}", f"{base}/{name}")

        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                payload = enc.encode(text).tobytes() + end
                if stream is None:
                    name = f"shard-{shard:06d}-{part:04d}.bin"
                    store.create_dir(base, recursive=True)
                    stream, offset = store.open_output_stream(f"{base}/{name}{attempt}"), 0
                record, n = frame(payload), len(payload) // enc.dtype.itemsize
                stream.write(record)
                yield doc_id, shard, part, nth, f"{folder}/data/{name}", offset, n, before, enc.dtype.itemsize
                offset, before, nth = offset + len(record), before + n, nth + 1
                if offset >= FILE_BYTES:
                    close()
                    stream, part = None, part + 1
        if stream is not None:
            close()

    ordered = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").alias("text")).repartitionByRange("doc_id").sortWithinPartitions("doc_id", "text")
    ordered.mapInArrow(lambda batches: record_batches(rows(batches), out), INDEX_SCHEMA).write.parquet(f"{folder}/index")
    return folder


def read_index(spark, folder: str) -> DataFrame:
    """The offset index, with ``start``: ids of all sequences before each one."""
    index = spark.read.schema(INDEX_SCHEMA).parquet(f"{folder}/index")
    shards = index.groupBy("shard").agg(F.sum("n_tokens").alias("shard_tokens"))
    running = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)  # one row per file writer
    bases = shards.select("shard", F.coalesce(F.sum("shard_tokens").over(running), F.lit(0)).alias("base"))
    return index.join(bases, "shard").withColumn("start", F.col("base") + F.col("before"))


def read_sequences(index: DataFrame) -> DataFrame:
    """Read the sequences that ``index`` lists, in any order and selection, from their files:
    doc_id, start, ids (array of int). Each row seeks to its offset and checks both checksums."""
    return index.select("doc_id", "start", "file", "offset", "width").mapInArrow(lambda b: record_batches(((d, s, ids.tolist()) for d, s, ids in _records(b)), _IDS), "doc_id long, start long, ids array<int>")


_IDS = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("ids", pa.list_(pa.int32()))])
_DIGESTS = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64()), ("ids_crc32", pa.int64())])


def _records(batches: Iterator[pa.RecordBatch]):
    name, stream = None, None
    for batch in batches:
        for doc_id, start, file, offset, width in zip(*(c.to_pylist() for c in batch.columns)):
            if file != name:
                if stream is not None:
                    stream.close()
                store, path = _store(file)
                name, stream = file, store.open_input_file(path)
            stream.seek(offset)
            yield doc_id, start, np.frombuffer(read_frame(stream), f"<u{width}")
    if stream is not None:
        stream.close()


def sequence_digests(index: DataFrame) -> DataFrame:
    """doc_id, start, n_tokens and ids_crc32 (CRC-32 of the ids as little-endian unsigned
    32-bit integers) of the sequences that ``index`` lists, read from their files."""

    def rows(batches):
        for doc_id, start, ids in _records(batches):
            yield doc_id, start, len(ids), zlib.crc32(ids.astype("<u4").tobytes())

    return index.select("doc_id", "start", "file", "offset", "width").mapInArrow(lambda b: record_batches(rows(b), _DIGESTS), "doc_id long, start long, n_tokens long, ids_crc32 long")
