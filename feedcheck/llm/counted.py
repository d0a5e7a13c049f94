"""Counts of hashed keys: words as 64-bit hashes, sorted arrays of keys with their counts, and
their exchange between tasks as packed blobs, one for each shard of the key space."""

from __future__ import annotations

import os
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from feedcheck.session import new_folder

#: Bytes of text for each shard, so that a shard's keys fit a task whatever the corpus.
SHARD_BYTES = 32 << 20
#: Keys that a task holds before it counts and sends them.
HELD_KEYS = 1 << 22
#: Bytes hashed at once.
BLOCK = 1 << 20

_P = 0x9E3779B97F4A7C15
_tables: dict[str, np.ndarray] = {}


def mixed(h: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit integers that scatters them."""
    h = h ^ (h >> np.uint64(30))
    h = h * np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(27)
    h = h * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def byte_classes(*classes: bytes) -> np.ndarray:
    """For each byte 0, or the number (from 1) of the class that holds it."""
    table = np.zeros(256, np.uint8)
    for n, members in enumerate(classes, 1):
        table[list(members)] = n
    return table


def _powers(n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    if "t" not in _tables:
        table = np.random.default_rng(7).integers(1, 1 << 64, 256, np.uint64)
        table[ord("A") : ord("Z") + 1] = table[ord("a") : ord("z") + 1]
        _tables["t"] = table
    if len(_tables.get("p", ())) < n:
        _tables["p"] = np.cumprod(np.full(n, _P, np.uint64))
        _tables["i"] = np.cumprod(np.full(n, pow(_P, -1, 1 << 64), np.uint64))
    return _tables["t"], _tables["p"], _tables["i"]


def text_column(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of a binary column without nulls, and where each text starts and the last one ends."""
    buffers = column.buffers()
    wide = pa.types.is_large_binary(column.type) or pa.types.is_large_string(column.type)
    at = np.frombuffer(buffers[1], np.int64 if wide else np.int32)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    data = np.frombuffer(buffers[2], np.uint8)[at[0] : at[-1]] if buffers[2] is not None else np.empty(0, np.uint8)
    return data, at - at[0]


def words_of(data: np.ndarray, at: np.ndarray, gap: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where each word (bytes of class 0) starts and stops; no word crosses the texts that start ``at``."""
    inside = np.zeros(len(data) + 2, bool)
    inside[1:-1] = gap[data] == 0
    edge = np.zeros(len(data) + 1, bool)
    edge[at] = True
    starts = np.flatnonzero(inside[1:] & (~inside[:-1] | edge))
    stops = np.flatnonzero(inside[:-1] & (~inside[1:] | edge))
    return starts, stops


def word_hashes(data: np.ndarray, starts: np.ndarray, stops: np.ndarray) -> np.ndarray:
    """Hashes of words, A-Z as a-z: a polynomial of the word's bytes modulo 2^64, mixed. A block of
    words is hashed at once, by differences of running sums."""
    out = np.empty(len(starts), np.uint64)
    first = 0
    while first < len(starts):
        base = starts[first]
        last = max(first + 1, int(np.searchsorted(stops, base + BLOCK, "right")))
        n = int(stops[last - 1] - base)
        table, power, inverse = _powers(max(n, BLOCK))
        sums = np.zeros(n + 1, np.uint64)
        np.cumsum(table[data[base : base + n]] * power[:n], out=sums[1:])
        s = starts[first:last] - base
        out[first:last] = (sums[stops[first:last] - base] - sums[s]) * inverse[s]
        first = last
    return mixed(out)


def counts_of(keys: np.ndarray, counts: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys in order, and how often each is met (or the sum of its counts)."""
    if not len(keys):
        return keys.astype(np.uint64), np.empty(0, np.int64)
    if counts is None:
        keys = np.sort(keys)
        first = np.flatnonzero(np.append(True, keys[1:] != keys[:-1]))
        return keys[first], np.diff(np.append(first, len(keys)))
    order = np.argsort(keys)
    keys = keys[order]
    first = np.flatnonzero(np.append(True, keys[1:] != keys[:-1]))
    return keys[first], np.add.reduceat(counts[order].astype(np.int64), first)


def least_type(counts: np.ndarray) -> np.dtype:
    return np.dtype("<" + np.min_scalar_type(int(counts.max()) if len(counts) else 0).str[1:])


def _planes(a: np.ndarray) -> bytes:
    """Bytes of integers, place by place, so that the shuffle's codec shortens places that are zero."""
    return np.ascontiguousarray(a.view(np.uint8).reshape(len(a), a.itemsize).T).tobytes()


def _whole(data: bytes, dtype: str) -> np.ndarray:
    size = np.dtype(dtype).itemsize
    return np.ascontiguousarray(np.frombuffer(data, np.uint8).reshape(size, -1).T).view(dtype).ravel()


def packed(keys: np.ndarray) -> bytes:
    """Sorted keys as differences."""
    return _planes(np.diff(keys, prepend=np.uint64(0)).astype("<u8"))


def unpacked(data: bytes) -> np.ndarray:
    return np.cumsum(_whole(data, "<u8"), dtype=np.uint64) if data else np.empty(0, np.uint64)


BLOBS = "shard int, keys binary, counts binary, width int"
BLOBS_SCHEMA = pa.schema([("shard", pa.int32()), ("keys", pa.binary()), ("counts", pa.binary()), ("width", pa.int32())])


def shard_of(scattered: np.ndarray, shards: int) -> np.ndarray:
    """Shard of a scattered key; shards are ranges of keys in order."""
    return ((scattered >> np.uint64(32)) * np.uint64(shards)) >> np.uint64(32)


def blobs(keys: np.ndarray, counts: np.ndarray, shard: np.ndarray) -> Iterator[tuple[int, bytes, bytes, int]]:
    """One row for each shard met: its keys (sorted and distinct) and counts, packed."""
    order = np.argsort(shard, kind="stable")
    shard = shard[order]
    first = np.flatnonzero(np.append(True, shard[1:] != shard[:-1])) if len(shard) else []
    for a, b in zip(first, np.append(first[1:], len(shard)) if len(shard) else []):
        mine = order[a:b]
        n = counts[mine]
        dtype = least_type(n)
        yield int(shard[a]), packed(keys[mine]), _planes(n.astype(dtype)), dtype.itemsize


class Tally:
    """Keys of one task, counted and sent whenever enough are held. ``place`` scatters keys to shards."""

    def __init__(self, shards: int, scattered: bool):
        self.shards, self.scattered = shards, scattered
        self.keys: list[np.ndarray] = []
        self.weights: list[np.ndarray] = []
        self.held = 0

    def add(self, keys: np.ndarray, weights: np.ndarray | None = None) -> Iterator[tuple]:
        self.keys.append(keys)
        if weights is not None:
            self.weights.append(weights)
        self.held += len(keys)
        if self.held >= HELD_KEYS:
            yield from self.flush()

    def flush(self) -> Iterator[tuple]:
        if self.held:
            keys, counts = counts_of(np.concatenate(self.keys), np.concatenate(self.weights) if self.weights else None)
            yield from blobs(keys, counts, shard_of(keys if self.scattered else mixed(keys), self.shards))
        self.keys, self.weights, self.held = [], [], 0


def sums(table: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    """Keys and summed counts of one shard's blobs."""
    keys = [unpacked(b) for b in table.column("keys").to_pylist()]
    counts = [_whole(b, f"<u{w}").astype(np.int64) for b, w in zip(table.column("counts").to_pylist(), table.column("width").to_pylist())]
    return counts_of(np.concatenate(keys), np.concatenate(counts))


def shards_for(docs: DataFrame) -> int:
    """Shards for the n-grams of ``docs`` (``text``), in proportion to their bytes."""
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    return max(1, -(-size // SHARD_BYTES))


def mapped_folder(spark: SparkSession, tag: str, folder: str | None = None) -> str:
    """A new folder that all workers can map into memory: in the shared folder, which has to be
    mounted on all machines. A store without paths cannot be mapped and is refused."""
    folder = folder or new_folder(spark, tag)
    path = folder.removeprefix("file:")
    path = "/" + path.lstrip("/") if folder.startswith("file:") else path
    if ":" in path.split("/")[0]:
        raise ValueError(f"arrays are mapped into memory, so their folder is a mounted path, not {folder}")
    return path


def write_array(folder: str, name: str, values: np.ndarray) -> None:
    """Write an array under a name of this attempt and rename it when complete, so that a task that
    runs again leaves the same file."""
    os.makedirs(folder, exist_ok=True)
    task = TaskContext.get()
    part = f"{folder}/{name}.attempt-{task.taskAttemptId() if task else 0}"
    with open(part, "wb") as f:
        np.save(f, values)
    os.replace(part, f"{folder}/{name}.npy")


def map_array(folder: str, name: str) -> np.ndarray:
    return np.load(f"{folder}/{name}.npy", mmap_mode="r")


class SortedArrays:
    """Sorted keys in shards, with columns beside them, mapped into memory when first asked for."""

    def __init__(self, folder: str, sizes: dict[int, int], shards: int, columns: tuple[str, ...] = ()):
        self.folder, self.sizes, self.shards, self.columns = folder, sizes, shards, columns
        self.mapped: dict[tuple[str, int], np.ndarray] = {}
        self.before, n = {}, 0
        for s in sorted(sizes):
            self.before[s], n = n, n + sizes[s]

    def array(self, column: str, shard: int) -> np.ndarray:
        if (column, shard) not in self.mapped:
            self.mapped[column, shard] = map_array(self.folder, f"{column}-{shard:07d}")
        return self.mapped[column, shard]

    def find(self, keys: np.ndarray) -> tuple[np.ndarray, dict[str, np.ndarray]]:
        """Place of each of the sorted ``keys`` among all, or -1, and what the columns hold there (0 where absent)."""
        place = np.full(len(keys), -1, np.int64)
        values = {c: np.zeros(len(keys), np.int64) for c in self.columns}
        shard = shard_of(keys, self.shards)
        first = np.flatnonzero(np.append(True, shard[1:] != shard[:-1])) if len(keys) else np.empty(0, np.int64)
        for a, b in zip(first, np.append(first[1:], len(keys))):
            s = int(shard[a])
            if not self.sizes.get(s):
                continue
            own = self.array("keys", s)
            at = np.searchsorted(own, keys[a:b])
            hit = own[np.minimum(at, len(own) - 1)] == keys[a:b]
            place[a:b][hit] = at[hit] + self.before[s]
            for c in self.columns:
                values[c][a:b][hit] = self.array(c, s)[at[hit]]
        return place, values
