"""Listings that see every name and survive what they cannot read.

Spark's own listings leave out names that start with ``_`` or ``.`` and stop at a folder that cannot be read. Here the
folders of one level are spread over tasks, each of which lists its own; those whose names match make up the next
level. The driver only counts them. There are as many jobs as levels, and each level is written to the shared folder.
"""

from __future__ import annotations

import os
import stat
from collections.abc import Iterator
from functools import reduce

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import matches
from ..session import materialise
from .lines import scanned_key

_ROW = "path string, file_name string, folder string, relative string, kind string, size long, modified_us long, error string"
_COLUMNS = [c.split()[0] for c in _ROW.split(", ")]
_BATCH = 10_000  # rows that a task holds of a folder


def _mounted(path: str) -> str | None:
    """A path that the machine itself can open; none for other stores."""
    if path.startswith("file:"):
        return "/" + path[len("file:") :].lstrip("/")
    return None if "://" in path else path


def open_bytes(path: str):
    """A file opened for reading with seeks, where it is mounted or in a store that Arrow reads."""
    own = _mounted(path)
    if own is not None:
        return open(own, "rb")
    from pyarrow import fs

    store, inner = fs.FileSystem.from_uri(path)
    return store.open_input_file(inner)


def _entry(name: str, info: os.stat_result | None, error: str | None) -> tuple:
    """``file_name, kind, size, modified_us, error`` of a name in a folder."""
    if info is None:
        return name, "unreadable", None, None, error
    kind = "folder" if stat.S_ISDIR(info.st_mode) else "file"
    return name, kind, None if kind == "folder" else info.st_size, info.st_mtime_ns // 1000, None


def _local(path: str) -> Iterator[tuple]:
    with os.scandir(path) as found:
        for e in found:
            try:
                e.name.encode()
            except UnicodeEncodeError:
                yield os.fsencode(e.name).decode(errors="replace"), "unreadable", None, None, "name is not UTF-8"
                continue
            try:
                info = e.stat()
            except OSError as problem:
                yield _entry(e.name, None, type(problem).__name__)
                continue
            # A link to a folder may lead back to where it stands.
            yield (e.name, "link", None, None, None) if e.is_symlink() and stat.S_ISDIR(info.st_mode) else _entry(e.name, info, None)


def _stored(path: str) -> Iterator[tuple]:
    from pyarrow import fs

    store, inner = fs.FileSystem.from_uri(path)
    for e in store.get_file_info(fs.FileSelector(inner)):
        folder = e.type == fs.FileType.Directory
        yield e.base_name, "folder" if folder else "file", None if folder else e.size, None if e.mtime_ns is None else e.mtime_ns // 1000, None


def _list(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        for path, relative in zip(batch["path"], batch["relative"]):
            rows = []
            own = _mounted(path)
            try:
                for name, *rest in _local(own) if own is not None else _stored(path):
                    rows.append((f"{path.rstrip('/')}/{name}", name, path, relative, *rest))
                    if len(rows) == _BATCH:
                        yield _frame(rows)
                        rows = []
            except OSError as problem:
                above, _, name = path.rstrip("/").rpartition("/")
                rows.append((path, name, above, relative, "unreadable", None, None, type(problem).__name__))
            yield _frame(rows)


def _frame(rows: list[tuple]) -> pd.DataFrame:
    return pd.DataFrame(rows, columns=_COLUMNS).astype({"size": "Int64", "modified_us": "Int64"})


def walk(spark: SparkSession, directory: str, enter: str = ".*", recursive: bool = True) -> DataFrame:
    """Everything below a directory: ``path, file_key, file_name, folder, relative, kind, size, modified, error``.

    ``kind`` is ``file``, ``folder``, ``link`` (to a folder, which is not entered) or ``unreadable``: a folder that
    could not be listed, a name that leads nowhere, or one that is not UTF-8; ``error`` says why. Only folders whose
    whole name matches ``enter`` are entered. ``relative`` is the folder below ``directory``, empty there;
    ``file_key`` is the path as scans report it. Paths without a scheme have to be mounted on all machines; other stores
    are those that Arrow reads. A folder is listed by one task, in batches.
    """
    level = spark.createDataFrame([(directory.rstrip("/") or "/", "")], "path string, relative string")
    levels, n = [], 1
    while n:
        spread = level.repartition(min(n, 4 * spark.sparkContext.defaultParallelism))
        found = materialise(spread.mapInPandas(_list, _ROW), "level")
        levels.append(found)
        inner = F.concat_ws("/", F.when(F.col("relative") != "", F.col("relative")), "file_name")
        level = found.filter((F.col("kind") == "folder") & matches(F.col("file_name"), enter)).select("path", inner.alias("relative"))
        n = level.count() if recursive else 0
    every = reduce(DataFrame.unionByName, levels)
    return every.select(
        "path", scanned_key(spark, F.col("path")).alias("file_key"), "file_name", "folder", "relative", "kind", "size",
        F.timestamp_micros("modified_us").alias("modified"), "error",
    )


def walked_files(spark: SparkSession, directory: str, enter: str = ".*", recursive: bool = True) -> DataFrame:
    """The files of :func:`walk`, for ``filter_listing``, ``listing_rows`` and the like."""
    return walk(spark, directory, enter, recursive).filter("kind = 'file'").drop("kind", "error")
