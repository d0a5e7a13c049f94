"""Listing state that is kept between runs: versions in a shared folder, committed by one writer at a time."""

from __future__ import annotations

import hashlib
import json
import uuid
from dataclasses import asdict, dataclass

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, SparkSession

from ..session import delete_folder, materialise
from .listing import ListingState, filter_listing, new_files

# Versions that are kept; older ones are deleted as new ones are committed.
KEPT = 100


class StateConflict(RuntimeError):
    """Another writer has committed since this state was read."""


def fingerprint(directory: str, filters: dict) -> str:
    """Digest of a directory and its filters; a state holds for one of them only."""
    return hashlib.sha256(json.dumps([directory, filters], sort_keys=True).encode()).hexdigest()


class ListingStore:
    """States of one feed's listing, as files ``v<number>`` below ``path``.

    A version is written under another name and then renamed, which fails where the version is there: of two writers
    that read the same state, one commits. This holds as far as the file system's rename does not replace; it is atomic
    on HDFS, while a local disk tells an existing name just before. Files are a line of JSON each.
    """

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path, self._fs = spark, path.rstrip("/"), spark._jvm.org.apache.hadoop.fs
        conf = spark._jsparkSession.sessionState().newHadoopConf()
        self._files = self._fs.Path(self.path).getFileSystem(conf)
        self._context = self._fs.FileContext.getFileContext(self._files.getUri(), conf)

    def _versions(self) -> list[int]:
        folder = self._fs.Path(self.path)
        if not self._files.exists(folder):
            return []
        names = [s.getPath().getName() for s in self._files.listStatus(folder)]
        return sorted(int(n[1:]) for n in names if n[:1] == "v" and n[1:].isdigit())

    def read(self, key: str) -> tuple[int, ListingState]:
        """The newest version's number, 0 if none, and its state; a new state if it is for another fingerprint."""
        found = self._versions()
        if not found:
            return 0, ListingState()
        row = json.loads(self.spark.read.text(f"{self.path}/v{found[-1]}").first().value)
        state = ListingState(row["listed"], row["emitted"]) if row["fingerprint"] == key else ListingState()
        return found[-1], state

    def commit(self, key: str, version: int, state: ListingState) -> int:
        """Commit the version after ``version``; :class:`StateConflict` if it is not the newest any more."""
        found = self._versions()
        if (found[-1] if found else 0) != version:
            raise StateConflict(f"version {version} of {self.path} is not the newest")
        draft = self._fs.Path(f"{self.path}/draft-{uuid.uuid4().hex}")
        out = self._files.create(draft, False)
        out.write(bytearray((json.dumps({"fingerprint": key, **asdict(state)}) + "\n").encode()))
        out.close()
        plain = self.spark.sparkContext._gateway.new_array(getattr(self._fs, "Options$Rename"), 0)
        try:
            self._context.rename(draft, self._fs.Path(f"{self.path}/v{version + 1}"), plain)
        except Py4JJavaError as e:
            self._files.delete(draft, False)
            if e.java_exception.getClass().getSimpleName() != "FileAlreadyExistsException":
                raise
            raise StateConflict(f"version {version + 1} of {self.path} is there") from None
        for old in (v for v in found if v <= version - KEPT):
            delete_folder(self.spark, f"{self.path}/v{old}")
        return version + 1

    def reset(self) -> int:
        """Commit an empty state, from which the next cycle hands out all files."""
        found = self._versions()
        return self.commit("", found[-1] if found else 0, ListingState())


@dataclass(frozen=True)
class Cycle:
    """New files of a listing, fixed in a written table, and the state after them."""

    store: ListingStore
    files: DataFrame
    key: str
    version: int
    state: ListingState

    def commit(self) -> int:
        """To be called once the files are dealt with: without it, the next cycle hands them out again."""
        return self.store.commit(self.key, self.version, self.state)


def begin_cycle(listing: DataFrame, store: ListingStore, directory: str, now: Column, time: str = "modified_ms", **filters) -> Cycle:
    """New files of ``listing`` by ``filters`` (those of ``filter_listing``) since the stored state. A change of
    directory or filters starts from a new state. The listing is read once."""
    key = fingerprint(directory, filters)
    version, state = store.read(key)
    seen = materialise(filter_listing(listing, now, **filters), "listing")
    files, after = new_files(seen, state, time)
    return Cycle(store, files, key, version, after)
