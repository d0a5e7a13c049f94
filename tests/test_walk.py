"""Listings level by level: hidden names, folders that are not entered, and what cannot be read."""

import os

from pyspark.sql import functions as F

from feedcheck.sources import listing as ls
from feedcheck.sources import walk as wk


def _put(path, text="x"):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w") as out:
        out.write(text)


def _tree(folder):
    for name, text in [("a.txt", "aaa"), (".h", "h"), ("_s", ""), ("in/b.txt", "bb"), ("in/.deep/c d.txt", "c"), (".tmp/never.txt", "n"), ("in/ü/_x/e.txt", "e")]:
        _put(f"{folder}/{name}", text)
    os.makedirs(f"{folder}/empty")
    os.symlink(folder, f"{folder}/in/back")
    os.symlink(f"{folder}/nowhere", f"{folder}/in/lost")
    os.symlink(f"{folder}/a.txt", f"{folder}/in/again")


def test_every_name_is_seen(spark, folder):
    _tree(folder)
    got = {(r.relative, r.file_name): (r.kind, r.size, r.error) for r in wk.walk(spark, folder, enter="(?!\\.tmp).*").collect()}
    assert got == {
        ("", "a.txt"): ("file", 3, None), ("", ".h"): ("file", 1, None), ("", "_s"): ("file", 0, None),
        ("", "in"): ("folder", None, None), ("", ".tmp"): ("folder", None, None), ("", "empty"): ("folder", None, None),
        ("in", "b.txt"): ("file", 2, None), ("in", ".deep"): ("folder", None, None), ("in", "ü"): ("folder", None, None),
        ("in", "back"): ("link", None, None), ("in", "lost"): ("unreadable", None, "FileNotFoundError"), ("in", "again"): ("file", 3, None),
        ("in/.deep", "c d.txt"): ("file", 1, None), ("in/ü", "_x"): ("folder", None, None), ("in/ü/_x", "e.txt"): ("file", 1, None),
    }
    flat = wk.walk(spark, f"file://{folder}/", recursive=False)
    assert {r.file_name for r in flat.collect()} == {"a.txt", ".h", "_s", "in", ".tmp", "empty"}


def test_keys_are_those_of_scans(spark, folder):
    _tree(folder)
    seen = {r.k for r in spark.read.text(f"{folder}/in/.deep/c d.txt").select(F.col("_metadata.file_path").alias("k")).collect()}
    assert seen == {r.file_key for r in wk.walked_files(spark, folder).filter("file_name = 'c d.txt'").collect()}


def test_unreadable_folders(spark, folder, monkeypatch):
    """A folder that vanishes between two levels, and a directory that is not there, are rows and stop nothing."""
    _tree(folder)
    rows = wk.walk(spark, f"{folder}/absent").collect()
    assert [(r.file_name, r.kind, r.error) for r in rows] == [("absent", "unreadable", "FileNotFoundError")]
    batch = wk.pd.DataFrame({"path": [f"{folder}/gone", f"{folder}/a.txt", f"{folder}/in"], "relative": ["gone", "a", "in"]})
    out = wk.pd.concat(wk._list(iter([batch])))
    assert sorted(out[out["kind"] == "unreadable"]["error"]) == ["FileNotFoundError", "FileNotFoundError", "NotADirectoryError"]
    assert "b.txt" in set(out["file_name"])
    assert wk.walk(spark, f"{folder}/empty").count() == 0


def test_names_that_are_not_text(spark, folder):
    with open(os.fsencode(folder) + b"/\xff.txt", "w"):
        pass
    assert [(r.file_name, r.kind, r.error) for r in wk.walk(spark, folder).collect()] == [("�.txt", "unreadable", "name is not UTF-8")]


def test_large_folders_and_filters(spark, folder, monkeypatch):
    monkeypatch.setattr(wk, "_BATCH", 3)
    for i in range(10):
        _put(f"{folder}/d{i}/f{i}.csv", "x" * i)
    files = wk.walked_files(spark, folder)
    kept = ls.filter_listing(files, F.current_timestamp(), min_size=4, path_re="d[0-8]", name_re=".*\\.csv")
    assert sorted(r.file_name for r in kept.collect()) == [f"f{i}.csv" for i in range(4, 9)]
    assert sum(len(f) for f in wk._list(iter([wk.pd.DataFrame({"path": [folder], "relative": [""]})]))) == 10
