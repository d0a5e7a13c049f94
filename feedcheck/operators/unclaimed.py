"""Landed files that no feed claims, and the ones that a feed does."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import codes
from ..functions.text import compiles, matches
from ..session import broadcast_if_small, materialise

KEYS = ["directory", "localhost"]
REPORT = [
    "file_uuid", "localhost", "file_name", "support_email_list", "quarantine_directory", "project", "directory", "port",
    "username", "private_key_path",
]


def is_claimed(name: Column, regexes: Column) -> Column:
    """Full match of any expression. They are joined into one, which Spark compiles once
    per run of rows of a directory; expressions that refer to their own groups or set
    flags cannot be joined and are tried one by one."""
    joined = F.array_join(F.transform(regexes, lambda r: F.concat(F.lit("(?:"), r, F.lit(")"))), "|")
    apart = F.exists(regexes, lambda r: r.rlike("\\\\[1-9Qk]|\\(\\?<[A-Za-z]|\\(\\?[A-Za-z-]"))
    return F.when(apart, F.exists(regexes, lambda r: matches(name, r))).otherwise(matches(name, joined))


def _broken_keys(rollup: DataFrame) -> DataFrame:
    """Directories with an expression that does not compile."""
    each = rollup.select(*KEYS, F.explode("regexes").alias("regex"))
    return each.filter(~compiles(F.col("regex"), whole=True)).select(*KEYS).distinct()


def broken_directories(rollup: DataFrame) -> DataFrame:
    """Rows of directories with an expression that does not compile: which of their files
    are claimed cannot be told."""
    return rollup.join(_broken_keys(rollup), KEYS, "left_semi")


def judged_directories(rollup: DataFrame) -> DataFrame:
    """Only directories that have an expression, and whose expressions all compile: one
    without any flags nothing. The rollup is written, as it is read several times."""
    known = materialise(rollup.filter(F.size("regexes") > 0), "rollup")
    return materialise(known.join(_broken_keys(known), KEYS, "left_anti"), "compiled")


def _with_regexes(listing: DataFrame, rollup: DataFrame) -> DataFrame:
    known = judged_directories(rollup)
    real = listing.filter(~F.col("file_name").isin(".", ".."))
    return real.join(broadcast_if_small(known), KEYS)


def unclaimed_files(listing: DataFrame, rollup: DataFrame) -> DataFrame:
    """Files of known directories that match none of the directory's expressions.

    ``listing`` has ``directory, localhost, file_name``; ``rollup`` has one row per
    directory and host with ``regexes``.
    """
    return _with_regexes(listing, rollup).filter(~is_claimed(F.col("file_name"), F.col("regexes")))


def claimed_files(listing: DataFrame, rollup: DataFrame) -> DataFrame:
    """Files that match, once per matching expression."""
    hits = F.filter("regexes", lambda r: matches(F.col("file_name"), r))
    return _with_regexes(listing, rollup).withColumn("file_regex", F.explode(hits))


def unclaimed_report(listing: DataFrame, rollup: DataFrame, reached: DataFrame | None = None, node: str = "0", find=None) -> DataFrame:
    """Report rows with ``log_type_id``; a host that could not be listed, and a directory
    with an expression that does not compile, give one row whose file name is the word
    null. ``reached`` has the directories and hosts that were listed; ``find`` may be
    ``patterns.unclaimed_by_index``, for many expressions in one directory."""
    found = (find or unclaimed_files)(listing, rollup).withColumn("log_type_id", F.lit(codes.UNCLAIMED_LISTED))
    out = found.withColumn("file_uuid", F.concat(F.lit(node + "-"), F.uuid())).select(*REPORT, "log_type_id")

    def one_row(rows: DataFrame, code: str) -> DataFrame:
        own = {"file_name": F.lit("null"), "file_uuid": F.concat(F.lit(node + "-"), F.uuid()), "log_type_id": F.lit(code)}
        return rows.withColumns(own).select(*REPORT, "log_type_id")

    out = out.unionByName(one_row(broken_directories(rollup), codes.LISTING_BAD_REGEX))
    if reached is None:
        return out
    lost = rollup.join(reached.select(*KEYS).distinct(), KEYS, "left_anti")
    return out.unionByName(one_row(lost, codes.UNCLAIMED_UNREACHABLE))
