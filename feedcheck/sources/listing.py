"""Listings of landed files, their filters and incremental state."""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import matches

DEFAULT_FILTER = "[^\\.].*"


def list_paths(spark: SparkSession, directory: str, recursive: bool = False) -> DataFrame:
    """``path, file_name, folder, size, modified`` of the files below a directory.

    File contents are not read. Names that start with ``_`` or ``.`` are never listed
    by Spark; a listing made elsewhere can be used with every function here.
    """
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", str(recursive).lower())
    df = reader.load(directory if recursive else f"{directory.rstrip('/')}/*")
    files = df.select(
        "path",
        F.element_at(F.split("path", "/"), -1).alias("file_name"),
        F.regexp_extract("path", "\\A(.*)/[^/]*\\z", 1).alias("folder"),
        F.col("length").alias("size"),
        F.col("modificationTime").alias("modified"),
    )
    if recursive:
        return files
    # The glob also looks into sub-folders; paths may show the file system's scheme.
    bare = re.sub(r"\A[a-z0-9]+:(//[^/]*)?(?=/)", "", directory).rstrip("/")
    return files.filter(F.col("folder").rlike(f"\\A(?:[a-z0-9]+:(?://[^/]*)?)?{re.escape(bare)}\\z"))


def listing_rows(listing: DataFrame, regex: str, conf_id: str, directory: str, host: str, node: str = "0") -> DataFrame:
    """Listing entries of the files whose whole name matches."""
    return listing.filter(matches(F.col("file_name"), regex)).select(
        F.date_format("modified", "yyyy-MM-dd HH:mm:ss").alias("listing_timestamp"),
        F.concat(F.lit(node + "-"), F.uuid()).alias("file_uuid"),
        F.lit(conf_id).alias("conf_id"),
        "file_name",
        F.lit(directory).alias("directory"),
        F.col("size").alias("actual_file_size"),
        F.lit(host).alias("localhost"),
    )


def list_files(
    spark: SparkSession, directory: str, regex: str, conf_id: str, host: str = "localhost", recursive: bool = False, node: str = "0"
) -> DataFrame:
    return listing_rows(list_paths(spark, directory, recursive), regex, conf_id, directory, host, node)


_SCHEME = r"\A[A-Za-z][A-Za-z0-9+.-]*:(//[^/]*)?(?=/)"


def _below(path: str, base: str) -> Column:
    """The part of a path column below ``base``; either may show the file system's scheme."""
    bare = re.sub(_SCHEME, "", base).rstrip("/")
    return F.substring(F.regexp_replace(path, _SCHEME, ""), F.lit(len(bare) + 2), F.length(path))


def segments_match(listing: DataFrame, base: str, name_regex: str = DEFAULT_FILTER) -> DataFrame:
    """Keep files whose name, and whose every folder below ``base``, matches: a folder
    that does not match is not entered."""
    parts = F.filter(F.split(_below("path", base), "/"), lambda p: p != "")
    return listing.filter(F.forall(parts, lambda p: matches(p, name_regex)))


def run_entries(listing: DataFrame, registry_id: str, now: Column | None = None, node: str = "0") -> DataFrame:
    """Run entries, sorted by path."""
    stamp = F.date_format(now if now is not None else F.current_timestamp(), "yyyy-MM-dd HH:mm:ss.SSS")
    flags = [F.lit(0).alias(c) for c in ("is_fetched", "is_locked", "is_success")]
    return listing.orderBy("path").select(
        stamp.alias("run_dt"),
        F.concat(F.lit(node + "-"), F.uuid()).alias("run_uuid"),
        F.lit(registry_id).alias("registry_id"),
        "file_name",
        F.col("folder").alias("file_path"),
        F.col("size").cast("string").alias("file_size"),
        *flags,
    )


def registry_id(body: Column) -> Column:
    """The ``id`` of a request's JSON body."""
    return F.get_json_object(body, "$.id")


def entries_json(listing: DataFrame) -> DataFrame:
    """Each entry as JSON text."""
    return listing.select(F.to_json(F.struct(*listing.columns)).alias("json"))


def filter_listing(
    listing: DataFrame,
    now: Column,
    min_size: int = 0,
    max_size: int | None = None,
    min_age_ms: int = 0,
    max_age_ms: int | None = None,
    path_re: str | None = None,
    name_re: str = DEFAULT_FILTER,
    ignore_hidden: bool = True,
    recursive: bool = True,
) -> DataFrame:
    """Size and age limits, both ends included; path pattern on a non-empty relative
    folder when recursing; whole-name pattern; hidden files.

    ``listing`` has ``file_name, relative, size, modified``.
    """
    age = F.unix_millis(now) - F.unix_millis(F.col("modified"))
    keep = (F.col("size") >= min_size) & (age >= min_age_ms)
    if max_size is not None:
        keep = keep & (F.col("size") <= max_size)
    if max_age_ms is not None:
        keep = keep & (age <= max_age_ms)
    if recursive and path_re is not None:
        keep = keep & ((F.coalesce("relative", F.lit("")) == "") | matches(F.col("relative"), path_re))
    keep = keep & matches(F.col("file_name"), name_re)
    if ignore_hidden:
        keep = keep & ~F.col("file_name").startswith(".")
    return listing.filter(keep)


def listing_attributes(listing: DataFrame, base: str) -> DataFrame:
    """Relative and absolute folder (each with a trailing slash), size and time."""
    relative = _below("folder", base)
    return listing.select(
        F.when(relative == "", F.lit("./")).otherwise(F.concat(relative, F.lit("/"))).alias("path"),
        F.col("file_name").alias("filename"),
        F.concat(F.col("folder"), F.lit("/")).alias("absolute_path"),
        F.col("size").cast("string").alias("file_size"),
        F.date_format("modified", "yyyy-MM-dd'T'HH:mm:ssZ").alias("file_last_modified_time"),
    )


@dataclass(frozen=True)
class ListingState:
    """Two times, in epoch milliseconds: newest seen and newest handed out. A change of
    directory or filter starts from a new state."""

    listed: int = -1
    emitted: int = -1


def new_files(listing: DataFrame, state: ListingState, time: str = "modified_ms") -> tuple[DataFrame, ListingState]:
    """Files not handed out yet, and the next state.

    The newest time is held back one cycle, because its files may still be arriving,
    unless it was already the newest last time. Files being copied are left out.
    """
    seen = listing.filter(~F.col("file_name").endswith("_COPYING_"))
    is_fresh = (F.col(time) >= state.listed) & (F.col(time) > state.emitted)
    fresh = seen.filter(is_fresh)
    # The two newest times say which are held back and which are handed out.
    times = seen.select(F.col(time).alias("t"), is_fresh.alias("fresh")).distinct()
    newest = times.orderBy(F.col("t").desc_nulls_last()).limit(2).collect()
    newest = [r for r in newest if r.t is not None]
    listed = max(state.listed, newest[0].t if newest else -1)
    held = [r.t for r in newest if r.fresh]
    if not held:
        return fresh, ListingState(listed, state.emitted)
    if held[0] != state.listed:
        fresh = fresh.filter(F.col(time) < held[0])
        held = held[1:]
    return fresh, ListingState(listed, max([state.emitted, *held[:1]]))
