"""Line numbers, header and footer sections, record ids."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import broadcast_if_small, materialise
from ..sources.lines import CHUNK, LineSource


def chunk_offsets(src: LineSource) -> DataFrame:
    """One row per chunk with the number of lines before it and in its whole file."""
    whole = Window.partitionBy("file_key")
    before = whole.orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    return src.chunks.select(
        *CHUNK,
        "base",
        F.coalesce(F.sum("n_lines").over(before), F.lit(0)).alias("lines_before"),
        F.sum("n_lines").over(whole).alias("total_lines"),
    )


def number_lines(src: LineSource, files: DataFrame | None = None, keep_unlisted: bool = False) -> DataFrame:
    """Rows with ``line_no`` (from 1) and ``total_lines``, plus the columns of ``files``.

    Per-file columns are joined to the chunk frame first. The big join is then on the
    chunk, so a file with a third of all lines is still spread over all its chunks.
    Lines of files that ``files`` does not list are left out unless asked for.
    """
    offsets = chunk_offsets(src)
    if files is not None:
        offsets = offsets.join(files.withColumn("__listed", F.lit(True)), "file_key", "left")
        if not keep_unlisted:
            offsets = offsets.withColumn("__listed", F.coalesce("__listed", F.lit(False)))
    if not src.partitioned:
        # Written out, the frame has a known size: one row per input split. Up to the
        # limit it goes to the lines; beyond it the lines are shuffled by split.
        offsets = broadcast_if_small(materialise(offsets, "offsets"), max_rows=4_000_000)
    joined = src.rows.join(offsets, CHUNK, "left")
    if files is not None and not keep_unlisted:
        # Null means that the chunk has no count at all, which the next step reports.
        joined = joined.filter(F.coalesce("__listed", F.lit(True)))
    lost = F.raise_error(F.lit("input splits changed between two scans of the same files")).cast("bigint")
    line_no = F.coalesce(F.col("lines_before") + F.col("seq") - F.col("base") + 1, lost)
    return joined.withColumn("line_no", line_no).drop("chunk", "chunk_len", "seq", "base", "lines_before", "__listed")


def section(header_n: Column, footer_n: Column) -> Column:
    """``header`` for the first N records, ``footer`` for the last M, else ``data``.
    A record that is both is a header record."""
    return (
        F.when(F.col("line_no") <= header_n, F.lit("header"))
        .when(F.col("line_no") > F.col("total_lines") - footer_n, F.lit("footer"))
        .otherwise(F.lit("data"))
    )


def frame(numbered: DataFrame, header_n="header_n", footer_n="footer_n") -> DataFrame:
    def count(v):
        return F.lit(v) if isinstance(v, int) else F.col(v)

    return numbered.withColumn("section", section(count(header_n), count(footer_n)))


def with_record_id(framed: DataFrame, header_n="header_n") -> DataFrame:
    """Position among the data records; invalid records use up ids too."""
    n = F.lit(header_n) if isinstance(header_n, int) else F.col(header_n)
    return framed.withColumn("record_id", F.when(F.col("section") == "data", F.col("line_no") - n))


def chosen_file_id(choice: Column, file_uuid: Column, file_id: Column) -> Column:
    return F.when(F.lower(choice) == "file_uuid", file_uuid).otherwise(file_id)


def rows_text(rows: Column, sep: Column | str) -> Column:
    """Text of collected ``(line_no, fields)`` rows: every value followed by the
    separator, records joined by a line feed, a null value printed as ``null``;
    null when there is no record."""
    sep = F.lit(sep) if isinstance(sep, str) else sep

    def record(r):
        values = F.transform(r["fields"], lambda v: F.concat(F.coalesce(F.when(v != "", v), F.lit("null")), sep))
        return F.array_join(values, "")

    lines = F.transform(F.array_sort(rows), record)
    return F.when(F.size(rows) > 0, F.array_join(lines, "\n"))


def section_text(framed: DataFrame, which: str, sep: str = "|") -> DataFrame:
    """One row per file with the text of its header or footer, which holds N or M rows."""
    rows = framed.filter(F.col("section") == which).groupBy("file_key")
    return rows.agg(F.collect_list(F.struct("line_no", "fields")).alias("__rows")).select(
        "file_key", rows_text(F.col("__rows"), sep).alias(f"{which}_text")
    )
