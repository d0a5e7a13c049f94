"""Writers of delimited text and of partitioned tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.delimited import render_line
from ..functions.dialect import Dialect


def project_to(df: DataFrame, target: list[str], extras: str = "append") -> DataFrame:
    """Columns by name in target order, absent ones null; then, or not, all others."""
    named = [F.col(f"`{n}`") if n in df.columns else F.lit(None).cast("string").alias(n) for n in target]
    rest = [F.col(f"`{c}`") for c in df.columns if c not in target] if extras == "append" else []
    return df.select(*named, *rest)


def line_column(df: DataFrame, d: Dialect) -> Column:
    """All columns of a frame as one line in the dialect."""
    numeric = [isinstance(f.dataType, T.NumericType) for f in df.schema.fields]
    return render_line([F.col(f"`{c}`").cast("string") for c in df.columns], d, numeric)


def write_feed(df: DataFrame, path: str, d: Dialect, mode: str = "errorifexists") -> None:
    """Write delimited text, with one header line per file where the dialect has one.

    Spark's csv writer serves the quote modes it knows; the others, and a trailing
    delimiter, are rendered as lines, in UTF-8. A value with a line break stands in quotes,
    or in a mode without quotes as an escape.
    """
    quote_mode = d.quote_mode.upper()
    if quote_mode in ("ALL", "MINIMAL") and not d.trailing_delimiter and d.quote:
        own_escape = d.escape and d.escape != d.quote
        df.write.mode(mode).options(
            sep=d.sep,
            quote=d.quote,
            escape=d.escape if own_escape else d.quote,
            quoteAll=quote_mode == "ALL",
            header=d.include_header,
            lineSep=d.record_separator,
            nullValue=d.null_string or "",
            emptyValue="",
            encoding=d.encoding,
            ignoreLeadingWhiteSpace=False,
            ignoreTrailingWhiteSpace=False,
        ).csv(path)
        return
    if d.encoding.upper() != "UTF-8":
        raise ValueError(f"rendered lines are written in UTF-8, not in {d.encoding}")
    line = line_column(df, d)
    if d.include_header:
        names = render_line([F.lit(c) for c in df.columns], d)
        if df.isEmpty():
            df.sparkSession.range(1).select(names.alias("value")).write.mode(mode).options(lineSep=d.record_separator).text(path)
            return
        # A task writes one file; its first row, whose number within the task is 0, brings the header along.
        first = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1)) == 0
        line = F.when(first, F.concat(names, F.lit(d.record_separator), line)).otherwise(line)
    df.select(line.alias("value")).write.mode(mode).options(lineSep=d.record_separator).text(path)


def write_lines(lines: DataFrame, path: str, key: str = "file_key", order: str | None = None, mode: str = "errorifexists") -> None:
    """Write rendered lines into one folder per file.

    With an order column the parts of a file, taken by name, hold its lines in order.
    Ranges are cut inside large files too, so no task writes one alone. Without order, lines of a
    file are brought together and large files split, so that not every task writes to every folder.
    """
    if order is not None:
        lines = lines.repartitionByRange(key, order).sortWithinPartitions(key, order)
    else:
        lines = lines.hint("rebalance", F.col(key))
    lines.select(key, F.col("line").alias("value")).write.mode(mode).partitionBy(key).text(path)


def write_partitioned(df: DataFrame, columns: list[str], path: str, mode: str = "append", rows_per_file: int = 10_000_000) -> None:
    """Write a table partitioned by ``columns``.

    The rebalance hint brings rows of a partition together, so that not every task
    writes a file in every partition, and splits a partition that holds too much.
    """
    out = df.hint("rebalance", *[F.col(c) for c in columns])
    out.write.mode(mode).option("maxRecordsPerFile", rows_per_file).partitionBy(*columns).parquet(path)
