"""Typed scans of delimited files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.delimited import split_line
from ..functions.dialect import Dialect
from ..functions.schema import FeedSchema, schema_from_header
from ..operators.validate import Checker, with_fields


def read_feed(spark: SparkSession, paths, d: Dialect, schema: FeedSchema | None = None, infer: bool = False, multiline: bool = False, **formats) -> DataFrame:
    """Read delimited files with Spark's csv reader.

    With ``schema`` the fields are typed by position; without one the first line names
    the columns, all text, or with ``infer`` typed from the data (``dateFormat`` and
    ``timestampFormat`` may be given). Only with ``multiline`` may a quoted value hold a
    line break; Spark then cannot split a file, so each is read by one task.
    """
    reader = spark.read.options(**d.read_options(), multiLine=multiline)
    if schema is not None and not infer:
        return reader.schema(schema.to_struct()).csv(paths)
    reader = reader.option("header", True).option("enforceSchema", False).options(**formats)
    return reader.option("inferSchema", infer).csv(paths)


def header_schema(spark: SparkSession, path: str, d: Dialect) -> FeedSchema:
    """All-text schema named by the first line of a file."""
    first = spark.read.option("encoding", d.encoding).text(path).filter(F.col("value") != "").select(split_line(F.col("value"), d).alias("f")).head()
    return schema_from_header(list(first.f)) if first else schema_from_header([])


def typed_records(lines: DataFrame, schema: FeedSchema, d: Dialect, keep: list[str], line: str = "line", strict: bool = True) -> DataFrame:
    """Typed columns of delimited lines; text that does not fit a type is null."""
    checker = Checker(schema, d, strict)
    rows = checker.prepare(with_fields(lines, d, line))
    return rows.select(*keep, *[checker.value(i, f).alias(f.name) for i, f in enumerate(schema.fields)])
