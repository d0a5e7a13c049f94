"""Worksheet cells to delimited lines."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import codes
from ..session import materialise


def cell_text(date_format: str = "yyyyMMddHHmmss") -> Column:
    """Text of a cell by its type. Whole numbers print as integers, others in shortest
    form; blank and error cells are empty."""
    num = F.col("num")
    number = F.when(num == F.floor(num), F.floor(num).cast("string")).otherwise(num.cast("string"))
    kind = F.upper("type")
    text = (
        F.when(kind.isin("STRING", "FORMULA_STRING"), F.col("str"))
        .when(kind.isin("NUMERIC", "FORMULA_NUMERIC"), number)
        .when(kind == "DATE", F.date_format("ts", date_format))
    )
    return F.coalesce(text, F.lit(""))


def cells_to_lines(cells: DataFrame, sep: str = "|", date_format: str = "yyyyMMddHHmmss") -> DataFrame:
    """One line per row of each sheet; missing cells are empty. A value that contains the
    separator is quoted, except in the last column of its row.

    Only a row's own cells are gathered.
    """
    rows = cells.select("file", "sheet", "row", F.col("col").alias("c"), cell_text(date_format).alias("t"))
    rows = rows.groupBy("file", "sheet", "row").agg(F.array_sort(F.collect_list(F.struct("c", "t"))).alias("cells"), F.max("c").alias("last"))
    # Of a cell that is given twice the first in order counts; such a file does not convert.
    cells_once = F.filter("cells", lambda x, i: (i == 0) | (x["c"] != F.get(F.col("cells"), i - 1)["c"]))
    rows = rows.withColumn("m", F.map_from_entries(cells_once))

    def shown(c):
        t = F.coalesce(F.element_at(F.col("m"), c), F.lit(""))
        quoted = F.concat(F.lit('"'), t, F.lit('"'))
        return F.when(F.contains(t, F.lit(sep)) & (c < F.col("last")), quoted).otherwise(t)

    line = F.array_join(F.transform(F.sequence(F.lit(0), F.col("last")), shown), sep)
    return rows.select("file", "sheet", "row", line.alias("line"))


def sheet_status(cells: DataFrame) -> DataFrame:
    """Per file: a boolean cell, or one that is given twice, makes the conversion of the whole file fail."""
    boolean = F.max(F.when(F.upper("type") == "BOOLEAN", 1).otherwise(0)) == 1
    rows = cells.groupBy("file", "sheet", "row").agg(boolean.alias("boolean"), (F.count("col") > F.size(F.collect_set("col"))).alias("twice"))
    return rows.groupBy("file").agg(F.max(F.col("boolean") | F.col("twice")).alias("failed")).select(
        "file", F.when(F.col("failed"), F.lit(codes.SHEET_FAILED)).otherwise(F.lit(codes.SHEET_CONVERTED)).alias("code")
    )


def convert_sheets(cells: DataFrame, sep: str = "|", date_format: str = "yyyyMMddHHmmss") -> DataFrame:
    """Lines of the files that convert. The few that do not are written out first, so
    that Spark knows how small the list is."""
    failed = sheet_status(cells).filter(F.col("code") == codes.SHEET_FAILED).select("file")
    return cells_to_lines(cells, sep, date_format).join(materialise(failed, "failed-sheets"), "file", "left_anti")
