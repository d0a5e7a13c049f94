"""Schemas of files that name their own columns, inferred from their values.

Each value is one bit mask: the kinds that its text fits. The kinds of a column are what all of its values share, so
masks merge by ``bit_and`` in a hash aggregate with map-side combine, over the scan that numbers the lines. The plan
does not grow with files or columns, and no task holds a file.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.dates import parse_strict
from ..functions.delimited import split_line, split_line_by
from ..functions.dialect import Dialect, with_dialects
from ..functions.schema import FeedField
from ..functions.text import as_int, as_long, trim_text
from ..session import materialise
from ..sources.lines import LineSource
from .framing import number_lines
from .validate import _typed

KINDS = ["int", "long", "double", "boolean"]
_MOST = 40  # patterns that have a bit


def kinds_of(value: Column, patterns: list[tuple[str, str]]) -> Column:
    """Mask of the kinds that a text fits: a bit for each of ``KINDS``, then one for each pattern. Numbers are
    no words and most words no numbers, so a look at the first character spares most tests."""
    number = value.rlike(r"\A[+-]?[0-9.]")
    numeric = [as_int(value), as_long(value), _typed(value, FeedField("", "double"), True, False)]
    fits = [*[number & n.isNotNull() for n in numeric], value.rlike(r"(?i)\A(?:true|false)\z")]
    mask = F.lit(0).cast("bigint")
    for bit, fit in enumerate([*fits, *[parse_strict(value, p).isNotNull() for _, p in patterns]]):
        mask = mask + F.when(fit, F.lit(1 << bit).cast("bigint")).otherwise(F.lit(0).cast("bigint"))
    return mask


def _cells(src: LineSource, d: Dialect, files: DataFrame | None) -> DataFrame:
    """``file_key, head, position, value`` of every field of every line; ``head`` for the first line."""
    own = None if files is None else with_dialects(files, d).select("file_key", "dialect")
    numbered = number_lines(src, own)
    fields = split_line(F.col("line"), d) if own is None else split_line_by(F.col("line"), F.col("dialect"), d.null_string)
    cells = numbered.select("file_key", (F.col("line_no") == 1).alias("head"), F.posexplode(fields).alias("position", "value"))
    value = trim_text(F.col("value")) if d.trim else F.col("value")
    missing = F.col("value") == (F.lit("") if d.null_string is None else F.lit(d.null_string))
    cells = cells.withColumn("value", value)
    return cells.withColumn("value", F.when(~missing & (F.col("value") != ""), F.col("value")))


def infer_schema(src: LineSource, d: Dialect, patterns: list[tuple[str, str]] = (), files: DataFrame | None = None) -> DataFrame:
    """One row per file and column: ``file_key, position, field_name, type, logical, pattern, nullable, n_values``.

    The first line names the columns. ``patterns`` are pairs of a logical type (such as ``date``) and a date pattern.
    A column is the first of: int, long, double, boolean, the patterns in their order, string, that all values
    fit; without any value it is a string. It is nullable if a line has no value there, empty texts and the null
    token being none. Malformed lines have no fields. Columns beyond the header have a null name. ``files`` may give
    each file its own dialect (see ``with_dialects``), and leaves out those that it does not list.
    """
    patterns = list(patterns)
    if len(patterns) > _MOST:
        raise ValueError(f"more than {_MOST} date patterns")
    head, value = F.col("head"), F.col("value")
    mask = F.when(~head & value.isNotNull(), kinds_of(value, patterns)).otherwise(F.lit(-1).cast("bigint"))
    sums = [F.bit_and("mask").alias("mask"), F.sum("n_values").alias("n_values"), F.sum("n_lines").alias("n_lines")]
    # A name is a key and not an aggregate of texts, which would be sorted.
    each = _cells(src, d, files).select(
        "file_key", "position", "head", F.when(head, value).alias("field_name"), mask.alias("mask"),
        (~head & value.isNotNull()).cast("bigint").alias("n_values"), (~head).cast("bigint").alias("n_lines"),
    )
    per_name = each.groupBy("file_key", "position", "head", "field_name").agg(*sums)
    columns = per_name.groupBy("file_key", "position").agg(F.max("field_name").alias("field_name"), *sums)
    lines = per_name.filter("position = 0").groupBy("file_key").agg(F.sum("n_lines").alias("lines_of_file"))
    out = columns.join(lines, "file_key")
    # With the number of kinds before it, so that the first that fits is taken.
    known = [(k, None, None) for k in KINDS] + [("long", logical, p) for logical, p in patterns]
    chosen = F.struct(F.lit("string").alias("type"), F.lit(None).cast("string").alias("logical"), F.lit(None).cast("string").alias("pattern"))
    for bit, (kind, logical, pattern) in reversed(list(enumerate(known))):
        named = F.struct(F.lit(kind).alias("type"), F.lit(logical).cast("string").alias("logical"), F.lit(pattern).cast("string").alias("pattern"))
        chosen = F.when((F.col("n_values") > 0) & (F.col("mask").bitwiseAND(F.lit(1 << bit)) != 0), named).otherwise(chosen)
    out = out.withColumn("c", chosen)
    return out.select("file_key", "position", "field_name", "c.*", (F.col("n_values") < F.col("lines_of_file")).alias("nullable"), "n_values")


def schema_texts(inferred: DataFrame, name: str = "inferred") -> DataFrame:
    """``file_key, table_schema``: the inferred columns of each file as the schema text that ``validate_files`` takes.
    Written out, as a validation reads it several times and each would infer again."""
    kind = F.when(F.col("nullable"), F.array(F.lit("null"), F.col("type"))).otherwise(F.array("type"))
    field = F.struct("position", F.struct(F.col("field_name").alias("name"), kind.alias("type"), F.col("pattern").alias("doc"), F.col("logical").alias("logicalType")).alias("f"))
    fields = F.transform(F.array_sort(F.collect_list(F.when(F.col("field_name").isNotNull(), field))), lambda x: x["f"])
    text = F.to_json(F.struct(F.lit("record").alias("type"), F.lit(name).alias("name"), fields.alias("fields")))
    return materialise(inferred.groupBy("file_key").agg(text.alias("table_schema")), "inferred")
