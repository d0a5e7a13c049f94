"""Manifest and header-line metadata: the eight known fields."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import codes
from ..functions import dates
from ..functions.schema import FeedSchema
from ..functions.text import as_long, or_empty

# The known metadata fields and the attribute suffix each one feeds.
LONG_FIELDS = ("sequence_number", "file_size", "record_count", "num_of_fields")
DATE_FIELDS = ("data_start_date", "data_end_date", "date_of_file_generation")
FIELDS = ("file_name", *LONG_FIELDS, *DATE_FIELDS)
SUFFIXES = {
    "file_name": "file_name",
    "sequence_number": "sequence_number",
    "file_size": "file_size",
    "record_count": "record_count",
    "num_of_fields": "number_of_fields",
    "data_start_date": "start_date",
    "data_end_date": "end_date",
    "date_of_file_generation": "Date_of_file_generation",
}


def _type(name: str) -> str:
    return "bigint" if name in LONG_FIELDS else "string"


def metadata_values(schema: FeedSchema, text_of, lenient: bool = False) -> tuple[dict[str, Column], Column, Column]:
    """Known fields of a record as columns.

    ``text_of(i)`` is the text of schema field ``i``. Field names match in any case and
    unknown ones are ignored; of two spellings the later wins. Also returns whether a
    number and whether a date failed.
    """
    values = {n: F.lit(None).cast(_type(n)) for n in FIELDS}
    bad_number = bad_date = F.lit(False)
    for i, f in enumerate(schema.fields):
        name = f.name.lower()
        if name not in values:
            continue
        text = text_of(i)
        text = F.when(text != "", text)
        if name in LONG_FIELDS:
            values[name] = as_long(text)
            bad_number = bad_number | (text.isNotNull() & values[name].isNull())
        elif name in DATE_FIELDS and f.doc:
            values[name] = dates.normalise_date(text, f.doc, lenient)
            bad_date = bad_date | values[name].isNull()
        else:
            values[name] = text
    return values, bad_number, bad_date


def extract_metadata(df: DataFrame, schema: FeedSchema, lenient: bool = False, into: str = "metadata") -> DataFrame:
    """Struct of the known fields from columns named as in ``schema``."""
    values, _, _ = metadata_values(schema, lambda i: F.col(schema.fields[i].name).cast("string"), lenient)
    return df.withColumn(into, F.struct(*[v.alias(n) for n, v in values.items()]))


def header_metadata(fields: Column, schema: FeedSchema, lenient: bool = False) -> Column:
    """Metadata struct of one header record, mapped to ``schema`` by position.

    Holds the known fields, ``has_count`` (the schema names a record count) and
    ``code``, the first error: too few values or a bad number, whichever field comes
    first; then too many values; then a date that does not parse.
    """
    code = codes.DATA_ONLY
    n = len(schema.fields)
    size = F.size(fields)

    def text_of(i):
        return F.get(fields, F.lit(i))

    first = F.lit(None).cast("string")
    for i, f in reversed(list(enumerate(schema.fields))):
        if f.name in LONG_FIELDS:
            first = F.when(as_long(text_of(i)).isNull(), F.lit(code["metadata_number"])).otherwise(first)
        first = F.when(size <= i, F.lit(code["metadata_short"])).otherwise(first)
    values, bad_number, bad_date = metadata_values(schema, text_of, lenient)
    error = (
        F.when(first.isNotNull(), first)
        .when(size > n, F.lit(code["metadata_long"]))
        .when(bad_number, F.lit(code["illegal_argument"]))
        .when(bad_date, F.lit(code["date"]))
    )
    has_count = any(f.name.lower() == "record_count" for f in schema.fields)
    return F.struct(*[v.alias(k) for k, v in values.items()], F.lit(has_count).alias("has_count"), error.alias("code"))


def metadata_values_of(fields: Column, text_of, patterns: list[str], lenient: bool = False) -> tuple[dict[str, Column], Column, Column]:
    """As ``metadata_values``, for a schema that is a column: an array of its fields. ``text_of`` takes a position
    that is a column, ``patterns`` has all date patterns that any row's known fields have."""

    def text(known):
        return F.nullif(text_of(known["i"]), F.lit(""))

    def dated(known):
        out = F.when(F.coalesce(known["doc"], F.lit("")) == "", text(known))
        for p in patterns:
            out = out.when(known["doc"] == p, dates.normalise_date(text(known), p, lenient))
        return out

    known = F.transform(fields, lambda f, i: F.struct(F.lower(f["name"]).alias("name"), f["doc"].alias("doc"), i.alias("i")))
    values = {}

    def last_named(n):
        return F.try_element_at(F.filter(known, lambda x: x["name"] == n), F.lit(-1))

    for n in FIELDS:
        last = last_named(n)
        values[n] = as_long(text(last)) if n in LONG_FIELDS else dated(last) if n in DATE_FIELDS else text(last)
        values[n] = F.when(last.isNotNull(), values[n])
    bad_number = F.exists(known, lambda x: x["name"].isin(*LONG_FIELDS) & text(x).isNotNull() & as_long(text(x)).isNull())
    bad_date = F.exists(known, lambda x: x["name"].isin(*DATE_FIELDS) & (F.coalesce(x["doc"], F.lit("")) != "") & dated(x).isNull())
    return values, bad_number, bad_date


def header_metadata_of(fields: Column, schema: Column, patterns: list[str], lenient: bool = False) -> Column:
    """As ``header_metadata``, for a schema that is a column."""
    code = codes.DATA_ONLY
    size = F.size(fields)

    def text_of(i):
        return F.get(fields, i)

    def first_of(f, i):
        number = f["name"].isin(*LONG_FIELDS) & as_long(text_of(i)).isNull()
        return F.when(size <= i, F.lit(code["metadata_short"])).when(number, F.lit(code["metadata_number"]))

    first = F.get(F.filter(F.transform(schema, first_of), lambda c: c.isNotNull()), F.lit(0))
    values, bad_number, bad_date = metadata_values_of(schema, text_of, patterns, lenient)
    error = (
        F.when(first.isNotNull(), first)
        .when(size > F.size(schema), F.lit(code["metadata_long"]))
        .when(bad_number, F.lit(code["illegal_argument"]))
        .when(bad_date, F.lit(code["date"]))
    )
    has_count = F.exists(schema, lambda f: F.lower(f["name"]) == "record_count")
    return F.struct(*[v.alias(k) for k, v in values.items()], has_count.alias("has_count"), error.alias("code"))


def attributes(metadata: Column, prefix: str) -> dict[str, Column]:
    """The eight text attributes ``<prefix>_…``; a missing value is the empty text."""
    return {f"{prefix}_{SUFFIXES[n]}": or_empty(metadata[n]) for n in FIELDS}


def data_file_name(record_name: Column, manifest_name: Column, extension: Column) -> Column:
    """Name up to its first dot, with the data file extension."""
    return F.concat(F.substring_index(F.coalesce(record_name, manifest_name), ".", 1), F.coalesce(extension, F.lit("null")))


def manifest_rows(records: DataFrame, carried: list[str]) -> DataFrame:
    """One row per manifest record: the manifest's own attributes and the ``data_*`` ones.

    ``records`` has ``metadata``, ``file_name`` and ``datafile_extension``.
    """
    attrs = {}
    for n in FIELDS:
        name = f"data_{SUFFIXES[n]}"
        attrs[name] = or_empty(F.col("metadata")[n])
    attrs["data_file_name"] = or_empty(
        data_file_name(F.col("metadata.file_name"), F.col("file_name"), F.col("datafile_extension"))
    )
    return records.select(*carried, *[v.alias(k) for k, v in attrs.items()])
