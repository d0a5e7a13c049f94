"""Partition paths from a partition specification."""

from __future__ import annotations

import json
import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..codes import PARTITION as CODE
from ..functions import dates


@dataclass(frozen=True)
class Part:
    source: str
    column_name: str | None = None
    format: str | None = None
    append_mod: str | None = None
    attribute_name: str | None = None


class SpecError(ValueError):
    """The specification fails for every file, with this code."""

    def __init__(self, code: str):
        super().__init__(f"partition specification refused with code {code}")
        self.code = code


def parse_spec(text: str | None) -> list[Part]:
    """Parts of a specification; an empty text has none."""
    if not text:
        return []
    try:
        items = json.loads(text)["partitionArr"]
        return [
            Part(i.get("source") or "", i.get("columnName"), i.get("format"), i.get("appendMod"), i.get("attributeName")) for i in items
        ]
    except (json.JSONDecodeError, KeyError, TypeError, AttributeError):
        raise SpecError(CODE["bad_json"]) from None


_UNITS = {"HH": "hour", "mm": "minute", "ss": "second"}


def _formatted(ts: Column, pattern: str, code: str) -> Column:
    try:
        return F.date_format(ts, dates.to_spark_pattern(pattern))
    except dates.PatternError:
        raise SpecError(CODE[code]) from None


def _stepped(ts: Column, mod: str | None) -> Column:
    """A unit rounded down to a multiple of the step, two digits wide."""
    if mod is None or len(mod) < 4:
        raise SpecError(CODE["mod_too_short"])
    unit, step = mod[:2], mod[2:4]
    if unit not in _UNITS:
        # Two letters the pattern language knows and that print a number are a wrong unit.
        numeric = unit in ("yy", "MM", "dd", "kk", "KK", "hh", "SS", "DD")
        try:
            if not numeric:
                dates.to_spark_pattern(unit)
        except dates.PatternError:
            raise SpecError(CODE["mod_bad_pattern"]) from None
        raise SpecError(CODE["mod_unit" if numeric and step.isdigit() else "mod_not_number"])
    if not re.fullmatch("[0-9]+", step) or int(step) == 0:
        raise SpecError(CODE["mod_not_number"])
    n = int(step)
    if unit == "HH" and n > 24:
        raise SpecError(CODE["mod_hours"])
    if n > 60:
        raise SpecError(CODE["mod_sixty"])
    value = F.date_part(F.lit(_UNITS[unit]), ts).cast("int")
    return F.lpad((F.floor(value / n) * n).cast("string"), 2, "0")


def _part(p: Part, ts: Column, columns: list[str]) -> tuple[Column, Column, Column]:
    """Raw form, value, and error code of one part."""
    ok = F.lit(None).cast("string")
    key = f"{p.column_name}=" if p.column_name else ""
    source = p.source.lower()
    if source == "date":
        if not p.format:
            raise SpecError(CODE["date_format_missing"])
        value = _formatted(ts, p.format, "date_format_invalid")
        return F.concat(F.lit(key), value), value, ok
    if source == "datewithmod":
        step = _stepped(ts, p.append_mod)
        if not p.format:  # the key is written together with the format only
            return step, step, ok
        value = F.concat(_formatted(ts, p.format, "mod_format_invalid"), step)
        return F.concat(F.lit(key), value), value, ok
    if source == "attribute":
        if not p.attribute_name:
            raise SpecError(CODE["attribute_name_missing"])
        value = F.col(f"`{p.attribute_name}`").cast("string") if p.attribute_name in columns else F.lit(None).cast("string")
        missing = F.when(F.coalesce(value, F.lit("")) == "", F.lit(CODE["attribute_missing"]))
        return F.concat(F.lit(f"{p.attribute_name}="), value), value, missing
    raise SpecError(CODE["unknown_source"])


def partition_columns(df: DataFrame, spec: str | None, ts: Column) -> DataFrame:
    """Add ``raw_partition`` (parts joined by ``/``), ``hive_partition`` (values joined by
    ``,``) and ``partition_code``. Both paths are null where the code is an error.

    ``ts`` is the reference time, so that results can be repeated.
    """
    null = F.lit(None).cast("string")
    try:
        parts = [_part(p, ts, df.columns) for p in parse_spec(spec)]
    except SpecError as e:
        return df.withColumns({"raw_partition": null, "hive_partition": null, "partition_code": F.lit(e.code)})
    errors = [c for _, _, c in parts]
    error = F.coalesce(*errors) if errors else null
    raw = F.concat_ws("/", *[r for r, _, _ in parts]) if parts else F.lit("")
    hive = F.concat_ws(",", *[v for _, v, _ in parts]) if parts else F.lit("")
    return df.withColumns(
        {
            "raw_partition": F.when(error.isNull(), raw),
            "hive_partition": F.when(error.isNull(), hive),
            "partition_code": F.coalesce(error, F.lit(CODE["success"])),
        }
    )


def with_partition_values(df: DataFrame, spec: str, ts: Column) -> tuple[DataFrame, list[str]]:
    """One column per part, for a partitioned write; unnamed parts are ``part_<i>``. Rows of
    which a part has no value have no place in the table; ``rows_without_partition`` has them."""
    named, errors = _named_parts(df, spec, ts)
    placed = df.filter(F.coalesce(*errors).isNull()) if errors else df
    return placed.withColumns(named), list(named)


def rows_without_partition(df: DataFrame, spec: str, ts: Column) -> DataFrame:
    """Rows that ``with_partition_values`` leaves out, with ``partition_code``."""
    _, errors = _named_parts(df, spec, ts)
    error = F.coalesce(*errors) if errors else F.lit(None).cast("string")
    return df.withColumn("partition_code", error).filter(F.col("partition_code").isNotNull())


def _named_parts(df: DataFrame, spec: str, ts: Column) -> tuple[dict[str, Column], list[Column]]:
    named, errors = {}, []
    for i, p in enumerate(parse_spec(spec)):
        _, value, error = _part(p, ts, df.columns)
        own = p.attribute_name if p.source.lower() == "attribute" else p.column_name
        named[own or f"part_{i}"] = value
        errors.append(error)
    return named, errors
