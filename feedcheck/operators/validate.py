"""Records against their schema: typed values, classified errors, hard stops."""

from __future__ import annotations

import hashlib
from functools import lru_cache, reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import codes
from ..functions import dates
from ..functions.delimited import field_at, split_line, split_line_by
from ..functions.dialect import Dialect
from ..functions.schema import FeedField, FeedSchema
from ..functions.text import as_int, as_long, has_control

MISSING, INVALID, EXTRA, OTHER = "MISSING_FIELD", "INVALID_FIELD", "EXTRA_FIELD", "OTHER"
MASK_BITS = 62  # fields per error mask, within a signed 64-bit number

# Reasons to stop at one record, in the order they are told apart.
STOPS = ("malformed", "null_pointer", "illegal_argument", "date")


# A decimal number; casts alone also take Java's type suffixes, hexadecimal floats and NaN.
_NUMBER = r"^\s*[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?\s*$"


def _typed(text: Column, f: FeedField, strict: bool, trimmed: bool) -> Column:
    """The typed value, or null where the text does not fit the type."""
    if f.type == "string":
        return text
    if f.type == "boolean":
        return F.when(F.lower(text).isin("true", "false"), F.lower(text) == "true")
    if f.type in ("int", "long"):
        exact = as_int(text, trimmed) if f.type == "int" else as_long(text, trimmed)
        # A number with decimals loses them; through a double it would also lose digits.
        if strict:
            return exact
        kind = "int" if f.type == "int" else "bigint"
        # Decimals are cut off the text, so that none of any length rounds up; with an exponent, off a decimal.
        cut = F.regexp_replace(text, r"\..*", "")
        whole = F.when(cut.isin("", "+", "-"), F.lit(0).cast(kind)).otherwise(cut.try_cast(kind))
        scaled = text.try_cast("decimal(38,18)")
        scaled = F.when(scaled < 0, F.ceil(scaled)).otherwise(F.floor(scaled)).try_cast(kind)
        return F.coalesce(exact, F.when(text.rlike(_NUMBER), F.when(text.rlike("[eE]"), scaled).otherwise(whole)))
    return F.when(text.rlike(_NUMBER), text.try_cast(f.type)) if f.type in ("float", "double") else text.try_cast(f.type)


def value_name(i: int, f: FeedField) -> str | None:
    """Name of the typed column of a field; none where the text itself is the value."""
    if f.is_date:
        return None if f.doc is None or _pattern_fails(f.doc) else f"__d{i}_{_pattern_id(f)}"
    return None if f.type == "string" else f"__v{i}_{f.type}"


def cell_name(i: int, f: FeedField) -> str:
    """Name of a field's value as text: one for all fields of a position that are read and written alike."""
    return f"__q{value_name(i, f) or f'__t{i}'}_{f.type}"


def rules(f: FeedField) -> list[str]:
    """The checks that a field takes part in."""
    out = [] if f.nullable else ["missing"]
    if not f.is_date:
        return out if f.type == "string" else [*out, f"bad_{f.type}"]
    if f.type != "string":
        out.append("word")
    if f.doc is None:
        return [*out, "null_pointer"]
    return [*out, "illegal_argument" if _pattern_fails(f.doc) else f"date{_pattern_id(f)}"]


def picks(fields) -> dict[str, list[int]]:
    """Bit masks of the positions that take part in each check."""
    n, out = max(1, -(-len(fields) // MASK_BITS)), {}
    for i, f in enumerate(fields):
        for rule in rules(f):
            out.setdefault(rule, [0] * n)[i // MASK_BITS] |= 1 << (i % MASK_BITS)
    return out


def _pattern_id(f: FeedField) -> str:
    return _short_digest(f.doc)


@lru_cache(4096)
def _short_digest(pattern: str) -> str:
    return hashlib.sha1(pattern.encode()).hexdigest()[:8]


class Checker:
    """Checks of one schema, or of any number of them, over the same ``fields`` array.

    Work is shared between schemas: position ``i`` is trimmed once, cast once per type
    and parsed once per date pattern that any schema needs there. The outcome of a
    record is a few bit masks, one bit per position. One schema selects from them with
    constants. Of many, ``cells`` has the distinct (position, field) pairs without names,
    and each row brings its own masks in the struct ``schema`` (see ``schemas.schema_table``).
    Generated code grows with the positions and kinds of fields, not with the schemas.
    """

    def __init__(self, schema: FeedSchema | None, d: Dialect, strict: bool = True, lenient_dates: bool = False, cells: list | None = None):
        self.cells = list(enumerate(schema.fields)) if schema else list(cells or [])
        self.schema, self.d, self.strict, self.lenient = schema, d, strict, lenient_dates
        self.width = max((i + 1 for i, _ in self.cells), default=0)
        self.n_masks = max(1, -(-self.width // MASK_BITS))
        self.picks = picks(schema.fields) if schema else {}

    @property
    def names(self) -> Column:
        return name_array(self.schema) if self.schema else F.col("schema.names")

    # -- columns ---------------------------------------------------------------

    def prepare(self, df: DataFrame) -> DataFrame:
        """Add the text ``__t<i>`` of every position and the typed columns."""
        control = F.col("__control") if "__control" in df.columns else None
        texts = {f"__t{i}": field_at(F.col("fields"), i, self.d, control) for i in range(self.width)}
        typed = {}
        for i, f in self.cells:
            name, text = value_name(i, f), F.col(f"__t{i}")
            if name and f.is_date:
                dated = F.when(dates.has_date_text(text), text)
                typed[name] = dates.to_epoch_millis(dated, f.doc, self.lenient)
            elif name:
                typed[name] = _typed(text, f, self.strict, self.d.trim)
        return df.withColumns(texts).withColumns(typed)

    def value(self, i: int, f: FeedField) -> Column:
        """Typed value of a field; an empty text is null, a date is epoch milliseconds."""
        name, text = value_name(i, f), F.nullif(F.col(f"__t{i}"), F.lit(""))
        if f.is_date and name and f.type == "string":
            return F.coalesce(F.col(name).cast("string"), text)
        if f.is_date and not name and f.type != "string":
            return F.lit(None).cast("bigint")
        return F.col(name) if name else text

    # -- masks -----------------------------------------------------------------

    def _raw(self) -> dict[str, dict[int, Column]]:
        """Conditions by mask name and position, before any schema is applied."""
        out: dict[str, dict[int, Column]] = {}
        for i in range(self.width):
            out.setdefault("empty", {})[i] = F.coalesce(F.col(f"__t{i}") == "", F.lit(True))
        for i, f in self.cells:
            text, name = F.col(f"__t{i}"), value_name(i, f)
            if f.is_date:
                out.setdefault("word", {})[i] = dates.is_null_word(text)
            if name:
                bad = F.col(name).isNull() & (text != "")
                out.setdefault(f"date{_pattern_id(f)}" if f.is_date else f"bad_{f.type}", {})[i] = bad
        return out

    def _select(self, mask: Column, k: int, rule: str) -> Column | None:
        """The bits of ``mask`` at the positions that the row's schema checks by ``rule``; none if no schema has any."""
        if not any(i // MASK_BITS == k and rule in rules(f) for i, f in self.cells):
            return None
        if self.schema:
            return mask.bitwiseAND(F.lit(self.picks[rule][k]).cast("bigint"))
        own = F.get(F.try_element_at(F.col("schema.picks"), F.lit(rule)), F.lit(k))
        return mask.bitwiseAND(F.coalesce(own, F.lit(0).cast("bigint")))

    def with_masks(self, df: DataFrame) -> DataFrame:
        """Add ``missing_<k>``, ``invalid_<k>`` and ``stop`` (a position in STOPS, or null).

        Masks add up with ``bit_or`` in a plain hash aggregate: the state per file is a
        few numbers, however many records are wrong and in however many ways.
        """
        raw = self._raw()
        zero = F.lit(0).cast("bigint")

        def union(masks):
            masks = [m for m in masks if m is not None]
            return reduce(lambda a, b: a.bitwiseOR(b), masks) if masks else None

        columns = {}
        for name, bits in raw.items():
            for k in range(self.n_masks):
                part = {i: c for i, c in bits.items() if i // MASK_BITS == k}
                columns[f"__{name}_{k}"] = union(
                    F.when(c, F.lit(1 << (i % MASK_BITS)).cast("bigint")).otherwise(zero) for i, c in part.items()
                )
        df = df.withColumns({n: c if c is not None else zero for n, c in columns.items()})
        out, held, stops = {}, {}, {}
        for k in range(self.n_masks):

            def use(name, rule=None, k=k):
                return self._select(F.col(f"__{name}_{k}"), k, rule or name)

            missing = use("empty", "missing")
            wrong = [use(n) for n in raw if n.startswith("bad_")]
            if "word" in raw:
                # The word null in a date field is left alone, and then is no number.
                wrong.append(use("word"))
                word = F.bitwise_not(F.col(f"__word_{k}"))
                dated = F.bitwise_not(F.col(f"__empty_{k}")).bitwiseAND(word)
                failed = union(use(n) for n in raw if n.startswith("date"))
                causes = {
                    "null_pointer": self._select(dated, k, "null_pointer"),
                    "illegal_argument": self._select(dated, k, "illegal_argument"),
                    "date": None if failed is None else failed.bitwiseAND(word),
                }
                for cause, mask in causes.items():
                    if mask is not None:
                        held[f"__stop_{cause}_{k}"] = mask
                        stops.setdefault(k, []).append(cause)
            invalid = union(wrong)
            out[f"missing_{k}"] = zero if missing is None else missing
            out[f"invalid_{k}"] = zero if invalid is None else invalid
        df = df.withColumns(held)
        first = [_first_stop({c: F.col(f"__stop_{c}_{k}") for c in causes}) for k, causes in stops.items()]
        out["stop"] = F.coalesce(*first) if first else F.lit(None).cast("int")
        return df.withColumns(out)

    def errors(self, allow_extra: bool = False) -> Column:
        """``ARRAY<STRUCT<type,field>>`` of one record from its masks: missing fields,
        then invalid ones, then extras."""
        names = self.names

        def as_errors(kind, found):
            return F.transform(found, lambda n: F.struct(F.lit(kind).alias("type"), n.alias("field")))

        parts = [
            as_errors(MISSING, mask_names(names, "missing", self.n_masks)),
            as_errors(INVALID, mask_names(names, "invalid", self.n_masks)),
        ]
        if not allow_extra:
            parts.append(as_errors(EXTRA, extra_names(F.size(names), F.size("fields"))))
        return F.when(self.has_error(allow_extra), F.concat(*parts))

    def has_error(self, allow_extra: bool = False) -> Column:
        """Whether a record has any error, without naming it."""
        out = F.lit(False)
        for k in range(self.n_masks):
            out = out | (F.col(f"missing_{k}").bitwiseOR(F.col(f"invalid_{k}")) != 0)
        if allow_extra:
            return out
        width = F.lit(self.width) if self.schema else F.size("schema.names")
        return out | (F.size("fields") > width)


@lru_cache(4096)
def _pattern_fails(pattern: str) -> bool:
    try:
        dates.to_spark_pattern(pattern)
        return False
    except dates.PatternError:
        return True


def _first_stop(masks: dict[str, Column]) -> Column:
    """Stop whose mask has the lowest bit set: the earliest field decides."""
    if len(masks) == 1:
        ((name, mask),) = masks.items()
        return F.when(mask != 0, F.lit(STOPS.index(name)))
    top = F.lit(1 << MASK_BITS).cast("bigint")
    low = {n: F.when(m != 0, m.bitwiseAND(F.negate(m))).otherwise(top) for n, m in masks.items()}
    least = F.least(*low.values())
    out = F.when(least == top, F.lit(None).cast("int"))
    for n, c in low.items():
        out = out.when(c == least, F.lit(STOPS.index(n)))
    return out


def with_fields(lines: DataFrame, d: Dialect, line: str = "line") -> DataFrame:
    """Add ``fields`` (null marks a malformed line) and, for trimming, ``__control``. Lines with a column
    ``dialect`` (see ``with_dialects``) are split each by its own."""
    if "dialect" in lines.columns:
        fields, escape = split_line_by(F.col(line), F.col("dialect"), d.null_string), F.col("dialect.own_escape")
    else:
        fields, escape = split_line(F.col(line), d), F.lit(d.escape)
    # An escape may stand for a control character.
    control = has_control(F.col(line)) | F.coalesce(F.contains(F.col(line), escape), F.lit(False))
    return lines.withColumns({"fields": fields, **({"__control": control} if d.trim else {})})


def malformed(lines: DataFrame, d: Dialect) -> DataFrame:
    """Lines that cannot be split, with the ordinal to report."""
    return with_fields(lines, d).filter(F.col("fields").isNull()).drop("fields", "__control")


def validate_records(
    df: DataFrame, schema: FeedSchema, d: Dialect, allow_extra: bool = False, strict: bool = True, lenient_dates: bool = False
) -> DataFrame:
    """Add ``errors`` and ``stop`` (the name of a hard stop) to rows that hold ``fields``."""
    checker = Checker(schema, d, strict, lenient_dates)
    names = F.array(*[F.lit(n) for n in STOPS])
    stop = F.when(F.col("fields").isNull(), F.lit(STOPS[0])).otherwise(F.get(names, F.col("stop")))
    out = checker.with_masks(checker.prepare(df))
    errors = F.coalesce(checker.errors(allow_extra), F.array().cast("array<struct<type:string,field:string>>"))
    return out.select(*df.columns, stop.alias("stop"), errors.alias("errors"))


def dates_to_epoch(df: DataFrame, schema: FeedSchema, lenient: bool = False) -> DataFrame:
    """Replace the text of every logical-date column by epoch milliseconds in the
    session time zone; a column ``<name>_failed`` marks text that does not parse."""
    out = {}
    for f in schema.fields:
        if f.is_date and f.doc:
            dated = dates.has_date_text(F.col(f.name))
            millis = dates.to_epoch_millis(F.col(f.name), f.doc, lenient)
            out[f.name] = F.when(dated, millis)
            out[f"{f.name}_failed"] = dated & millis.isNull()
    return df.withColumns(out)


def record_errors(validated: DataFrame, keys: list[str]) -> DataFrame:
    """One row per error of each data record.

    The outer explode keeps the optimizer from copying the whole check of a record into
    a filter below it; records without errors leave in the filter above it.
    """
    exploded = validated.select(*keys, F.explode_outer("errors").alias("e")).filter(F.col("e").isNotNull())
    return exploded.select(*keys, F.col("e.type").alias("error_type"), F.col("e.field").alias("field"))


# ---- file rollup -------------------------------------------------------------


def name_array(schema: FeedSchema) -> Column:
    return F.array(*[F.lit(n) for n in schema.names]).cast("array<string>")


def mask_names(names: Column, prefix: str, n_masks: int) -> Column:
    """Sorted names whose bit is set in the masks ``prefix_0, prefix_1, …``."""
    masks = F.array(*[F.coalesce(F.col(f"{prefix}_{k}"), F.lit(0).cast("bigint")) for k in range(n_masks)])

    def is_set(_, i):
        mask = F.get(masks, F.floor(i / MASK_BITS).cast("int"))
        return F.call_function("shiftright", mask, F.pmod(i, F.lit(MASK_BITS))).bitwiseAND(F.lit(1).cast("bigint")) == 1

    return F.sort_array(F.filter(names, is_set))


def extra_names(n_names: Column, n_fields: Column) -> Column:
    """Names of the values beyond the last schema field, by position from 0."""
    many = F.coalesce(n_fields, F.lit(0))
    names = F.transform(F.sequence(n_names, many - 1), lambda i: F.concat(F.lit("unknown_field_index_"), i.cast("string")))
    return F.when(many > n_names, F.sort_array(names)).otherwise(F.array().cast("array<string>"))


def error_message(missing: Column, extra: Column, invalid: Column, other: Column | None = None) -> Column:
    """One message per file. Every part after the first set is preceded by ``; ``,
    also when it is the first part shown; the text is cut at 65535 characters."""

    given = {"missing": missing, "extra": extra, "invalid": invalid, "other": other}
    parts = [F.lit(codes.SUMMARY_START)]
    for kind, (before, after) in codes.SUMMARY_PARTS.items():
        names = given[kind]
        if names is not None:
            text = F.concat(F.lit(before), F.size(names).cast("string"), F.lit(after + "["), F.array_join(names, ", "), F.lit("]"))
            parts.append(F.when(F.size(names) > 0, text).otherwise(F.lit("")))
    return F.substring(F.concat(*parts), 1, codes.SUMMARY_LIMIT)


def summarise_errors(errors: DataFrame, key: str = "file_key") -> DataFrame:
    """Message per file from rows ``key, error_type, field``.

    Errors are made distinct before they are collected, so a group holds field names,
    not records.
    """
    distinct = errors.select(key, "error_type", "field").distinct()

    def names(kind):
        return F.array_sort(F.collect_list(F.when(F.col("error_type") == kind, F.col("field"))))

    return distinct.groupBy(key).agg(error_message(names(MISSING), names(EXTRA), names(INVALID), names(OTHER)).alias("message"))
