"""Delimited-text dialects and their presets."""

from __future__ import annotations

import re
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Dialect:
    sep: str = ","
    quote: str | None = '"'
    escape: str | None = "\\"
    comment: str | None = None
    null_string: str | None = None
    trim: bool = True
    encoding: str = "UTF-8"
    header: bool = False
    ignore_header_names: bool = False
    quote_mode: str = "MINIMAL"
    trailing_delimiter: bool = False
    record_separator: str = "\n"
    include_header: bool = True

    def read_options(self) -> dict:
        """Options of Spark's csv reader."""
        opts = {
            "sep": self.sep,
            "quote": self.quote or "",
            "escape": self.escape or (self.quote or ""),
            "ignoreLeadingWhiteSpace": self.trim,
            "ignoreTrailingWhiteSpace": self.trim,
            "encoding": self.encoding,
            "header": self.header,
            "enforceSchema": self.ignore_header_names or not self.header,
        }
        if self.comment:
            opts["comment"] = self.comment
        if self.null_string is not None:
            opts["nullValue"] = self.null_string
        return opts


# Dialect presets.
PRESETS = {
    "custom": Dialect(),
    "rfc-4180": Dialect(sep=",", quote='"', escape=None, trim=False, record_separator="\r\n"),
    "excel": Dialect(sep=",", quote='"', escape=None, trim=False, record_separator="\r\n"),
    "tdf": Dialect(sep="\t", quote='"', escape=None, trim=True, record_separator="\r\n"),
    "mysql": Dialect(sep="\t", quote=None, escape="\\", null_string="\\N", trim=False),
    "informix-unload": Dialect(sep="|", quote='"', escape="\\", trim=False),
    "informix-unload-csv": Dialect(sep=",", quote='"', escape=None, trim=False),
}
DEFAULT = Dialect(sep=",", quote='"', escape=None, trim=False, record_separator="\r\n")


def unescape(text: str | None) -> str | None:
    """``\\t``, ``\\n`` and ``\\r`` written out as two characters become one."""
    if text is None:
        return None
    return text.replace("\\t", "\t").replace("\\n", "\n").replace("\\r", "\r")


#: Letters after a backslash. Fixed values.
_LETTERS = {"b": "\b", "f": "\f", "n": "\n", "r": "\r", "t": "\t"}
_UNICODE, _OCTAL = r"\\u+\+?([0-9A-Fa-f]{4})", r"\\([0-3]?[0-7]{1,2})"


def escaped_char(text: str) -> str:
    """One character that may be written as a Java escape: ``\\u0001``, octal, a letter such as ``\\t``, or
    a backslash before any other character. Anything else is returned as it is."""
    if m := re.fullmatch(_UNICODE, text):
        return chr(int(m[1], 16))
    if m := re.fullmatch(_OCTAL, text):
        return chr(int(m[1], 8))
    if len(text) == 2 and text[0] == "\\":
        return _LETTERS.get(text[1], text[1])
    return text


def one_char(value: str | None, default: str | None) -> str | None:
    """A dialect character must be exactly one character; anything else is the default."""
    value = None if value is None else escaped_char(value)
    return value if value is not None and len(value) == 1 else default


def dialect(name: str = "custom", **overrides) -> Dialect:
    """A preset with overrides; an unknown name is the default format.

    Overrides apply to every preset here, and character options fall back to the
    preset's own value when they are not one character long.
    """
    base = PRESETS.get(name.lower(), DEFAULT)
    for key in ("sep", "quote", "escape", "comment"):
        if overrides.get(key) is not None:
            overrides[key] = one_char(overrides[key], getattr(base, key))
    for key in ("null_string", "record_separator"):
        if overrides.get(key) is not None:
            overrides[key] = unescape(overrides[key])
    return replace(base, **overrides)


def one_char_column(col: Column, default: str | None) -> Column:
    """Column form of :func:`one_char` for dialects that differ per file."""

    def utf16(digits: Column) -> Column:
        return F.decode(F.unhex(F.lpad(digits, 4, "0")), "UTF-16BE")

    after = F.substring(col, 2, 1)
    letter = after
    for name, char in _LETTERS.items():
        letter = F.when(after == name, F.lit(char)).otherwise(letter)
    return (
        F.when(F.length(col) == 1, col)
        .when(col.rlike(rf"\A{_UNICODE}\z"), utf16(F.regexp_extract(col, rf"\A{_UNICODE}\z", 1)))
        .when(col.rlike(rf"\A{_OCTAL}\z"), utf16(F.conv(F.regexp_extract(col, rf"\A{_OCTAL}\z", 1), 8, 16)))
        .when((F.length(col) == 2) & col.startswith("\\"), letter)
        .otherwise(F.lit(default))
    )


#: Columns of ``files`` that override a dialect's characters.
DIALECT_COLUMNS = {"field_separator": "sep", "quote_char": "quote", "escape_char": "escape", "comment_marker": "comment"}


def _literal(char: Column) -> Column:
    """A character as it stands in a regular expression, also within brackets."""
    return F.concat(F.lit("\\x{"), F.hex(F.ascii(char)), F.lit("}"))


def with_dialects(files: DataFrame, base: Dialect = PRESETS["custom"]) -> DataFrame:
    """Add ``dialect`` to ``files``: each row's separator, quote, escape and comment marker, and the regular
    expressions that split its lines.

    Columns ``field_separator``, ``quote_char``, ``escape_char`` and ``comment_marker`` override ``base``; a null
    or a value that is not one character is the base's own. The expressions are built once per file, in
    columns, so any number of dialects shares one scan and one plan. An escape equal to the quote is no
    escape of its own.
    """
    chars = {n: one_char_column(F.col(c), getattr(base, n)) if c in files.columns else F.lit(getattr(base, n)) for c, n in DIALECT_COLUMNS.items()}
    chars = {n: c.cast("string") for n, c in chars.items()}
    out = files.withColumn("dialect", F.struct(*[c.alias(n) for n, c in chars.items()]))
    sep, q = (_literal(F.col(f"dialect.{n}")) for n in ("sep", "quote"))
    own = F.col("dialect.escape").isNotNull() & ~F.col("dialect.escape").eqNullSafe(F.col("dialect.quote"))
    e = F.when(own, _literal(F.col("dialect.escape")))
    plain = F.when(own, F.concat(F.lit("(?:[^"), sep, e, F.lit("]++|"), e, F.lit(".)*+"))).otherwise(F.concat(F.lit("[^"), sep, F.lit("]*+")))
    inside = F.when(own, F.concat(F.lit("(?:[^"), q, e, F.lit("]++|"), e, F.lit(".|"), q, q, F.lit(")*+"))).otherwise(F.concat(F.lit("(?:[^"), q, F.lit("]++|"), q, q, F.lit(")*+")))
    token = F.coalesce(F.concat(F.lit("(?:"), q, inside, q, F.lit("(?:(?!"), sep, F.lit(")[ \\t])*+|(?!"), q, F.lit(")"), plain, F.lit(")")), plain)
    patterns = {
        "own_escape": F.when(own, F.col("dialect.escape")),
        "at_sep": sep,
        "each": F.concat(F.lit("(?s)"), sep, F.lit("("), token, F.lit(")")),
        "whole": F.concat(F.lit("(?s)\\A(?:"), token, F.lit(")(?:"), sep, token, F.lit(")*+\\z")),
    }
    return out.withColumn("dialect", F.struct("dialect.*", *[c.alias(n) for n, c in patterns.items()]))
