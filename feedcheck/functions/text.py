"""Small text expressions shared by the operators."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


# Control characters and the blank: what a trim removes, and what a cast skips.
BLANKS = "".join(chr(i) for i in range(33)) + "\x7f"


def trim_text(col: Column) -> Column:
    return F.btrim(col, F.lit(BLANKS))


def has_control(line: Column) -> Column:
    """Whether a line holds a control character, so that trimming blanks is not enough."""
    return line.rlike("[\\x00-\\x1f\\x7f]")


# What a text must look like to be a whole number of 64 bits. A cast that fails costs many times a look, as it throws.
_WHOLE = r"\A[\x00-\x20\x7f]*+[+-]?0*[0-9]{1,19}[\x00-\x20\x7f]*+\z"


def as_long(text: Column, trimmed: bool = False) -> Column:
    """The text as a 64-bit integer, or null: a sign and digits, no points or exponents.
    The cast alone would also skip blanks around the digits."""
    fits = text.rlike(_WHOLE)
    return F.when(fits if trimmed else fits & (text == trim_text(text)), text.try_cast("bigint"))


def as_int(text: Column, trimmed: bool = False) -> Column:
    value = as_long(text, trimmed)
    return F.when(value.between(-(1 << 31), (1 << 31) - 1), value.cast("int"))


def matches(text: Column, pattern) -> Column:
    """Full match of a regular expression given as text or as a column."""
    if isinstance(pattern, str):
        return text.rlike(f"\\A(?:{pattern})\\z")
    return F.rlike(text, F.concat(F.lit("\\A(?:"), pattern, F.lit(")\\z")))


def or_empty(col: Column) -> Column:
    return F.coalesce(col.cast("string"), F.lit(""))


def compiles(pattern: Column, whole: bool = False) -> Column:
    """Whether a text is a pattern that Spark's ``rlike`` takes; null for null. With ``whole``, as a pattern for a
    whole text, which an open ``\\Q`` or comment is not. Every row tries its own, in the task that holds it."""
    text = F.concat(F.lit("\\A(?:"), pattern, F.lit(")\\z")) if whole else pattern
    tried = F.try_reflect(F.lit("java.util.regex.Pattern"), F.lit("compile"), text)
    return F.when(pattern.isNotNull(), tried.isNotNull())
