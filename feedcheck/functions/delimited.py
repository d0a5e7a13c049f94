"""Split a delimited line into fields and render fields as a line, as columns."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from .dialect import Dialect
from .text import trim_text

# Code points that Unicode reserves for use inside a program: no text holds them.
_KEEP_ESCAPE, _KEEP_QUOTE = "\ufdd0", "\ufdd1"


def _token(d: Dialect) -> str:
    """Regular expression of one field.

    Only possessive repeats: the Java matcher then walks a field of any length in a
    loop, without recursion.
    """
    sep, esc = re.escape(d.sep), re.escape(d.escape) if _own_escape(d) else ""
    plain = f"(?:[^{sep}{esc}]++|{esc}.)*+" if esc else f"[^{sep}]*+"
    if not d.quote:
        return plain
    q = re.escape(d.quote)
    return f"(?:{q}{_inside(d)}{q}{_blanks(d)}|(?!{q}){plain})"


def _blanks(d: Dialect) -> str:
    """Regular expression of blanks after a closing quote; a separator is none."""
    return f"(?:(?!{re.escape(d.sep)})[ \\t])*+"


def _inside(d: Dialect) -> str:
    """Regular expression of the text between two quotes."""
    q, esc = re.escape(d.quote), re.escape(d.escape) if _own_escape(d) else ""
    return f"(?:[^{q}{esc}]++|{esc}.|{q}{q})*+" if esc else f"(?:[^{q}]++|{q}{q})*+"


def open_quote(line: Column, d: Dialect) -> tuple[Column, Column]:
    """Whether a physical line ends inside a quoted value: when it starts outside of one,
    and when it starts inside."""
    sep, q, tok = re.escape(d.sep), re.escape(d.quote), _token(d)
    inside = _inside(d)
    opened = f"(?s)\\A(?:{tok}{sep})*+{q}{inside}\\z"
    kept = f"(?s)\\A{inside}(?:{q}{_blanks(d)}(?:{sep}{tok})*+{sep}{q}{inside})?\\z"
    has_quote = F.contains(line, F.lit(d.quote))
    return F.when(has_quote, line.rlike(opened)).otherwise(False), F.when(has_quote, line.rlike(kept)).otherwise(True)


def _own_escape(d: Dialect) -> bool:
    return bool(d.escape) and d.escape != d.quote


def _special(line: Column, d: Dialect) -> Column:
    marks = [F.contains(line, F.lit(c)) for c in (d.quote, d.escape if _own_escape(d) else None) if c]
    out = F.lit(False)
    for m in marks:
        out = out | m
    return out


def _clean(token: Column, d: Dialect) -> Column:
    def swap(c, a, b):
        return F.replace(c, F.lit(a), F.lit(b))

    quoted = token.startswith(d.quote) if d.quote else F.lit(False)
    body = F.when(quoted, F.regexp_extract(token, f"(?s)\\A{re.escape(d.quote)}(.*){re.escape(d.quote)}[ \\t]*\\z", 1)).otherwise(token) if d.quote else token
    if _own_escape(d):
        e = d.escape
        body = swap(body, e + e, _KEEP_ESCAPE)
        if d.quote:
            body = swap(body, e + d.quote, _KEEP_QUOTE)
    if d.quote:
        body = F.when(quoted, swap(body, d.quote * 2, d.quote)).otherwise(body)
    if _own_escape(d):
        body = swap(body, e + d.sep, d.sep)
        for letter, char in (("n", "\n"), ("r", "\r"), ("t", "\t")):
            body = swap(body, e + letter, char)
        if d.quote:
            body = swap(body, _KEEP_QUOTE, d.quote)
        body = swap(body, _KEEP_ESCAPE, e)
    return body


def split_line(line: Column, d: Dialect) -> Column:
    """Array of field texts, quotes and escapes resolved; null when the line is malformed.

    A line is malformed when a quote that opens a field is not closed, or when text
    follows the closing quote. A quote inside a bare field is ordinary text. Lines
    without quotes and escapes take the plain split.
    """
    plain = F.split(line, re.escape(d.sep), -1)
    if not d.quote and not _own_escape(d):
        return plain
    tok, sep = _token(d), re.escape(d.sep)
    whole = f"(?s)\\A(?:{tok})(?:{sep}{tok})*+\\z"
    tokens = F.regexp_extract_all(F.concat(F.lit(d.sep), line), F.lit(f"(?s){sep}({tok})"), F.lit(1))
    if _own_escape(d) and d.null_string is not None and d.null_string.startswith(d.escape):
        # The null token (such as \N) is recognised before escapes are resolved.
        cleaned = F.transform(tokens, lambda t: F.when(t != F.lit(d.null_string), _clean(t, d)))
    else:
        cleaned = F.transform(tokens, lambda t: _clean(t, d))
    return F.when(~_special(line, d), plain).when(line.rlike(whole), cleaned)


def split_line_by(line: Column, dialect: Column, null_string: str | None = None) -> Column:
    """:func:`split_line` where separator, quote and escape differ from row to row: ``dialect`` is the
    struct that ``with_dialects`` adds."""
    sep, q, e = dialect["sep"], dialect["quote"], dialect["own_escape"]

    def swap(c: Column, a: Column, b: Column) -> Column:
        return F.coalesce(F.replace(c, a, b), c)  # as it is where the row has no such character

    def clean(token: Column) -> Column:
        quoted = F.coalesce(token.startswith(q), F.lit(False))
        bare = F.rtrim(token, F.lit(" \t"))
        body = F.when(quoted, F.substring(bare, F.lit(2), F.length(bare) - 2)).otherwise(token)
        body = swap(swap(body, F.concat(e, e), F.lit(_KEEP_ESCAPE)), F.concat(e, q), F.lit(_KEEP_QUOTE))
        body = F.when(quoted, F.replace(body, F.concat(q, q), q)).otherwise(body)
        body = swap(body, F.concat(e, sep), sep)
        for letter, char in (("n", "\n"), ("r", "\r"), ("t", "\t")):
            body = swap(body, F.concat(e, F.lit(letter)), F.lit(char))
        return swap(swap(body, F.lit(_KEEP_QUOTE), q), F.lit(_KEEP_ESCAPE), e)

    tokens = F.regexp_extract_all(F.concat(sep, line), dialect["each"], F.lit(1))
    if null_string is not None:
        # A null token (such as \N) is recognised before escapes are resolved.
        kept = F.lit(null_string)
        cleaned = F.transform(tokens, lambda t: F.when(F.coalesce(t == kept, F.lit(False)) & F.coalesce(kept.startswith(e), F.lit(False)), F.lit(None).cast("string")).otherwise(clean(t)))
    else:
        cleaned = F.transform(tokens, clean)
    special = F.coalesce(F.contains(line, q), F.lit(False)) | F.coalesce(F.contains(line, e), F.lit(False))
    return F.when(~special, F.split(line, dialect["at_sep"], -1)).when(F.rlike(line, dialect["whole"]), cleaned)


def field_at(fields: Column, i: int, d: Dialect, control: Column | None = None) -> Column:
    """Field ``i`` (from 0): trimmed if the dialect trims; null if absent or the null token.

    ``control`` tells whether the line holds control characters. Without any, the far
    cheaper trim of blanks does the same.
    """
    v = F.get(fields, F.lit(i))
    if d.trim:
        v = trim_text(v) if control is None else F.when(control, trim_text(v)).otherwise(F.trim(v))
    if d.null_string is not None:
        v = F.when(v != F.lit(d.null_string), v)
    return v


def quote_field(text: Column, d: Dialect, numeric: bool = False) -> Column:
    """One value as it stands in a line under the dialect's quote mode."""
    value = F.coalesce(text, F.lit(d.null_string or ""))
    mode = d.quote_mode.upper()
    if numeric and mode in ("MINIMAL", "NON_NUMERIC"):
        return value  # digits, sign, point: nothing to quote
    if mode == "NONE" or not d.quote:
        if not d.escape:
            return value
        out = F.replace(value, F.lit(d.escape), F.lit(d.escape * 2))
        specials = [(d.sep, d.escape + d.sep), ("\n", d.escape + "n"), ("\r", d.escape + "r")]
        if d.quote:
            specials.append((d.quote, d.escape + d.quote))
        for a, b in specials:
            out = F.replace(out, F.lit(a), F.lit(b))
        if d.null_string:
            out = F.when(text.isNull(), F.lit(d.null_string)).otherwise(out)
        return out
    escaped = value
    if _own_escape(d):
        escaped = F.replace(escaped, F.lit(d.escape), F.lit(d.escape * 2))
    escaped = F.replace(escaped, F.lit(d.quote), F.lit(d.quote * 2))
    wrapped = F.concat(F.lit(d.quote), escaped, F.lit(d.quote))
    if mode == "ALL":
        return wrapped
    if mode == "NON_NUMERIC":
        return F.when(text.isNull(), value).otherwise(wrapped)
    if mode != "MINIMAL":
        raise ValueError(f"unknown quote mode {d.quote_mode}")
    needs = F.lit(False)
    for c in (d.sep, d.quote, "\n", "\r", *([d.escape] if _own_escape(d) else [])):
        needs = needs | F.contains(value, F.lit(c))
    return F.when(text.isNull() | ~needs, value).otherwise(wrapped)


def render_line(values: list[Column], d: Dialect, numeric: list[bool] | None = None) -> Column:
    """All values as one line, without the record separator."""
    numeric = numeric or [False] * len(values)
    parts = [quote_field(v, d, n) for v, n in zip(values, numeric)]
    line = F.concat_ws(d.sep, *parts)
    return F.concat(line, F.lit(d.sep)) if d.trailing_delimiter else line
