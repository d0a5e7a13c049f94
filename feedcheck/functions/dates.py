"""Date patterns, lenient parsing and conversion to epoch milliseconds."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

# Pattern letters that mean the same in both pattern languages.
_SHARED_LETTERS = set("GyMdDEahHkKmsSzZX")
TARGET_PATTERN = "yyyyMMddHHmmss"


class PatternError(ValueError):
    """The date pattern is not usable."""


def _runs(pattern: str) -> list[tuple[str, bool]]:
    """Cut a pattern into (text, is_literal) runs; quotes are resolved."""
    out: list[tuple[str, bool]] = []
    i = 0
    while i < len(pattern):
        c = pattern[i]
        if c == "'":
            if pattern[i + 1 : i + 2] == "'":
                out.append(("'", True))
                i += 2
                continue
            m = re.compile(r"'((?:[^']|'')*)'").match(pattern, i)
            if not m:
                raise PatternError(f"unterminated quote in {pattern!r}")
            out.append((m.group(1).replace("''", "'"), True))
            i = m.end()
        elif c.isascii() and c.isalpha():
            j = i
            while j < len(pattern) and pattern[j] == c:
                j += 1
            out.append((pattern[i:j], False))
            i = j
        else:
            out.append((c, True))
            i += 1
    return out


def to_spark_pattern(pattern: str) -> str:
    """Spark spelling of a feed's date pattern.

    Brackets are plain text in feed patterns but optional sections in Spark, so they
    are quoted. Week-based years and unknown letters are refused. ``yy`` is 20yy.
    """
    out = []
    for text, literal in _runs(pattern):
        if literal:
            bare = re.fullmatch(r"[^A-Za-z'\[\]{}#]+", text)
            out.append(text if bare else "'" + text.replace("'", "''") + "'")
        elif text[0] not in _SHARED_LETTERS:
            raise PatternError(f"pattern letter {text[0]!r} is not supported in {pattern!r}")
        elif text[0] == "S" and len(text) != 3:
            # Milliseconds in feed patterns, a fraction of a second in Spark: the same with three digits only.
            raise PatternError(f"milliseconds take three digits in {pattern!r}")
        else:
            out.append(text)
    return "".join(out)


# Parts of patterns that Spark parses, so that a text of another shape needs no try to learn of a wrong one.
_PARSED = {"y", "yy", "yyy", "yyyy", "M", "MM", "d", "dd", "H", "HH", "h", "hh", "k", "kk", "K", "KK", "m", "mm", "s", "ss", "SSS"}
_PARSED_WORDS = {"MMM", "MMMM", "a"}


def _shape(pattern: str) -> str | None:
    """Expression that every text under the pattern matches, and few others; none for rare letters."""
    out = ""
    for text, literal in _runs(pattern):
        if not literal and text not in _PARSED | _PARSED_WORDS:
            return None
        out += re.sub(r"([^\w\s])", r"\\\1", text) if literal else "[+-]?[0-9]+" if text in _PARSED else ".*"
    return f"(?ius)\\A{out}\\z"


def parse_strict(col: Column, pattern: str) -> Column:
    """Timestamp under the session time zone, or null. Texts of another shape are not tried: a parse that fails
    costs many times a look, as it throws."""
    tried, shape = F.try_to_timestamp(col, F.lit(to_spark_pattern(pattern))), _shape(pattern)
    return F.when(col.rlike(shape), tried) if shape else tried


# Larger parts lead beyond the years that a timestamp holds: months, days, and the clock's seconds.
_LARGEST = {"month": 1_000_000, "day": 50_000_000, "second": 1_000_000_000_000}
_NUMERIC = {"y": "year", "M": "month", "d": "day", "D": "day", "H": "hour", "k": "hour", "h": "hour", "K": "hour", "m": "minute", "s": "second", "S": "milli"}
_WORDS = {"a": "half", "E": "weekday", "z": "zone", "Z": "zone", "X": "zone"}

# English names, of which the first three letters tell them apart.
_MONTHS = "jan(?:uary)?|feb(?:ruary)?|mar(?:ch)?|apr(?:il)?|may|june?|july?|aug(?:ust)?|sep(?:tember)?|oct(?:ober)?|nov(?:ember)?|dec(?:ember)?"
_MONTH_ORDER = "janfebmaraprmayjunjulaugsepoctnovdec"
_WEEKDAYS = "mon(?:day)?|tue(?:sday)?|wed(?:nesday)?|thu(?:rsday)?|fri(?:day)?|sat(?:urday)?|sun(?:day)?"
_NAMED_ZONE = "(?:UTC|GMT)(?:[+-][0-9]{1,2}:[0-9]{2})?|[+-][0-9]{4}"
_ISO_ZONE = {1: "Z|[+-][0-9]{2}", 2: "Z|[+-][0-9]{4}", 3: "Z|[+-][0-9]{2}:[0-9]{2}"}


def _lenient_regex(runs: list[tuple[str, bool]]) -> tuple[str, dict[str, str]] | None:
    """Regular expression of a text under a pattern, and the pattern's run for each part, in the order of
    groups; none if the pattern has letters or combinations that are read strictly."""
    regex, found = "\\A[ \\t]*", {}
    for i, (text, literal) in enumerate(runs):
        if literal:
            regex += re.escape(text)
            continue
        letter, n = text[0], len(text)
        part = _NUMERIC.get(letter) or _WORDS.get(letter)
        if part is None or part in found or (letter == "X" and n > 3):
            return None
        found[part] = text
        if letter == "M" and n > 2:
            regex += f"((?i:{_MONTHS}))"
        elif letter == "a":
            regex += "((?i:am|pm))"
        elif letter == "E":
            regex += f"((?i:{_WEEKDAYS}))"
        elif part == "zone":
            regex += f"((?i:{_ISO_ZONE[n] if letter == 'X' else _NAMED_ZONE}))"
        else:
            abuts = i + 1 < len(runs) and not runs[i + 1][1] and runs[i + 1][0][0] in _NUMERIC
            regex += f"([0-9]{{{n}}})" if abuts and not (runs[i + 1][0][0] == "M" and len(runs[i + 1][0]) > 2) else "([0-9]+)"
    if "year" not in found or ("month" in found and found.get("day", "d")[0] == "D"):
        return None
    return regex, found


def _offset(zone: Column) -> Column:
    """Seconds east of Greenwich; null where hours pass 23 or minutes 59."""
    digits = F.regexp_replace(zone, "[^0-9]", "")
    digits = F.lpad(F.when(F.length(digits) == 2, F.concat(digits, F.lit("00"))).otherwise(digits), 4, "0")
    hours, minutes = F.substring(digits, 1, 2).cast("int"), F.substring(digits, 3, 2).cast("int")
    return F.when((hours < 24) & (minutes < 60), F.when(F.contains(zone, F.lit("-")), -1).otherwise(1) * (hours * 3600 + minutes * 60))


def _hour(value: Column, letter: str, half: Column | None) -> Column:
    """Hours since midnight: clocks that start at 1 have no 0, and 12-hour ones go by the half of the day."""
    if letter in "hk":
        top = 12 if letter == "h" else 24
        value = F.when(value == top, F.lit(0)).otherwise(value)
    if letter in "hK" and half is not None:
        value = value + F.when(F.lower(half) == "pm", F.lit(12)).otherwise(F.lit(0))
    return value


def parse_lenient(col: Column, pattern: str) -> Column:
    """Parse with roll-over: month 13 is January of the next year, day 32 the first of
    the next month, hour 25 one o'clock of the next day; text after the last field is ignored.

    Takes number fields, English names of months (short or long, in any case), 12-hour and 24-hour clocks, days of the
    year and zones as offsets, ``UTC`` or ``GMT``. A weekday is only checked to be one. Patterns with other
    letters, with a part twice or without a year use the strict parser.
    """
    known = _lenient_regex(_runs(pattern))
    if known is None:
        return parse_strict(col, pattern)
    regex, found = known
    # One run of the expression: all parts in one text, null where it does not match.
    joined = F.regexp_replace(F.regexp_substr(col, F.lit(regex)), F.lit(regex), F.lit("\x01".join(f"${n}" for n in range(1, len(found) + 1))))
    # Bound to a name, so that Spark does not run it again for every part.
    return F.get(F.transform(F.array(F.split(joined, "\x01")), lambda texts: _rolled(texts, found)), F.lit(0))


def _rolled(texts: Column, found: dict[str, str]) -> Column:
    """Timestamp of the texts of a pattern's parts."""
    part = {}
    for n, (name, text) in enumerate(found.items()):
        value = F.get(texts, F.lit(n))
        if text[0] in _WORDS:
            part[name] = value
        elif text[0] == "M" and len(text) > 2:
            part[name] = ((F.position(F.lower(F.left(value, F.lit(3))), F.lit(_MONTH_ORDER)) + 2) / 3).cast("bigint")
        else:
            number = value.try_cast("bigint")
            number = F.when(number < _LARGEST.get(name, _LARGEST["second"]), number)
            part[name] = number + F.lit(2000) if text == "yy" else number
    zero = F.lit(0)
    start = F.when(part["year"].between(1, 9999), F.make_date(F.when(part["year"].between(1, 9999), part["year"]).cast("int"), F.lit(1), F.lit(1)))
    # Calendar parts move the date, clock parts the time of day, both without a zone; the
    # zone comes last, so a change of clocks in between does not shift the result.
    day = F.date_add(F.add_months(start, (part.get("month", F.lit(1)) - 1).cast("int")), (part.get("day", F.lit(1)) - 1).cast("int"))
    hour = _hour(part["hour"], found["hour"][0], part.get("half")) if "hour" in part else zero
    seconds = hour * 3600 + part.get("minute", zero) * 60 + part.get("second", zero)
    seconds = F.when(seconds < _LARGEST["second"], seconds)
    milli = part.get("milli", zero)
    if "zone" in part:
        days = F.date_diff(day, F.lit("1970-01-01").cast("date")).cast("bigint")
        return F.timestamp_millis((days * 86_400 + seconds - _offset(part["zone"])) * 1000 + milli)
    stamp = day.cast("timestamp_ntz") + F.make_dt_interval(zero, zero, zero, seconds.cast("decimal(18,6)"))
    if "milli" in part:
        stamp = stamp + F.make_dt_interval(zero, zero, zero, (milli / F.lit(1000)).cast("decimal(18,6)"))
    return stamp.cast("timestamp")


def parse_date(col: Column, pattern: str, lenient: bool = False) -> Column:
    return parse_lenient(col, pattern) if lenient else parse_strict(col, pattern)


def has_date_text(col: Column) -> Column:
    """False for a missing value and for the word null in any case: those are left alone."""
    return F.coalesce(~is_null_word(col) & (col != F.lit("")), F.lit(False))


def is_null_word(col: Column) -> Column:
    """The length test spares almost every value the change of case."""
    return (F.octet_length(col) == 4) & (F.lower(col) == "null")


def to_epoch_millis(col: Column, pattern: str, lenient: bool = False) -> Column:
    return F.unix_millis(parse_date(col, pattern, lenient))


def normalise_date(col: Column, pattern: str | None, lenient: bool = False) -> Column:
    """Text re-printed as ``yyyyMMddHHmmss``; without a pattern it stays as it is.
    Null where a pattern is given and the text does not parse."""
    if not pattern:
        return col
    return F.date_format(parse_date(col, pattern, lenient), TARGET_PATTERN)
