"""Many expressions in one directory: an index of what their matches must contain.

Every match of ``a.*_0371_[0-9]+`` contains ``_0371_``, so only names that hold this text need the expression. Texts are
cut into pieces of the largest of a few sizes that they hold: names with a piece are among those with a part of it, and
pieces of three letters alone would soon be common to many of thousands of expressions. An expression is filed under the
rarest such piece, a name fetches the expressions under its own pieces, and these alone run. Expressions without a text
of three letters that every match contains form a rest list, which is tried on the names that are still unclaimed.
Results are those of ``unclaimed_files``.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StringType

from ..functions.text import matches
from ..session import broadcast_if_small, materialise
from .unclaimed import KEYS, is_claimed, judged_directories

GRAM = 3
SIZES = (GRAM, 4, 5, 6, 8, 12, 16, 24, 32)
_SLOTS = 1 << 19  # words of 64 bits that tell which pieces are filed
_DEEPEST = 40  # groups within groups beyond this are not looked into
_REPEAT = re.compile(r"(?:[?*+]|\{(\d+)(?:,\d*)?\})[?+]?")
# Escapes that stand for no letter as it is, with what belongs to them.
_ESCAPE = re.compile(r"\\(?:[pPN]\{[^}]*\}|[pP].|x\{[^}]*\}|x..|u....|c.|k<[^>]*>|[0-9]+|[A-Za-z])", re.DOTALL)


class _Unsure(Exception):
    """Nothing can be said about the expression."""


class _Reader:
    """Walks through an expression and gathers covers: lists of texts of which every match contains one or more."""

    def __init__(self, text: str):
        self.text, self.at = text, 0

    def choice(self, depth: int = 0) -> list[list[str]]:
        """Covers of alternatives, up to the end or the bracket that closes their group."""
        if depth > _DEEPEST:
            raise _Unsure
        branches = [self.sequence(depth)]
        while self.text.startswith("|", self.at):
            self.at += 1
            branches.append(self.sequence(depth))
        if len(branches) == 1:
            return branches[0]
        if not all(branches):
            return []  # one alternative may match without any known text
        best = [max(covers, key=lambda c: min(map(len, c))) for covers in branches]
        return [sorted({t for cover in best for t in cover})]

    def sequence(self, depth: int) -> list[list[str]]:
        found: list[list[str]] = []
        run = ""

        def close():
            nonlocal run
            if run:
                found.append([run])
            run = ""

        while self.at < len(self.text) and self.text[self.at] not in "|)":
            letters, covers = self.atom(depth)
            again = _REPEAT.match(self.text, self.at)
            if again:
                self.at = again.end()
                optional = again.group()[0] in "?*" or again.group(1) is not None and int(again.group(1)) == 0
                # A repeat binds the last letter alone, as in a quoted text.
                run += letters[:-1] if optional else letters
                close()
                found += [] if optional else covers
            elif letters:
                run += letters
            else:
                close()
                found += covers
        close()
        return found

    def atom(self, depth: int) -> tuple[str, list[list[str]]]:
        """The letters that the next part stands for, or the covers of a group."""
        c = self.text[self.at]
        if c == "(":
            return "", self.group(depth)
        if c == "[":
            self.skip_class()
            return "", []
        if c == "\\":
            return self.escape(), []
        self.at += 1
        return ("" if c in ".^$" else c), []

    def escape(self) -> str:
        if self.text.startswith("\\Q", self.at):
            end = self.text.find("\\E", self.at)
            body = self.text[self.at + 2 : end if end >= 0 else len(self.text)]
            self.at = end + 2 if end >= 0 else len(self.text)
            return body
        known = _ESCAPE.match(self.text, self.at)
        if known:
            self.at = known.end()
            return ""
        letter = self.text[self.at + 1 : self.at + 2]
        self.at += 2
        return letter

    def group(self, depth: int) -> list[list[str]]:
        self.at += 1
        looks = False
        if self.text.startswith("?", self.at):
            kind = re.compile(r"\?(?::|>|<?[=!]|<[A-Za-z][A-Za-z0-9]*>)").match(self.text, self.at)
            if not kind:
                raise _Unsure  # flags change what letters mean
            looks = kind.group()[-1] in "=!"
            self.at = kind.end()
        covers = self.choice(depth + 1)
        if not self.text.startswith(")", self.at):
            raise _Unsure
        self.at += 1
        return [] if looks else covers

    def skip_class(self) -> None:
        depth = 0
        while self.at < len(self.text):
            c = self.text[self.at]
            if c == "\\":
                self.escape()
                continue
            self.at += 1
            if c == "[":
                depth += 1
                if self.text.startswith("^", self.at):
                    self.at += 1
                if self.text.startswith("]", self.at):
                    raise _Unsure  # a letter or an end, as one reads it
            elif c == "]":
                depth -= 1
                if depth == 0:
                    return
        raise _Unsure


def covers_of(regex: str) -> list[list[str]]:
    """Covers of an expression: each is a list of texts of which every match contains at least one. None if
    nothing is certain, as under flags."""
    reader = _Reader(regex)
    try:
        covers = reader.choice()
    except _Unsure:
        return []
    return covers if reader.at == len(regex) else []


@F.pandas_udf(ArrayType(ArrayType(StringType())))
def _covers(regexes: Iterator[pd.Series]) -> Iterator[pd.Series]:
    for batch in regexes:
        yield batch.map(covers_of)


def grams(text: Column, size: Column) -> Column:
    """Distinct pieces of a text, which has at least this many letters."""
    return F.array_distinct(F.transform(F.sequence(F.lit(1), F.length(text) - size + 1), lambda i: F.substring(text, i, size)))


def pattern_index(sets: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The index ``set_id, gram, regex`` of sets of expressions (``set_id, regexes``), and the rest list
    ``set_id, rest``: one row per set that has expressions without such a piece."""
    each = sets.select("set_id", F.explode("regexes").alias("regex")).distinct()
    # Texts are read once each, by the tasks that hold them.
    read = each.select("regex").distinct().withColumn("covers", _covers("regex"))
    read = read.withColumn("covers", F.filter("covers", lambda c: (F.size(c) > 0) & F.forall(c, lambda t: F.length(t) >= GRAM)))
    known = materialise(each.join(read, "regex"), "covers")
    texts = known.select("set_id", "regex", F.posexplode("covers").alias("cover", "texts"))
    pieces = texts.select("set_id", "regex", "cover", F.posexplode("texts").alias("place", "text"))
    size = F.coalesce(*[F.when(F.length("text") >= s, F.lit(s)) for s in reversed(SIZES)])
    pieces = pieces.withColumn("gram", F.explode(grams(F.col("text"), size)))
    # How many expressions of the set could be filed under the piece.
    common = pieces.select("set_id", "regex", "gram").distinct().groupBy("set_id", "gram").agg(F.count(F.lit(1)).alias("n"))
    rarest = pieces.join(common, ["set_id", "gram"]).groupBy("set_id", "regex", "cover", "place").agg(F.min(F.struct("n", "gram")).alias("r"))
    per_cover = rarest.groupBy("set_id", "regex", "cover").agg(F.sum("r.n").alias("n"), F.collect_set("r.gram").alias("grams"))
    chosen = per_cover.groupBy("set_id", "regex").agg(F.min(F.struct("n", "cover", "grams")).alias("best"))
    index = materialise(chosen.select("set_id", "regex", F.explode("best.grams").alias("gram")), "patterns")
    rest = known.filter(F.size("covers") == 0).groupBy("set_id").agg(F.sort_array(F.collect_set("regex")).alias("rest"))
    return index, materialise(rest, "rest")


def _may_be_filed(own: DataFrame, index: DataFrame) -> DataFrame:
    """Rows whose ``set_id, gram`` may be in the index: all that are, and a few more. The look is at a table of bits of
    a fixed size, so that an index of any size meets only these in a shuffle."""
    h = F.xxhash64("set_id", "gram")
    slot, bit = F.pmod(F.shiftrightunsigned(h, 6), F.lit(_SLOTS)), F.call_function("shiftleft", F.lit(1).cast("bigint"), h.bitwiseAND(F.lit(63)).cast("int"))
    bits = index.groupBy(slot.alias("slot")).agg(F.bit_or(bit).alias("bits"))
    return own.withColumn("slot", slot).join(F.broadcast(bits), "slot").filter(F.col("bits").bitwiseAND(bit) != 0).drop("slot", "bits")


def candidates(placed: DataFrame, index: DataFrame) -> DataFrame:
    """``set_id, file_name, regex``: the expressions that a name has to try, the rest list apart. A name has pieces of
    the sizes that its set's index knows."""
    sizes = index.select("set_id", F.length("gram").alias("size")).distinct()
    # Names are shuffled, so that a few large files of them do not make a few long tasks.
    own = placed.select("set_id", "file_name").distinct().join(broadcast_if_small(sizes), "set_id").filter(F.length("file_name") >= F.col("size"))
    own = own.select("set_id", "file_name", "size", F.explode(F.sequence(F.lit(1), F.length("file_name") - F.col("size") + 1)).alias("start"))
    own = own.select("set_id", "file_name", F.substring("file_name", F.col("start"), F.col("size")).alias("gram"))
    near = broadcast_if_small(index)
    own = _may_be_filed(own, index) if near is index else own
    return own.join(near, ["set_id", "gram"]).select("set_id", "file_name", "regex")


def _placed(listing: DataFrame, rollup: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Files with the number of their directory's set of expressions, and these sets."""
    sets = materialise(judged_directories(rollup).withColumn("set_id", F.monotonically_increasing_id()), "sets")
    real = listing.filter(~F.col("file_name").isin(".", ".."))
    return real.join(broadcast_if_small(sets.drop("regexes")), KEYS), sets.select("set_id", "regexes")


def unclaimed_by_index(listing: DataFrame, rollup: DataFrame) -> DataFrame:
    """``unclaimed_files`` for directories with thousands of expressions: the same rows, without the
    column ``regexes``. What is compared grows with names and candidates, not with names times expressions."""
    placed, sets = _placed(listing, rollup)
    index, rest = pattern_index(sets)
    hits = candidates(placed, index).filter(matches(F.col("file_name"), F.col("regex"))).select("set_id", "file_name").distinct()
    left = placed.join(hits, ["set_id", "file_name"], "left_anti").join(broadcast_if_small(rest), "set_id", "left")
    tried = F.coalesce(is_claimed(F.col("file_name"), F.col("rest")), F.lit(False))
    return left.filter(~tried).drop("set_id", "rest")
