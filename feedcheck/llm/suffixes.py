"""Repeated byte strings by a radix sort of suffixes that is as deep as the threshold.

Two windows of ``size`` bytes are equal if their suffixes agree through that depth. Sorting
every suffix of a corpus would move many times its bytes, so windows are sorted together
where they hold the same anchor: of all grams within a window, the one of least hash. The
anchor depends on the window's bytes alone, so equal windows have equal anchors at equal
offsets, and each window belongs to one anchor. The passes go from the most significant
digit on:

* The first digit is the anchor's gram, which all windows of an anchor share. Anchors whose
  gram is met once have no repeated window.
* A digit sorts the windows of an anchor, by the anchor's offset in them, into ranges of 256,
  then 16, then 1. The bytes common to all windows of a range (inner) decide who goes on
  together; if the bytes of all of them (outer) are met twice, for the same offsets, every
  window of the range is repeated and is settled.
* Only groups with an unsettled member get a next pass, with one witness for each settled
  outer string. After the last pass inner and outer are the window itself, and groups of two
  or more are exactly the repeated windows.

Windows of words go through the same passes: their units are the words of a text instead of
its bytes, compared byte for byte whatever white space is between them.
"""

from __future__ import annotations

import hashlib
import re
from dataclasses import dataclass
from itertools import accumulate, zip_longest

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedcheck.llm.common import record_batches, small_batches
from feedcheck.session import delete_table, materialise, scratch

#: Windows worked on at once.
BLOCK = 1 << 16

_P = 0x9E3779B97F4A7C15 | 1
_tables: dict[str, np.ndarray] = {}


def ranges_of(size: int) -> list[int]:
    """Offsets that the passes put together: 256, 16, 1 as far as the gram stays a fair part of the window."""
    return [256, 16, 1] if size >= 320 else [16, 1] if size >= 24 else [1]


def ranges_of_words(words: int) -> list[int]:
    """The same for windows of words."""
    return [32, 4, 1] if words >= 48 else [8, 1] if words >= 12 else [1]


#: White space as Python and Unicode have it; of its bytes, the ASCII ones and longer characters.
_CONTROLS = bytes(32 if 9 <= b <= 13 or 28 <= b <= 32 else b for b in range(256))
_LONG_SPACE = re.compile(rb"\xc2[\x85\xa0]|\xe1\x9a\x80|\xe2\x80[\x80-\x8a\xa8\xa9\xaf]|\xe2\x81\x9f|\xe3\x80\x80")
_SPACE = r"\x09-\x0d\x1c-\x20\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"


def _spaced(data: bytes) -> bytes:
    """White space as spaces, at the same places."""
    data = data.translate(_CONTROLS)
    return data if data.isascii() else _LONG_SPACE.sub(lambda m: b" " * len(m[0]), data)


def in_words(data: bytes) -> tuple[list[bytes], bytes, list[int]]:
    """The words of a text, the words with one space between each two, and where each starts in that."""
    found = _spaced(data).split()
    return found, b" ".join(found), list(accumulate((len(w) + 1 for w in found), initial=0))


def _powers(n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    if len(_tables.get("p", ())) < n:
        rng = np.random.default_rng(99)
        _tables["t"] = rng.integers(0, 1 << 64, 256, np.uint64)
        _tables["p"] = np.cumprod(np.full(n, _P, np.uint64))
        _tables["i"] = np.cumprod(np.full(n, pow(_P, -1, 1 << 64), np.uint64))
    return _tables["t"], _tables["p"], _tables["i"]


def anchors(data: bytes | list[bytes], size: int) -> list[tuple[int, int, int]]:
    """(anchor, least offset, greatest offset) of runs of windows; each window of ``data`` (bytes, or words) is in one."""
    by_word = isinstance(data, list)
    span = (ranges_of_words if by_word else ranges_of)(size)[0]
    gram = size - span + 1
    out = []
    hashes = np.fromiter(map(xxhash.xxh3_64_intdigest, data), np.uint64, len(data)) if by_word else None
    for begin in range(0, len(data) - size + 1, BLOCK):
        windows = min(BLOCK, len(data) - size + 1 - begin)
        table, power, inverse = _powers(BLOCK + size)
        piece = hashes[begin : begin + windows + size - 1] if by_word else table[np.frombuffer(data, np.uint8, windows + size - 1, begin)]
        sums = np.zeros(len(piece) + 1, np.uint64)
        np.cumsum(piece * power[: len(piece)], out=sums[1:])
        n = len(piece) - gram + 1
        h = (sums[gram:] - sums[:n]) * inverse[:n]
        h ^= h >> np.uint64(29)
        h *= np.uint64(0xBF58476D1CE4E5B9)
        h &= np.uint64(0xFFFFFFFF00000000)
        h |= np.arange(n, dtype=np.uint64)
        step = 1
        while step < span:
            h = np.minimum(h[:-step], h[step:])
            step *= 2
        at = (h & np.uint64(0xFFFFFFFF)).astype(np.int64)
        first = np.flatnonzero(np.append(True, at[1:] != at[:-1]))
        last = np.append(first[1:], windows) - 1
        a = at[first]
        out += zip((a + begin).tolist(), (a - last).tolist(), (a - first).tolist())
    return out


def node(data: bytes, a: int, low: int, high: int, low_node: int, width: int, size: int) -> tuple[bytes, bytes]:
    """Digests of a range of offsets: of the inner bytes of the whole range, and of the outer
    bytes of those windows in it that are this anchor's, together with which ones they are."""
    inner = xxhash.xxh3_128_digest(data[a - low_node : a - low_node - width + 1 + size])
    return inner, inner if width == 1 else xxhash.xxh3_128_digest(data[a - high : a - low + size], seed=low << 16 | high)


def word_node(data: bytes, at: list[int], a: int, low: int, high: int, low_node: int, width: int, words: int) -> tuple[bytes, bytes]:
    """The same for windows of words, whose digests never equal those of windows of bytes."""
    inner = xxhash.xxh3_128_digest(data[at[a - low_node] : at[a - low_node - width + 1 + words] - 1], seed=1 << 40)
    return inner, inner if width == 1 else xxhash.xxh3_128_digest(data[at[a - high] : at[a - low + words] - 1], seed=1 << 40 | low << 16 | high)


_ROW = "key binary, a long, low int, high int, known boolean, worded boolean, inner binary, outer binary"
_ROWS = pa.schema([("key", pa.binary()), ("a", pa.int64()), ("low", pa.int32()), ("high", pa.int32()), ("known", pa.bool_()), ("worded", pa.bool_()), ("inner", pa.binary()), ("outer", pa.binary())])
_FIRST = pa.schema([("doc_id", pa.int64()), *_ROWS])


def _first_pass(rows: DataFrame, size: int, words: int | None) -> DataFrame:
    width, word_width = ranges_of(size)[0], ranges_of_words(words)[0] if words else 0

    def made(batches):
        for batch in batches:
            for d, key, data in zip(*(c.to_pylist() for c in batch.columns)):
                for a, low, high in anchors(data, size):
                    yield d, key, a, low, high, False, False, *node(data, a, low, high, 0, width, size)
                if words:
                    found, plain, at = in_words(data)
                    for a, low, high in anchors(found, words):
                        yield d, key, a, low, high, False, True, *word_node(plain, at, a, low, high, 0, word_width, words)

    least = min(size, 2 * words - 1) if words else size
    return rows.filter(F.octet_length("body") >= least).select("doc_id", "key", "body").mapInArrow(lambda b: record_batches(made(b), _FIRST, 16384), "doc_id long, " + _ROW)


def _next_pass(open_rows: DataFrame, texts: DataFrame, width: int, word_width: int, size: int, words: int | None) -> DataFrame:
    """Split each open row into ranges of ``width`` offsets, or ``word_width`` for windows of words."""
    listed = open_rows.groupBy("key").agg(F.collect_list(F.struct("a", "low", "high", "known", "worded")).alias("rows"))

    def made(batches):
        for batch in batches:
            for key, data, rows in zip(*(c.to_pylist() for c in batch.columns)):
                plain, at = in_words(data)[1:] if any(r["worded"] for r in rows) else (b"", [])
                for r in rows:
                    step = word_width if r["worded"] else width
                    for low_node in range(r["low"] // step * step, r["high"] + 1, step):
                        low, high = max(low_node, r["low"]), min(low_node + step - 1, r["high"])
                        digests = word_node(plain, at, r["a"], low, high, low_node, step, words) if r["worded"] else node(data, r["a"], low, high, low_node, step, size)
                        yield key, r["a"], low, high, r["known"], r["worded"], *digests

    wide = texts.join(listed, "key").select("key", "body", "rows")
    return wide.mapInArrow(lambda b: record_batches(made(b), _ROWS, 16384), _ROW)


@dataclass
class Repeats:
    """``rows``: doc_id, key, sha, n_bytes, holds (a window at least) of each row; ``stand``: rows of each key (copies);
    ``spans``: removed spans by key, of texts without copies; ``texts``: key and body of texts that may hold repeats."""

    rows: DataFrame
    stand: DataFrame
    spans: DataFrame
    texts: DataFrame


def repeats(docs: DataFrame, size: int = 400, words: int | None = None) -> Repeats:
    """Find the bytes of ``docs`` (``doc_id``, ``text``) that a repeated string of ``size`` bytes covers,
    and with ``words`` also those that so many repeated words in a row cover.

    A string counts as repeated if it starts at two places or more, of one document or of two,
    also where they overlap; it never crosses documents. Of texts that are equal as a whole
    (repeated throughout, if they are long enough) one stands for all. A null text is empty.
    Rows that share an id or have none are told apart by their texts. Words are what white space
    separates, in the same case and with the marks they touch; a removed run reaches from its first
    word to its last one.
    """
    if size < 2 or words is not None and words < 1:
        raise ValueError("size is at least 2, and words at least 1")
    small_batches(docs.sparkSession)
    body = F.coalesce(F.col("text"), F.lit("")).cast("binary")
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), body.alias("body"), F.sha2(body, 256).alias("sha"))
    rows = rows.withColumn("key", F.substring(F.unhex("sha"), 1, 16))
    holds = F.octet_length("body") >= size
    if words:
        holds |= F.rlike(F.col("body").cast("string"), F.lit(rf"\A[{_SPACE}]*+(?:[^{_SPACE}]++[{_SPACE}]++){{{words - 1}}}[^{_SPACE}]"))
    listed = materialise(rows.select("doc_id", "key", "sha", F.octet_length("body").cast("long").alias("n_bytes"), holds.alias("holds")), "texts")
    stand = materialise(listed.groupBy("key").agg(F.count(F.lit(1)).alias("copies"), F.min("doc_id").alias("stand")), "stand")
    spark = docs.sparkSession
    with scratch(spark):
        current, texts = _met_twice(rows, stand, size, words)
    settled = []
    for width, word_width in [*zip_longest(ranges_of(size)[1:], ranges_of_words(words)[1:] if words else [], fillvalue=1), (0, 0)]:
        with scratch(spark):
            groups = current.groupBy("inner", "outer").agg(F.count(F.lit(1)).alias("n"), F.min("known").alias("all_known"), F.min(F.struct("key", "a", "low", "high", "worded")).alias("w"))
            groups = materialise(groups.withColumn("twice", F.col("n") > 1), "groups")
            found = current.filter("not known").join(groups.filter("twice and not all_known").select("inner", "outer"), ["inner", "outer"])
            length = F.when(F.col("worded"), words or 0).otherwise(size)
            settled.append(materialise(found.select("key", "worded", (F.col("a") - F.col("high")).alias("start"), (F.col("a") - F.col("low") + length).alias("stop")), "settled", keep=True))
            if width:
                # Alone in its group, a string that is met once has no equal window either.
                unsettled = groups.groupBy("inner").agg(F.count(F.lit(1)).alias("strings"), F.max(~F.col("twice") & ~F.col("all_known")).alias("open")).filter("open and strings > 1").select("inner")
                unsettled = materialise(unsettled, "unsettled")
                onward = groups.join(unsettled, "inner").select("w.*", (F.col("twice") | F.col("all_known")).alias("known"))
                after = materialise(_next_pass(onward, texts, width, word_width, size, words), "pass", keep=True)
        delete_table(current)
        if width:
            current = after
    spans = settled[0]
    for more in settled[1:]:
        spans = spans.union(more)
    return Repeats(listed, stand.select("key", "copies"), spans.groupBy("key").agg(F.collect_list(F.struct("start", "stop", "worded")).alias("spans")), texts)


def _met_twice(rows: DataFrame, stand: DataFrame, size: int, words: int | None) -> tuple[DataFrame, DataFrame]:
    """Rows of the first pass whose inner string is met twice or more, and the texts they are from; both stay."""
    first = materialise(_first_pass(rows, size, words), "anchors")
    # Only texts with copies have rows to leave out; where they are few, the anchors need no shuffle.
    mine = materialise(stand.filter("copies > 1").select("key", "stand", F.lit(True).alias("copied")), "copied")
    current = first.drop("known").join(mine, "key", "left").withColumn("known", F.col("copied").isNotNull())
    current = current.filter(~F.col("known") | F.col("doc_id").eqNullSafe(F.col("stand"))).drop("doc_id", "stand", "copied")
    # Keys are written before they are joined back, so that both sides of the join are plain shuffles and Spark may split a hot one.
    met = materialise(current.groupBy("inner").agg(F.count(F.lit(1)).alias("n"), F.min("known").alias("all_known")).filter("n > 1 and not all_known").select("inner"), "met")
    current = materialise(current.join(met, "inner"), "pass", keep=True)
    wanted = current.select("key").distinct().join(stand, "key").select("key", "stand")
    texts = rows.join(wanted, "key").filter(F.col("doc_id").eqNullSafe(F.col("stand"))).select("key", "body")
    return current, materialise(texts, "bodies", keep=True)


def in_bytes(data: bytes, spans: list[dict]) -> list[dict]:
    """Spans of words as spans of the bytes of the text."""
    if not any(s["worded"] for s in spans):
        return spans
    bounds = [m.span() for m in re.finditer(rb"[^ ]+", _spaced(data))]
    return [{"start": bounds[s["start"]][0], "stop": bounds[s["stop"] - 1][1]} if s["worded"] else s for s in spans]


def merged(spans: list[dict]) -> list[tuple[int, int]]:
    """Spans that touch or overlap, as one."""
    out: list[list[int]] = []
    for start, stop in sorted((s["start"], s["stop"]) for s in spans):
        if out and start <= out[-1][1]:
            out[-1][1] = max(out[-1][1], stop)
        else:
            out.append([start, stop])
    return [tuple(s) for s in out]


def kept_bytes(data: bytes, spans: list[tuple[int, int]]) -> bytes:
    parts, at = [], 0
    for start, stop in spans:
        parts.append(data[at:start])
        at = stop
    return b"".join([*parts, data[at:]])


_CUT = pa.schema([("key", pa.binary()), ("n_removed", pa.int64()), ("n_spans", pa.int64()), ("kept_sha256", pa.string())])
_LEFT = pa.schema([("key", pa.binary()), ("left", pa.string())])


def _of_spans(found: Repeats, make, schema: pa.Schema, ddl: str) -> DataFrame:
    def made(batches):
        for batch in batches:
            for key, data, spans in zip(*(c.to_pylist() for c in batch.columns)):
                yield key, *make(data, merged(in_bytes(data, spans)))

    return found.texts.join(found.spans, "key").select("key", "body", "spans").mapInArrow(lambda b: record_batches(made(b), schema, 256), ddl)


def removal_digests(found: Repeats) -> DataFrame:
    """One row per row: doc_id, n_bytes, n_removed, n_spans, kept_sha256."""

    def make(data, spans):
        return sum(b - a for a, b in spans), len(spans), hashlib.sha256(kept_bytes(data, spans)).hexdigest()

    cut = _of_spans(found, make, _CUT, "key binary, n_removed long, n_spans long, kept_sha256 string")
    whole = (F.col("copies") > 1) & F.col("holds")
    # One small row per text, written, so that Spark may split a text with very many rows in the join.
    by_text = materialise(found.stand.join(cut, "key", "left"), "cut")
    return (
        found.rows.join(by_text, "key")
        .select(
            "doc_id",
            "n_bytes",
            F.when(whole, F.col("n_bytes")).otherwise(F.coalesce("n_removed", F.lit(0).cast("long"))).alias("n_removed"),
            F.when(whole, F.lit(1)).otherwise(F.coalesce("n_spans", F.lit(0).cast("long"))).cast("long").alias("n_spans"),
            F.when(whole, F.lit(hashlib.sha256().hexdigest())).otherwise(F.coalesce("kept_sha256", "sha")).alias("kept_sha256"),
        )
    )


def without_repeats(docs: DataFrame, size: int = 400, words: int | None = None) -> DataFrame:
    """``docs`` without the bytes that :func:`repeats` finds, with all its columns; a character cut in two
    goes as a whole, and documents of which nothing is left go, with ``words`` also those of which only white
    space is left. ``n_chars``, where present, is counted anew."""
    spark = docs.sparkSession

    def make(data, spans):
        left = kept_bytes(data, spans).decode("utf-8", "ignore")
        return ("" if words and not left.strip() else left,)

    with scratch(spark):
        found = repeats(docs, size, words)
        cut = _of_spans(found, make, _LEFT, "key binary, left string")
        gone = found.rows.filter("holds").select("key").join(found.stand.filter("copies > 1"), "key").select("key", F.lit("").alias("left")).distinct()
        change = materialise(cut.union(gone).select("key", "left"), "left", keep=True)
    # The caller's row is one column, so that none of its names can clash.
    whole = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))
    digest = F.substring(F.unhex(F.sha2(F.coalesce(F.col("row.text"), F.lit("")).cast("binary"), 256)), 1, 16)
    joined = whole.join(change, digest == F.col("key"), "left").filter(F.col("left").isNull() | (F.col("left") != ""))
    text = F.coalesce(F.col("left"), F.col("row.text"))
    columns = {"text": text}
    if "n_chars" in docs.columns:
        columns["n_chars"] = F.when(F.col("left").isNull(), F.col("row.n_chars")).otherwise(F.char_length(text)).cast(docs.schema["n_chars"].dataType)
    return joined.select(*[columns.get(c, F.col(f"row.`{c}`")).alias(c) for c in docs.columns])
