"""Phrases whose words stay together, from counts over a prefix-free parse.

A text is a sequence of words and of marks between its pieces. Two neighbours whose hash is
among the least of ``EVERY`` are a trigger; a chunk goes from one trigger to the next, both included, so
neighbouring chunks share a trigger and equal passages give equal chunks wherever they stand.
Spark counts each distinct chunk (the dictionary with its frequencies). An n-gram of up to
three words belongs to the chunk in which it starts before the closing trigger, so what two
chunks share is counted once, and the count in the corpus is the sum over distinct chunks of
the chunk's frequency. Longer phrases need a longer trigger: ``words - 1`` neighbours.

Only n-grams that are met often enough matter, and such an n-gram has two shorter ones that
are met as often. So lengths are counted one after the other over hashed keys, each over the
n-grams whose parts were frequent; frequent keys are sorted arrays that workers map into
memory. Hashes decide only what is looked at: the counts that go into scores are grouped by
the phrase itself.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from feedcheck.llm.common import record_batches, small_batches
from feedcheck.llm.counted import BLOBS, BLOBS_SCHEMA, SHARD_BYTES, SortedArrays, Tally, byte_classes, mapped_folder, mixed, sums, text_column, word_hashes, words_of, write_array
from feedcheck.session import materialise

#: Tokens between two triggers, on average.
EVERY = 16
#: Distinct chunks that a task holds, by their bytes, before it sends their counts.
HELD_BYTES = 24 << 20
#: Chunks whose n-grams are looked up together, by their bytes.
GATHERED_BYTES = 6 << 20
#: Parts of a language whose first phrases are found apart.
PARTS = 16
#: Marks between pieces. Words are told from them by spaces.
MARK = b"\n"
_MARKS = bytes(10 if b in b".,;:!?\x0a\x0b\x0c\x0d" else 32 if b == 9 else b for b in range(256))
_GAPS = byte_classes(b" ")
_UNKNOWN = "und"

_CHUNKS = pa.schema([("lang", pa.string()), ("chunk", pa.binary()), ("n", pa.int64()), ("own", pa.int32())])


def spaced(text: bytes) -> bytes:
    """Words in lower case (A-Z) and a mark between each two pieces, with one space between each two."""
    return b" ".join(filter(None, text.lower().translate(_MARKS).replace(MARK, b" \n ").split(b" ")))


def chunks_of(texts: list[bytes], shared: int = 2, every: int = EVERY) -> Iterator[tuple[int, bytes, int]]:
    """Chunks of :func:`spaced` texts: which text, the chunk, and how many words start in it before its closing
    trigger. A text is closed by marks, which are its last trigger; one without words has no chunks."""
    closing = b" \n" * shared
    data = np.frombuffer(b"".join(t + closing for t in texts if t), np.uint8)
    numbers = np.flatnonzero([len(t) > 0 for t in texts])
    at = np.cumsum([0, *(len(t) + len(closing) for t in texts if t)])
    starts, stops = words_of(data, at, _GAPS)
    hashes = word_hashes(data, starts, stops)
    marks = np.append(0, np.cumsum((stops - starts == 1) & (data[starts] == MARK[0])))
    first = np.searchsorted(starts, at)
    trigger = np.zeros(len(hashes), np.uint64)
    for k in range(shared):
        trigger[: len(hashes) - k] = mixed(trigger[: len(hashes) - k] + hashes[k:])
    cut = trigger < np.uint64((1 << 64) // every)
    # The closing marks of a text are a trigger, its first word always starts a chunk, and no chunk starts within the closing marks.
    for k in range(1, shared + 1):
        cut[first[1:] - k] = k == shared
    cut[first[:-1]] = True
    cuts = np.flatnonzero(cut)
    text = np.searchsorted(first, cuts, "right") - 1
    whole = data.tobytes()
    for j in np.flatnonzero(text[1:] == text[:-1]).tolist():
        a, b = cuts[j], cuts[j + 1]
        yield int(numbers[text[j]]), whole[starts[a] : stops[b + shared - 1]], int(b - a - marks[b] + marks[a])


def dictionary(docs: DataFrame, shared: int = 2) -> DataFrame:
    """Distinct chunks of ``docs`` (``text``, ``lang``): lang, chunk, own (words counted in it), n (frequency).

    A null text has no chunks; a null lang counts as ``und``.
    """
    small_batches(docs.sparkSession)

    def rows(batches):
        held: Counter = Counter()
        size = 0
        for batch in batches:
            langs, texts = (c.to_pylist() for c in batch.columns)
            held.update((langs[i], chunk, own) for i, chunk, own in chunks_of(list(map(spaced, texts)), shared))
            size += batch.nbytes
            if size >= HELD_BYTES:
                yield from ((lang, chunk, n, own) for (lang, chunk, own), n in held.items())
                held, size = Counter(), 0
        yield from ((lang, chunk, n, own) for (lang, chunk, own), n in held.items())

    texts = docs.select(F.coalesce(F.col("lang").cast("string"), F.lit(_UNKNOWN)).alias("lang"), F.coalesce(F.col("text"), F.lit("")).cast("binary").alias("text"))
    parsed = texts.mapInArrow(lambda b: record_batches(rows(b), _CHUNKS, 4096), "lang string, chunk binary, n long, own int")
    return materialise(parsed.groupBy("lang", "chunk", "own").agg(F.sum("n").alias("n")), "chunks")


def gathered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Batches of chunks put together up to ``GATHERED_BYTES``."""
    held, size = [], 0
    for batch in batches:
        held.append(batch)
        size += batch.nbytes
        if size >= GATHERED_BYTES:
            yield from pa.Table.from_batches(held).combine_chunks().to_batches()
            held, size = [], 0
    if size:
        yield from pa.Table.from_batches(held).combine_chunks().to_batches()


def slices(data: np.ndarray, starts: np.ndarray, stops: np.ndarray) -> pa.Array:
    """Slices of UTF-8 bytes as strings."""
    ends = np.cumsum(np.append(0, stops - starts))
    body = data[np.repeat(starts - ends[:-1], stops - starts) + np.arange(ends[-1])]
    return pa.StringArray.from_buffers(len(starts), pa.py_buffer(ends.astype(np.int32).tobytes()), pa.py_buffer(body.tobytes()))


class Grams:
    """N-grams of one batch of chunks that start in a chunk's own part and cross no mark: hashed keys by length,
    up to ``longest`` words. The chunks share triggers of ``words - 1`` tokens."""

    def __init__(self, batch: pa.RecordBatch, words: int, longest: int):
        lang, chunk, n = batch.columns[:3]
        self.data, at = text_column(chunk)
        self.starts, self.stops = words_of(self.data, at, _GAPS)
        seeds = {x: xxhash.xxh3_64_intdigest(x or "") for x in set(lang.to_pylist())}
        text = np.searchsorted(at, self.starts, "right") - 1
        self.text, self.weights = text, n.to_numpy(zero_copy_only=False)[text]
        mark = (self.stops - self.starts == 1) & (self.data[self.starts] == MARK[0])
        ends = np.searchsorted(text, np.arange(len(chunk)), "right")
        own = np.arange(len(text)) < (ends - (words - 1))[text]
        hashes = word_hashes(self.data, self.starts, self.stops)
        self.keys = [mixed(hashes + np.array([seeds[x] for x in lang.to_pylist()], np.uint64)[text])]
        self.valid = [own & ~mark]
        for k in range(1, longest):
            key, valid = np.zeros_like(hashes), np.zeros(len(hashes), bool)
            if len(hashes) > k:
                key[:-k] = mixed(self.keys[k - 1][:-k] * np.uint64(0x9E3779B97F4A7C15) + hashes[k:])
                valid[:-k] = self.valid[k - 1][:-k] & ~mark[k:]
            self.keys.append(key)
            self.valid.append(valid)
        self.mark, self.inside = mark, ends[text] - np.arange(len(text))

    def frequent(self, arrays: dict[int, SortedArrays]) -> None:
        """Keep the n-grams whose parts of the lengths in ``arrays`` are frequent, from the shortest on."""
        for k, known in sorted(arrays.items()):
            if k >= len(self.keys):
                return
            # Parts that start a word later may belong to the next chunk, but lie in this one.
            whole = (self.inside >= k) & ~self.mark
            for j in range(1, k):
                whole[:-j] &= ~self.mark[j:]
            asked = np.flatnonzero(whole)
            distinct, back = np.unique(self.keys[k - 1][asked], return_inverse=True)
            whole[asked] = known.find(distinct)[0][back] >= 0
            self.valid[k] &= whole & np.append(whole[1:], False)
            for longer in range(k + 1, len(self.keys)):
                self.valid[longer] &= self.valid[longer - 1]


def frequent_counts(chunks: DataFrame, words: int, least: int) -> DataFrame:
    """lang, phrase (words joined by one space), words, f of every phrase of up to ``words`` words that
    occurs at least ``least`` times in its language, from the dictionary ``chunks``."""
    spark = chunks.sparkSession
    small_batches(spark)
    folder = mapped_folder(spark, "phrases")
    size = chunks.agg(F.sum(F.octet_length("chunk"))).first()[0] or 0
    shards = max(1, -(-size // SHARD_BYTES))
    sizes: dict[int, dict[int, int]] = {}

    def arrays(known: dict[int, dict[int, int]]) -> dict[int, SortedArrays]:
        return {k: SortedArrays(f"{folder}/words-{k}", s, shards) for k, s in known.items()}

    def counted(k: int) -> dict[int, int]:
        """Count phrases of ``k`` words and write the frequent ones; how many each shard has."""
        known = dict(sizes)

        def keys(batches):
            tally, parts = Tally(shards, scattered=True), arrays(known)
            for batch in gathered(batches):
                grams = Grams(batch, words, k)
                grams.frequent(parts)
                valid = grams.valid[k - 1]
                yield from tally.add(grams.keys[k - 1][valid], grams.weights[valid])
            yield from tally.flush()

        def often(table: pa.Table) -> pa.Table:
            shard = table.column("shard")[0].as_py()
            found, counts = sums(table)
            found = found[counts >= least]
            write_array(f"{folder}/words-{k}", f"keys-{shard:07d}", found)
            return pa.table({"shard": pa.array([shard], pa.int32()), "n": pa.array([len(found)], pa.int64())})

        sent = chunks.select("lang", "chunk", "n").mapInArrow(lambda b: record_batches(keys(b), BLOBS_SCHEMA, 16), BLOBS)
        return {r.shard: r.n for r in materialise(sent.groupBy("shard").applyInArrow(often, "shard int, n long"), "frequent").collect()}

    # Nearly all words of a text are frequent, so pairs are counted first, without asking for their words.
    for k in range(2, words + 1):
        sizes[k] = counted(k)

    out = pa.schema([("lang", pa.string()), ("phrase", pa.string()), ("words", pa.int32()), ("n", pa.int64())])

    def named(batches):
        """Words, and frequent phrases, by name, each once a batch."""
        parts = arrays(sizes)
        for batch in gathered(batches):
            grams = Grams(batch, words, words)
            grams.frequent(parts)
            langs = batch.column(0).combine_chunks() if isinstance(batch.column(0), pa.ChunkedArray) else batch.column(0)
            for k in range(1, words + 1):
                asked = np.flatnonzero(grams.valid[k - 1])
                distinct, at, back = np.unique(grams.keys[k - 1][asked], return_index=True, return_inverse=True)
                totals = np.bincount(back, grams.weights[asked], len(distinct)).astype(np.int64)
                if k > 1:
                    hit = parts[k].find(distinct)[0] >= 0
                    at, totals = at[hit], totals[hit]
                i = asked[at]
                yield pa.RecordBatch.from_arrays([langs.take(pa.array(grams.text[i])), slices(grams.data, grams.starts[i], grams.stops[i + k - 1]), pa.array(np.full(len(i), k), pa.int32()), pa.array(totals, pa.int64())], schema=out)

    rows = chunks.select("lang", "chunk", "n").mapInArrow(named, "lang string, phrase string, words int, n long")
    return materialise(rows.groupBy("lang", "phrase", "words").agg(F.sum("n").alias("f")).filter(F.col("f") >= least), "phrases")


def scored(cuts: DataFrame) -> DataFrame:
    """``cuts`` (``a``, ``l``, ``r``, up to 10^15) with score, floor(1000000 a a / (l r)) in decimals of 38 places."""
    a, l, r = (f"cast({c} as decimal(15,0))" for c in "alr")
    return cuts.withColumn("score", F.expr(f"cast({a} * {a} * cast(1000000 as decimal(7,0)) as decimal(38,0)) div ({l} * {r})"))


def collocations(docs: DataFrame, words: int = 3, least: int = 10, inside: int = 50, limit: int = 2000) -> DataFrame:
    """Phrases of two to ``words`` words that occur at least ``least`` times in ``docs`` (``text``, ``lang``),
    the first ``limit`` of each language: lang, rank, phrase, a, l, r, n, score.

    Words are in lower case (A-Z) and stand between spaces or tabs; phrases do not cross the marks
    ``.,;:!?`` or line breaks. a counts all occurrences, overlaps included, n all words of the
    language. A phrase is cut in two where floor(1000000 a a / (l r)) is least, l and r being the counts
    of the parts; ties go to the shortest first part. A phrase goes if a longer one of at least ``least``
    occurrences and ``inside`` per cent of its own holds its words in a row. Order: score and a descending, then the
    phrase's bytes. A null text counts as empty, a null lang as ``und``; repeated rows count as often
    as they occur; an empty table gives no rows; other columns are ignored.
    """
    if words < 2 or least < 1:
        raise ValueError("phrases have at least two words and one occurrence")
    chunks = dictionary(docs, words - 1)
    totals = chunks.groupBy("lang").agg(F.sum(F.col("n") * F.col("own")).alias("n"))
    counts = frequent_counts(chunks, words, least)
    part = F.split("phrase", " ")
    found = counts.filter("words > 1").select("lang", "phrase", "words", F.col("f").alias("a"))
    cuts = found.withColumn("k", F.explode(F.sequence(F.lit(1), F.col("words") - 1)))
    cuts = cuts.withColumn("first", F.array_join(F.slice(part, F.lit(1), F.col("k")), " ")).withColumn("rest", F.array_join(F.slice(part, F.col("k") + 1, F.col("words") - F.col("k")), " "))
    cuts = cuts.join(counts.select("lang", F.col("phrase").alias("first"), F.col("f").alias("l")), ["lang", "first"])
    cuts = materialise(cuts.join(counts.select("lang", F.col("phrase").alias("rest"), F.col("f").alias("r")), ["lang", "rest"]), "cuts")
    best = scored(cuts).groupBy("lang", "phrase", "words", "a").agg(F.min(F.struct("score", "k", "l", "r")).alias("cut"))
    spans = F.flatten(F.transform(F.sequence(F.lit(2), F.col("words") - 1), lambda m: F.transform(F.sequence(F.lit(1), F.col("words") - m + 1), lambda s: F.array_join(F.slice(part, s, m), " "))))
    longer = found.filter("words > 2").select("lang", F.explode(spans).alias("phrase"), F.col("a").alias("f")).groupBy("lang", "phrase").agg(F.max("f").alias("held"))
    left = best.join(longer, ["lang", "phrase"], "left").filter(F.col("held").isNull() | (100 * F.col("held") < inside * F.col("a")))
    left = left.select("lang", "phrase", "a", "cut.l", "cut.r", F.col("cut.score").alias("score"))
    # The first of each part of a language, then of the language, so that no task sees more than the parts' first.
    by = [F.col("score").desc(), F.col("a").desc(), "phrase"]
    left = left.withColumn("part", F.pmod(F.hash("phrase"), F.lit(PARTS)))
    left = left.withColumn("rank", F.row_number().over(Window.partitionBy("lang", "part").orderBy(*by))).filter(F.col("rank") <= limit)
    order = Window.partitionBy("lang").orderBy(*by)
    ranked = left.withColumn("rank", F.row_number().over(order).cast("long")).filter(F.col("rank") <= limit)
    return ranked.join(totals, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
