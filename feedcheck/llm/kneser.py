"""Interpolated modified Kneser-Ney model of word pairs: counted in Spark, stored as sorted hash
arrays that workers map into memory.

Level one holds the hashes of all training tokens in order; the place of a token's hash is its
number. Level two holds pairs of numbers, scattered by a bijection to 64-bit keys, in order.
Both are cut into shards, which are ranges of keys: a task of the count makes one shard, and no
shard depends on how frequent a word is, because pairs of one word are scattered over all.

    p(w|u) = max(c(uw) - D(c(uw)), 0) / c(u) + g(u) p(w)
    p(w)   = max(a(w) - D'(a(w)), 0) / A + g' / (V + 1)

c are counts of the training text, a(w) the number of different tokens met before w, A their
sum, V the number of different tokens. D and D' take one of three values each for counts of
1, 2 and 3 or more, estimated from how many pairs (or tokens) are met one to four times; g and g'
are what the discounts leave. A token not met in training has a = 0; after a token not met, p(w|u)
is p(w). With the unknown token as one more, p(.|u) adds up to one.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedcheck.llm.common import record_batches, small_batches
from feedcheck.llm.counted import BLOBS, BLOBS_SCHEMA, SortedArrays, Tally, byte_classes, least_type, mapped_folder, mixed, shard_of, shards_for, sums, text_column, word_hashes, words_of, write_array
from feedcheck.session import materialise

#: White space between words.
GAPS = byte_classes(b" \x09\x0a\x0b\x0c\x0d")
#: Hashes of the start and of the end of a text.
START, END = (int(mixed(np.array([n], np.uint64))[0]) for n in (1, 2))
_HALF = np.uint64(32)


def tokens_of(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the start, the words and the end of each text of a binary column, one text after
    another, and where each text's start is."""
    data, at = text_column(column)
    starts, stops = words_of(data, at, GAPS)
    hashes = word_hashes(data, starts, stops)
    text = np.searchsorted(at, starts, "right") - 1  # empty texts start where the next one does
    first = np.arange(len(column)) * 2 + np.searchsorted(text, np.arange(len(column)))
    out = np.empty(len(hashes) + 2 * len(column), np.uint64)
    out[np.arange(len(hashes)) + 2 * text + 1] = hashes
    out[first] = START
    out[np.append(first[1:], len(out)) - 1] = END
    return out, first


def discounts(n: list[int]) -> tuple[float, float, float]:
    """Discounts of counts 1, 2 and 3 or more, from the numbers of keys counted 1, 2, 3 and 4 times.
    Where these are too few for an estimate, 1/2, 1 and 3/2."""
    if min(n) > 0:
        y = n[0] / (n[0] + 2 * n[1])
        found = tuple(k - (k + 1) * y * n[k] / n[k - 1] for k in (1, 2, 3))
        if all(0 < d < k for k, d in zip((1, 2, 3), found)):
            return found
    return 0.5, 1.0, 1.5


@dataclass
class Model:
    """``words`` and ``pairs`` lie in ``folder``; sizes by shard. ``tokens`` is N, ``types`` V, ``links`` A."""

    folder: str
    shards: int
    words: dict[int, int]
    pairs: dict[int, int]
    tokens: int
    types: int
    links: int
    pair_discounts: tuple[float, float, float]
    word_discounts: tuple[float, float, float]
    rest: float

    def arrays(self) -> tuple[SortedArrays, SortedArrays]:
        if self.folder not in _open:
            words = SortedArrays(f"{self.folder}/words", self.words, self.shards, ("counts", "before", "one", "two", "more"))
            _open[self.folder] = words, SortedArrays(f"{self.folder}/pairs", self.pairs, self.shards, ("counts",))
        return _open[self.folder]


_open: dict[str, tuple[SortedArrays, SortedArrays]] = {}


def _texts(docs: DataFrame, *columns) -> DataFrame:
    return docs.select(F.coalesce(F.col("text"), F.lit("")).cast("binary").alias("text"), *columns)


def fit(docs: DataFrame, folder: str | None = None) -> Model:
    """Count ``docs`` (``text``; null counts as empty, other columns are ignored) and write the model.

    Tokens are the words between white space, A-Z in lower case, and one end for each text. Words are
    told apart by 64-bit hashes. Each task counts its own rows first; shards are merged in tasks of
    bounded size. Only sizes and totals of shards come to the driver. At most 2^32 - 1 different
    words. An empty table gives a model that gives each token the probability one. ``folder`` is a path that all
    workers share; by default it lies in the shared folder.
    """
    spark = docs.sparkSession
    small_batches(spark)
    shards, folder = shards_for(docs), mapped_folder(spark, "kneser", folder)
    texts = _texts(docs)

    def words(batches):
        tally = Tally(shards, scattered=True)
        for batch in batches:
            yield from tally.add(tokens_of(batch.column(0))[0])
        yield from tally.flush()

    def word_shard(table: pa.Table) -> pa.Table:
        shard = table.column("shard")[0].as_py()
        keys, counts = sums(table)
        write_array(f"{folder}/words", f"keys-{shard:07d}", keys)
        write_array(f"{folder}/words", f"counts-{shard:07d}", counts.astype(least_type(counts)))
        starts = int(counts[keys == np.uint64(START)].sum())
        return pa.table({"shard": pa.array([shard], pa.int32()), "n": pa.array([len(keys)], pa.int64()), "tokens": pa.array([int(counts.sum()) - starts], pa.int64()), "starts": pa.array([starts], pa.int64())})

    counted = texts.mapInArrow(lambda b: record_batches(words(b), BLOBS_SCHEMA, 16), BLOBS)
    sizes = materialise(counted.groupBy("shard").applyInArrow(word_shard, "shard int, n long, tokens long, starts long"), "words").collect()
    word_sizes = {r.shard: r.n for r in sizes}
    tokens, types = sum(r.tokens for r in sizes), max(0, sum(word_sizes.values()) - 1)
    if types >= 1 << 32:
        raise ValueError("more than 2^32 - 1 different words")
    if not types:
        return Model(folder, shards, {}, {}, 0, 0, 0, discounts([0] * 4), discounts([0] * 4), 1.0)

    def pairs(batches):
        known, tally = SortedArrays(f"{folder}/words", word_sizes, shards), Tally(shards, scattered=False)
        for batch in batches:
            hashes, first = tokens_of(batch.column(0))
            distinct, back = np.unique(hashes, return_inverse=True)
            ids = known.find(distinct)[0].astype(np.uint64)[back]
            inner = np.ones(len(ids), bool)
            inner[first] = False
            inner = np.flatnonzero(inner)
            yield from tally.add(ids[inner - 1] << _HALF | ids[inner])
        yield from tally.flush()

    names = np.array(sorted(word_sizes))
    ends = np.cumsum([word_sizes[s] for s in names])

    def pair_shard(table: pa.Table) -> pa.Table:
        shard = table.column("shard")[0].as_py()
        keys, counts = sums(table)
        scattered = mixed(keys)
        order = np.argsort(scattered)
        write_array(f"{folder}/pairs", f"keys-{shard:07d}", scattered[order])
        write_array(f"{folder}/pairs", f"counts-{shard:07d}", counts[order].astype(least_type(counts)))
        left, at = np.unique((keys >> _HALF).astype(np.int64), return_inverse=True)
        right, met = np.unique((keys & np.uint64(0xFFFFFFFF)).astype(np.int64), return_counts=True)
        ids = np.union1d(left, right)
        cells = np.zeros((4, len(ids)), "<u4")
        cells[0, np.searchsorted(ids, right)] = met
        for row, kind in enumerate((counts == 1, counts == 2, counts > 2), 1):
            cells[row, np.searchsorted(ids, left)] = np.bincount(at[kind], minlength=len(left))
        bounds = np.searchsorted(ids, np.append(0, ends))
        rows = [(int(s), ids[a:b].astype("<u4").tobytes(), cells[:, a:b].tobytes(), shard, 0, *[0] * 4) for s, a, b in zip(names, bounds, bounds[1:]) if b > a]
        rows.append((-1, b"", b"", shard, len(keys), *(int((counts == k).sum()) for k in (1, 2, 3, 4))))
        return pa.table([pa.array(c, t) for c, t in zip(zip(*rows), _PARTS.types)], schema=_PARTS)

    counted = texts.mapInArrow(lambda b: record_batches(pairs(b), BLOBS_SCHEMA, 16), BLOBS)
    parts = materialise(counted.groupBy("shard").applyInArrow(pair_shard, _PARTS_DDL), "pairs")
    totals = parts.filter("shard < 0").select("of", "n", "n1", "n2", "n3", "n4").collect()
    before = {s: int(e) - word_sizes[s] for s, e in zip(names.tolist(), ends)}

    def neighbour_shard(table: pa.Table) -> pa.Table:
        shard = table.column("shard")[0].as_py()
        cells = np.zeros((4, word_sizes[shard]), np.int64)
        for ids, values in zip(table.column("ids").to_pylist(), table.column("cells").to_pylist()):
            at = np.frombuffer(ids, "<u4").astype(np.int64) - before[shard]
            cells[:, at] += np.frombuffer(values, "<u4").reshape(4, -1)
        for name, row in zip(("before", "one", "two", "more"), cells):
            write_array(f"{folder}/words", f"{name}-{shard:07d}", row.astype(least_type(row)))
        a = cells[0]
        return pa.table({k: pa.array([int(v)], pa.int64()) for k, v in {"links": a.sum(), "n1": (a == 1).sum(), "n2": (a == 2).sum(), "n3": (a == 3).sum(), "n4": (a == 4).sum(), "more": (a > 2).sum()}.items()})

    seen = parts.filter("shard >= 0").select("shard", "ids", "cells")
    level = materialise(seen.groupBy("shard").applyInArrow(neighbour_shard, "links long, n1 long, n2 long, n3 long, n4 long, more long"), "neighbours").agg(*[F.sum(c).alias(c) for c in ("links", "n1", "n2", "n3", "n4", "more")]).first()
    low = discounts([level.n1, level.n2, level.n3, level.n4])
    rest = (low[0] * level.n1 + low[1] * level.n2 + low[2] * level.more) / level.links
    high = discounts([sum(r[f"n{k}"] for r in totals) for k in (1, 2, 3, 4)])
    return Model(folder, shards, word_sizes, {r.of: r.n for r in totals}, tokens, types, level.links, high, low, rest)


_PARTS_DDL = "shard int, ids binary, cells binary, of int, n long, n1 long, n2 long, n3 long, n4 long"
_PARTS = pa.schema([("shard", pa.int32()), ("ids", pa.binary()), ("cells", pa.binary()), ("of", pa.int32()), *[(c, pa.int64()) for c in ("n", "n1", "n2", "n3", "n4")]])

_SCORES = pa.schema([("doc_id", pa.int64()), ("held_out", pa.bool_()), *[(c, pa.int64()) for c in ("n_tokens", "n_known", "train_tokens")], ("base_score", pa.float64()), ("score", pa.float64())])


def _less(counts: np.ndarray, discount: tuple[float, float, float]) -> np.ndarray:
    return counts - np.array([0.0, *discount])[np.minimum(counts, 3)]


def token_scores(column: pa.Array, model: Model) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Of each token after the start: its count in training, its probability under the model, the base
    probability; and where each text's tokens start among them."""
    words, pairs = model.arrays()
    hashes, first = tokens_of(column)
    distinct, back = np.unique(hashes, return_inverse=True)
    place, word = words.find(distinct)
    p_word = (_less(word["before"], model.word_discounts) / max(1, model.links)) + model.rest / (model.types + 1)
    with np.errstate(divide="ignore", invalid="ignore"):
        left = sum(d * word[c] for d, c in zip(model.pair_discounts, ("one", "two", "more"))) / word["counts"]
    ids = place[back]
    inner = np.ones(len(ids), bool)
    inner[first] = False
    inner = np.flatnonzero(inner)
    now, last = back[inner], back[inner - 1]
    both = (ids[inner] >= 0) & (ids[inner - 1] >= 0)
    keys = mixed(ids[inner - 1][both].astype(np.uint64) << _HALF | ids[inner][both].astype(np.uint64))
    asked, again = np.unique(keys, return_inverse=True)
    met = np.zeros(len(inner), np.int64)
    met[both] = pairs.find(asked)[1]["counts"][again]
    seen = ids[inner - 1] >= 0
    p = p_word[now]
    p[seen] = _less(met[seen], model.pair_discounts) / word["counts"][last[seen]] + left[last[seen]] * p[seen]
    counts = word["counts"][now]
    return counts, p, (counts + 1) / (model.tokens + model.types + 1), first - np.arange(len(first))


def score(docs: DataFrame, model: Model, held_out: str = "false") -> DataFrame:
    """One row for each of ``docs`` (``doc_id``, ``text``): doc_id, held_out (the given SQL condition, false
    where it is null), n_tokens, n_known (tokens met in training), train_tokens, base_score (log10 of the
    add-one probability of the tokens alone) and score (log10 of the model's probability); perplexity is
    ``pow(10, -score / n_tokens)``.

    A null text counts as empty and has its end alone; null and repeated ids give rows of their own; an
    empty table gives no rows. Other columns are ignored. Nothing is shuffled.
    """
    small_batches(docs.sparkSession)
    texts = _texts(docs, F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.expr(held_out), F.lit(False)).alias("held_out"))

    def rows(batches):
        for batch in batches:
            if not len(batch):
                continue
            counts, p, base, first = token_scores(batch.column(0), model)
            known = np.add.reduceat((counts > 0).astype(np.int64), first)
            columns = [batch.column(1), batch.column(2), np.diff(np.append(first, len(counts))), known, np.full(len(batch), model.tokens), np.add.reduceat(np.log10(base), first), np.add.reduceat(np.log10(p), first)]
            yield pa.RecordBatch.from_arrays([c if isinstance(c, pa.Array) else pa.array(c, f.type) for c, f in zip(columns, _SCORES)], schema=_SCORES)

    return texts.mapInArrow(rows, "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double")
