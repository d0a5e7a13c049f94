"""Near-duplicates by circulant MinHash, banding and exact Jaccard similarity."""

from __future__ import annotations

from collections import OrderedDict

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedcheck.llm.common import record_batches, small_batches
from feedcheck.llm.graph import components
from feedcheck.session import materialise

#: Words of a shingle; signature coordinates; bands and coordinates of each. Drawn 200 000
#: times, a pair at a similarity of 0.85 shares no band in one draw, one at 0.8 in 4 of
#: 10 000; a pair at 0.4 shares any in 7 of 100.
WORDS, COORDINATES, BANDS, ROWS = 5, 160, 48, 7
#: Members of a family that meet in one task at once.
BLOCK_ROWS = 64
#: Shingles worked on at once, so that arrays stay in the processor's cache.
BLOCK = 1 << 15

_ODD = np.uint64(0x9E3779B97F4A7C15)


def words_of(text: str | None) -> list[bytes]:
    """Words of a text in UTF-8 with A-Z lower-cased, split at space and at bytes 9 to 13."""
    return text.encode("utf-8", "replace").lower().split() if text else []


def shingle_set(text: str | None) -> np.ndarray:
    """Sorted distinct 64-bit hashes of a text's shingles of five words; a shorter text is one
    shingle, an empty one has none."""
    words = words_of(text)
    if not words:
        return np.empty(0, np.uint64)
    h = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))
    n = max(1, len(words) - WORDS + 1)
    mixed = np.full(n, min(len(words), WORDS), np.uint64)
    for i in range(min(len(words), WORDS)):
        mixed = (mixed ^ h[i : i + n]) * _ODD
        mixed ^= mixed >> np.uint64(32)
    return np.unique(mixed)


def _spread(x: np.ndarray, factor: int, shift: int, factor2: int, shift2: int) -> np.ndarray:
    """A permutation of the 32-bit integers, in place: odd factors and shifted sums can be undone."""
    x *= np.uint32(factor)
    x ^= x >> np.uint32(shift)
    x *= np.uint32(factor2)
    x ^= x >> np.uint32(shift2)
    return x


def signatures(sets: list[np.ndarray]) -> np.ndarray:
    """COORDINATES x sets of MinHash values (all ones for an empty set).

    A first permutation of the 32-bit integers scatters the shingles. A second one,
    shifted circularly by k places, gives coordinate k: the least second(first(s) + k).
    """
    out = np.full((COORDINATES, len(sets)), 0xFFFFFFFF, np.uint32)
    filled = [i for i, s in enumerate(sets) if len(s)]
    at = 0
    while at < len(filled):
        upto, size = at, 0
        while upto < len(filled) and (size == 0 or size + len(sets[filled[upto]]) <= BLOCK):
            size += len(sets[filled[upto]])
            upto += 1
        group = filled[at:upto]
        y = _spread((np.concatenate([sets[i] for i in group]) >> np.uint64(32)).astype(np.uint32), 0x2C1B3C6D, 15, 0x297A2D39, 14)
        if len(group) == 1:
            for k in range(COORDINATES):
                out[k, group[0]] = min(_spread(y[i : i + BLOCK] + np.uint32(k), 0x85EBCA6B, 13, 0xC2B2AE35, 16).min() for i in range(0, len(y), BLOCK))
        else:
            starts = np.cumsum([0] + [len(sets[i]) for i in group[:-1]])
            z = np.empty_like(y)
            for k in range(COORDINATES):
                np.add(y, np.uint32(k), out=z)
                out[k, group] = np.minimum.reduceat(_spread(z, 0x85EBCA6B, 13, 0xC2B2AE35, 16), starts)
        at = upto
    return out


def band_coordinates() -> np.ndarray:
    """BANDS x ROWS of coordinates: each band is its own choice, so coordinates serve several bands."""
    rng = np.random.default_rng(20240607)
    return np.array([rng.choice(COORDINATES, ROWS, replace=False) for _ in range(BANDS)])


def band_keys(sig: np.ndarray) -> np.ndarray:
    """Sets x BANDS of signed 64-bit keys, each made of a band's number and its coordinates."""
    chosen = band_coordinates()
    keys = np.broadcast_to(np.arange(1, BANDS + 1, dtype=np.uint64)[:, None], (BANDS, sig.shape[1])).copy()
    for r in range(ROWS):
        keys = (keys ^ sig[chosen[:, r]].astype(np.uint64)) * _ODD
        keys ^= keys >> np.uint64(29)
    return keys.T.view(np.int64) if keys.T.flags.c_contiguous else np.ascontiguousarray(keys.T).view(np.int64)


_SIGNED = pa.schema([("doc_id", pa.int64()), ("n_shingles", pa.int64()), ("set_key", pa.binary()), ("bands", pa.list_(pa.int64()))])


def signed(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles, set_key (128-bit digest of the shingle set) and bands of each row."""

    def rows(batches):
        for batch in batches:
            ids, texts = (c.to_pylist() for c in batch.columns)
            for i in range(0, len(ids), 128):
                sets = [shingle_set(t) for t in texts[i : i + 128]]
                keys = band_keys(signatures(sets))
                for d, s, k in zip(ids[i : i + 128], sets, keys):
                    yield d, len(s), xxhash.xxh3_128_digest(s.tobytes()), k if len(s) else []

    small_batches(docs.sparkSession)
    read = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").alias("text"))
    return read.mapInArrow(lambda b: record_batches(rows(b), _SIGNED, 512), "doc_id long, n_shingles long, set_key binary, bands array<long>")


_CHECKED = pa.schema([("a", pa.int64()), ("b", pa.int64()), ("common", pa.int64()), ("total", pa.int64())])


def compared(pairs: DataFrame, docs: DataFrame) -> DataFrame:
    """``pairs`` (a, b) with the exact sizes of intersection and union of their full sets."""
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").alias("text"))
    wide = pairs.join(texts.select(F.col("doc_id").alias("a"), F.col("text").alias("text_a")), "a").join(texts.select(F.col("doc_id").alias("b"), F.col("text").alias("text_b")), "b")

    def rows(batches):
        recent: OrderedDict[str, np.ndarray] = OrderedDict()

        def known(text):
            if text not in recent:
                recent[text] = shingle_set(text)
                if len(recent) > 64:
                    recent.popitem(last=False)
            return recent[text]

        for batch in batches:
            for a, b, x, y in zip(*(c.to_pylist() for c in batch.columns)):
                x, y = known(x), known(y)
                common = len(np.intersect1d(x, y, assume_unique=True))
                yield a, b, common, len(x) + len(y) - common

    small_batches(docs.sparkSession)
    return wide.select("a", "b", "text_a", "text_b").mapInArrow(lambda b: record_batches(rows(b), _CHECKED), "a long, b long, common long, total long")


_EDGES = pa.schema([("a", pa.int64()), ("b", pa.int64())])


def _links_of_blocks(batches, percent: int, limit: float):
    """Links in each block of (centre, block, loose_block), whose rows come one after another,
    members first. A loose row needs one link at most to all members near the centre."""

    def links(members, loose):
        sets = {}

        def known(row):
            if row["id"] not in sets:
                sets[row["id"]] = shingle_set(row["text"])
            return sets[row["id"]]

        for y in loose:
            joined = False
            for x in members:
                if x["id"] == y["id"] or x["loose"] and x["id"] > y["id"] or joined and not x["loose"]:
                    continue
                n, m = x["n"], y["n"]
                if 100 * min(n, m) < percent * max(n, m):
                    continue
                if x["far"] <= 1 and y["far"] <= 1:
                    apart = abs(x["far"] - y["far"])
                elif x["far"] <= 1 or y["far"] <= 1:
                    apart = x["least_far"] - y["far"] if y["far"] <= 1 else y["least_far"] - x["far"]
                else:
                    apart = 0
                if apart > limit:
                    continue
                common = len(np.intersect1d(known(x), known(y), assume_unique=True))
                if 100 * common >= percent * (len(known(x)) + len(known(y)) - common):
                    joined |= not x["loose"]
                    yield min(x["id"], y["id"]), max(x["id"], y["id"])

    key, members, loose = None, [], []
    for batch in batches:
        for row in batch.to_pylist():
            now = (row["centre"], row["block"], row["loose_block"])
            if now != key:
                yield from links(members, loose)
                key, members, loose = now, [], []
            (loose if row["asks"] else members).append(row)
    yield from links(members, loose)


def _links_off_centre(family: DataFrame, docs: DataFrame, percent: int, limit: float) -> DataFrame:
    """Links that do not show in the comparison with the centre: each loose member of a family
    (centre, id, n, far, least_far) against the others, in blocks of about 64 by 64."""
    # Written, so that both sides of the join are plain shuffles and Spark may split a hot one.
    family = materialise(family.withColumn("loose", F.col("far") > limit), "family")
    sizes = materialise(family.groupBy("centre").agg(F.count(F.lit(1)).alias("size"), F.sum(F.col("loose").cast("int")).alias("n_loose")).filter("n_loose > 0 and size > 1"), "sizes")
    texts = docs.select(F.col("doc_id").cast("long").alias("id"), F.col("text").alias("text"))
    rows = family.join(sizes, "centre").join(texts, "id")
    blocks, loose_blocks = F.ceil(F.col("size") / BLOCK_ROWS), F.ceil(F.col("n_loose") / BLOCK_ROWS)
    own, own_loose = F.pmod(F.xxhash64("id"), blocks), F.pmod(F.xxhash64("id"), loose_blocks)
    columns = ["centre", "id", "n", "far", "least_far", "loose", "text", "block", "loose_block", "asks"]
    members = rows.withColumns({"block": own, "asks": F.lit(False)}).withColumn("loose_block", F.explode(F.sequence(F.lit(0).cast("long"), loose_blocks - 1)))
    asking = rows.filter("loose").withColumns({"loose_block": own_loose, "asks": F.lit(True)}).withColumn("block", F.explode(F.sequence(F.lit(0).cast("long"), blocks - 1)))
    key = ["centre", "block", "loose_block"]
    dealt = members.select(*columns).union(asking.select(*columns)).repartition(*key).sortWithinPartitions(*key, "asks")
    return dealt.mapInArrow(lambda b: record_batches(_links_of_blocks(b, percent, limit), _EDGES), "a long, b long")


def near_duplicates(docs: DataFrame, percent: int = 85) -> DataFrame:
    """One row per row of ``docs`` (``doc_id``, ``text``): doc_id, n_shingles, component_id, kept.

    Documents are linked if 100 * intersection >= percent * union of their shingle sets;
    component_id is the smallest id reachable. Documents with equal sets are one class from the
    start, and only its smallest id goes on. Band keys find candidates. In each bucket of a key
    every member is compared with one centre, the member that meets most others in all its
    buckets; a bucket of any size gives no more pairs than members. Members that are within the limit of
    the centre need no pair among themselves, as they share a component. A member farther off
    is compared with the other members of that centre, block by block inside tasks, so no
    pairs are dealt out; as 1 - similarity obeys the triangle inequality, only those count
    whose distance to the centre differs from its own by no more than the limit. Pairs whose
    sizes rule a link out are not compared; all others are on full sets.

    A text without words has no shingles and stays alone, as does a row with a null id. Rows
    that share an id count as one document. An empty table gives no rows.
    """
    if not 0 < percent <= 100:
        raise ValueError("percent is from 1 to 100")
    fits = f"100 * least(n, m) >= {percent} * greatest(n, m)"
    limit = 1 - percent / 100 + 1e-9
    staged = materialise(signed(docs), "signed")
    full = staged.filter("doc_id is not null and n_shingles > 0")
    classes = materialise(full.groupBy("set_key").agg(F.min("doc_id").alias("id"), F.count(F.lit(1)).alias("copies")), "classes")
    alone = full.join(classes.select("set_key", F.col("id").alias("doc_id")), ["set_key", "doc_id"], "left_semi")
    bands = alone.select(F.col("doc_id").alias("id"), F.col("n_shingles").alias("n"), F.explode("bands").alias("key"))
    shared = bands.groupBy("key").agg(F.count(F.lit(1)).alias("members")).filter("members > 1")
    member = materialise(bands.join(shared, "key"), "members")
    degree = member.groupBy("id").agg(F.sum(F.col("members") - 1).alias("degree"))
    centre = member.join(degree, "id").groupBy("key").agg(F.max(F.struct("degree", (-F.col("id")).alias("minus"), "n")).alias("c"))
    spokes = member.join(centre.select("key", (-F.col("c.minus")).alias("centre"), F.col("c.n").alias("m")), "key").filter("id <> centre")
    spokes = materialise(spokes.select("id", "n", "centre", "m").distinct(), "spokes")
    by_centre = materialise(compared(spokes.filter(fits).select(F.least("id", "centre").alias("a"), F.greatest("id", "centre").alias("b")).distinct(), docs), "centres")
    found = by_centre.withColumn("far", 1 - F.col("common") / F.col("total"))
    both = found.select(F.col("a").alias("id"), F.col("b").alias("centre"), "far").union(found.select(F.col("b").alias("id"), F.col("a").alias("centre"), "far"))
    # A pair that sizes rule out was not compared; its distance is at least that of nested sets.
    family = spokes.join(both, ["id", "centre"], "left").select("centre", "id", "n", F.coalesce("far", F.lit(2.0)).alias("far"), (1 - F.least("n", "m") / F.greatest("n", "m")).alias("least_far"))
    near = by_centre.filter(f"100 * common >= {percent} * total").select("a", "b")
    edges = near.union(_links_off_centre(family, docs, percent, limit))
    labels = components(edges)
    named = classes.join(labels, "id", "left").select("set_key", F.coalesce("component", "id").alias("component_id"))
    out = staged.join(named, "set_key", "left")
    component = F.when(F.col("doc_id").isNull(), F.lit(None)).when(F.col("n_shingles") == 0, F.col("doc_id")).otherwise(F.col("component_id"))
    return out.select("doc_id", "n_shingles", component.cast("long").alias("component_id"), F.coalesce(F.col("doc_id") == component, F.lit(True)).alias("kept"))
