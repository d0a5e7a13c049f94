"""Packing of token sequences by an order-preserving dynamic programme."""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedcheck.llm.bpe import codec
from feedcheck.llm.common import record_batches, small_batches

#: Cost of a cut, in tokens of padding: at a sentence's end, and inside a sentence.
SENTENCE, INSIDE = 8, 24
#: Cells of a sequence; one in which no sentence ends has a candidate cut at its end.
CELLS = 128
#: Windows are chosen over so many tokens at a time, up to the next end of a document.
SEGMENT = 1 << 20

PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"
_PIECES = pa.schema([(n, pa.int64()) for n in ("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")])


def padding(length: int, size: int) -> int:
    """Pad tokens of a sequence: up to ``size``, but none at a power of two."""
    return 0 if length & (length - 1) == 0 else size - length


def candidates(n: int, sentence_ends: np.ndarray, cell_size: int) -> tuple[np.ndarray, np.ndarray]:
    """Where a document of ``n`` tokens may be cut, and at what cost: at its end for nothing, after
    each sentence, and at the end of a cell in which no sentence ends."""
    inner = sentence_ends[(sentence_ends > 0) & (sentence_ends < n)]
    cells = -(-n // cell_size)
    taken = np.bincount((inner - 1) // cell_size, minlength=cells)
    bare = (np.flatnonzero(taken[: cells - 1] == 0) + 1) * cell_size
    at, cost = np.append(inner, bare), np.append(np.full(len(inner), SENTENCE), np.full(len(bare), INSIDE))
    order = np.argsort(at, kind="stable")
    return np.append(at[order], n), np.append(cost[order], 0)


def windows(at: list[int], cost: list[int], size: int) -> list[int]:
    """Ends of the windows over ``at`` (ascending cut positions; the last is the end) with
    the least sum of padding and cut costs; no window is longer than ``size``.

    The best start of a full or padded window is the least of best[i] + at[i] over the starts
    within reach, which a monotone queue holds. Starts half and a quarter of the size back
    need no padding and are looked up. What is left at the end may instead be cut into
    powers of two, which need no padding either.
    """
    best, back = [0], [-1]
    at = [0, *at]
    # place[p + size]: which candidate lies at p; none lies before 0.
    place = [-1] * (at[-1] + size + 1)
    place[size] = 0
    # A queue of candidates, from ``head`` on, with their keys.
    queue, keys, head = [0], [0], 0
    half, quarter = size // 2, size // 4
    for j, price in enumerate(cost, 1):
        p = at[j]
        reach = p - size
        while at[queue[head]] < reach:
            head += 1
        i = queue[head]
        length = p - at[i]
        least = best[i] if length & (length - 1) == 0 else keys[head] - reach
        o = place[p + half]
        if o >= 0 and best[o] < least:
            least, i = best[o], o
        o = place[p + size - quarter]
        if o >= 0 and best[o] < least:
            least, i = best[o], o
        value = least + price
        best.append(value)
        back.append(i)
        place[p + size] = j
        key = value + p
        while len(queue) > head and keys[-1] >= key:
            queue.pop()
            keys.pop()
        queue.append(j)
        keys.append(key)
    end, last = at[-1], len(at) - 1
    choice, least, tail = back[last], best[last] - cost[-1], [end - at[back[last]]]
    for i in range(last - 1, -1, -1):
        rest = end - at[i]
        if rest > size:
            break
        parts = [1 << b for b in range(rest.bit_length() - 1, -1, -1) if rest >> b & 1]
        if best[i] + INSIDE * (len(parts) - 1) < least:
            choice, least, tail = i, best[i] + INSIDE * (len(parts) - 1), parts
    cuts = []
    while choice > 0:
        cuts.append(at[choice])
        choice = back[choice]
    cuts.reverse()
    for part in tail:
        cuts.append((cuts[-1] if cuts else 0) + part)
    return cuts


def pack_documents(docs: DataFrame, tokenizer: str, end_id: int, size: int = 4096) -> DataFrame:
    """Pack ``docs`` (``doc_id``, ``text``) in id order into sequences of at most ``size`` ids (a
    power of two); one row per piece: doc_id, start, length, ids_crc32, doc_tokens,
    sequence_id, offset.

    Texts are range-partitioned by id and encoded in order; each task places its windows over
    about a million tokens at a time, so what it holds is bounded by that and its longest
    document. Sequence ids hold the partition in their upper bits and count up within it.

    A null text counts as empty, and such a document is ``end_id`` alone. Rows that share an
    id are packed one after another, in order of their texts; null ids come first. An empty
    table gives no rows.
    """
    if size < 4 or size & (size - 1):
        raise ValueError("size is a power of two")
    small_batches(docs.sparkSession)

    def rows(batches: Iterator[pa.RecordBatch]):
        enc = codec(tokenizer, library=True)
        end = np.array([end_id], enc.dtype)
        stops = np.zeros(max(*enc.names, end_id) + 1, bool)
        for token, i in enc.vocab.items():
            stops[i] = token.removesuffix("</w>")[-1:] in (".", "!", "?", "Ċ")
        sequence = TaskContext.get().partitionId() << 32
        held: list[tuple[int | None, np.ndarray]] = []
        at, cost, total = [], [], 0

        def flush():
            nonlocal sequence
            ends = iter(windows(at, cost, size))
            stop, origin, position = next(ends), 0, 0
            for doc_id, ids in held:
                done, n, wide = 0, len(ids), ids.astype("<u4")
                while done < n:
                    if position == stop:
                        stop, origin, sequence = next(ends), stop, sequence + 1
                    length = min(n - done, stop - position)
                    yield doc_id, done, length, zlib.crc32(wide[done : done + length]), n, sequence, position - origin
                    done, position = done + length, position + length
            sequence += 1

        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                ids = np.append(enc.encode(text), end)
                where, price = candidates(len(ids), np.flatnonzero(stops[ids]) + 1, max(1, size // CELLS))
                at += (where + total).tolist()
                cost += price.tolist()
                held.append((doc_id, ids))
                total += len(ids)
                if total >= SEGMENT:
                    yield from flush()
                    held, at, cost, total = [], [], [], 0
        if held:
            yield from flush()

    ordered = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").alias("text")).repartitionByRange("doc_id").sortWithinPartitions("doc_id", "text")
    return ordered.mapInArrow(lambda batches: record_batches(rows(batches), _PIECES), PIECES)
