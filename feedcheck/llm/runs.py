"""Periodic runs of words, found from Lyndon roots.

A run is a stretch with smallest period q that no neighbour extends keeping q. For one of the
two orders of the words, plain or turned around, every stretch of q words in the run that is a
Lyndon word is the longest Lyndon word that starts there, and a run of three periods holds two
of them side by side, the first within its first q words (the runs theorem). So runs are found
from the longest Lyndon word at each place, under both orders:

* The first phase of Baier's suffix sorter groups suffixes by that word. Groups are handled
  from the greatest down. The nearest place before a member that is neither handled nor of its
  group, its predecessor, has a Lyndon word that goes on with the group's; predecessors are
  taken out of their groups and put right above them, by how many members they precede.
  When a group is handled, its word is final: its members are the places where exactly
  this word is the longest. No suffixes are sorted within groups, that is the second phase.
* Two members of a group as far apart as its word is long are a root and its repetition.
* A root is extended to both sides by common extensions of the places q apart.

A word that is met less than three times between two others cannot lie in a run of three
periods, so the sorter works on the stretches between such words.
"""

from __future__ import annotations

import hashlib
import zlib
from collections import Counter, defaultdict
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedcheck.llm.common import record_batches, small_batches

#: A run has so many words at least, and so many periods.
SHORTEST, PERIODS = 24, 3


def lyndon_groups(ranks: list[int]) -> tuple[list[int], list[int]]:
    """For each place the number of its group and the length of the longest Lyndon word that starts
    there; places share a group if and only if these words are equal. ``ranks`` are ordered letters."""
    n = len(ranks)
    first: dict[int, list[int]] = defaultdict(list)
    for i, r in enumerate(ranks):
        first[r].append(i)
    letters = sorted(first)
    members = [first[r] for r in letters]
    length, below = [1] * len(letters), list(range(-1, len(letters) - 1))
    # above[g] is the group handled before g.
    above = [*range(1, len(letters)), -1]
    number = {r: g for g, r in enumerate(letters)}
    group = [number[r] for r in ranks]
    open_ = list(range(-1, n))  # open_[i + 1]: a place up to i that may be the last open one
    g = len(letters) - 1
    while g >= 0:
        own = [i for i in members[g] if group[i] == g]
        members[g] = own
        for i in own:
            open_[i + 1] = i - 1
        met: dict[int, int] = {}
        for i in own:
            j = open_[i]
            while j >= 0 and open_[j + 1] != j:
                j = open_[j + 1]
            k = i - 1
            while k > j:
                open_[k + 1], k = j, open_[k + 1]
            open_[i + 1] = j
            if j >= 0:
                met[j] = met.get(j, 0) + 1
        if met:
            moved: dict[tuple[int, int], list[int]] = defaultdict(list)
            for j, count in met.items():
                moved[count, group[j]].append(j)
            # From the greatest count down, each right above the old group.
            for count, old in sorted(moved, reverse=True):
                new = len(members)
                members.append(moved[count, old])
                length.append(length[old] + count * length[g])
                up = above[old]
                above.append(up)
                below.append(old)
                above[old] = new
                if up >= 0:
                    below[up] = new
                for j in members[new]:
                    group[j] = new
        g = below[g]
    return group, [length[x] for x in group]


def common(a: list[int], i: int, j: int, most: int) -> int:
    """How many letters from ``i`` and from ``j`` on are equal, up to ``most``."""
    done, step = 0, 8
    while done < most:
        step = min(step, most - done)
        if a[i + done : i + done + step] != a[j + done : j + done + step]:
            while a[i + done] == a[j + done]:
                done += 1
            return done
        done += step
        step *= 2
    return done


def _runs_of(a: list[int], shortest: int, periods: int) -> set[tuple[int, int, int]]:
    """Runs of a stretch: (start, length, period)."""
    n, found = len(a), set()
    back = a[::-1]
    top = max(a, default=0)
    for ranks in (a, [top - x for x in a]):
        group, length = lyndon_groups(ranks)
        covered: dict[int, int] = {}
        for i, p in enumerate(length):
            if i + 2 * p > n or group[i + p] != group[i] or covered.get(p, 0) >= i + 2 * p:
                continue
            stop = i + 2 * p
            while stop + p <= n and group[stop] == group[i]:
                stop += p
            # Both sides go on for less than a period, unless the order's roots end first.
            stop += common(a, stop, stop - p, n - stop)
            start = i - common(back, n - i, n - i - p, i)
            covered[p] = stop
            if stop - start >= max(shortest, periods * p):
                found.add((start, stop - start, p))
    return found


def stretches(words: list, least: int, shortest: int) -> Iterator[tuple[int, int]]:
    """Bounds of the stretches of at least ``shortest`` words in which each word is met ``least`` times."""
    todo = [(0, len(words))]
    while todo:
        lo, hi = todo.pop()
        if hi - lo < shortest:
            continue
        part = words[lo:hi]
        rare = {w for w, c in Counter(part).items() if c < least}
        if not rare:
            yield lo, hi
            continue
        start = lo
        for i, w in enumerate(part, lo):
            if w in rare:
                if i - start >= shortest:
                    todo.append((start, i))
                start = i + 1
        if hi - start >= shortest:
            todo.append((start, hi))


def word_runs(words: list, shortest: int = SHORTEST, periods: int = PERIODS) -> list[tuple[int, int, int]]:
    """All runs of ``words`` with ``shortest`` words and ``periods`` periods (three or more) at least, as
    (start, length, period) in order of start, then period."""
    if periods < 3 or shortest < 1:
        raise ValueError("runs have at least three periods and one word")
    out = []
    for lo, hi in stretches(words, periods, shortest):
        names = {w: k for k, w in enumerate(dict.fromkeys(words[lo:hi]))}
        out += [(lo + s, n, p) for s, n, p in _runs_of([names[w] for w in words[lo:hi]], shortest, periods)]
    return sorted(out)


def collapsed(words: list, found: list[tuple[int, int, int]]) -> list:
    """``words`` without those that a run holds after its first period."""
    out, at = [], 0
    for lo, hi in sorted((s + p, s + n) for s, n, p in found):
        if hi > at:
            out += words[at : max(at, lo)]
            at = hi
    return out + words[at:]


def greatest(found: list[tuple[int, int, int]]) -> tuple[int, int, int] | None:
    """The run with the greatest length over period; ties go to the smallest start, then period."""
    best = None
    for r in found:
        if best is None or r[1] * best[2] > best[1] * r[2]:
            best = r
    return best


def repeated_tail(words: list, doc_id: int | None) -> list:
    """``words`` with a tail that repeats, for one id in ten (by its CRC-32), as the query's contract has it."""
    n = len(words)
    if doc_id is None or not n or (h := zlib.crc32(str(doc_id).encode())) % 10:
        return words
    a = (g := h // 10) % n
    p = 1 + (n - a) // (3 + g % 8)
    tail = words[a : a + p]
    return words[:a] + (tail * -(-(n - a) // p))[: n - a]


_ROWS = pa.schema([("doc_id", pa.int64()), *[(c, pa.int64()) for c in ("n_runs", "start", "length", "period", "exponent_milli")], ("runs_sha256", pa.string()), ("collapsed_sha256", pa.string())])
_DDL = "doc_id long, n_runs long, start long, length long, period long, exponent_milli long, runs_sha256 string, collapsed_sha256 string"
_FOUND = pa.schema([("doc_id", pa.int64()), *[(c, pa.int64()) for c in ("start", "length", "period")]])


def _words(batches, change) -> Iterator[tuple[int | None, list[bytes]]]:
    for batch in batches:
        for doc_id, text in zip(*(c.to_pylist() for c in batch.columns)):
            yield doc_id, change(text.split(), doc_id)


def _same(words: list, doc_id: int | None) -> list:
    return words


def _texts(docs: DataFrame) -> DataFrame:
    small_batches(docs.sparkSession)
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text"), F.lit("")).cast("binary").alias("text"))


def find_runs(docs: DataFrame, shortest: int = SHORTEST, periods: int = PERIODS) -> DataFrame:
    """doc_id, start, length, period of all runs of words in ``docs`` (``doc_id``, ``text``).

    Words are what white space (ASCII) separates, compared byte for byte; runs do not cross texts. A null
    or empty text has none. Repeated rows and null ids are looked at row by row, other columns are
    ignored, and an empty table gives no rows. Nothing is shuffled; a task holds one text at a time.
    """

    def rows(batches):
        return ((d, *r) for d, words in _words(batches, _same) for r in word_runs(words, shortest, periods))

    return _texts(docs).mapInArrow(lambda b: record_batches(rows(b), _FOUND), "doc_id long, start long, length long, period long")


def without_runs(docs: DataFrame, shortest: int = SHORTEST, periods: int = PERIODS) -> DataFrame:
    """doc_id and text of each of ``docs``, of each run only its first period; the words that stay are
    joined by one space. Odd cases as in :func:`find_runs`, but each row gives one."""
    out = pa.schema([("doc_id", pa.int64()), ("text", pa.string())])

    def rows(batches):
        return ((d, b" ".join(collapsed(w, word_runs(w, shortest, periods))).decode()) for d, w in _words(batches, _same))

    return _texts(docs).mapInArrow(lambda b: record_batches(rows(b), out, 256), "doc_id long, text string")


def run_digests(docs: DataFrame, change=_same) -> DataFrame:
    """One row for each of ``docs``: doc_id, n_runs, of the run with the greatest exponent start, length,
    period and exponent_milli (nulls if there is none), and digests of all runs and of the collapsed words.
    ``change`` turns the words and id of a row into the words to look at. Odd cases as in :func:`find_runs`;
    a row without words has no run and the digests of nothing."""

    def rows(batches):
        for doc_id, words in _words(batches, change):
            found = word_runs(words)
            best = greatest(found)
            listed = "".join(f"{s},{n},{p}\n" for s, n, p in found).encode()
            kept = b" ".join(collapsed(words, found))
            yield doc_id, len(found), *(best or (None,) * 3), best and 1000 * best[1] // best[2], hashlib.sha256(listed).hexdigest(), hashlib.sha256(kept).hexdigest()

    return _texts(docs).mapInArrow(lambda b: record_batches(rows(b), _ROWS), _DDL)
