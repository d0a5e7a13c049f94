import hashlib
import random
import re
import zlib
from fractions import Fraction

import pytest

from feedcheck.llm import queries, runs


def docs_of(spark, rows):
    return spark.createDataFrame([(i, t, 7, "k") for i, t in rows], "doc_id long, text string, start int, runs_sha256 string")


def longest_lyndon(a):
    """Distance to the next smaller suffix, by comparing suffixes."""
    return [next((j for j in range(i + 1, len(a)) if a[j:] < a[i:]), len(a)) - i for i in range(len(a))]


def all_runs(words, shortest, periods):
    n, out = len(words), []
    for p in range(1, n // periods + 1):
        i = 0
        while i + p < n:
            j = i
            while j + p < n and words[j] == words[j + p]:
                j += 1
            length = j + p - i
            if length >= max(shortest, periods * p) and not any(all(words[k] == words[k + q] for k in range(i, i + length - q)) for q in range(1, p)):
                out.append((i, length, p))
            i = max(j, i + 1)
    return sorted(out)


def drawn(rng):
    k, n = rng.choice([1, 2, 2, 3, 5]), rng.randrange(0, 45)
    a = [rng.randrange(k) for _ in range(n)]
    if n and rng.random() < 0.6:
        p = rng.randrange(1, 9)
        a = a[: rng.randrange(n)] + (a[:p] * 12)[: rng.randrange(70)] + a[: rng.randrange(6)]
    return a


def test_groups_are_the_longest_lyndon_words():
    rng = random.Random(1)
    for _ in range(800):
        a = drawn(rng)
        group, length = runs.lyndon_groups(a)
        assert length == longest_lyndon(a)
        words = {}
        for i, g in enumerate(group):
            words.setdefault(g, set()).add(tuple(a[i : i + length[i]]))
        assert all(len(w) == 1 for w in words.values()) and len({min(w) for w in words.values()}) == len(words)


@pytest.mark.parametrize("shortest, periods", [(1, 3), (5, 3), (24, 3), (8, 4)])
def test_runs_against_brute_force(shortest, periods):
    rng = random.Random(shortest + periods)
    for _ in range(600):
        a = drawn(rng)
        if rng.random() < 0.3:
            a += [100, 101, 100] + drawn(rng)  # words too rare for a run
        assert runs.word_runs(a, shortest, periods) == all_runs(a, shortest, periods)


def test_runs_within_runs_and_very_long_texts():
    inner = (["a"] * 30 + ["b"]) * 4
    assert runs.word_runs(inner) == all_runs(inner, 24, 3) and len(runs.word_runs(inner)) == 5
    assert runs.word_runs(["z"] * 300_000) == [(0, 300_000, 1)]
    fib, more = [0], [0, 1]
    while len(more) < 2500:
        fib, more = more, more + fib
    assert runs.word_runs(more) == all_runs(more, 24, 3)
    with pytest.raises(ValueError):
        runs.word_runs(more, 24, 2)


def test_ties_go_to_the_smallest_start_then_period():
    words = ["a"] * 24 + ["x"] + ["b"] * 24 + ["y"] + ["c", "d"] * 24
    found = runs.word_runs(words)
    assert found == [(0, 24, 1), (25, 24, 1), (50, 48, 2)] and runs.greatest(found) == (0, 24, 1)
    assert runs.greatest([(0, 24, 2), (1, 37, 3), (4, 25, 2)]) == (4, 25, 2) and runs.greatest([]) is None


def digests(doc_id, text, changed=False):
    words = re.findall(r"[^\x20\x09-\x0d]+", text or "")
    n = len(words)
    if changed and doc_id is not None and n and zlib.crc32(str(doc_id).encode()) % 10 == 0:
        g = zlib.crc32(str(doc_id).encode()) // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [words[i if i < a else a + (i - a) % p] for i in range(n)]
    found = all_runs(words, 24, 3)
    best = min(found, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2]), default=(None,) * 3)
    gone = {i for s, m, p in found for i in range(s + p, s + m)}
    kept = " ".join(w for i, w in enumerate(words) if i not in gone)
    listed = "".join(f"{s},{m},{p}\n" for s, m, p in found)
    return (doc_id, len(found), *best, best[0] is not None and 1000 * best[1] // best[2] or None, hashlib.sha256(listed.encode()).hexdigest(), hashlib.sha256(kept.encode()).hexdigest())


ODD = ["", None, " \t\n", "a " * 23, "a " * 24, "é\x0bé\r" * 30, "a　b\xa0c " * 40, "A a " * 20, "x" * 9000 + " y" * 50, "w " * 4000, "\x1c \x1c " * 15]


def test_digests_against_brute_force(spark):
    rng = random.Random(9)
    texts = ODD + [" ".join(f"w{k}" for k in drawn(rng)) for _ in range(150)]
    rows = [*enumerate(texts), (None, "a " * 30), (None, "a " * 30), (3, "b c " * 30)]
    got = runs.run_digests(docs_of(spark, rows)).collect()
    assert got[0].__fields__ == ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]
    assert sorted(map(tuple, got), key=str) == sorted((digests(i, t) for i, t in rows), key=str)
    assert runs.run_digests(docs_of(spark, [])).count() == 0


def test_query_with_repeated_tails(spark, folder):
    rng = random.Random(2)
    rows = [(i, " ".join(f"w{rng.randrange(300)}" for _ in range(rng.randrange(0, 250)))) for i in range(200)] + [(None, "q " * 40)]
    docs_of(spark, rows).write.parquet(f"{folder}/documents.parquet")
    got = queries.op13_runs(spark, folder).collect()
    want = [digests(i, t, changed=True) for i, t in rows]
    assert sorted(map(tuple, got), key=str) == sorted(want, key=str)
    assert sum(w[1] > 0 for w in want) > 10


def test_runs_and_texts_without_them(spark):
    rows = [(1, "one  two " + "three " * 25 + "four"), (2, None), (1, "a b\tc")]
    assert [tuple(r) for r in runs.find_runs(docs_of(spark, rows)).collect()] == [(1, 2, 25, 1)]
    left = runs.without_runs(docs_of(spark, rows)).collect()
    assert sorted(map(tuple, left)) == [(1, "a b c"), (1, "one two three four"), (2, "")]
    assert runs.find_runs(docs_of(spark, rows), shortest=30).count() == 0
