import hashlib
import re
import tracemalloc
from collections import Counter

import numpy as np
import pytest

from feedcheck.llm import minhash, suffixes
from feedcheck.llm.graph import components

WORDS = [f"w{i}" for i in range(3000)]


def docs_of(spark, rows):
    return spark.createDataFrame([(i, t, -1, "k") for i, t in rows], "doc_id long, text string, component_id int, key string")


def linked(rows, percent=85):
    def shingles(t):
        w = (t or "").encode().lower().split()
        return {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set()

    sets = [shingles(t) for _, t in rows]
    up = list(range(len(rows)))

    def root(i):
        while up[i] != i:
            i = up[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            a, b = sets[i], sets[j]
            if a and b and 100 * len(a & b) >= percent * len(a | b):
                x, y = root(i), root(j)
                if rows[x][0] < rows[y][0]:
                    up[y] = x
                else:
                    up[x] = y
    return [(rows[i][0], len(sets[i]), rows[root(i)][0], rows[root(i)][0] == rows[i][0]) for i in range(len(rows))]


def edited(words, rng, n):
    words = list(words)
    for i in rng.choice(len(words), n, replace=False):
        words[i] = f"x{rng.integers(1 << 30)}"
    return " ".join(words)


def test_near_duplicates_against_all_pairs(spark):
    rng = np.random.default_rng(4)
    rows = []
    for f in range(6):  # families with members near the limit, and chains of small changes
        base = [WORDS[k] for k in rng.integers(0, 3000, 120 + 40 * f)]
        rows += [(len(rows) + k, edited(base, rng, int(rng.integers(0, 5)))) for k in range(25)]
        step = base
        for _ in range(8):
            step = edited(step, rng, 2).split()
            rows.append((len(rows), " ".join(step)))
    rows += [(len(rows) + k, t) for k, t in enumerate(["", None, "one two", "ONE two", "one  two\n", "a b c d e", " \t ", "é" * 50, rows[3][1].upper(), rows[3][1], "z " * 60_000])]
    got = minhash.near_duplicates(docs_of(spark, rows))
    assert got.columns == ["doc_id", "n_shingles", "component_id", "kept"]
    assert sorted(map(tuple, got.collect())) == sorted(linked(rows))


@pytest.mark.parametrize("percent", [80, 85])
def test_family_larger_than_a_block(spark, percent):
    rng = np.random.default_rng(9)
    base = [WORDS[k] for k in rng.integers(0, 3000, 146)]
    rows = [(k, edited(base, rng, int(rng.choice([1, 2, 3, 4])))) for k in range(260)]
    assert sorted(map(tuple, minhash.near_duplicates(docs_of(spark, rows), percent).collect())) == sorted(linked(rows, percent))


def test_null_ids_and_empty_table(spark):
    got = minhash.near_duplicates(docs_of(spark, [(None, "a b"), (None, "a b"), (4, "a b"), (4, "a b"), (2, "a b")])).collect()
    assert sorted(map(tuple, got), key=str) == sorted([(None, 1, None, True)] * 2 + [(4, 1, 2, False)] * 2 + [(2, 1, 2, True)], key=str)
    assert minhash.near_duplicates(docs_of(spark, [])).count() == 0


def test_signature_estimates_similarity():
    rng = np.random.default_rng(2)
    x = rng.integers(0, 1 << 63, 4000).astype(np.uint64)
    a, b = np.unique(x[:3000]), np.unique(x[1000:])
    sig = minhash.signatures([a, b, np.empty(0, np.uint64)])
    assert abs((sig[:, 0] == sig[:, 1]).mean() - 0.5) < 0.15 and (sig[:, 2] == 0xFFFFFFFF).all()
    alone = minhash.signatures([np.concatenate([x] * 20)])
    assert (alone[:, 0] == minhash.signatures([x, x[:5]])[:, 0]).all()


def test_words_leave_nothing_in_a_worker():
    def read(texts):
        for text in texts:
            minhash.shingle_set(text)
            suffixes.anchors(text.encode().split(), 51)

    def texts(start):
        return (" ".join(f"word{start + 1000 * i + j}" for j in range(1000)) for i in range(60))

    read(texts(10**6))
    tracemalloc.start()
    try:
        before = tracemalloc.get_traced_memory()[0]
        read(texts(2 * 10**6))
        held = tracemalloc.get_traced_memory()[0] - before
    finally:
        tracemalloc.stop()
    assert held < 1 << 20


def test_components_of_long_paths(spark):
    edges = [(i, i + 1) for i in range(100, 160)] + [(7, 300), (300, 5), (1, 160)]
    got = {r.id: r.component for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert all(got[i] == 1 for i in range(100, 161)) and got[7] == got[300] == got[5] == 5


def covered(texts, size):
    data = [(t or "").encode() for t in texts]
    count = {}
    for b in data:
        for i in range(len(b) - size + 1):
            count[b[i : i + size]] = count.get(b[i : i + size], 0) + 1
    out = []
    for b in data:
        hit = [False] * len(b)
        for i in range(len(b) - size + 1):
            if count[b[i : i + size]] > 1:
                hit[i : i + size] = [True] * size
        runs = sum(h and (k == 0 or not hit[k - 1]) for k, h in enumerate(hit))
        out.append((len(b), sum(hit), runs, hashlib.sha256(bytes(c for c, h in zip(b, hit) if not h)).hexdigest()))
    return out


@pytest.mark.parametrize("size", [8, 40, 400])
def test_repeats_against_brute_force(spark, size):
    rng = np.random.default_rng(size)
    letters = list("abcé ")
    passage = "".join(rng.choice(letters, size + size // 2))
    texts = [None, "", "a" * (size - 1), "a" * size, "a" * (size + 1), "ab" * size, passage, "x" + passage, passage + "y" + passage[: size - 1]]
    texts += ["".join(rng.choice(letters, 3 * size)) + passage[rng.integers(0, size // 2) :] + "".join(rng.choice(letters, size)) for _ in range(12)]
    copy = "".join(rng.choice(letters, 2 * size))
    texts += [copy, copy, copy[: size + 3], "q" * 5 + copy[2:], "".join(rng.choice(letters, 30))] * 2
    rows = list(enumerate(texts))
    got = suffixes.removal_digests(suffixes.repeats(docs_of(spark, rows), size)).collect()
    assert [tuple(r)[1:] for r in sorted(got)] == covered(texts, size)


def test_repeats_across_blocks_of_a_long_text(spark, monkeypatch):
    monkeypatch.setattr(suffixes, "BLOCK", 64)
    rng = np.random.default_rng(0)
    long = "".join(rng.choice(list("abcdef"), 2000))
    texts = [long, "--" + long[300:900] + "--", long[1200:1300]]
    spans = [suffixes.anchors(t.encode(), 40) for t in texts]
    assert all(sum(h - low + 1 for _, low, h in s) == len(t) - 39 for s, t in zip(spans, texts))
    got = suffixes.removal_digests(suffixes.repeats(docs_of(spark, list(enumerate(texts))), 40)).collect()
    assert [tuple(r)[1:] for r in sorted(got)] == covered(texts, 40)


def test_texts_without_repeats(spark):
    rows = [(1, "A" * 3 + "é" * 30 + "tail"), (2, "é" * 30 + "B"), (3, "same text that is long enough"), (3, "same text that is long enough"), (None, None), (5, "short")]
    left = suffixes.without_repeats(docs_of(spark, rows), 24)
    assert left.columns == ["doc_id", "text", "component_id", "key"]
    assert sorted(((r.doc_id, r.text) for r in left.collect()), key=str) == sorted([(1, "AAAtail"), (2, "B"), (None, None), (5, "short")], key=str)
    assert suffixes.without_repeats(docs_of(spark, []), 24).count() == 0


def words_left(texts, size, words):
    """Brute force for windows of words and of bytes."""
    spans = [[m.span() for m in re.finditer(r"\S+", t)] for t in texts]
    runs = [[" ".join(t[a:b] for a, b in s[i : i + words]) for i in range(len(s) - words + 1)] for t, s in zip(texts, spans)]
    count = Counter(w for r in runs for w in r)
    strings = Counter(t.encode()[i : i + size] for t in texts for i in range(len(t.encode()) - size + 1))
    out = []
    for t, s, r in zip(texts, spans, runs):
        hit = np.zeros(len(t.encode()), bool)
        for i, w in enumerate(r):
            if count[w] > 1:
                hit[len(t[: s[i][0]].encode()) : len(t[: s[i + words - 1][1]].encode())] = True
        for i in range(len(hit) - size + 1):
            if strings[t.encode()[i : i + size]] > 1:
                hit[i : i + size] = True
        left = bytes(c for c, h in zip(t.encode(), hit) if not h).decode(errors="ignore")
        out.append(left if left.strip() else "")
    return out


@pytest.mark.parametrize("words", [3, 12, 51])
def test_repeated_words_against_brute_force(spark, monkeypatch, words):
    monkeypatch.setattr(suffixes, "BLOCK", 64)
    rng = np.random.default_rng(words)
    text = lambda n, gap=" ": gap.join(rng.choice(["é", "of", "a", "sea.", "tide", "the", "Run", "ßo", "on", "x"], n))
    passages = [text(n).split() for n in (words - 1, words, words + 1, words + 9, 4 * words)]
    texts = ["", " ", "\u3000a\xa0", text(words), text(300), "é " * (words - 1), "no " * (words + 70)]
    for p in passages:
        texts += [f"{text(40)} {gap.join(p)}\n{text(30)}" for gap in (" ", "  ", "\u2003", "\t\n", "\x1c")]
    copy = text(words + 2)
    texts += [copy, copy, text(3 * words, "\xa0"), "q" * 700, "p" + "q" * 500, " ".join(passages[3]), "  " + "\t".join(passages[2])]
    got = {r.doc_id: r.text for r in suffixes.without_repeats(docs_of(spark, list(enumerate(texts))), 400, words).collect()}
    want = words_left(texts, 400, words)
    assert got == {i: w for i, w in enumerate(want) if w or not texts[i]} | ({1: " "})
    assert sum(w != t for w, t in zip(want, texts)) > 15
