import re
from collections import Counter

import numpy as np
import pytest

from feedcheck.llm import counted, phrases, queries


def docs_of(spark, rows):
    return spark.createDataFrame([(i, t, lang, 5, "k") for i, (t, lang) in enumerate(rows)], "doc_id long, text string, lang string, n int, phrase string")


def brute(rows, words=3, least=10, inside=50, limit=2000):
    f, n = Counter(), Counter()
    for text, lang in rows:
        lang = "und" if lang is None else lang
        lower = "".join(c.lower() if c.isascii() else c for c in text or "")
        for piece in re.split(r"[.,;:!?\x0a-\x0d]", lower):
            ws = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(ws)
            f.update((lang, tuple(ws[i : i + k])) for k in range(1, words + 1) for i in range(len(ws) - k + 1))
    found = {g: a for g, a in f.items() if len(g[1]) > 1 and a >= least}
    out = []
    for (lang, p), a in found.items():
        if any(x == lang and len(q) > len(p) and 100 * b >= inside * a and any(q[i : i + len(p)] == p for i in range(len(q))) for (x, q), b in found.items()):
            continue
        score, k = min((1000000 * a * a // (f[lang, p[:k]] * f[lang, p[k:]]), k) for k in range(1, len(p)))
        out.append((lang, -score, -a, " ".join(p).encode(), f[lang, p[:k]], f[lang, p[k:]]))
    out.sort()
    ranks, result = Counter(), []
    for lang, score, a, p, l, r in out:
        ranks[lang] += 1
        if ranks[lang] <= limit:
            result.append((lang, ranks[lang], p.decode(), -a, l, r, n[lang], -score))
    return sorted(result)


def sample(rng, n, lang):
    vocabulary = np.array(["the", "The", "of", "sea", "tide", "É", "é", "x-y", "ß", "mat", "…", "a"])
    weight = 1 / np.arange(1, len(vocabulary) + 1)
    passage = " ".join(rng.choice(vocabulary, 50))

    def text():
        ws = rng.choice(vocabulary, int(rng.integers(0, 70)), p=weight / weight.sum())
        gaps = rng.choice([" ", " ", " ", "  ", "\t", ". ", ", ", "\n", "!?", "\r\n", "\x0b", "\xa0"], len(ws))
        return "".join(w + g for w, g in zip(ws, gaps)) + (passage if rng.random() < 0.3 else "")

    return [(text(), lang) for _ in range(n)]


ODD = [("", "en"), (None, "en"), (" \t. ,", "en"), ("a b c " * 400, "en"), ("z " * 3000, None), ("New York. " * 30, None), ("q" * 4000 + " r", "fr"), ("\x1c \x1c " * 12, "fr")]


@pytest.mark.parametrize("words", [2, 3, 4])
def test_collocations_against_brute_force(spark, monkeypatch, words):
    monkeypatch.setattr(counted, "HELD_KEYS", 700)
    monkeypatch.setattr(phrases, "SHARD_BYTES", 3000)
    monkeypatch.setattr(phrases, "GATHERED_BYTES", 5000)
    monkeypatch.setattr(phrases, "HELD_BYTES", 2000)
    rng = np.random.default_rng(words)
    rows = sample(rng, 60, "en") + sample(rng, 40, "fr") + sample(rng, 20, None) + sample(rng, 5, "und") + ODD
    rows += rows[:30]
    got = phrases.collocations(docs_of(spark, rows), words=words, limit=40 if words == 3 else 2000)
    assert got.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    want = brute(rows, words, limit=40 if words == 3 else 2000)
    assert len(want) > 50 and sorted(map(tuple, got.collect())) == want


def test_query_against_brute_force(spark, folder):
    rows = sample(np.random.default_rng(11), 150, "de") + ODD
    docs_of(spark, rows).write.parquet(f"{folder}/documents.parquet")
    assert sorted(map(tuple, queries.op12_phrases(spark, folder).collect())) == brute(rows)


def test_chunks_cover_each_word_once():
    rng = np.random.default_rng(0)
    assert phrases.spaced(b" A,b\t\tC  d.\n\xc3\x89 ") == b"a \n b c d \n \n \xc3\x89"
    for shared in (1, 2, 3):
        texts = [b"", *(b" ".join(rng.choice([b"a", b"bc", b"\n", b"d", b"e"], n).tolist()) for n in (1, 2, 3, 50, 700)), b"", b"d"]
        got = list(phrases.chunks_of(texts, shared, every=4))
        for i, text in enumerate(texts):
            parts = [c.split(b" ") for j, c, _ in got if j == i]
            assert b" ".join(sum((p[:-shared] for p in parts), [])) == text
            assert all(p[-shared:] == (q + [b"\n"] * shared)[:shared] for p, q in zip(parts, [*parts[1:], [b"\n"] * shared]))
            assert [own for j, _, own in got if j == i] == [sum(t != b"\n" for t in p[:-shared]) for p in parts]
        assert len(got) > 100


def test_equal_passages_give_equal_chunks():
    rng = np.random.default_rng(1)
    passage = " ".join(f"w{k}" for k in rng.integers(0, 500, 400))
    a, b = (Counter(c for _, c, _ in phrases.chunks_of([(" ".join(f"{x}{k}" for k in range(n)) + " " + passage).encode()])) for x, n in (("p", 9), ("q", 33)))
    assert sum((a & b).values()) >= 15


def test_scores_beyond_64_bits(spark):
    cases = [(10**12 + 7, 10**12 + 9, 10**12 + 7), (999_999_999_999_999,) * 3, (10, 10**15 - 1, 10), (3, 7, 5)]
    got = phrases.scored(spark.createDataFrame(cases, "a long, l long, r long")).collect()
    assert [r.score for r in got] == [1000000 * a * a // (l * r) for a, l, r in cases]


def test_empty_table(spark):
    assert phrases.collocations(docs_of(spark, [])).count() == 0
    assert phrases.collocations(docs_of(spark, [(None, None)])).count() == 0
