import math
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest

from feedcheck.llm import counted, kneser, queries


def docs_of(spark, rows):
    return spark.createDataFrame([(i, t, 3, "k") for i, t in rows], "doc_id long, text string, score int, held_out string")


def tokens(text):
    lower = "".join(c.lower() if c.isascii() else c for c in text or "")
    return [*re.findall(r"[^\x20\x09-\x0d]+", lower), None]


def brute(train, texts):
    """The model by its definition, from dictionaries: known, tokens, base and score of each text."""
    rows = [["<", *tokens(t)] for t in train]
    unigram = Counter(w for r in rows for w in r[1:])
    pairs = Counter(p for r in rows for p in zip(r, r[1:]))
    left, before, after = Counter(), Counter(), defaultdict(Counter)
    for (u, w), c in pairs.items():
        left[u] += c
        before[w] += 1
        after[u][min(c, 3)] += 1
    n, v, links = sum(unigram.values()), len(unigram), len(pairs)

    def estimate(counts):
        m = [sum(c == k for c in counts) for k in (1, 2, 3, 4)]
        return [0.0, *kneser.discounts(m)]

    high, low = estimate(pairs.values()), estimate(before.values())
    rest = sum(low[min(c, 3)] for c in before.values()) / links if links else 1.0
    out = []
    for t in texts:
        total = base = 0.0
        ws = tokens(t)
        for u, w in zip(["<", *ws], ws):
            p = rest / (v + 1) + (before[w] - low[min(before[w], 3)]) / max(1, links)
            if left[u]:
                c = pairs[u, w]
                p = (c - high[min(c, 3)]) / left[u] + sum(high[k] * after[u][k] for k in after[u]) / left[u] * p
            total += math.log10(p)
            base += math.log10((unigram[w] + 1) / (n + v + 1))
        out.append((len(ws), sum(unigram[w] > 0 for w in ws), n, base, total))
    return out


def sample(rng, n):
    words = np.array([f"w{k}" for k in range(60)] + ["É", "é", "THE", "the", "a,", "ß"])
    weight = 1 / np.arange(1, len(words) + 1)
    return [" ".join(rng.choice(words, int(rng.integers(0, 60)), p=weight / weight.sum())) for _ in range(n)]


ODD = ["", None, " \t\n", "the", "The\x0bthe\x0cthe\rthe", "never met before", "a　b\xa0c", "z " * 3000, "x" * 5000, "\x1cthe\x1c", "tab\tthe  w1"]


def test_scores_against_brute_force(spark, monkeypatch):
    monkeypatch.setattr(counted, "SHARD_BYTES", 4000)
    monkeypatch.setattr(counted, "HELD_KEYS", 500)
    monkeypatch.setattr(counted, "BLOCK", 512)
    rng = np.random.default_rng(3)
    train, test = sample(rng, 250) + ODD[:5] + ["the cat"] * 30, sample(rng, 60) + ODD
    model = kneser.fit(docs_of(spark, list(enumerate(train))))
    assert model.shards > 3
    got = kneser.score(docs_of(spark, list(enumerate(test))), model, "doc_id > 5").collect()
    assert got[0].__fields__ == ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"]
    for r, want in zip(sorted(got), brute(train, test), strict=True):
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (r.doc_id > 5, *want[:3])
        assert r.base_score == pytest.approx(want[3], rel=1e-9) and r.score == pytest.approx(want[4], rel=1e-9)


def test_probabilities_add_up_to_one(spark):
    train = sample(np.random.default_rng(8), 80)
    model = kneser.fit(docs_of(spark, list(enumerate(train))))
    vocabulary = sorted({w for t in train for w in tokens(t)[:-1]})
    for context in ["the", "w3", "w59", "unseen", ""]:
        texts = [f"{context} {w}".strip().encode() for w in [*vocabulary, "unknown-word"]]
        p = [kneser.token_scores(pa.array([t], pa.binary()), model)[1][1 if context else 0] for t in texts]
        end = kneser.token_scores(pa.array([context.encode()], pa.binary()), model)[1][-1]
        assert sum(p) + end == pytest.approx(1)


def test_better_than_the_base_on_texts_held_out(spark):
    rng = np.random.default_rng(5)
    step = {f"w{k}": [f"w{j}" for j in rng.integers(0, 200, 4)] for k in range(200)}

    def walk():
        out = ["w0"]
        for _ in range(80):
            out.append(step[out[-1]][rng.integers(0, 4)])
        return " ".join(out)

    model = kneser.fit(docs_of(spark, [(k, walk()) for k in range(200)]))
    got = kneser.score(docs_of(spark, [(k, walk()) for k in range(20)]), model).collect()
    assert all(r.score > r.base_score + 60 and not r.held_out for r in got)


def test_empty_tables_null_ids_and_repeated_rows(spark):
    nothing = kneser.fit(docs_of(spark, []))
    assert [tuple(r) for r in kneser.score(docs_of(spark, [(None, "a b"), (1, None)]), nothing).sort("n_tokens").collect()] == [(1, False, 1, 0, 0, 0.0, 0.0), (None, False, 3, 0, 0, 0.0, 0.0)]
    model = kneser.fit(docs_of(spark, [(None, "a b"), (1, "a b"), (1, "a b"), (2, None)]))
    got = kneser.score(docs_of(spark, [(None, "a b"), (1, "a b"), (1, "a b")]), model, "doc_id = 1").collect()
    assert sorted([r[:5] for r in map(tuple, got)], key=str) == sorted([(None, False, 3, 3, 10), (1, True, 3, 3, 10), (1, True, 3, 3, 10)], key=str)
    assert kneser.score(docs_of(spark, []), model).count() == 0
    with pytest.raises(ValueError, match="mounted"):
        kneser.fit(docs_of(spark, []), "hdfs://host/model")


def test_query_learns_from_the_other_documents(spark, folder):
    rng = np.random.default_rng(1)
    rows = list(enumerate(sample(rng, 120)))
    docs_of(spark, rows).write.parquet(f"{folder}/documents.parquet")
    out = [zlib.crc32(str(i).encode()) % 7 == 2 for i, _ in rows]
    want = brute([t for (_, t), o in zip(rows, out) if not o], [t for _, t in rows])
    got = sorted(queries.op11_kneser(spark, folder).collect())
    assert any(out) and [r.held_out for r in got] == out
    assert all(tuple(r)[2:5] == w[:3] and r.score == pytest.approx(w[4], rel=1e-9) for r, w in zip(got, want, strict=True))


def test_words_as_hashes():
    texts = [b"", b"Ab  c", b"c", b"\n", b"d\xc3\x89 AB", b""]
    data, at = counted.text_column(pa.array([b"skipped", *texts], pa.binary())[1:])
    starts, stops = counted.words_of(data, at, kneser.GAPS)
    found = [bytes(data[a:b]) for a, b in zip(starts, stops)]
    assert found == [b"Ab", b"c", b"c", b"d\xc3\x89", b"AB"]
    h = counted.word_hashes(data, starts, stops)
    assert h[0] == h[4] and h[1] == h[2] and len(set(h.tolist())) == 3
    keys = np.unique(np.random.default_rng(0).integers(0, 1 << 64, 1000, np.uint64))
    assert (counted.unpacked(counted.packed(keys)) == keys).all()
