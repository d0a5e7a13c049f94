import corpus_pipeline as cp
import numpy as np
from feedcheck.llm.queries import tokenizer_file
from tokenizers import Tokenizer

from .test_dedup import linked


def test_pipeline_against_brute_force(spark, folder):
    rng = np.random.default_rng(12)
    words = ["".join(rng.choice(["tha", "ing", "er", "on", "st"], rng.integers(1, 4))) for _ in range(900)]
    text = lambda n: " ".join(rng.choice(words, n))
    passage = text(120)
    rows = [(i, text(int(rng.integers(20, 200)))) for i in range(30)]
    rows += [(30, rows[3][1]), (31, rows[4][1]), (32, rows[5][1] + " more"), (33, None), (34, "1234 !?"), (35, "")]
    base = text(100).split()
    rows += [(36, " ".join(base)), (37, " ".join([*base[:50], "stthaer", *base[51:-6]]))]  # a similarity of 0.84
    rows += [(40 + k, text(60) + " " + passage + " " + text(60)) for k in range(3)]
    spark.createDataFrame([(i, t, "en", "s", len(t or "")) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{folder}/documents.parquet")

    left = [r for r in rows if r[1] and any(c.isalpha() for c in r[1])]
    first = {}
    for i, t in left:
        first.setdefault(t, i)
    left = [(i, t) for i, t in left if first[t] == i]
    stays = {i for i, _, _, kept in linked(left, 80) if kept}
    assert not {32, 37} & stays
    left = [(i, t) for i, t in left if i in stays]
    count = {}
    for _, t in left:
        for k in range(len(t) - 399):
            count[t[k : k + 400]] = count.get(t[k : k + 400], 0) + 1
    want = {}
    for i, t in left:
        hit = [False] * len(t)
        for k in range(len(t) - 399):
            if count[t[k : k + 400]] > 1:
                hit[k : k + 400] = [True] * 400
        want[i] = "".join(c for c, h in zip(t, hit) if not h)
    assert any(want[i] != dict(rows)[i] for i in want) and len(want) < len(rows) - 5

    lib = Tokenizer.from_file(tokenizer_file("word_bpe_49k.json"))
    got = {}
    for r in cp.run(spark, folder).collect():
        got[r.doc_id] = got.get(r.doc_id, 0) + r.length
    assert got == {i: len(lib.encode(t, add_special_tokens=False).ids) + 1 for i, t in want.items() if t}
    docs = cp.table(spark, folder, "documents")
    for _, stage in cp.STAGES[:-1]:
        assert stage(spark, docs.limit(0), folder).columns == docs.columns


def test_passages_of_over_50_short_words(spark):
    rng = np.random.default_rng(5)
    text = lambda n: " ".join(rng.choice(["a", "of", "to", "sea", "tide", "buoy", "we", "log"], n))
    passages = {n: text(n) for n in (50, 51, 55, 60)}
    assert all(len(p) < 400 for p in passages.values())
    rows = [(10 * n + i, f"{text(30)} x{n}{i} {p} y{n}{i} {text(30)}") for n, p in passages.items() for i in range(3)]
    left = {r.doc_id: r.text for r in cp.repeated_passages(spark, spark.createDataFrame(rows, "doc_id long, text string"), "").collect()}
    assert left == {i: t if i // 10 == 50 else t.replace(passages[i // 10], "") for i, t in rows}


def test_rows_with_repeated_or_null_ids(spark):
    rng = np.random.default_rng(8)
    words = ["".join(rng.choice(["tha", "ing", "er", "on", "st"], rng.integers(1, 4))) for _ in range(900)]
    text = lambda n: " ".join(rng.choice(words, n))
    docs_of = lambda rows: spark.createDataFrame([(i, t, "en") for i, t in rows], "doc_id long, text string, lang string")
    taught = [(i, text(40)) for i in range(20)]
    left = cp.language(spark, docs_of([*taught, (3, "1234 !?"), (None, "99"), (None, text(9)), (7, text(9))]), "").collect()
    assert len(left) == 22 and all(any(c.isalpha() for c in r.text) for r in left)

    a, b, c = text(100), text(100), text(100)
    rows = [(None, a), (None, a + " more"), (5, b), (5, c), (4, b + " more"), (9, c + " more"), (None, c + " most")]
    left = {(r.doc_id, r.text) for r in cp.near_copies(spark, docs_of(rows), "").collect()}
    assert len(left) == 3 and {(4, b + " more"), (5, c)} < left and (left - {(4, b + " more"), (5, c)}) < {(None, a), (None, a + " more")}


def test_clashing_names_and_a_very_long_text(spark):
    rng = np.random.default_rng(3)
    words = ["".join(rng.choice(["tha", "ing", "er", "on", "st"], rng.integers(1, 4))) for _ in range(900)]
    text = lambda n: " ".join(rng.choice(words, n))
    odd = ["number", "row", "left", "key", "sha", "sha_", "left_", "nth_", "kept", "a.b", "id"]
    rows = [(i, text(60), "en", *[100 * i + k for k in range(len(odd))]) for i in range(12)]
    rows += [(20, text(150_000), "en", *[7] * len(odd)), (2, text(60), "en", *[8] * len(odd)), (None, text(60), "en", *[9] * len(odd))]
    rows += [rows[5], (21, rows[6][1] + " more", "en", *[5] * len(odd))]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, " + ", ".join(f"`{c}` long" for c in odd))
    for name, stage in cp.STAGES[:-1]:
        after = stage(spark, docs, "")
        assert after.columns == docs.columns
        left = after.collect()
        stays = {"language": 17, "exact_copies": 16, "near_copies": 15, "repeated_passages": 14}[name]
        assert len(left) == stays, name
        assert {tuple(r)[3:] for r in left} <= {r[3:] for r in rows}, name
