import numpy as np
import pytest

from feedcheck.llm import html, langid, neighbours

SYLLABLES = {"aa": ["tho", "ing", "wer"], "bb": ["ñor", "ciá", "osl"], "cc": ["sch", "über", "keit"]}


def language_rows(n=240):
    rng = np.random.default_rng(3)
    rows = []
    for i in range(n):
        lang = sorted(SYLLABLES)[i % 3]
        words = ["".join(rng.choice(SYLLABLES[lang], rng.integers(1, 4))) for _ in range(rng.integers(6, 300))]
        rows.append((i, " ".join(words), lang))
    return rows


def test_language_is_learned_and_cases_are_defined(spark):
    schema = "doc_id long, text string, lang string, score string"
    rows = language_rows()
    docs = spark.createDataFrame([(*r, "s") for r in rows], schema)
    net = langid.fit(docs, sample_docs=60)
    assert net.langs == ["aa", "bb", "cc"]
    odd = [(900, None, "aa"), (901, "", "bb"), (902, "123 !?", "cc"), (None, rows[0][1], None), (7, rows[7][1], None), (7, rows[7][1], None), (903, "sch" * 100_000, None)]
    got = langid.predict(spark.createDataFrame([(*r, "s") for r in rows + odd], schema), net).collect()
    assert len(got) == len(rows) + len(odd) and all(0 <= r.score <= 1 for r in got)
    truth = {i: lang for i, _, lang in rows}
    right = [r.lang_pred == truth[r.doc_id] for r in got if r.doc_id in truth and r.held_out]
    assert len(right) > 20 and np.mean(right) > 0.95
    said = {r.doc_id: r for r in got}
    assert [said[i].lang_pred for i in (900, 901, 902)] == ["und"] * 3 and said[900].score == 0 and said[None].lang_pred == "aa"
    assert langid.predict(docs.limit(0), net).count() == 0
    nothing = langid.fit(docs.limit(0))
    assert {r.lang_pred for r in langid.predict(docs, nothing).collect()} == {"und"}


def test_held_out_rows_teach_nothing(spark):
    import zlib

    rows = [(i, "abc def", "right" if zlib.crc32(str(i).encode()) % 5 else "wrong") for i in range(100)]
    assert langid.fit(spark.createDataFrame(rows, "doc_id long, text string, lang string")).langs == ["right"]


def brute(rows, asked, k=10):
    out = []
    for q, a in asked:
        near = sorted((float(np.sqrt(((np.array(v, float) - np.array(a, float)) ** 2).sum())), i) for i, v in rows if i != q and len(v) == len(a))
        out += [(q, n + 1, i, s) for n, (s, i) in enumerate(near[:k])]
    return out


def test_neighbours_recall_and_scores(spark):
    rng = np.random.default_rng(6)
    x = rng.normal(size=(1500, 16)).round(3)
    x[200:900] = x[5]  # a vector with very many copies
    rows = [(i, v.tolist()) for i, v in enumerate(x)]
    frame = spark.createDataFrame([(i, v, "l") for i, v in rows], "vec_id long, embedding array<double>, rank string")
    asked = [r for r in rows if r[0] % 50 == 0]
    got = neighbours.nearest(frame, frame.filter("vec_id % 50 = 0")).collect()
    want = brute(rows, asked)
    assert len(got) == len(want)
    known = {(q, i): s for q, _, i, s in want}
    hits = [(r.query_id, r.vec_id) in known for r in got]
    assert np.mean(hits) >= 0.95
    for r in got:
        assert r.score == pytest.approx(float(np.sqrt(((x[r.query_id] - x[r.vec_id]) ** 2).sum())), abs=1e-12)


def test_several_shards_and_odd_vectors(spark, monkeypatch):
    rng = np.random.default_rng(8)
    rows = [(i, rng.normal(size=4).tolist()) for i in range(300)] + [(400 + i, rng.normal(size=3).tolist()) for i in range(4)]
    odd = [(900, None), (901, [0.0] * 4), (902, [1.0, None, 1.0, 1.0]), (903, [float("nan")] * 4), (904, [float("inf"), 0.0, 0.0, 1.0]), (None, [1.0] * 4), rows[7], rows[7], (905, [])]
    frame = spark.createDataFrame(rows + odd, "vec_id long, embedding array<double>")
    index = neighbours.build_index(frame, shard_rows=50)
    assert index.count() > 4 and index.selectExpr("sum(length(ids) / 8)").first()[0] == 304
    got = sorted(map(tuple, neighbours.nearest(frame, frame.filter("vec_id % 100 = 0 or vec_id > 399 or vec_id is null")).collect()))
    want = sorted(brute(rows, [r for r in rows if r[0] % 100 == 0 or r[0] > 399]))
    assert [g[:3] for g in got] == [w[:3] for w in want]
    assert neighbours.nearest(frame.limit(0), frame).count() == 0 == neighbours.nearest(frame, frame.limit(0)).count()


@pytest.fixture(scope="module")
def model():
    return html.fit()


def test_layouts_not_seen_in_training(model):
    common = union = 0
    for page in html.layouts(120, seed=4242):
        dom = html.Dom(page)
        labels = html.labels_of(dom, lambda n: n.label)
        p, _ = model.marginals(dom.nodes, [html.features(n) for n in dom.nodes])
        got, want = set(dom.blocks(lambda i: p[i] > 0.5)), set(dom.blocks(lambda i: labels[i] == 1))
        common, union = common + len(got & want), union + len(got | want)
    assert common > 0.9 * union


def test_marginals_against_enumeration(model):
    from itertools import product
    from math import exp

    dom = html.Dom("<body><nav><a>x y</a></nav><article><h1>T t</h1><p>One two. Three four five.</p></article></body>")
    found = [html.features(n) for n in dom.nodes]
    score = [sum(model.weights.get(f, 0.0) for f in fs) for fs in found]
    mass, total = [0.0] * len(score), 0.0
    for labels in product((0, 1), repeat=len(score)):
        e = sum(s for s, y in zip(score, labels) if y)
        e += sum(model.between[int(n.tag in html.LEAVES)][labels[n.parent]][labels[i]] for i, n in enumerate(dom.nodes) if i)
        total += exp(e)
        for i, y in enumerate(labels):
            mass[i] += y * exp(e)
    p, _ = model.marginals(dom.nodes, found)
    assert p == pytest.approx([m / total for m in mass])


PAGE = "<html><head><title>t</title><script>var a='<p>no</p>';</script></head><body><nav><ul><li><a href='/'>Home</a></li><li><a href='/b'>More</a></li></ul></nav><article><h1>A  title</h1><p>First &amp; second\n sentence. And <b>bold</b>ly more of it here.<p>Another one &lt;here&gt;, that goes on. And on.</article><footer>&copy; x</footer></body></html>"


def test_pages_and_their_cases(spark, model):
    want = "A title\nFirst & second sentence. And boldly more of it here.\nAnother one <here>, that goes on. And on."
    assert html.page_text(model, PAGE) == want
    deep = "<div>" * 20_000 + "x"
    rows = [(1, "u", PAGE), (2, None, None), (3, "u", ""), (4, "u", "<nav><a>x</a></nav>"), (None, "u", PAGE), (1, "u", PAGE), (5, "u", "</p></div><p <<>&#xZZ;&am"), (6, "u", deep), (7, "u", PAGE[: PAGE.index("Another") + 5])]
    frame = spark.createDataFrame([(*r, "t") for r in rows], "page_id long, url string, html string, text string")
    got = html.main_texts(frame, model).collect()
    assert len(got) == len(rows) and all(r.n_chars == len(r.text) for r in got)
    assert [r.text for r in got if r.page_id in (1, None)] == [want] * 3
    assert {r.page_id: r.text for r in got}[2] == "" == {r.page_id: r.text for r in got}[3]
    assert html.main_texts(frame.limit(0), model).count() == 0


def test_id_and_role_count_beside_many_classes():
    dom = html.Dom("<div class='flex flex-col w-1/4 p-4 m-2 bg-gray-100 text-sm' id='sidebar' role='navigation'>x</div>")
    assert {"name sidebar", "name navigation"} <= set(html.features(dom.nodes[-1]))
