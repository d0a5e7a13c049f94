import hashlib

from pyspark.sql import functions as F

from feedcheck.llm import exact, urls

DOCS = "doc_id long, text string, kept string, salt int"


def docs_of(spark, rows):
    return spark.createDataFrame([(i, t, "x", 1) for i, t in rows], DOCS)


def test_copies_null_empty_long_and_repeated_rows(spark):
    long = "ab " * 400_000
    rows = [(1, "a"), (2, "a"), (3, "A"), (4, None), (5, ""), (6, long), (7, long), (7, long), (None, "a"), (8, "a ")]
    got = [tuple(r) for r in exact.exact_duplicates(docs_of(spark, rows)).collect()]
    sha = lambda t: hashlib.sha256((t or "").encode()).hexdigest()
    want = [(1, 1, 3, True, sha("a")), (2, 1, 3, False, sha("a")), (None, 1, 3, False, sha("a")), (3, 3, 1, True, sha("A")), (8, 8, 1, True, sha("a "))]
    want += [(4, 4, 2, True, sha("")), (5, 4, 2, False, sha("")), (6, 6, 3, True, sha(long)), (7, 6, 3, False, sha(long)), (7, 6, 3, False, sha(long))]
    assert sorted(got, key=str) == sorted(want, key=str)


def test_keep_largest_keeps_one_of_equal_rows(spark):
    got = exact.exact_duplicates(docs_of(spark, [(1, "a"), (9, "a"), (9, "a")]), keep="largest").collect()
    assert sorted((r.doc_id, r.keep_id, r.kept) for r in got) == [(1, 9, False), (9, 9, False), (9, 9, True)]


def test_hot_text_over_many_salts(spark):
    rows = [(i, "hot") for i in range(2000)] + [(i, f"t{i % 700}") for i in range(2000, 4000)]
    got = exact.exact_duplicates(docs_of(spark, rows)).filter("kept").select("doc_id", "group_size").collect()
    assert len(got) == 701 and {r.doc_id: r.group_size for r in got}[0] == 2000


def test_empty_table_and_rows_without_copies(spark):
    empty = docs_of(spark, [])
    assert exact.exact_duplicates(empty).count() == 0 and exact.without_copies(empty).count() == 0
    left = exact.without_copies(docs_of(spark, [(2, "a"), (1, "a"), (1, "a"), (1, "b"), (None, "c")]))
    assert left.columns == ["doc_id", "text", "kept", "salt"]
    assert sorted(((r.doc_id, r.text) for r in left.collect()), key=str) == [(1, "a"), (1, "b"), (None, "c")]


PAGES = [
    (1, "http://www.Example.ORG/es/1"), (2, "https://example.org/en/12?x=/es/"), (3, "http://a.com/de/#f"), (4, "http://a.com/fr"),
    (5, "http://x.net/de/"), (6, None), (7, ""), (8, "no scheme"), (9, "http://org"), (10, "http://notexample.org/es/x"), (10, "http://notexample.org/es/x"),
    (None, "x://b.c.example.org/en/"), (11, "http://example.org/EN/1"), (12, "http:///en/1"), (13, "http://com/de/é?" + "q" * 100_000),
]
RULES = [("allow", "org", "/"), ("block", "example.org", "/es/"), ("block", "example.org", "/en/1"), ("allow", "com", "/fr/"), ("block", "com", "/de/")]


def judged(url, rules, default="allow"):
    host = path = ""
    if url is not None and "://" in url:
        rest = url.split("://", 1)[1]
        cut = min((rest.find(c) for c in "/?#" if c in rest), default=len(rest))
        host, rest = "".join(c.lower() if c.isascii() else c for c in rest[:cut]), rest[cut:]
        path = rest[: min((rest.find(c) for c in "?#" if c in rest), default=len(rest))]
    fits = [(len(h + p), h + p, v) for v, h, p in rules if (host == h or host.endswith("." + h)) and path.startswith(p)]
    return (host, path, max(fits)[1], max(fits)[2]) if fits else (host, path, None, default)


def test_rules_against_brute_force(spark):
    pages = spark.createDataFrame([(i, u, "r", "h") for i, u in PAGES], "page_id long, url string, rule string, host string")
    got = [tuple(r) for r in urls.url_verdicts(pages, RULES).collect()]
    assert sorted(got, key=str) == sorted(((i, *judged(u, RULES)) for i, u in PAGES), key=str)
    assert urls.url_verdicts(pages.limit(0), RULES).count() == 0
    assert {r.verdict for r in urls.url_verdicts(pages, [], default="block").collect()} == {"block"}


def test_joined_index_gives_the_same(spark, monkeypatch):
    rules = RULES + [("block", f"h{i}.net", f"/p{i % 7}/") for i in range(300)] + [("allow", "x.net", "/d")]
    pages = spark.createDataFrame(PAGES + [(100 + i, f"http://w.h{i}.net/p{i % 5}/z") for i in range(50)], "page_id long, url string")
    inline = sorted(map(tuple, urls.url_verdicts(pages, rules).collect()), key=str)
    monkeypatch.setattr(urls, "INLINE_RULES", 10)
    assert sorted(map(tuple, urls.url_verdicts(pages, rules).collect()), key=str) == inline
    assert inline == sorted(((r.page_id, *judged(r.url, rules)) for r in pages.collect()), key=str)


def test_no_python_on_the_main_path(spark, capsys):
    exact.exact_duplicates(docs_of(spark, [(1, "a")])).explain()
    urls.url_verdicts(spark.createDataFrame(PAGES, "page_id long, url string"), RULES).explain()
    said = capsys.readouterr().out
    assert "Python" not in said and "Arrow" not in said and "Cartesian" not in said
    assert F  # columns only
