"""The index of expressions: covers hold for every match, results are those of trying all, and few are tried."""

import random
import re

from pyspark.sql import functions as F

from feedcheck.operators.patterns import _may_be_filed, candidates, covers_of, pattern_index, unclaimed_by_index
from feedcheck.operators.unclaimed import unclaimed_files, unclaimed_report

PARTS = ["abc", "xyz1", "_0371_", "b", "\\.", "\\d+", "[a-c]{2}", "[^_]*", "(abc|b_1)", "(?:xyz1|ab)?", "(?:q)*", "(b+c|cab)", "a{0,2}", "(abc){2}", "\\Qa.b\\E", "\\Qabc\\E?", ".*", "\\x41bc", "ab+", "(?=a)", "(?:a(b|c)abc)+"]


def _expression(draw):
    text = "".join(draw.choice(PARTS) for _ in range(draw.randint(1, 4)))
    return text if draw.random() < 0.8 else text + "|" + "".join(draw.choice(PARTS) for _ in range(draw.randint(1, 2)))


def _name(draw):
    return "".join(draw.choice(["abc", "xyz1", "_0371_", "b", ".", "7", "ca", "b_1", "q", "a.b", "Abc", "ab", "c"]) for _ in range(draw.randint(0, 4)))


def test_covers():
    assert covers_of("a.*_0371_[0-9]+") == [["a"], ["_0371_"]]
    assert covers_of("(?:abc|xyz)_1") == [["abc", "xyz"], ["_1"]]
    assert covers_of("abc?d") == [["ab"], ["d"]]
    assert covers_of("abc{2,}d") == [["abc"], ["d"]]
    assert covers_of("abc|.*") == [] and covers_of("(?i)abc") == [] and covers_of("") == []
    assert covers_of("\\Qa.c\\E{0}x") == [["a."], ["x"]]
    assert covers_of("\\x41\\u0042\\p{Lu}\\N{DIGIT ONE}\\cAdef") == [["def"]]
    assert covers_of("[]a]bc") == [] and covers_of("(abc") == [] and covers_of("[a&&[^b]]cde") == [["cde"]]
    assert covers_of("(" * 100 + "abc" + ")" * 100) == [] and covers_of("(?<!abc)def") == [["def"]]


def test_every_match_contains_one_text_of_each_cover():
    draw, met = random.Random(3), 0
    for _ in range(3000):
        regex = _expression(draw)
        plain = re.sub(r"\\Q(.*?)\\E", lambda m: "".join(map(re.escape, m[1])), regex)
        for _ in range(20):
            name = _name(draw)
            if re.fullmatch(plain, name):
                met += 1
                for cover in covers_of(regex):
                    assert any(t in name for t in cover), (regex, name, cover)
    assert met > 300


ROLLUP = "directory string, localhost string, regexes array<string>, port string"


def test_same_as_trying_all(spark):
    draw = random.Random(11)
    sets = [(f"/d{i % 5}", "h1", [_expression(draw) for _ in range(draw.randint(0, 6))], str(i)) for i in range(7)]
    sets += [("/flags", "h1", ["(?i)ABC", "(a)b\\1"], "22"), ("/broken", "h1", ["abc", "("], "22"), ("/none", "h1", None, "22")]
    rollup = spark.createDataFrame(sets, ROLLUP)
    names = sorted({_name(draw) for _ in range(60)}) + ["ABC", "aba", ".", "..", "", None]
    rows = [(d, "h1", n, k) for k, d in enumerate(["/d0", "/d1", "/d2", "/d3", "/d4", "/flags", "/broken", "/none", "/strange"]) for n in names]
    rows += rows[:5]
    listing = spark.createDataFrame(rows, "directory string, localhost string, file_name string, k int")
    one, other = unclaimed_files(listing, rollup).drop("regexes"), unclaimed_by_index(listing, rollup)
    want = sorted(map(str, one.select(sorted(one.columns)).collect()))
    assert want and sorted(map(str, other.select(sorted(one.columns)).collect())) == want
    nothing = unclaimed_by_index(listing.limit(0), rollup), unclaimed_by_index(listing, rollup.limit(0))
    assert [d.count() for d in nothing] == [0, 0]


def test_report_through_the_index(spark):
    rollup = spark.createDataFrame([("/in", "h1", ["abc.*"], "22")], ROLLUP)
    for c in ("support_email_list", "quarantine_directory", "project", "username", "private_key_path"):
        rollup = rollup.withColumn(c, F.lit("x"))
    listing = spark.createDataFrame([("/in", "h1", "abc1"), ("/in", "h1", "xbc1")], "directory string, localhost string, file_name string")
    assert [r.file_name for r in unclaimed_report(listing, rollup, find=unclaimed_by_index).collect()] == ["xbc1"]


def test_few_expressions_are_tried(spark):
    sets = spark.createDataFrame([(1, [f"feed_{i:05d}_[0-9]+\\.csv" for i in range(3000)] + ["[0-9]+"])], "set_id long, regexes array<string>")
    index, rest = pattern_index(sets)
    assert index.count() == 3000 and rest.first().rest == ["[0-9]+"]
    names = spark.createDataFrame([(1, f"feed_{i:05d}_77.csv") for i in range(0, 3000, 30)], "set_id long, file_name string")
    tried = candidates(names, index)
    # Trying all would be 3000 for each of the 100 names.
    assert tried.count() < 100 * 40
    own = F.concat(F.substring("file_name", 1, 11), F.lit("[0-9]+\\.csv"))
    assert tried.filter(F.col("regex") == own).count() == 100


def test_long_pieces_tell_numbers_apart(spark):
    """Numbers share their pieces of three digits with many others, but not their longer ones."""
    sets = spark.createDataFrame([(1, [f".*#0*{i}_.*" for i in range(10_000, 14_000)])], "set_id long, regexes array<string>")
    index, rest = pattern_index(sets)
    names = spark.createDataFrame([(1, f"c#0000{i}_{i + 7}_x.csv") for i in range(10_000, 14_000, 40)], "set_id long, file_name string")
    tried = candidates(names, index)
    assert tried.count() <= 3 * 100 and rest.count() == 0
    own = F.concat(F.lit(".*#0*"), F.substring("file_name", 7, 5), F.lit("_.*"))
    assert tried.filter(F.col("regex") == own).count() == 100
    # The look before a shuffle loses none that is filed, and leaves out nearly all others.
    grams = spark.range(0, 40_000).select(F.lit(1).cast("long").alias("set_id"), F.concat(F.col("id").cast("string"), F.lit("_")).alias("gram"))
    passed = _may_be_filed(grams, index)
    assert passed.join(index, ["set_id", "gram"], "left_semi").count() == grams.join(index, ["set_id", "gram"], "left_semi").count() == 4000
    assert passed.count() < 4400
