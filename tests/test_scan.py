"""Line numbers over split files, and the readers and writers of delimited text."""

import os
import random
from dataclasses import replace

from feedcheck.functions.delimited import split_line, split_line_by
from feedcheck.functions.dialect import Dialect, dialect, with_dialects
from feedcheck.functions.schema import schema_from_avro_json
from feedcheck.operators.framing import frame, number_lines
from feedcheck.plans.validation import validate_files
from feedcheck.sources import feed, sinks
from feedcheck.sources.lines import ordered_lines, scan_lines
from pyspark.sql import functions as F

from .feeds import avro


def test_numbers_are_exact_over_many_splits(spark, folder):
    """Blank and comment lines are no records and take no number."""
    expected = {}
    for name, n in (("a", 4000), ("b", 10), ("c", 7001)):
        lines, kept = [], 0
        for i in range(n):
            if i % 10 == 3:
                lines.append("")
            elif i % 10 == 7:
                lines.append("# note")
            else:
                kept += 1
                lines.append(f"{name}|{kept}")
        expected[name] = kept
        with open(f"{folder}/{name}.unl", "w") as f:
            f.write("\n".join(lines))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
    try:
        d = dialect(sep="|", comment="#")
        src = scan_lines(spark, folder, d)
        assert src.chunks.count() > 15
        rows = frame(number_lines(src), 2, 1)
        parts = F.split("line", "\\|")
        wrong = rows.filter(F.col("line_no") != parts[1].cast("bigint"))
        assert wrong.count() == 0
        got = rows.groupBy(parts[0].alias("name")).agg(
            F.max("line_no").alias("n"), F.max("total_lines").alias("t"), F.count_if(F.col("section") == "header").alias("h"),
            F.count_if(F.col("section") == "footer").alias("f"),
        )
        for r in got.collect():
            assert (r.n, r.t, r.h, r.f) == (expected[r.name], expected[r.name], 2, 1)
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_large_file_in_splits_is_validated_like_a_small_one(spark, folder):
    n = 6000
    body = [f"{i}|{i * 3}|{'x' if i % 2 else 'a,b'}" for i in range(n)]
    for name, lines in (("good", body), ("bad", [*body[:4321], "q|1|x", *body[4322:]])):
        with open(f"{folder}/{name}.unl", "w") as f:
            f.write("\n".join([str(n), *lines, "end"]))
    settings = {
        "header_record_count": "1", "footer_record_count": "1", "record_count_location": "header", "record_count_filter": "[0-9]+",
        "add_file_and_record_id": "1", "file_uuid_or_id": "file_uuid", "file_uuid": "u", "field_separator": "|",
        "table_schema": avro("a:long", "b:long", "c:string"), "insert_table_schema": avro("file_id:string", "record_id:long", "a:long", "b:long", "c:string"),
    }
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
    try:
        src = scan_lines(spark, folder, dialect(sep="|"))
        files = src.chunks.select("file_key").distinct()
        run = validate_files(src, files, "data_only", settings=settings, dialect=dialect(sep="|"))
        assert {r.file_key[-8:]: (r.code, r.actual_record_count) for r in run.decided.collect()} == {"good.unl": ("225304", n), "/bad.unl": ("325308", n)}
        got = [r.line for r in run.success_lines().orderBy("record_id").collect()]
        assert got == [f"u|{i + 1}|{b}" for i, b in enumerate(body)]
        errors = [(r.line_no, r.record_id, r.field) for r in run.record_errors().collect()]
        assert errors == [(4323, 4322, "a")]
        assert run.original_lines("failure").count() == n + 2
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_ordered_lines_use_bounded_buckets(spark):
    df = spark.range(0, 1000).select(F.when(F.col("id") % 3 == 0, "small").otherwise("big").alias("f"), (F.col("id") * 7 - 500).alias("o"))
    src = ordered_lines(df.withColumn("l", F.col("o").cast("string")), "f", "o", "l", width=50)
    assert src.chunks.agg(F.max("n_lines")).first()[0] <= 50
    rows = number_lines(src).collect()
    for key in ("small", "big"):
        mine = sorted((r.line_no, int(r.line)) for r in rows if r.file_key == key)
        assert [n for n, _ in mine] == list(range(1, len(mine) + 1))
        assert [o for _, o in mine] == sorted(o for _, o in mine)


def test_sections_divide_each_file(spark):
    df = spark.createDataFrame([("f", i, 5) for i in range(1, 6)], "file_key string, line_no long, total_lines long")
    for header, footer, expected in ((2, 2, "hhdff"), (4, 4, "hhhhf"), (0, 0, "ddddd"), (9, 1, "hhhhh")):
        got = "".join(r.section[0] for r in frame(df, header, footer).orderBy("line_no").collect())
        assert got == expected


def test_split_line(spark):
    cases = {
        "a|b|c": ["a", "b", "c"], 'a|"b|c"|d': ["a", "b|c", "d"], "|a|": ["", "a", ""], '"a""b"|c': ['a"b', "c"], '"a': None,
        '"a"x|b': None, "a\\|b|c": ["a|b", "c"], 'x"y|z': ['x"y', "z"], '"a\\"b|c"|d': ['a"b|c', "d"], '"q" |r': ["q", "r"],
        "a\\": None, '"l1\nl2"|z': ["l1\nl2", "z"], "a\\\\|b": ["a\\", "b"],
    }
    df = spark.createDataFrame([(k,) for k in cases], "line string")
    for r in df.select("line", split_line(F.col("line"), dialect(sep="|")).alias("f")).collect():
        assert r.f == cases[r.line], r.line
    # A very long value with very many quotes is read whole.
    long = '"' + 'x""' * 50_000 + '"|z'
    r = spark.createDataFrame([(long,)], "line string").select(split_line(F.col("line"), dialect(sep="|")).alias("f")).first()
    assert r.f == ['x"' * 50_000, "z"]


def test_mysql_null_token(spark):
    d = dialect("mysql")
    r = spark.createDataFrame([("\\N\ta\\tb\tc",)], "line string").select(split_line(F.col("line"), d).alias("f")).first()
    assert r.f == [None, "a\tb", "c"]


def test_presets():
    assert dialect("tdf").sep == "\t"
    assert dialect("no such name").escape is None
    assert dialect(sep="\\t").sep == "\t"
    assert dialect(sep="||").sep == ","


def test_dialects_per_file(spark):
    rows = [("a", "|"), ("b", "\\t"), ("c", "too long"), ("d", "\\u0001"), ("e", "\\174"), ("f", "\\|"), ("g", "\\"), ("h", None), ("i", "\\u20ac"), ("j", "")]
    files = spark.createDataFrame(rows, "file_key string, field_separator string")
    got = {r.file_key: r.dialect.sep for r in with_dialects(files, Dialect()).collect()}
    assert got == {"a": "|", "b": "\t", "c": ",", "d": "\x01", "e": "|", "f": "|", "g": "\\", "h": ",", "i": "\u20ac", "j": ","}
    assert all(dialect(sep=s).sep == got[k] for k, s in rows if s is not None)


def test_lines_split_each_by_its_own_dialect_as_by_one(spark):
    forms = [dialect(sep=s, quote=q, escape=e, null_string=n, trim=False) for s in ("|", "\t", "]") for q in ('"', "'") for e in ("\\", q, "-") for n in (None, "\\N")]
    rng = random.Random(4)
    lines = ["", "a"] + ["".join(rng.choices("ab|\t]\"'\\- \tnN", k=rng.randrange(12))) for _ in range(150)]
    for n in (None, "\\N"):
        mine = [d for d in forms if d.null_string == n]
        base = replace(mine[0], sep=",")
        files = spark.createDataFrame([(i, d.sep, d.quote, d.escape) for i, d in enumerate(mine)], "id int, field_separator string, quote_char string, escape_char string")
        rows = with_dialects(files, base).crossJoin(spark.createDataFrame([(x,) for x in lines], "line string"))
        got = {(r.id, r.line): r.fields for r in rows.select("id", "line", split_line_by(F.col("line"), F.col("dialect"), n).alias("fields")).collect()}
        for i, d in enumerate(mine):
            want = spark.createDataFrame([(x,) for x in lines], "line string").select("line", split_line(F.col("line"), d).alias("fields")).collect()
            assert all(got[i, r.line] == r.fields for r in want), (d, [(r.line, got[i, r.line], r.fields) for r in want if got[i, r.line] != r.fields][:3])


def test_a_tab_after_a_closing_quote_separates(spark):
    d = dialect("tdf")
    assert spark.range(1).select(split_line(F.lit('"a"\t"b" \t\t"c"'), d).alias("f")).first().f == ["a", "b", "", "c"]
    assert spark.range(1).select(split_line(F.lit('"a" "b"\tc'), d).alias("f")).first().f is None


def test_a_dialect_without_quote(spark):
    files = with_dialects(spark.createDataFrame([("|", None)], "field_separator string, quote_char string"), dialect("mysql"))
    rows = files.withColumn("line", F.lit('a"|\\N|b\\|c')).select(split_line_by(F.col("line"), F.col("dialect"), "\\N").alias("f"))
    assert rows.first().f == ['a"', None, "b|c"]


def test_write_and_read(spark, folder):
    rows = [(1, "a,b", 1.5), (2, 'say "x"', None), (3, None, 2.0)]
    df = spark.createDataFrame(rows, "id long, text string, num double")
    schema = schema_from_avro_json(avro("id:long", "text:string?", "num:double?"))
    for i, mode in enumerate(("ALL", "MINIMAL")):
        d = dialect("rfc-4180", quote_mode=mode, header=True, record_separator="\n")
        sinks.write_feed(df, f"{folder}/{i}", d)
        back = feed.read_feed(spark, f"{folder}/{i}", d, schema)
        assert sorted(map(tuple, back.collect())) == sorted(rows)
        assert feed.read_feed(spark, f"{folder}/{i}", d, infer=True).schema["num"].dataType.typeName() == "double"
        assert feed.header_schema(spark, f"{folder}/{i}", d).names == ["id", "text", "num"]
    d = dialect(sep="|", quote_mode="NON_NUMERIC", trailing_delimiter=True, include_header=True)
    sinks.write_feed(df.coalesce(1), f"{folder}/lines", d)
    part = next(f for f in os.listdir(f"{folder}/lines") if f.startswith("part-"))
    assert open(f"{folder}/lines/{part}").read().splitlines() == ['"id"|"text"|"num"|', '1|"a,b"|1.5|', '2|"say ""x"""||', "3||2.0|"]


def test_multiline_values(spark, folder):
    with open(f"{folder}/m.csv", "w") as f:
        f.write('1,"two\nlines"\n2,one\n')
    schema = schema_from_avro_json(avro("id:long", "text:string"))
    d = dialect("rfc-4180")
    assert [tuple(r) for r in feed.read_feed(spark, folder, d, schema, multiline=True).collect()] == [(1, "two\nlines"), (2, "one")]


def test_typed_records(spark):
    lines = spark.createDataFrame([("a|1|2.5|true",), ("b|x|y|z",), ("c|99999999999||",)], "line string")
    schema = schema_from_avro_json(avro("name:string", "n:int", "v:double", "ok:boolean"))
    got = [tuple(r) for r in feed.typed_records(lines, schema, dialect(sep="|"), []).collect()]
    assert got == [("a", 1, 2.5, True), ("b", None, None, None), ("c", None, None, None)]
