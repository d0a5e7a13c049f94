"""Records whose quoted values hold line breaks, over many splits."""

import csv
import io
import random

import pytest
from feedcheck.functions.delimited import split_line
from feedcheck.functions.dialect import dialect
from feedcheck.operators.framing import number_lines
from feedcheck.sources.lines import scan_lines
from pyspark.sql import functions as F


@pytest.mark.parametrize("end", ["\n", "\r\n"])
def test_records_over_several_lines(spark, folder, end):
    rng = random.Random(3)
    words = ["a", "b c", 'q"q', "x|y", "line\nbreak", "two\n\nbreaks", "\n", '"\n"', "é", "", "# no comment\n"]
    expected = {}
    for name, n in (("a", 900), ("b", 3), ("c", 400)):
        rows = [[str(i), rng.choice(words), rng.choice(words)] for i in range(1, n + 1)]
        expected[name] = rows
        text = io.StringIO()
        csv.writer(text, delimiter="|", lineterminator=end).writerows(rows)
        with open(f"{folder}/{name}.csv", "w", newline="") as f:
            f.write(text.getvalue())
    spark.conf.set("spark.sql.files.maxPartitionBytes", "512")
    try:
        d = dialect("rfc-4180", sep="|")
        src = scan_lines(spark, folder, d, multiline=True)
        got = {}
        for r in number_lines(src).withColumn("f", split_line(F.col("line"), d)).orderBy("file_key", "line_no").collect():
            got.setdefault(r.file_key[-5], []).append((r.line_no, r.total_lines, r.f))
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    for name, rows in expected.items():
        assert [f for _, _, f in got[name]] == rows
        assert [(n, t) for n, t, _ in got[name]] == [(i, len(rows)) for i in range(1, len(rows) + 1)]


def test_unclosed_quote_makes_one_line_malformed_and_loses_none(spark, folder):
    with open(f"{folder}/u.csv", "w") as f:
        f.write('1|a\n2|"b\nc"|d\n\n3|"open\n' + "4|x\n" * 200)
    spark.conf.set("spark.sql.files.maxPartitionBytes", "64")
    try:
        d = dialect("rfc-4180", sep="|")
        rows = number_lines(scan_lines(spark, folder, d, multiline=True)).withColumn("f", split_line(F.col("line"), d))
        got = [(r.line_no, r.line, r.f) for r in rows.orderBy("line_no").collect()]
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert got[:3] == [(1, "1|a", ["1", "a"]), (2, '2|"b\nc"|d', ["2", "b\nc", "d"]), (3, '3|"open', None)]
    assert got[3:] == [(n, "4|x", ["4", "x"]) for n in range(4, 204)]
