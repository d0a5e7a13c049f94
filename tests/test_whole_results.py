"""No file, line or row vanishes: unlisted and doubled files, blank lines, broken patterns."""

import datetime

import pytest
from feedcheck import codes
from feedcheck.functions import dates
from feedcheck.functions.dialect import dialect
from feedcheck.operators import partition, sheets, unclaimed
from feedcheck.plans.validation import validate_files
from feedcheck.sources import listing
from feedcheck.sources.lines import scan_lines
from pyspark.sql import functions as F

from .feeds import avro, settings

KEPT = ("table_schema", "insert_table_schema", "header_record_count", "footer_record_count", "record_count_location", "field_separator", "add_file_and_record_id", "file_uuid_or_id")


def test_every_file_has_one_verdict_and_every_line_a_route(spark, folder):
    texts = {"good": "1|a\n\n2|b\n", "bad": "\n1|a\n\nx|b\n", "twice": "1|a\n", "extra": "7|z\n\n"}
    for name, text in texts.items():
        with open(f"{folder}/{name}.unl", "w") as f:
            f.write(text)
    d = dialect(sep="|")
    src = scan_lines(spark, folder, d)
    paths = {k: f"file:{folder}/{k}.unl" for k in texts}
    files = spark.createDataFrame([(paths[k], k) for k in ("good", "bad", "twice", "twice")], "file_key string, file_name string")
    schema = avro("n:long", "word:string")
    fixed = {k: v for k, v in settings(read=schema, write=schema).items() if k in KEPT}
    run = validate_files(src, files, "data_only", settings=fixed, dialect=d)
    got = sorted((r.file_key.rsplit("/", 1)[1], r.status, r.code, r.message) for r in run.decided.collect())
    attribute = codes.PROFILES["data_only"]["attribute"]
    assert [g[:2] for g in got] == [("bad.unl", "failure"), ("extra.unl", "failure"), ("good.unl", "success"), ("twice.unl", "failure")]
    assert got[1][2:] == (attribute, "file is not listed")
    assert got[3][2:] == (attribute, "file is listed 2 times")
    lines = {}
    for status in ("success", "failure"):
        for r in run.original_lines(status).orderBy("file_key", "line_no").collect():
            lines.setdefault(r.file_key.rsplit("/", 1)[1][:-4], []).append(r.line)
    assert lines == {k: v.split("\n")[:-1] for k, v in texts.items()}
    assert [r.line for r in run.success_lines().orderBy("record_id").collect()] == ["1|a", "2|b"]


def test_a_broken_expression_leaves_other_directories_alone(spark):
    rollup = spark.createDataFrame([("/a", "h", ["(", "x.*"]), ("/b", "h", ["y.*", "\\Qz\\E"]), ("/c", "h", ["\\Qz"])], "directory string, localhost string, regexes array<string>")
    for c in set(unclaimed.REPORT) - {"directory", "localhost", "file_name", "file_uuid"}:
        rollup = rollup.withColumn(c, F.lit("-"))
    files = spark.createDataFrame([("/a", "h", "x1"), ("/b", "h", "y1"), ("/b", "h", "z"), ("/b", "h", "w"), ("/c", "h", "z")], "directory string, localhost string, file_name string")
    report = unclaimed.unclaimed_report(files, rollup, files)
    assert sorted((r.directory, r.file_name, r.log_type_id) for r in report.collect()) == [("/a", "null", codes.LISTING_BAD_REGEX), ("/b", "w", codes.UNCLAIMED_LISTED), ("/c", "null", codes.LISTING_BAD_REGEX)]
    assert sorted(r.file_name for r in unclaimed.claimed_files(files, rollup).collect()) == ["y1", "z"]


@pytest.mark.parametrize("base", ["/d/it's", "file:/d/it's/", "file:///d/it's"])
@pytest.mark.parametrize("scheme", ["", "file:", "file://"])
def test_bases_with_and_without_a_scheme(spark, base, scheme):
    df = spark.createDataFrame([(f"{scheme}/d/it's/s/f", f"{scheme}/d/it's/s", "f"), (f"{scheme}/d/it's/.h/f", f"{scheme}/d/it's/.h", "f")], "path string, folder string, file_name string")
    assert [r.folder for r in listing.segments_match(df, base).collect()] == [f"{scheme}/d/it's/s"]
    rows = df.withColumns({"size": F.lit(1), "modified": F.current_timestamp()})
    assert [r.path for r in listing.listing_attributes(rows, base).collect()] == ["s/", ".h/"]


def test_listing_state_over_cycles(spark):
    def cycle(times, state):
        df = spark.createDataFrame([("f", t) for t in times], "file_name string, modified_ms long")
        out, state = listing.new_files(df, state)
        return sorted(r.modified_ms for r in out.collect()), state

    out, state = cycle([1, 2, 2, 3], listing.ListingState())
    assert (out, state) == ([1, 2, 2], listing.ListingState(3, 2))
    out, state = cycle([1, 2, 2, 3], state)
    assert (out, state) == ([3], listing.ListingState(3, 3))
    out, state = cycle([1, 2, 2, 3], state)
    assert (out, state) == ([], listing.ListingState(3, 3))
    out, state = cycle([], state)
    assert (out, state) == ([], listing.ListingState(3, 3))


def test_dates_roll_over_through_long_parts_and_milliseconds_are_three_digits(spark):
    df = spark.createDataFrame([("2019110110101000000123",), ("20191101101010",), ("2019110110101099999999999999999999",)], "t string")
    got = [r.x for r in df.select(dates.parse_lenient(F.col("t"), "yyyyMMddHHmmss").alias("x")).collect()]
    start = datetime.datetime(2019, 11, 1, 10, 10)
    assert got == [start + datetime.timedelta(seconds=1_000_000_123), start.replace(second=10), None]
    with pytest.raises(dates.PatternError):
        dates.to_spark_pattern("yyyy S")


def test_rows_without_a_partition_value_are_told_apart(spark):
    df = spark.createDataFrame([(1, "eu"), (2, ""), (3, None)], "n int, region string")
    spec = '{"partitionArr": [{"source": "attribute", "attributeName": "region"}]}'
    ts = F.lit("2024-01-01 00:00:00").cast("timestamp")
    rows, columns = partition.with_partition_values(df, spec, ts)
    assert ([r.n for r in rows.collect()], columns) == ([1], ["region"])
    left = partition.rows_without_partition(df, spec, ts)
    assert sorted((r.n, r.partition_code) for r in left.collect()) == [(2, "326017"), (3, "326017")]


def test_a_cell_given_twice_fails_its_file_only(spark):
    cells = spark.createDataFrame([("f", "s", 0, 0, "a"), ("f", "s", 0, 0, "b"), ("g", "s", 0, 0, "c"), ("g", "s", 0, 1, "d")], "file string, sheet string, row int, col int, str string")
    cells = cells.withColumns({"type": F.lit("STRING"), "num": F.lit(None).cast("double"), "ts": F.lit(None).cast("timestamp")})
    assert [(r.file, r.line) for r in sheets.convert_sheets(cells).collect()] == [("g", "c|d")]
