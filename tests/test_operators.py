"""Partition paths, listings, unclaimed files, sheets, statistics, encryption, dates."""

import os
from datetime import datetime

import pytest
from feedcheck.functions import dates
from feedcheck.functions.schema import SchemaMissing, SchemaUnparsable, schema_from_avro_json
from feedcheck.functions.text import compiles
from feedcheck.operators import audit, crypt, metadata, partition, reconcile, sheets, stats, unclaimed
from feedcheck.sources import conf as cn
from feedcheck.sources import listing as ls
from feedcheck.sources import sinks
from feedcheck.sources.state import ListingStore, StateConflict, begin_cycle
from pyspark.sql import functions as F

from .feeds import avro

NOW = datetime(2020, 3, 22, 10, 44, 5)


def paths(spark, spec, **attrs):
    df = spark.createDataFrame([(NOW, *attrs.values())], ["ts", *attrs])
    r = partition.partition_columns(df, spec, F.col("ts")).first()
    return r.raw_partition, r.hive_partition, r.partition_code


def part(**kw):
    import json

    return json.dumps({"partitionArr": [kw]})


def test_partition_paths(spark):
    spec = (
        '{"partitionArr":[{"source":"date","format":"yy"},{"columnName":"pier","source":"attribute",'
        '"attributeName":"pier"},{"columnName":"slot","source":"dateWithMod","format":"ddHH","appendMod":"mm15"}]}'
    )
    raw, hive, code = paths(spark, spec, pier="east4")
    assert raw == "20/pier=east4/slot=221030"
    assert hive == "20,east4,221030"
    assert code == "226005"
    assert paths(spark, '{"partitionArr":[]}') == ("", "", "226005")
    assert paths(spark, "") == ("", "", "226005")
    ymd = '{"partitionArr":[{"columnName":"year","source":"date","format":"yyyy"},{"columnName":"month","source":"date","format":"MM"},{"columnName":"day","source":"date","format":"dd"}]}'
    assert paths(spark, ymd)[:2] == ("year=2020/month=03/day=22", "2020,03,22")
    # The raw key of an attribute is the attribute's name, also when a column name is given.
    assert paths(spark, part(source="attribute", columnName="c", attributeName="a"), a="v")[:2] == ("a=v", "v")


@pytest.mark.parametrize(
    ("spec", "code"),
    [
        ("{", "326006"), (part(source="date"), "326007"), (part(source="date", format="jj"), "326008"),
        (part(source="dateWithMod", format="jj", appendMod="mm15"), "326009"), (part(source="dateWithMod"), "326010"),
        (part(source="dateWithMod", appendMod="mm1"), "326010"), (part(source="dateWithMod", appendMod="mmxx"), "326011"),
        (part(source="dateWithMod", appendMod="jj15"), "326012"), (part(source="dateWithMod", appendMod="HH25"), "326013"),
        (part(source="dateWithMod", appendMod="mm61"), "326014"), (part(source="dateWithMod", appendMod="dd15"), "326015"),
        (part(source="attribute"), "326016"), (part(source="attribute", attributeName="gone"), "326017"),
        (part(source="other"), "326018"),
        (part(source="dateWithMod", appendMod="mm00"), "326011"),  # a step of zero is refused here
    ],
)
def test_partition_errors(spark, spec, code):
    assert paths(spark, spec) == (None, None, code)


def test_partitioned_write(spark, folder):
    df = spark.range(100).withColumns({"ts": F.timestamp_seconds(F.col("id") * 7200), "kind": F.when(F.col("id") % 2 == 0, "a").otherwise("b")})
    spec = '{"partitionArr":[{"source":"date","format":"dd"},{"source":"attribute","attributeName":"kind"}]}'
    rows, columns = partition.with_partition_values(df, spec, F.col("ts"))
    assert columns == ["part_0", "kind"]
    sinks.write_partitioned(rows, columns, f"{folder}/out")
    assert spark.read.parquet(f"{folder}/out").count() == 100
    assert "part_0=01" in os.listdir(f"{folder}/out")


def test_written_lines_keep_their_order(spark, folder):
    df = spark.range(5000).select(F.when(F.col("id") % 10 == 0, "s").otherwise("big").alias("file_key"), F.col("id").alias("record_id"))
    df = df.withColumn("line", F.col("record_id").cast("string")).repartition(7)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        sinks.write_lines(df, f"{folder}/out", order="record_id")
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    parts = sorted(f for f in os.listdir(f"{folder}/out/file_key=big") if f.endswith(".txt"))
    assert len(parts) > 1
    got = [int(x) for p in parts for x in open(f"{folder}/out/file_key=big/{p}").read().split()]
    assert got == [i for i in range(5000) if i % 10]


def listing(spark, names, directory="/in", host="h1"):
    return spark.createDataFrame([(directory, host, n) for n in names], "directory string, localhost string, file_name string")


def test_unclaimed_and_claimed_divide_the_listing(spark):
    rows = [
        ("/in", "h1, h2", "22", "^tides_[0-9]{8}\\_n.csv.gz$", "u2", None, "/q", "b@x,a@x", "p"),
        ("/in", "h1, h2", "22", "^tides_[0-9]{8}\\.list$", "u1", "/k", "/q", "a@x", "p"),
        ("/none", "h1", "22", None, "u", None, "/q", None, "p"),
        ("/back", "h1", "22", "(a)\\1", "u", None, "/q", None, "p"),
        ("/back", "h1", "22", "(b)\\1", "u", None, "/q", None, "p"),
        ("/other", "h1", "22", ".*", "u", None, "/q", None, "x"),
        (None, "h1", "22", ".*", "u", None, "/q", None, "p"),
    ]
    names = "directory, hostname, port, file_regex, username, private_key_path, quarantine_directory, support_email_list, project".split(", ")
    conf = spark.createDataFrame(rows, ", ".join(f"{n} string" for n in names))
    rollup = cn.directory_rollup(conf, "p")
    r = rollup.filter("directory = '/in'").first()
    assert (r.username, r.private_key_path, r.support_email_list) == ("u1", "/k", "a@x,b@x")
    hosts = cn.explode_hosts(rollup)
    files = ["tides_20230405_n.csv.gz", "tides_20230405.list", "tides_20230405.list\n", "x", ".", ".."]
    landed = listing(spark, files).union(listing(spark, ["y"], "/none")).union(listing(spark, ["aa", "bb", "ab"], "/back"))
    found = {(r.directory, r.file_name) for r in unclaimed.unclaimed_files(landed, hosts).collect()}
    assert found == {("/in", "x"), ("/in", "tides_20230405.list\n"), ("/back", "ab")}  # no expression, nothing flagged
    claimed = {(r.directory, r.file_name) for r in unclaimed.claimed_files(landed, hosts).collect()}
    assert claimed == {("/in", files[0]), ("/in", files[1]), ("/back", "aa"), ("/back", "bb")}
    report = unclaimed.unclaimed_report(landed, hosts, landed).collect()
    lost = {(r.directory, r.localhost) for r in report if r.file_name == "null"}
    assert lost == {("/in", "h2")}
    assert {r.log_type_id for r in report} == {"231001", "331004"}


def test_list_files(spark, folder):
    for p in ("a.txt", "b.csv", "sub/c.txt", "sub/tmp~/d.txt"):
        os.makedirs(os.path.dirname(f"{folder}/{p}"), exist_ok=True)
        open(f"{folder}/{p}", "w").write("xyz")
    flat = ls.list_files(spark, folder, ".*\\.txt", "7").collect()
    assert [(r.file_name, r.actual_file_size, r.conf_id) for r in flat] == [("a.txt", 3, "7")]
    deep = ls.list_paths(spark, folder, recursive=True)
    assert sorted(r.file_name for r in deep.collect()) == ["a.txt", "b.csv", "c.txt", "d.txt"]
    kept = ls.segments_match(deep, f"file:{folder}", "[a-z.]+")
    assert sorted(r.file_name for r in kept.collect()) == ["a.txt", "b.csv", "c.txt"]  # tmp~ is not entered
    runs = ls.run_entries(kept, "r1").collect()
    assert [r.file_name for r in runs] == ["a.txt", "b.csv", "c.txt"]
    attrs = {r.filename: r.path for r in ls.listing_attributes(deep, f"file:{folder}").collect()}
    assert attrs == {"a.txt": "./", "b.csv": "./", "c.txt": "sub/", "d.txt": "sub/tmp~/"}
    assert '"file_name":"a.txt"' in ls.entries_json(deep.select("file_name")).orderBy("json").first().json


def test_listing_limits_include_both_ends(spark):
    now = F.lit("2024-01-01 00:10:00").cast("timestamp")
    rows = [("a", "", 10, "2024-01-01 00:00:00"), ("b", "x", 20, "2024-01-01 00:09:00"), (".h", "", 15, "2024-01-01 00:05:00"), ("c", "y/z", 21, "2024-01-01 00:05:00")]
    df = spark.createDataFrame(rows, "file_name string, relative string, size long, modified string").withColumn("modified", F.to_timestamp("modified"))

    def names(**kw):
        return sorted(r.file_name for r in ls.filter_listing(df, now, **kw).collect())

    assert names(min_size=10, max_size=20, name_re=".*") == ["a", "b"]
    assert names(min_age_ms=60_000, max_age_ms=600_000) == ["a", "b", "c"]
    assert names(max_age_ms=599_999) == ["b", "c"]
    assert names(path_re="x") == ["a", "b"]
    assert names(path_re="x", recursive=False) == ["a", "b", "c"]
    assert names(name_re=".*", ignore_hidden=False) == [".h", "a", "b", "c"]


def test_incremental_listing(spark):
    def df(rows):
        return spark.createDataFrame(rows, "file_name string, modified_ms long")

    def names(d):
        return sorted(r.file_name for r in d.collect())

    out, state = ls.new_files(df([("a", 1), ("b", 2), ("c", 2), ("d_COPYING_", 9)]), ls.ListingState())
    assert names(out) == ["a"] and state == ls.ListingState(2, 1)
    out, state = ls.new_files(df([("a", 1), ("b", 2), ("c", 2)]), state)
    assert names(out) == ["b", "c"] and state == ls.ListingState(2, 2)
    out, state = ls.new_files(df([("a", 1), ("b", 2), ("c", 2)]), state)
    assert names(out) == [] and state == ls.ListingState(2, 2)
    out, state = ls.new_files(df([("a", 1), ("e", 5)]), state)
    assert names(out) == [] and state.listed == 5


def test_stored_state(spark, folder):
    def df(*rows):
        rows = [(n, "", 10, t, datetime(2024, 1, 1)) for n, t in rows]
        return spark.createDataFrame(rows, "file_name string, relative string, size long, modified_ms long, modified timestamp")

    def names(cycle):
        return sorted(r.file_name for r in cycle.files.collect())

    now, store = F.lit("2024-02-01").cast("timestamp"), ListingStore(spark, f"{folder}/state")
    rows = [("a", 1), ("b", 2)]
    one, other = (begin_cycle(df(*rows), store, "/d", now, name_re="[ab]") for _ in range(2))
    assert names(one) == names(other) == ["a"]
    assert one.commit() == 1
    with pytest.raises(StateConflict):
        other.commit()
    again = begin_cycle(df(*rows), store, "/d", now, name_re="[ab]")
    assert names(again) == ["b"]
    # Both have read version 1, and the second comes between the first one's look and its rename.
    late = ListingStore(spark, f"{folder}/state")
    late._versions = lambda: [1]
    assert again.commit() == 2
    with pytest.raises(StateConflict):
        late.commit(again.key, 1, again.state)
    assert names(begin_cycle(df(*rows), store, "/d", now, name_re="[ab]")) == []
    assert names(begin_cycle(df(*rows), store, "/d", now, name_re=".*")) == ["a"]
    assert names(begin_cycle(df(*rows), store, "/e", now, name_re="[ab]")) == ["a"]
    assert store.reset() == 3
    assert names(begin_cycle(df(*rows), store, "/d", now, name_re="[ab]")) == ["a"]
    assert names(begin_cycle(df(), store, "/d", now)) == []


def test_versions_are_pruned(spark, folder, monkeypatch):
    monkeypatch.setattr("feedcheck.sources.state.KEPT", 3)
    store = ListingStore(spark, f"{folder}/state")
    for k in range(6):
        assert store.commit("x", k, ls.ListingState(k, k)) == k + 1
    assert store.read("x") == (6, ls.ListingState(5, 5)) and store._versions() == [3, 4, 5, 6]


def test_first_rows(spark):
    rows = [(k % 3, k) for k in range(1000)]
    df = spark.createDataFrame(rows, "a int, b int").repartition(5)
    for n in (0, 1, 333, 334, 999, 1000, 5000):
        got = sorted((r.a, r.b) for r in stats.first_rows(df, [F.col("a").desc(), F.col("b")], n).collect())
        assert got == sorted(sorted(rows, key=lambda r: (-r[0], r[1]))[:n])
    assert stats.first_rows(df.limit(0), [F.col("a")], 5).count() == 0


def test_patterns_compile(spark):
    given = ["a.*", "((", "\\Qopen", "(?x) a # note", "", "[a", "(?<n>x)\\k<n>", None]
    rows = spark.createDataFrame([(p,) for p in given], "p string").select("p", compiles(F.col("p")).alias("part"), compiles(F.col("p"), whole=True).alias("whole"))
    assert [(r.part, r.whole) for r in rows.collect()] == [(True, True), (False, False), (True, False), (True, False), (True, True), (False, False), (True, True), (None, None)]


def test_sheets(spark):
    schema = "file string, sheet int, row int, col int, type string, str string, num double, ts timestamp"
    day = datetime(1999, 11, 5)
    rows = [
        ("f", 0, 0, 0, "DATE", None, None, day), ("f", 0, 0, 1, "NUMERIC", None, 17.25, None), ("f", 0, 0, 2, "STRING", "lock;gate", None, None),
        ("f", 0, 0, 3, "STRING", "low|high|slack", None, None), ("f", 0, 0, 4, "STRING", "kelp", None, None),
        ("f", 1, 0, 0, "BLANK", None, None, None), ("f", 1, 0, 2, "FORMULA_NUMERIC", None, 0.5, None), ("f", 1, 0, 3, "STRING", "a|b", None, None),
        ("g", 0, 0, 0, "BOOLEAN", None, None, None),
    ]
    cells = spark.createDataFrame(rows, schema)
    lines = [r.line for r in sheets.convert_sheets(cells, "|", "dd/MM/yyyy").orderBy("file", "sheet", "row").collect()]
    assert lines == ['05/11/1999|17.25|lock;gate|"low|high|slack"|kelp', "||0.5|a|b"]
    assert {r.file: r.code for r in sheets.sheet_status(cells).collect()} == {"f": "227002", "g": "327002"}


def test_statistics(spark):
    t0 = datetime(2024, 1, 1)
    rows = [("/d/", "f", "READ", 1, t0)] * 9 + [("/d/", "slow", "READ", 100, t0), ("/d", "f", "STAT", -1, t0), ("/d", "f", "LISTING", 20_000, t0)]
    df = spark.createDataFrame(rows, "directory string, filename string, operation string, duration_ms int, created_at timestamp")
    s = {r.operation: r for r in stats.operation_stats(df).collect()}
    assert (s["READ"].n, s["READ"].min_ms, s["READ"].max_ms) == (10, 1, 100)
    assert s["READ"].mean_ms == pytest.approx(10.9) and s["READ"].std_ms == pytest.approx(29.7)
    assert tuple(s["STAT"])[1:] == (0, 0, 0, 0.0, 0.0)
    assert [tuple(r) for r in stats.operation_outliers(df).collect()] == [("READ", "/d/slow", 100)]
    assert [r.operation for r in stats.slow_operations(df, limit_ms=99).collect()] == ["READ"]
    kept = stats.retain(df, F.lit("2024-01-01 00:15:00").cast("timestamp"), max_entries=2)
    assert {(r.directory, r.filename) for r in kept.collect()} == {("/d", "f"), ("/d/", "f")}
    assert stats.retain(df, F.lit("2024-01-01 00:15:01").cast("timestamp")).count() == 0


def test_encryption(spark):
    df = spark.createDataFrame([(b"Hello World!", "p"), (b"x", ""), (b"y", None)], "content binary, key string")
    for armor in (False, True):
        out = crypt.decrypt_content(crypt.encrypt_content(df, "content", "key", armor=armor), "encrypted", "key", armor=armor)
        got = [(r.decrypted and bytes(r.decrypted), r.encrypted_code) for r in out.collect()]
        assert got == [(b"Hello World!", None), (None, "323015"), (None, "323014")]
    wrong = crypt.encrypt_content(df.limit(1), "content", "key").withColumn("key", F.lit("other"))
    assert crypt.decrypt_content(wrong, "encrypted", "key").first().decrypted is None
    assert crypt.normalise_passphrase("é") == "é"


def test_dates(spark):
    df = spark.createDataFrame([("20191332",), ("20191101xyz",), ("2019110",), ("20191101",), ("x",), (None,)], "t string")
    got = [r[0] and r[0].strftime("%Y%m%d") for r in df.select(dates.parse_lenient(F.col("t"), "yyyyMMdd")).collect()]
    assert got == ["20200201", "20191101", "20191031", "20191101", None, None]
    strict = [r[0] is not None for r in df.select(dates.parse_strict(F.col("t"), "yyyyMMdd")).collect()]
    assert strict == [False, False, False, True, False, False]
    assert dates.to_spark_pattern("[dd-MMM-yy],[HH:mm:ss]") == "'['dd-MMM-yy']','['HH:mm:ss']'"
    for bad in ("YYYY", "jj", "'open"):
        with pytest.raises(dates.PatternError):
            dates.to_spark_pattern(bad)


def test_lenient_dates_over_a_change_of_clocks(spark):
    spark.conf.set("spark.sql.session.timeZone", "Europe/Berlin")
    try:
        df = spark.createDataFrame([("20240331120000",), ("20241027120000",), ("20240330360000",)], "t string")
        got = [r[0] for r in df.select(F.date_format(dates.parse_lenient(F.col("t"), "yyyyMMddHHmmss"), "yyyyMMddHHmmss")).collect()]
        assert got == ["20240331120000", "20241027120000", "20240331120000"]
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_schema_text():
    s = schema_from_avro_json(avro("a:long", "b:string?", "c:long@yyyyMMdd#date"))
    st = s.to_struct()
    assert [f.nullable for f in st] == [False, True, False]
    assert st["c"].metadata == {"doc": "yyyyMMdd", "logicalType": "date"}
    with pytest.raises(SchemaMissing):
        schema_from_avro_json(" ")
    for bad in ("{", "[]", '{"type":"record","fields":[{"name":"a","type":"bytes"}]}', '{"type":"record","fields":[{"name":"a","type":{"type":"array","items":"int"}}]}'):
        with pytest.raises(SchemaUnparsable):
            schema_from_avro_json(bad)


def test_metadata_names_in_any_case(spark):
    schema = schema_from_avro_json(avro("FILE_NAME:string", "Record_Count:long", "other:string", "data_end_date:string@dd/MM/yyyy"))
    df = spark.createDataFrame([("f", "12", "x", "31/12/2020")], schema.names)
    m = metadata.extract_metadata(df, schema).first().metadata
    assert (m.file_name, m.record_count, m.data_end_date, m.file_size) == ("f", 12, "20201231000000", None)


def test_reconcile(spark):
    claims = spark.createDataFrame([("a", "2", "footer"), ("b", "0", "footer"), ("c", "x", "footer"), ("d", None, "footer"), ("e", "9", "NONE")], "file_key string, claimed_text string, location string")
    counts = reconcile.actual_counts(spark.createDataFrame([("a",), ("a",)], "file_key string"), 0, 0)
    got = {r.file_key: (r.actual_count, r.status) for r in reconcile.reconcile(claims, counts).collect()}
    assert got == {"a": (2, "matched"), "b": (0, "matched"), "c": (0, "unparsed"), "d": (0, "not_found"), "e": (0, "skipped")}


def test_audit_levels(spark, folder):
    df = spark.createDataFrame([("1", "u", "f")], "conf_id string, file_uuid string, file_name string")
    events = audit.audit_event(df, "125202", "start").unionByName(audit.audit_event(df, "325205", "bad"))
    assert events.columns == audit.COLUMNS
    for _ in range(2):  # a repeated batch leaves one copy
        audit.write_audit(events, f"{folder}/audit", "INFO", batch_id=4)
    assert [r.log_type_id for r in spark.read.parquet(f"{folder}/audit").collect()] == ["325205"]


def test_conf_from_parquet(spark, folder):
    spark.createDataFrame([("p", "/a"), ("q", "/b")], "project string, directory string").write.parquet(f"{folder}/conf")
    df = cn.read_conf(spark, f"{folder}/conf", "p", ["directory"])
    assert [tuple(r) for r in df.collect()] == [("/a",)]
    assert "PushedFilters: [IsNotNull(project), EqualTo(project,p)]" in df._jdf.queryExecution().toString()
