"""Inferred schemas against the same rule applied to each file's values in plain Python."""

import random
import re
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from feedcheck.functions.dates import parse_strict
from feedcheck.functions.dialect import dialect
from feedcheck.functions.schema import schema_from_avro_json
from feedcheck.functions.text import as_int, as_long
from feedcheck.operators.infer import infer_schema, schema_texts
from feedcheck.sources.lines import ordered_lines, scan_lines

FORM = dialect(sep="|")
PATTERNS = [("date", "yyyyMMdd"), ("date", "dd.MM.yyyy"), ("timestamp-millis", "yyyy-MM-dd HH:mm:ss")]
TEXTS = ["1", "-7", "+3", "007", "2147483648", "12345678901234567890", "2.5", ".5", "1e3", "1.", ".", "-", "NaN", "1d", "true", "False", "yes", "31.01.2024", "32.01.2024", "20240131", "2024-01-31 10:00:00", "x", "", " 4 ", "ü"]


def _date(text, form):
    try:
        return datetime.strptime(text, form).strftime(form) == text
    except ValueError:
        return False


def _fits(text):
    whole = re.fullmatch(r"[+-]?[0-9]+", text)
    yield "int", None, bool(whole) and -(1 << 31) <= int(text) < 1 << 31
    yield "long", None, bool(whole) and -(1 << 63) <= int(text) < 1 << 63
    yield "double", None, bool(re.fullmatch(r"[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?", text))
    yield "boolean", None, text.lower() in ("true", "false")
    yield "long", "yyyyMMdd", _date(text, "%Y%m%d")
    yield "long", "dd.MM.yyyy", _date(text, "%d.%m.%Y")
    yield "long", "yyyy-MM-dd HH:mm:ss", _date(text, "%Y-%m-%d %H:%M:%S")


def _expected(rows, column):
    values = [r[column].strip() for r in rows if column < len(r) and r[column].strip()]
    for picked in zip(*map(_fits, values)):
        if all(f for _, _, f in picked):
            return picked[0][:2], len(values)
    return ("string", None), len(values)


def _source(spark, files):
    lines = [(k, i, line) for k, rows in files.items() for i, line in enumerate(rows)]
    return ordered_lines(spark.createDataFrame(lines, "file_key string, i int, line string"), "file_key", "i", "line")


def test_kinds_against_plain_python(spark):
    draw = random.Random(7)
    groups = [["1", "-7", "+3", "007"], ["1", "2147483648"], ["1", "12345678901234567890", "2.5", ".5", "1e3", "1."], ["true", "False"], ["31.01.2024"], ["2024-01-31 10:00:00"], TEXTS]
    files = {}
    for k in range(25):
        width = draw.randint(1, 5)
        kinds = [draw.choice(groups) for _ in range(width)]
        files[f"f{k}"] = [[draw.choice(g) if draw.random() < 0.9 else draw.choice(["", draw.choice(TEXTS)]) for g in kinds][: draw.choice([width, width, width, draw.randint(1, width)])] for _ in range(draw.randint(0, 6))]
        files[f"f{k}"] = [r for r in files[f"f{k}"] if r != [""]]
    src = _source(spark, {k: ["|".join(f"c{i}" for i in range(5))] + ["|".join(r) for r in rows] for k, rows in files.items()})
    got = {(r.file_key, r.position): r for r in infer_schema(src, FORM, PATTERNS).collect()}
    assert len(got) == 25 * 5
    for (key, place), r in got.items():
        want, n = _expected(files[key], place)
        assert ((r.type, r.pattern), r.n_values) == (want, n), (key, place, files[key])
        assert r.field_name == f"c{place}" and r.nullable == (n < len(files[key]))
        assert r.logical == dict((p, name) for name, p in PATTERNS).get(r.pattern)


def test_texts_are_schemas(spark):
    src = _source(spark, {"a": ['k"1|k2|k3|k4', "1|31.01.2024||x|more", "2|01.02.2024|5|y"], "b": ["only"]})
    texts = {r.file_key: schema_from_avro_json(r.table_schema) for r in schema_texts(infer_schema(src, dialect(sep="|", quote=""), PATTERNS)).collect()}
    got = [(f.name, f.type, f.nullable, f.doc, f.logical) for f in texts["a"].fields]
    assert got == [('k"1', "int", False, None, None), ("k2", "long", False, "dd.MM.yyyy", "date"), ("k3", "int", True, None, None), ("k4", "string", False, None, None)]
    assert [(f.name, f.type) for f in texts["b"].fields] == [("only", "string")]


def test_surplus_malformed_and_dialects(spark):
    src = _source(spark, {"a": ["k|v", "1|2|3", '4|"open', "5|6"], "b": ["k;v", "1;'2;3'", "2;4"], "c": ["k", "1"]})
    files = spark.createDataFrame([("a", "|", '"'), ("b", ";", "'")], "file_key string, field_separator string, quote_char string")
    rows = {(r.file_key, r.position): (r.field_name, r.type, r.nullable, r.n_values) for r in infer_schema(src, dialect(), files=files).collect()}
    assert rows == {
        ("a", 0): ("k", "int", False, 2), ("a", 1): ("v", "int", False, 2), ("a", 2): (None, "int", True, 1),
        ("b", 0): ("k", "int", False, 2), ("b", 1): ("v", "string", False, 2),
    }


def test_scanned_splits_and_nothing(spark, folder):
    text = "k|v\n" + "".join(f"{i}|{i}.5\n" for i in range(20000))
    with open(f"{folder}/big.txt", "w") as out:
        out.write(text)
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "50000")
    try:
        rows = infer_schema(scan_lines(spark, folder, FORM), FORM).orderBy("position").collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert [(r.field_name, r.type, r.n_values, r.nullable) for r in rows] == [("k", "int", 20000, False), ("v", "double", 20000, False)]
    empty = _source(spark, {"a": ["k"]})
    assert infer_schema(type(empty)(empty.rows.limit(0), empty.chunks.limit(0), partitioned=True), FORM).count() == 0
    with pytest.raises(ValueError):
        infer_schema(empty, FORM, [("date", "yyyy")] * 41)


def test_values_are_looked_at_before_they_are_cast(spark):
    """A cast or a parse that fails throws, which costs many times a look; results are those of the bare cast."""
    texts = ["", "+", "-1", "+1", " 1", "1\x7f", "1.0", "2147483648", "-2147483648", "9223372036854775808", "0" * 30 + "5", "1" * 40, "\u0662", "word", "2020-01-02", "2020-1-2", "+12020-01-02", "-2020-01-02", "2020-13-02", "2020-01-02\n", None]
    d, s = spark.createDataFrame([(x,) for x in texts], "s string"), F.col("s")
    pairs = [(as_long(s, True), s.try_cast("bigint")), (as_int(s, True), s.try_cast("int")), *[(parse_strict(s, p).cast("string"), F.try_to_timestamp(s, F.lit(p)).cast("string")) for p in ("yyyy-MM-dd", "y-M-d")]]
    for one, bare in pairs:
        assert "RLIKE" in str(one).upper()
        assert d.filter(~one.eqNullSafe(bare)).count() == 0


def test_schemas_are_inferred_once(spark):
    """A validation reads the texts several times, so they are a written table."""
    src = ordered_lines(spark.createDataFrame([("f", 1, "k"), ("f", 2, "7")], "file_key string, n long, line string"), "file_key", "n", "line")
    texts = schema_texts(infer_schema(src, dialect(sep="|"), PATTERNS))
    assert texts.inputFiles() and "Window" not in texts._jdf.queryExecution().toString()
