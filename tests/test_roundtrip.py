"""Random values survive being rendered and split, in every dialect that can hold them."""

import random

import pytest
from feedcheck.functions.delimited import field_at, render_line, split_line
from feedcheck.functions.dialect import dialect
from pyspark.sql import functions as F

ALPHABET = ["a", "é", "|", ",", "\t", '"', "\\", "n", " ", "\n", "\r", "", "\U0001f600", '""', '\\"', "\\\\", "|\\"]
DIALECTS = {
    "minimal": dialect(sep="|", trim=False),
    "all": dialect(sep="|", trim=False, quote_mode="ALL"),
    "none": dialect(sep="|", trim=False, quote_mode="NONE"),
    "rfc": dialect("rfc-4180"),
    "rfc_all": dialect("rfc-4180", quote_mode="ALL"),
    "comma": dialect(sep=",", trim=False, quote_mode="NON_NUMERIC"),
    "trailing": dialect(sep="|", trim=False, quote_mode="ALL", trailing_delimiter=True),
}


@pytest.mark.parametrize("name", DIALECTS)
def test_roundtrip(spark, name):
    d = DIALECTS[name]
    rng = random.Random(7)
    rows = [tuple("".join(rng.choice(ALPHABET) for _ in range(rng.randint(0, 12))) for _ in range(3)) for _ in range(1500)]
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "i int, a string, b string, c string")
    lines = df.select("*", render_line([F.col("a"), F.col("b"), F.col("c")], d).alias("line"))
    back = lines.withColumn("f", split_line(F.col("line"), d))
    fields = [field_at(F.col("f"), k, d) for k in range(3)]
    got = back.select("i", F.size("f").alias("n"), "line", *[c.alias(f"x{k}") for k, c in enumerate(fields)]).orderBy("i").collect()
    for r, want in zip(got, rows):
        assert (r.x0, r.x1, r.x2) == want, repr(r.line)
        assert r.n == (4 if d.trailing_delimiter else 3)
