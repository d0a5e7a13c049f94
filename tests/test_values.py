"""Number fields: what counts as a number, and that none loses digits."""

from feedcheck.functions.schema import FeedField
from feedcheck.operators.validate import _typed
from pyspark.sql import functions as F
import inspect


def typed(spark, kind, values, strict):
    names = list(inspect.signature(FeedField).parameters)
    made = {n: p.default for n, p in inspect.signature(FeedField).parameters.items()}
    made = {n: (None if v is inspect.Parameter.empty else v) for n, v in made.items()} | {"name": "x", "type": kind}
    field = FeedField(*[made[n] for n in names])
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v string")
    return [r.t for r in df.select("i", _typed(F.col("v"), field, strict, False).alias("t")).orderBy("i").collect()]


def test_doubles(spark):
    values = ["1", "-1.5", ".5", "5.", "1e3", "+2E-1", "1d", "1f", "0x1p3", "NaN", "Infinity", "", "x", None]
    want = [1.0, -1.5, 0.5, 5.0, 1000.0, 0.2] + [None] * 8
    assert typed(spark, "double", values, True) == want == typed(spark, "double", values, False)


def test_whole_numbers_keep_their_digits(spark):
    values = ["9007199254740993.0", "9007199254740993", "12.9", "-12.9", "1d", "99999999999999999999"]
    assert typed(spark, "long", values, False) == [9007199254740993, 9007199254740993, 12, -12, None, None]
    assert typed(spark, "long", values, True)[:3] == [None, 9007199254740993, None]
