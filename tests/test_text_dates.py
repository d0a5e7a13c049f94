"""Roll-over in dates with names, 12-hour clocks and zones."""

from pyspark.sql import functions as F

from feedcheck.functions import dates

CASES = [
    ("dd-MMM-yy", "32-JAN-20", "2020-02-01 00:00:00"), ("dd-MMM-yy", "1-february-21 and more", "2021-02-01 00:00:00"),
    ("dd-MMM-yy", "31-XXX-20", None), ("dd-MMM-yy", "00-Mar-24", "2024-02-29 00:00:00"), ("ddMMMyyyy", "05Sep2023", "2023-09-05 00:00:00"),
    ("MMMM d, yyyy", "may 40, 2023", "2023-06-09 00:00:00"), ("EEE dd MMM yyyy", "mon 31 Apr 2023", "2023-05-01 00:00:00"), ("EEE dd MMM yyyy", "day 1 Apr 2023", None),
    ("yyyy-MM-dd hh:mm a", "2024-01-31 12:30 AM", "2024-01-31 00:30:00"), ("yyyy-MM-dd hh:mm a", "2024-01-31 12:30 pm", "2024-01-31 12:30:00"),
    ("yyyy-MM-dd hh:mm a", "2024-01-31 13:00 pm", "2024-02-01 01:00:00"), ("yyyy-MM-dd hh:mm", "2024-01-31 12:30", "2024-01-31 00:30:00"),
    ("yyyy-MM-dd KK a", "2024-01-31 11 pm", "2024-01-31 23:00:00"), ("yyyy-MM-dd kk", "2024-01-31 24", "2024-01-31 00:00:00"),
    ("yyyy-MM-dd HH z", "2024-01-31 23 GMT-1:00", "2024-02-01 00:00:00"), ("yyyy-MM-dd HH z", "2024-01-31 23 UTC", "2024-01-31 23:00:00"),
    ("yyyy-MM-dd HH Z", "2024-01-31 23 +0130", "2024-01-31 21:30:00"), ("yyyy-MM-dd HH Z", "2024-01-31 23 +2500", None), ("yyyy-MM-dd HHX", "2024-01-31 23-02", "2024-02-01 01:00:00"),
    ("yyyy-MM-dd HHXXX", "2024-01-31 23Z", "2024-01-31 23:00:00"), ("yyyy-DDD", "2024-366", "2024-12-31 00:00:00"), ("yyyy-DDD", "2023-366", "2024-01-01 00:00:00"),
    ("yyyy-MM-dd", "2024-13-01", "2025-01-01 00:00:00"), ("yyyyMMdd", "20241332", "2025-02-01 00:00:00"), ("yyyy", "", None), ("yyyy", "x\x01", None),
]


def test_cases(spark):
    df = spark.createDataFrame([(i, t) for i, (_, t, _) in enumerate(CASES)] + [(len(CASES), None)], "i int, t string")
    for i, (pattern, text, want) in enumerate(CASES):
        row = df.filter(F.col("i") == i).select(F.date_format(dates.parse_lenient(F.col("t"), pattern), "yyyy-MM-dd HH:mm:ss").alias("x")).first()
        assert row.x == want, (pattern, text)
    assert df.filter("t is null").select(dates.parse_lenient(F.col("t"), "dd-MMM-yy")).first()[0] is None


def test_zones_count_in_the_session_zone_too(spark):
    spark.conf.set("spark.sql.session.timeZone", "Europe/Berlin")
    try:
        df = spark.createDataFrame([("2024-10-27 00:30 Z",), ("2024-10-27 01:30 Z",)], "t string")
        got = [r[0] for r in df.select(F.unix_millis(dates.parse_lenient(F.col("t"), "yyyy-MM-dd HH:mm X"))).collect()]
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert got[1] - got[0] == 3_600_000


def test_other_patterns_are_strict(spark):
    df = spark.createDataFrame([("32-01 32",)], "t string")
    for pattern in ("dd-MM dd", "G dd-MM-yyyy", "yyyy-MM-DDD"):
        assert df.select(dates.parse_lenient(F.col("t"), pattern)).first()[0] is None
