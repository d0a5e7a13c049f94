"""Feeds derived from the given tables, with damage at known places.

Every event becomes one line of its day's file, every order one line of its month's
manifest. No row is left out; some lines are spoiled so that each check has work to do.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.dialect import dialect
from ..sources.lines import LineSource, ordered_lines

DIALECT = dialect(sep="|")
_LAST = 1 << 60


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    # Date text is read in the process time zone; the expected results are in UTC.
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def avro_schema(name: str, *fields: tuple) -> str:
    out = []
    for field_name, kind, *more in fields:
        nullable = kind.endswith("?")
        item = {"name": field_name, "type": ["null", kind[:-1]] if nullable else kind}
        for key, value in zip(("doc", "logicalType"), more):
            if value is not None:
                item[key] = value
        out.append(item)
    return json.dumps({"type": "record", "name": name, "fields": out})


_EVENT_FIELDS = [("event_id", "long"), ("user_id", "long"), ("event_type", "string"), ("cents", "long")]
EVENT_SCHEMA = avro_schema("event", *_EVENT_FIELDS, ("event_time", "long", "yyyyMMddHHmmss", "timestamp-millis"))
EVENT_TARGET = avro_schema(
    "target", ("file_uuid", "string"), ("record_id", "long"), ("event_type", "string"), ("event_id", "long"), ("channel", "string?")
)
EVENT_HEADER = avro_schema(
    "header", ("file_name", "string"), ("sequence_number", "long"), ("file_size", "long"), ("record_count", "long"),
    ("num_of_fields", "long"), ("data_start_date", "string", "dd/MM/yyyy"), ("note", "string"),
)
MANIFEST_SCHEMA = avro_schema(
    "manifest", ("file_name", "string"), ("SEQUENCE_NUMBER", "long"), ("record_count", "long"), ("customer", "string?"),
    ("data_start_date", "string", "dd-MMM-yyyy"), ("date_of_file_generation", "string"),
)


def _when(day: Column, remainder: int, modulus: int) -> Column:
    """Spoils one event in ``modulus`` on one day in five."""
    return (day % 5 == remainder) & (F.col("event_id") % modulus == 0)


def event_fields(spark: SparkSession, sf_dir: str, damage: bool = True) -> DataFrame:
    """``event_id, file_key, dom`` and the line's parts ``f1..f5, extra``."""
    ev = table(spark, sf_dir, "events").select("event_id", "ts", "user_id", "event_type", "value")
    dom = F.dayofmonth("ts")

    def spoiled(remainder, modulus):
        return _when(F.col("dom"), remainder, modulus) if damage else F.lit(False)

    # The time is printed once and cut into pieces.
    ev = ev.withColumns({"dom": dom, "printed": F.date_format("ts", "yyyyMMddHHmmss")})
    dom, printed = F.col("dom"), F.col("printed")
    month = F.when(spoiled(4, 79), F.lit("13")).otherwise(F.substring(printed, 5, 2))
    stamp = F.concat(F.substring(printed, 1, 4), month, F.substring(printed, 7, 8))
    return ev.select(
        "event_id",
        F.concat(F.lit("events_"), F.substring(printed, 1, 8), F.lit(".unl")).alias("file_key"),
        dom,
        F.concat(F.col("user_id").cast("string"), F.when(spoiled(1, 97), F.lit("a")).otherwise(F.lit(""))).alias("f2"),
        F.col("event_type").alias("f3"),
        F.round(F.col("value") * 100).cast("bigint").cast("string").alias("f4"),
        F.when(~spoiled(2, 89), stamp).alias("f5"),
        F.when(spoiled(3, 83), F.lit("x")).alias("extra"),
    )


def event_data_lines(spark: SparkSession, sf_dir: str, damage: bool = True) -> DataFrame:
    f = event_fields(spark, sf_dir, damage)
    line = F.concat_ws("|", F.col("event_id").cast("string"), "f2", "f3", "f4", "f5", "extra")
    return f.select("file_key", "dom", F.col("event_id").alias("ord"), line.alias("line"))


def _bookends(data: DataFrame, header: Column | None, footer: Column | None) -> DataFrame:
    """One header and one footer line per file; ``claim`` is the line count, one too high
    on every seventh day."""
    per_file = data.groupBy("file_key", "dom").agg(F.count(F.lit(1)).alias("n"))
    per_file = per_file.withColumn("claim", F.col("n") + F.when(F.col("dom") % 7 == 0, 1).otherwise(0))
    out = data.select("file_key", "ord", "line")
    for place, text in ((-1, header), (_LAST, footer)):
        if text is not None:
            out = out.unionByName(per_file.select("file_key", F.lit(place).cast("bigint").alias("ord"), text.alias("line")))
    return out


def event_feed(spark: SparkSession, sf_dir: str, damage: bool = True) -> LineSource:
    """Daily files with a header ``HDR|<n>`` and a footer ``<n>``."""
    claim = F.col("claim").cast("string")
    lines = _bookends(event_data_lines(spark, sf_dir, damage), F.concat(F.lit("HDR|"), claim), claim)
    return ordered_lines(lines, "file_key", "ord", "line", blanks=False)


def event_metadata_feed(spark: SparkSession, sf_dir: str) -> LineSource:
    """Daily files with a metadata line first: one value too many on the 11th day of
    ten, a bad number on the 3rd, one too few on the 5th; and a footer ``<n>``."""
    claim = F.col("claim").cast("string")
    last_digit = F.col("dom") % 10
    size = F.when(last_digit == 3, F.lit("12k")).otherwise((F.col("n") * 10).cast("string"))
    note = F.when(last_digit == 5, F.lit(None).cast("string")).otherwise(F.lit("daily"))
    more = F.when(last_digit == 1, F.lit("more"))
    meta_claim = F.when(F.col("dom") % 9 == 0, F.col("claim") + 5).otherwise(F.col("claim")).cast("string")
    date = F.regexp_replace("file_key", "\\Aevents_(....)(..)(..).unl\\z", "$3/$2/$1")
    header = F.concat_ws("|", "file_key", F.col("dom").cast("string"), size, meta_claim, F.lit("5"), date, note, more)
    lines = _bookends(event_data_lines(spark, sf_dir, damage=False), header, claim)
    return ordered_lines(lines, "file_key", "ord", "line", blanks=False)


def event_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per daily file, with its name and ids."""
    days = table(spark, sf_dir, "events").select(F.date_format("ts", "yyyyMMdd").alias("d")).distinct()
    name = F.concat(F.lit("events_"), F.col("d"), F.lit(".unl"))
    return days.select(
        name.alias("file_key"), name.alias("file_name"), F.concat(F.lit("node-"), F.col("d")).alias("file_uuid"), F.col("d").alias("file_id"),
        (F.substring("d", 7, 2).cast("int") % 3).cast("string").alias("conf_id"),
    )


def event_settings(**more) -> dict:
    out = {
        "header_record_count": "1", "footer_record_count": "1", "record_count_location": "footer", "record_count_filter": "(\\d*)",
        "add_file_and_record_id": "1", "file_uuid_or_id": "file_id", "field_separator": "|",
        "table_schema": EVENT_SCHEMA, "insert_table_schema": EVENT_TARGET,
    }
    out.update(more)
    return out


def manifest_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every order as a manifest record of its month: ``file_key, ord, line``."""
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    key = F.col("o_orderkey").cast("string")
    line = F.concat_ws(
        "|", F.concat(F.lit("order_"), key, F.lit(".unl.gz")), key, (F.col("o_orderkey") % 7 + 1).cast("string"),
        F.col("o_custkey").cast("string"), F.date_format("o_orderdate", "dd-MMM-yyyy"), F.date_format("o_orderdate", "yyyyMMdd"),
    )
    file_key = F.concat(F.lit("orders_"), F.date_format("o_orderdate", "yyyyMM"), F.lit(".ctrl"))
    return o.select(file_key.alias("file_key"), F.month("o_orderdate").alias("month"), F.col("o_orderkey").alias("ord"), line.alias("line"))


def manifest_feed(spark: SparkSession, sf_dir: str) -> LineSource:
    """Monthly manifests with a header ``<n>``, one too high in May."""
    data = manifest_lines(spark, sf_dir)
    n = data.groupBy("file_key", "month").agg(F.count(F.lit(1)).alias("n"))
    claim = (F.col("n") + F.when(F.col("month") == 5, 1).otherwise(0)).cast("string")
    head = n.select("file_key", F.lit(-1).cast("bigint").alias("ord"), claim.alias("line"))
    return ordered_lines(data.select("file_key", "ord", "line").unionByName(head), "file_key", "ord", "line", blanks=False)


def manifest_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    months = table(spark, sf_dir, "orders").select(F.date_format("o_orderdate", "yyyyMM").alias("m")).distinct()
    name = F.concat(F.lit("orders_"), F.col("m"), F.lit(".ctrl"))
    return months.select(name.alias("file_key"), name.alias("file_name"), F.col("m").alias("file_uuid"), F.lit("7").alias("conf_id"))


# Feeds of the listing queries: a page is a landed file, its host the directory.
# Expressions by the last letter before the host's first dot.
PAGE_REGEXES = {
    "e": ["[0-9]+\\?utm_source=feed", ".*\\.html"],
    "n": ["[0-9]+", "[0-9]+/", ".*#top"],
    "g": [".*\\?page=[0-9]&ref=x"],
    "s": ["(.*)"],
}


def page_listing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages as a listing: directory (host), language folder, name, size and time."""
    p = table(spark, sf_dir, "pages")
    host = F.regexp_extract("url", "\\A[a-z]+://([^/]+)", 1)
    rest = F.regexp_extract("url", "\\A[a-z]+://[^/]+/(.*)\\z", 1)
    return p.select(
        "page_id",
        host.alias("directory"),
        F.lit("h1").alias("localhost"),
        F.substring_index(rest, "/", 1).alias("relative"),
        F.regexp_replace(rest, "\\A[^/]*/", "").alias("file_name"),
        F.length("html").cast("bigint").alias("size"),
        (F.lit(1_700_000_000_000) + F.col("page_id") * 60_000).alias("modified_ms"),
    ).withColumn("modified", F.timestamp_millis("modified_ms"))


def page_conf(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Configuration rows of the page hosts, derived from the pages."""
    rules = F.create_map(*[x for k, v in PAGE_REGEXES.items() for x in (F.lit(k), F.array(*[F.lit(r) for r in v]))])
    d = page_listing(spark, sf_dir).select("directory").distinct()
    letter = F.right(F.substring_index("directory", ".", 1), F.lit(1))
    d = d.withColumn("regexes", F.coalesce(rules[letter], F.array(F.lit(None).cast("string"))))
    return d.select("directory", F.posexplode("regexes").alias("i", "file_regex")).select(
        "directory",
        F.lit("h1, h2").alias("hostname"),
        F.lit("22").alias("port"),
        "file_regex",
        F.concat(F.lit("user"), F.col("i").cast("string")).alias("username"),
        F.when(F.col("i") == 1, F.lit("/keys/b")).alias("private_key_path"),
        F.concat(F.lit("/quarantine/"), F.col("directory")).alias("quarantine_directory"),
        F.concat(F.lit("ops@x.org,team"), F.col("i").cast("string"), F.lit("@x.org")).alias("support_email_list"),
        F.when(F.length("directory") % 2 == 0, F.lit("even")).otherwise(F.lit("odd")).alias("project"),
    )


def event_timings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as timed operations of a user's files."""
    ev = table(spark, sf_dir, "events")
    return ev.select(
        F.concat(F.lit("/data/u"), F.col("user_id").cast("string")).alias("directory"),
        F.concat(F.lit("f"), (F.col("event_id") % 10).cast("string")).alias("filename"),
        F.upper("event_type").alias("operation"),
        F.round(F.col("value") * 10).cast("int").alias("duration_ms"),
        F.col("ts").cast("timestamp").alias("created_at"),
        "event_id",
    )


UNTYPED_PATTERNS = [("date", "yyyy-MM-dd"), ("date", "dd/MM/yyyy")]


def untyped_order_feed(spark: SparkSession, sf_dir: str) -> LineSource:
    """Orders as one file per month that names its columns but not their types. The month decides whether keys pass
    32 bits, prices have decimals or a word among them, dates follow one pattern or two, and notes are missing."""
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate", "o_orderpriority")
    key, m = F.col("o_orderkey"), F.year("o_orderdate") * 12 + F.month("o_orderdate")
    number = (key + F.when(m % 4 == 0, F.lit(3_000_000_000)).otherwise(F.lit(0))).cast("string")
    price = F.concat(key.cast("string"), F.when(m % 3 == 0, F.lit("")).otherwise(F.lit(".25")))
    price = F.when((m % 6 == 1) & (key % 7 == 0), F.lit("none")).otherwise(price)
    iso, plain = F.date_format("o_orderdate", "yyyy-MM-dd"), F.date_format("o_orderdate", "dd/MM/yyyy")
    day = F.when((m % 2 == 0) != ((m % 7 == 0) & (key % 3 == 0)), iso).otherwise(plain)
    mark = F.when((m % 5 == 0) & (key % 4 == 0), F.lit("yes")).when(key % 2 == 0, F.lit("true")).otherwise(F.lit("FALSE"))
    note = F.when((m % 3 == 1) | (m % 3 == 2) & (key % 5 == 0), F.lit("")).otherwise(F.col("o_orderpriority"))
    file_key = F.concat(F.lit("orders_"), F.date_format("o_orderdate", "yyyyMM"))
    lines = o.select(file_key.alias("file_key"), key.cast("bigint").alias("ord"), F.concat_ws("|", number, price, day, mark, note).alias("line"))
    names = lines.select("file_key").distinct().select("file_key", F.lit(-1).cast("bigint").alias("ord"), F.lit("key|price|day|mark|note").alias("line"))
    return ordered_lines(lines.unionByName(names), "file_key", "ord", "line", blanks=False)
