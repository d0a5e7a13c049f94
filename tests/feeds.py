"""Schemas, content blocks and a runner for whole-file cases."""

import json
import os

from feedcheck.functions.dialect import dialect
from feedcheck.plans.validation import validate_files
from feedcheck.sources.lines import scan_lines
from pyspark.sql import functions as F


def avro(*fields):
    """Fields as ``name:type[?][@pattern][#logical]``."""
    out = []
    for f in fields:
        f, _, logical = f.partition("#")
        f, at, doc = f.partition("@")
        name, _, kind = f.partition(":")
        item = {"name": name, "type": ["null", kind[:-1]] if kind.endswith("?") else kind}
        if at:
            item["doc"] = doc
        if logical:
            item["logicalType"] = logical
        out.append(item)
    return json.dumps({"type": "record", "name": "r", "fields": out})


_M6 = ["file_name:string", "record_count:long", "num_of_fields:long", "file_size:long", "date_of_file_generation:string", "data_start_date:string"]
_IDS = ["file_id:string", "record_id:long"]
SCHEMAS = {
    "manifest6": avro(*_M6),
    "manifest6+ids": avro(*_IDS, *_M6),
    "manifest6+uuid": avro("file_uuid:string", "record_id:long", *_M6),
    "manifest6@": avro(*_M6[:4], "date_of_file_generation:string@yyyyMMddHHmmss", "data_start_date:string@yyyyMMdd"),
    "manifest6@empty": avro(*_M6[:4], "date_of_file_generation:string@", "data_start_date:string@"),
    "ctrl2": avro("record_count:long", "date_of_file_generation:string"),
    "crew": avro("sailor:string", "berth:int", "signed_on:long@yyyyMMdd#date", "last_watch:long@yyyyMMddHHmmss#timestamp-millis"),
    "soundings": avro("station:long", "depth_cm:long", "remark:string?"),
    "readings9": avro("meter:string", *[f"reading_{i}:string?" for i in range(8)]),
    "readings9+ids": avro(*_IDS, "meter:string", *[f"reading_{i}:string?" for i in range(8)]),
    # Metadata lines: all fields, without a count, and short ones.
    "head_all": avro(
        "num_of_fields:long", "file_name:string", "record_count:long", "sequence_number:long",
        "data_start_date:string", "data_end_date:string", "date_of_file_generation:string", "file_size:long",
    ),
    "head_uncounted": avro(
        "num_of_fields:long", "file_name:string", "sequence_number:long",
        "data_start_date:string", "data_end_date:string", "date_of_file_generation:string", "file_size:long",
    ),
    "head_short": avro("file_name:string", "record_count:long", "sequence_number:long", "file_size:long", "data_end_date:string"),
    "head_short@": avro("file_name:string", "record_count:long", "sequence_number:long", "file_size:long", "data_end_date:string@dd/MMM/yyyy HH.mm"),
    "head_dated": avro(
        "record_count:long", "date_of_file_generation:string@yyyy/MM/dd HH:mm", "file_name:string",
        "data_end_date:string@dd.MM.yyyy", "data_start_date:string@dd.MM.yyyy",
    ),
}

# Invented feeds: tide tables and buoy logs.
D2 = ["tides_north_0405.csv.gz|31|9|1480|20230405061500|20230404", "tides_south_0405.csv.gz|33|9|1512|20230405061530|20230404"]
M3 = [f"buoy_{name}.csv.gz|{n}|12|{n * 46}|2023030{n % 7 + 1}043015|20230228" for name, n in (("amber", 88), ("birch", 103), ("coral", 251))]
H_ALL = "4|tides.txt|2|07|20230203|20230204|20230205|512"


def with_ids(lines, file_id="123"):
    return [f"{file_id}|{i}|{x}" for i, x in enumerate(lines, 1)]


def settings(read="manifest6", write=None, header=0, footer=0, ids="0", location="none", claimed="2", **more):
    """Settings of one file; any of them can be replaced by ``more``."""
    out = {
        "file_uuid": "123", "file_id": "12345", "conf_id": "1", "file_name": "tides.txt",
        "header_record_count": str(header), "footer_record_count": str(footer),
        "record_count_location": location, "record_count_filter": "(\\d*)",
        "add_file_and_record_id": ids, "file_uuid_or_id": "file_uuid", "field_separator": "|",
        "metadata_record_count": claimed, "metadata_header_record": None, "datafile_extension": ".csv.gz",
        "table_schema": SCHEMAS.get(read, read),
        "insert_table_schema": SCHEMAS.get(write or (read + "+ids" if ids == "1" else read), write),
        "header_schema": None,
    }
    if "header_schema" in more:
        more["header_schema"] = SCHEMAS.get(more["header_schema"], more["header_schema"])
    out.update(more)
    return out


def run_cases(spark, folder, cases, profile, **options):
    """Validate all cases in one run; returns verdict rows and output lines by case name."""
    data = f"{folder}/in"
    os.makedirs(data)
    names = list(next(iter(cases.values()))[1])
    rows = []
    for name, (lines, s) in cases.items():
        with open(f"{data}/{name}.txt", "w", newline="") as f:
            f.write("\n".join(lines))
        rows.append((f"file:{data}/{name}.txt", *[s[n] for n in names]))
    files = spark.createDataFrame(rows, "file_key string, " + ", ".join(f"{n} string" for n in names))
    d = options.pop("dialect", dialect(sep="|"))
    src = scan_lines(spark, data, d)
    run = validate_files(src, files, profile, dialect=d, **options)

    def case(key):
        return key.rsplit("/", 1)[1][:-4]

    verdicts = {case(r.file_key): r for r in run.decided.collect()}
    assert set(verdicts) == set(cases)
    out = {}
    for r in run.success_lines().orderBy("file_key", "record_id").collect():
        out.setdefault(case(r.file_key), []).append(r.line)
    failed = {}
    for r in run.original_lines("failure").orderBy("file_key", "line_no").collect():
        failed.setdefault(case(r.file_key), []).append(r.line)
    return run, verdicts, out, failed


def session_zone(spark, zone):
    spark.conf.set("spark.sql.session.timeZone", zone)
    return F.lit(zone)
