"""Audit rows of single records."""

from feedcheck.functions.dialect import dialect
from feedcheck.plans.feeds import avro_schema, event_settings
from feedcheck.plans.validation import validate_files
from feedcheck.sources.lines import ordered_lines

SCHEMA = avro_schema("r", ("FILE_name", "string"), ("record_count", "long"), ("owner", "string?"))


def _run(spark, rows, profile, **more):
    lines = spark.createDataFrame([(k, i, t) for k, texts in rows.items() for i, t in enumerate(texts)], "file_key string, i int, line string")
    files = spark.createDataFrame([(k, "c", "u-" + k, k) for k in rows], "file_key string, conf_id string, file_uuid string, file_name string")
    plain = {"header_record_count": "0", "footer_record_count": "0", "record_count_location": "none", "add_file_and_record_id": "0"}
    plain |= {"table_schema": SCHEMA, "insert_table_schema": SCHEMA, "datafile_extension": ".dat"} | more
    run = validate_files(ordered_lines(lines, "file_key", "i", "line", blanks=False), files, profile, settings=event_settings(**plain), dialect=dialect(sep="|"))
    return run


def _rows(df):
    return sorted((r.file_name, r.log_type_id, r.log_message) for r in df.collect())


def test_invalid_and_unknown(spark):
    texts = {"a": ["f1|1|me", "f2|x|", "|y|z|more"], "b": ["f3|2|", 'f4|"open|me']}
    run = _run(spark, texts, "manifest")
    want = [
        ("a", "125000", "record 1: field owner is not known, its value is me"),
        ("a", "325108", "record 2 is invalid: INVALID_FIELD record_count"),
        ("a", "325108", "record 3 is invalid: MISSING_FIELD FILE_name; INVALID_FIELD record_count; EXTRA_FIELD unknown_field_index_3"),
        ("b", "125000", "record 1: field owner is not known, its value is "),
    ]
    assert _rows(run.record_audit()) == want
    every = _rows(run.audit(records=True))
    assert [r for r in every if r in want] == want and len(every) == len(want) + len(_rows(run.audit()))
    assert {r[1] for r in _rows(run.audit("ERROR", records=True))} >= {"325108"}
    assert not [r for r in _rows(run.audit("INFO", records=True)) if r[1].startswith("1")]


def test_profiles_and_unread_files(spark):
    for profile, code in (("data", "325213"), ("data_only", "325313")):
        run = _run(spark, {"a": ["f1|1|me", "f2|x|"]}, profile, metadata_record_count="2")
        assert _rows(run.record_audit()) == [("a", code, "record 2 is invalid: INVALID_FIELD record_count")]
        assert _rows(_run(spark, {"a": ["f2|x|"]}, profile, table_schema="{", metadata_record_count="1").record_audit()) == []

