"""Data files whose record count comes from an attribute."""

import pytest

from .feeds import D2, run_cases, settings, with_ids

CREW = ["dana|5|20150302|20210607081500", "mo|6|20180911|20210607101545", "ines|11|20190120|20210606235959", "raf|2|20200704|20210601000001"]
S = settings
CASES = {
    # name: (lines, settings, expected code, expected output)
    "ids": (D2, S(ids="1"), "225204", with_ids(D2)),
    "no_ids": (D2, S(), "225204", D2),
    "header": (["header", *D2], S(header=1), "225204", D2),
    "footer": ([*D2, "footer"], S(footer=1), "225204", D2),
    "both_ids": (["header", *D2, "footer"], S(header=1, footer=1, ids="1"), "225204", with_ids(D2)),
    "bad_type": (["31|20230405061500", "3b1|20230405061588"], S("ctrl2"), "325208", None),
    "bad_attributes": (D2, S(header="a", footer="b", claimed="c", location="nones"), "325205", None),
    "bad_location": (D2, S(location="invalid"), "325205", None),
    "bad_header_count": (D2, S(header="a"), "325205", None),
    "bad_footer_count": (D2, S(footer="a"), "325205", None),
    "negative_header_count": (D2, S(header="-1"), "325205", None),
    "claimed_text": (D2, S(claimed="2a"), "325205", None),
    "claimed_null": (D2, S(claimed=None), "325205", None),
    "location_null": (D2, S(location=None), "325218", None),
    "mismatch": (["3", *D2], S(header=1, claimed="3"), "325206", None),
    "wrong_feed": (["3", *D2], S("soundings", header=1), "325208", None),
    "mismatch_hides_errors": (["20|x", "2a5|y"], S("ctrl2", claimed="5"), "325206", None),
    "malformed": ([D2[0], '"open|1|2|3|4|5'], S(), "325209", None),
    "schema_missing": (D2, S(table_schema=None), "325210", None),
    "schema_bad": (D2, S(table_schema="{nope"), "325211", None),
    "target_missing": (D2, S(insert_table_schema=None), "325218", None),
    "dates": (CREW, S("crew", claimed="4"), "225204", None),
    "date_bad": ([*CREW[:3], "raf|2|2020-07-04|20210601000001"], S("crew", claimed="9"), "325224", None),
    "short_and_long": ([D2[0] + "|x|y", "only|1"], S(), "325208", None),
    "empty": ([], S(claimed="0"), "225204", None),
    "header_longer_than_file": (D2, S(header=3), "325206", None),
}


@pytest.fixture(scope="module")
def result(spark, tmp_path_factory):
    cases = {k: (v[0], v[1]) for k, v in CASES.items()}
    spark.conf.set("spark.sql.session.timeZone", "Asia/Kolkata")
    try:
        yield run_cases(spark, str(tmp_path_factory.mktemp("dv")), cases, "data")
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


@pytest.mark.parametrize("name", CASES)
def test_verdict(result, name):
    _, verdicts, out, failed = result
    lines, _, code, expected = CASES[name]
    assert verdicts[name].code == code
    if code == "225204":
        assert name not in failed
        if expected:
            assert out[name] == expected
    else:
        assert name not in out
        assert failed[name] == lines  # the original content goes to failure


def test_dates_become_epoch_millis(result):
    assert result[2]["dates"][0] == "dana|5|1425234600000|1623033900000"


def test_error_names(result):
    v = result[1]["short_and_long"]
    assert v.missing_fields == ["data_start_date", "date_of_file_generation", "file_size", "num_of_fields"]
    assert v.extra_fields == ["unknown_field_index_6", "unknown_field_index_7"]
    assert v.message == (
        "Records in this FlowFile were invalid for the following reasons: "
        "The following 4 fields were missing: [data_start_date, date_of_file_generation, file_size, num_of_fields]; "
        "The following 2 fields were present in the Record but not in the schema: [unknown_field_index_6, unknown_field_index_7]"
    )
    assert result[1]["bad_type"].message == (
        "Records in this FlowFile were invalid for the following reasons: "
        "; The following 1 fields had values whose type did not match the schema: [record_count]"
    )


def test_record_errors(result):
    rows = {(r.line_no, r.error_type, r.field) for r in result[0].record_errors().collect() if "bad_type" in r.file_key}
    assert rows == {(2, "INVALID_FIELD", "record_count")}


def test_audit(result):
    from collections import Counter

    run = result[0]
    kinds = Counter(r.log_type_id for r in run.audit().collect())
    assert kinds["125202"] == len(CASES)
    assert kinds["225204"] == sum(c[2] == "225204" for c in CASES.values())
    assert kinds["325205"] == sum(c[2] == "325205" for c in CASES.values())
    assert {r.log_type_id[0] for r in run.audit("ERROR").collect()} == {"3"}
