"""Data files that state their own record count."""

import pytest

from .feeds import D2, H_ALL, run_cases, settings, with_ids

S = settings
META = {"location": "header_metadata", "header": 1, "metadata_header_record": "1"}
BOTH = {"location": "header_metadata_and_footer", "header": 1, "footer": 1, "metadata_header_record": "1"}
H_SHORT = "tides.txt|2|07|512|20230204"
H_UNCOUNTED = "4|tides.txt|07|20230203|20230204|20230205|512"
READINGS = ["|".join(["meter 7"] + [f"{i}.5" for i in range(8)])] * 13
CASES = {
    "none_ids": (D2, S(ids="1"), "225304", with_ids(D2)),
    "none": (D2, S(), "225304", D2),
    "header": (["2", *D2], S(header=1, location="header"), "225304", D2),
    "header_footer": (["2", *D2, "footer"], S(header=1, footer=1, location="HEADER"), "225304", D2),
    "header_ids": (["2", *D2], S(header=1, ids="1", location="header"), "225304", with_ids(D2)),
    "header_footer_ids": (["2", *D2, "footer"], S(header=1, footer=1, ids="1", location="header"), "225304", with_ids(D2)),
    "footer": ([*D2, "2"], S(footer=1, location="footer"), "225304", D2),
    "footer_ids": ([*D2, "2"], S(footer=1, ids="1", location="footer"), "225304", with_ids(D2)),
    "filename": (D2, S(location="filename", file_name="2_tides.txt"), "225304", D2),
    "count_text_empty": (["a", *D2], S(header=1, location="header"), "325307", None),
    "filter_not_found": (["a", *D2], S(header=1, location="header", record_count_filter="[0-9]+"), "325327", None),
    "filter_broken": (["2", *D2], S(header=1, location="header", record_count_filter="(("), "325334", None),
    "filter_blank": (["2", *D2], S(header=1, location="header", record_count_filter=""), "325305", None),
    "no_header_lines": (D2, S(location="header"), "325333", None),
    "mismatch": (["3", *D2], S(header=1, location="header"), "325306", None),
    "bad_type": (["31|20230405061500", "3b1|20230405061588"], S("ctrl2"), "325308", None),
    "bad_attributes": (D2, S(header="a", footer="b", location="nones"), "325305", None),
    "bad_choice": (D2, S(file_uuid_or_id="name"), "325305", None),
    "choice_null": (D2, S(file_uuid_or_id=None), "325333", None),
    "meta_fewer": (["tides.txt|2|07|512|09/May/2023 17.45", *D2], S(ids="1", header_schema="head_short@", **META), "225304", with_ids(D2)),
    "meta_more": ([H_ALL, *D2], S(ids="1", header_schema="head_all", **META), "225304", with_ids(D2)),
    "meta_footer": ([H_SHORT, *D2, "2"], S(ids="1", header_schema="head_short", **BOTH), "225304", with_ids(D2)),
    "meta_footer_8": ([H_ALL, *D2, "2"], S(ids="1", header_schema="head_all", **BOTH), "225304", with_ids(D2)),
    "meta_no_count_footer": ([H_UNCOUNTED, *D2, "2"], S(ids="1", header_schema="head_uncounted", **BOTH), "225304", with_ids(D2)),
    "meta_extra": ([H_ALL + "|one too many", *D2], S(ids="1", header_schema="head_all", **META), "325326", None),
    "meta_short": (["4|tides.txt|2", *D2], S(ids="1", header_schema="head_all", **META), "325324", None),
    "meta_bad_number": ([H_ALL.replace("|512", "|51b"), *D2], S(ids="1", header_schema="head_all", **META), "325325", None),
    "meta_no_count": ([H_UNCOUNTED, *D2], S(ids="1", header_schema="head_uncounted", **META), "325328", None),
    "meta_differs": ([H_ALL.replace("|2|07", "|3|07"), *D2, "2"], S(ids="1", header_schema="head_all", **BOTH), "325329", None),
    "meta_not_found": (["x", *D2], S(ids="1", header_schema="head_all", **{**META, "metadata_header_record": "2"}), "325330", None),
    "meta_setting_word": (D2, S(metadata_header_record="header_metadata"), "325323", None),
    "meta_setting_text": (D2, S(metadata_header_record="one"), "325334", None),
    "meta_schema_missing": ([H_ALL, *D2], S(header_schema=None, **META), "325333", None),
    "meta_schema_bad": ([H_ALL, *D2], S(header_schema="{", **META), "325311", None),
    "meta_date_bad": (["tides.txt|2|07|512|x", *D2], S(header_schema="head_short@", **META), "325335", None),
    "meta_plain_dates": (
        ["buoy_amber.csv.gz|2|12|8800|20230302043015|20230301", *D2, "2"], S(ids="1", header_schema="manifest6", **BOTH), "225304", with_ids(D2),
    ),
    "meta_pattern_dates": (
        ["buoy_amber.csv.gz|2|12|8800|20230302043015|20230301", *D2, "2"], S(ids="1", header_schema="manifest6@", **BOTH), "225304", with_ids(D2),
    ),
    "file_id_choice": (
        [*D2, D2[0], "3"], S(write="manifest6+uuid", footer=1, ids="1", location="footer", file_uuid_or_id="file_id"), "225304",
        [f"|{i}|{x}|12345" for i, x in enumerate([*D2, D2[0]], 1)],
    ),
    "many_columns": (
        ["13|2023/06/05 11:20|readings.csv|04.06.2023|03.06.2023", "names", *READINGS, "13"],
        S("readings9", ids="1", header_schema="head_dated", **{**BOTH, "header": 2}), "225304", with_ids(READINGS),
    ),
    "malformed_before_meta": (['"open|1', H_ALL, *D2], S(header_schema="head_all", **{**META, "header": 2, "metadata_header_record": "2"}), "325309", None),
    "malformed_footer": ([*D2, '"2'], S(footer=1, location="footer"), "325309", None),
}


@pytest.fixture(scope="module")
def result(spark, tmp_path_factory):
    cases = {k: (v[0], v[1]) for k, v in CASES.items()}
    return run_cases(spark, str(tmp_path_factory.mktemp("do")), cases, "data_only")


@pytest.mark.parametrize("name", CASES)
def test_verdict(result, name):
    _, verdicts, out, failed = result
    lines, _, code, expected = CASES[name]
    assert verdicts[name].code == code, verdicts[name]
    if code == "225304":
        assert name not in failed
        assert out[name] == expected
    else:
        assert name not in out
        assert failed[name] == lines


def test_metadata_attributes(result):
    v = result[1]["meta_more"]
    assert (v.metadata_file_name, v.metadata_sequence_number, v.metadata_file_size) == ("tides.txt", "7", "512")
    assert (v.metadata_record_count, v.metadata_number_of_fields) == ("2", "4")
    assert (v.metadata_end_date, v.metadata_start_date, v.metadata_Date_of_file_generation) == ("20230204", "20230203", "20230205")
    v = result[1]["meta_footer"]
    assert (v.metadata_end_date, v.metadata_start_date, v.metadata_Date_of_file_generation) == ("20230204", "", "")
    assert result[1]["meta_fewer"].metadata_end_date == "20230509174500"
    assert result[1]["meta_pattern_dates"].metadata_start_date == "20230301000000"
    assert result[1]["none"].metadata_file_name == ""
    assert result[1]["mismatch"].metadata_file_name is None


def test_count_status(result):
    status = {k: v.count_status for k, v in result[1].items()}
    assert status["none"] == "skipped"
    assert status["header"] == "matched"
    assert status["mismatch"] == "mismatched"
    assert status["filter_not_found"] == "not_found"
    assert status["count_text_empty"] == "unparsed"
