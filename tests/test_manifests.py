"""Manifests and the rows they expand to."""

import pytest

from .feeds import D2, M3, run_cases, settings

S = settings
TWO = ["31|20230405061500", "33|20230405061588"]
CASES = {
    "plain": (TWO, S("ctrl2"), "225104", 2),
    "header_footer": (["3", *TWO, "35|20230405061599", "footer"], S("ctrl2", header=1, footer=1, location="header", datafile_extension=".csv", file_name="tides.ctrl"), "225104", 3),
    "verf": (["2", *D2], S(header=1, location="header"), "225104", 2),
    "ctrl": (["2", *TWO], S("ctrl2", header=1, location="header", datafile_extension=".csv", file_name="tides.ctrl"), "225104", 2),
    "footer": ([*D2, "2"], S(footer=1, location="footer"), "225104", 2),
    "filename": (D2, S(location="filename", file_name="2_tides.txt"), "225104", 2),
    "none": (["h", *D2, "f"], S(header=1, footer=1), "225104", 2),
    "extension": (D2, S(datafile_extension=".csv.gz.pgp"), "225104", 2),
    "three_plain": ([*M3, "3"], S(footer=1, location="footer"), "225104", 3),
    "three_dated": ([*M3, "3"], S("manifest6@", footer=1, location="footer"), "225104", 3),
    "three_empty_pattern": ([*M3, "3"], S("manifest6@empty", footer=1, location="footer"), "225104", 3),
    "bad_value": (["20|x", "2a5|y"], S("ctrl2"), "325113", 0),
    "bad_attributes": (D2, S(header="a", footer="b", location="nones"), "325105", 0),
    "bad_location": (D2, S(location="header_metadata"), "325105", 0),
    "count_text": (["a", *D2], S(header=1, location="header"), "325107", 0),
    "mismatch": (["3", *D2], S(header=1, location="header"), "325106", 0),
    "no_target": (D2, S(insert_table_schema=None), "325133", 0),
    "date_bad": ([M3[0].replace("|20230228", "|2023-02-28")], S("manifest6@"), "325135", 0),
}


@pytest.fixture(scope="module")
def result(spark, tmp_path_factory):
    cases = {k: (v[0], v[1]) for k, v in CASES.items()}
    run, verdicts, _, failed = run_cases(spark, str(tmp_path_factory.mktemp("mv")), cases, "manifest")
    rows = {}
    for r in run.manifest_rows().orderBy("file_key", "record_id").collect():
        rows.setdefault(r.file_key.rsplit("/", 1)[1][:-4], []).append(r)
    kept = {}
    for r in run.original_lines("success").orderBy("file_key", "line_no").collect():
        kept.setdefault(r.file_key.rsplit("/", 1)[1][:-4], []).append(r.line)
    return verdicts, rows, kept, failed


@pytest.mark.parametrize("name", CASES)
def test_manifest(result, name):
    verdicts, rows, kept, failed = result
    lines, _, code, n = CASES[name]
    assert verdicts[name].code == code, verdicts[name]
    assert len(rows.get(name, [])) == n
    assert (kept if code == "225104" else failed)[name] == lines


def test_rows(result):
    _, rows, _, _ = result
    r = rows["header_footer"][0]
    assert (r.data_file_name, r.data_record_count, r.data_Date_of_file_generation) == ("tides.csv", "31", "20230405061500")
    assert (r.data_sequence_number, r.data_file_size, r.data_start_date, r.data_end_date) == ("", "", "", "")
    r = rows["verf"][0]
    assert r.data_file_name == "tides_north_0405.csv.gz"
    assert (r.data_file_size, r.data_record_count, r.data_number_of_fields) == ("1480", "31", "9")
    assert (r.data_start_date, r.data_end_date, r.data_Date_of_file_generation) == ("20230404", "", "20230405061500")
    assert [x.data_file_name for x in rows["ctrl"]] == ["tides.csv", "tides.csv"]
    assert all(x.data_file_name.endswith("5.csv.gz.pgp") for x in rows["extension"])
    assert rows["three_dated"][0].data_start_date == "20230228000000"
    assert rows["three_dated"][0].data_Date_of_file_generation == "20230305043015"
    assert rows["three_empty_pattern"][0].data_start_date == "20230228"


def test_claimed_count_attribute(result):
    verdicts = result[0]
    assert verdicts["verf"].metadata_record_count == "2"
    assert verdicts["plain"].metadata_record_count == ""
