"""Verdict and audit codes of the three validations."""

# Numeric codes written to the audit table, by validation and cause.
DATA = {
    "start": "125202",
    "count_matched": "125203",
    "success": "225204",
    "attribute": "325205",
    "count_mismatch": "325206",
    "schema_errors": "325208",
    "malformed": "325209",
    "schema_missing": "325210",
    "schema_unparsable": "325211",
    "io": "325212",
    "record": "325213",
    "location": "325214",
    "id_flag": "325215",
    "number": "325216",
    "filter_blank": "325131",
    "file_id_choice": "325314",
    "null_pointer": "325218",
    "illegal_argument": "325223",
    "date": "325224",
}
DATA_ONLY = {
    "start": "125302",
    "count_matched": "125303",
    "success": "225304",
    "attribute": "325305",
    "count_mismatch": "325306",
    "count_text": "325307",
    "schema_errors": "325308",
    "malformed": "325309",
    "schema_missing": "325310",
    "schema_unparsable": "325311",
    "io": "325312",
    "record": "325313",
    "location": "325314",
    "id_flag": "325315",
    "number": "325316",
    "filter_failed": "325327",
    "filter_blank": "325331",
    "file_id_choice": "325314",
    "null_pointer": "325333",
    "illegal_argument": "325334",
    "date": "325335",
    "metadata_record": "325323",
    "metadata_short": "325324",
    "metadata_number": "325325",
    "metadata_long": "325326",
    "metadata_no_count": "325328",
    "metadata_footer_differ": "325329",
    "metadata_not_found": "325330",
    "metadata_record_number": "325332",
}
MANIFEST = {
    "start": "125102",
    "count_matched": "125103",
    "success": "225104",
    "attribute": "325105",
    "count_mismatch": "325106",
    "count_text": "325107",
    "record": "325108",
    "malformed": "325109",
    "schema_missing": "325110",
    "schema_unparsable": "325111",
    "io": "325112",
    "schema_errors": "325113",
    "location": "325114",
    "id_flag": "325115",
    "number": "325116",
    "filter_failed": "325130",
    "filter_blank": "325131",
    "null_pointer": "325133",
    "illegal_argument": "325134",
    "date": "325135",
    "unknown_field": "125000",
}
PROFILES = {"data": DATA, "data_only": DATA_ONLY, "manifest": MANIFEST}

# Partition path errors.
PARTITION = {
    "start": "126001",
    "parsed": "126002",
    "success": "226005",
    "bad_json": "326006",
    "date_format_missing": "326007",
    "date_format_invalid": "326008",
    "mod_format_invalid": "326009",
    "mod_too_short": "326010",
    "mod_not_number": "326011",
    "mod_bad_pattern": "326012",
    "mod_hours": "326013",
    "mod_sixty": "326014",
    "mod_unit": "326015",
    "attribute_name_missing": "326016",
    "attribute_missing": "326017",
    "unknown_source": "326018",
}

# Other steps.
LISTED = "210023"
LISTING_FAILED = "310027"
LISTING_BAD_REGEX = "310029"
UNCLAIMED_LISTED = "231001"
UNCLAIMED_UNREACHABLE = "331004"
SHEET_CONVERTED = "227002"
SHEET_FAILED = "327002"
CONF_MISSING = "323008"
PASSPHRASE_NULL = "323014"
PASSPHRASE_EMPTY = "323015"

# Message of a failed configuration check, by cause.
CHECK_MESSAGES = {
    "number": "Invalid {0} attribute value, value should be a Number ",
    "location": "Invalid record_count_location attribute value",
    "filter_blank": "Invalid record_count_filter attribute value",
    "id_flag": "Invalid add_file_and_record_id attribute value, allowed value are 1 or 0",
    "file_id_choice": "Invalid file_uuid_or_id attribute value, allowed value are file_uuid or file_id",
}

LEVELS = {"1": "DEBUG", "2": "INFO", "3": "ERROR"}

# The message of a file with schema errors. A part is shown as its text, the
# number of names, and the second text, with the names in brackets.
SUMMARY_START = "Records in this FlowFile were invalid for the following reasons: "
SUMMARY_PARTS = {
    "missing": ("The following ", " fields were missing: "),
    "extra": ("; The following ", " fields were present in the Record but not in the schema: "),
    "invalid": ("; The following ", " fields had values whose type did not match the schema: "),
    "other": ("; The following ", " additional problems were encountered: "),
}
SUMMARY_LIMIT = 65535
