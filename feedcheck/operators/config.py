"""Checks of per-file settings and lookups in the configuration table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import codes
from ..functions.text import as_int
from ..session import broadcast_if_small

# Where a feed may state its record count.
LOCATIONS = {
    "data": ("header", "footer", "filename", "none"),
    "data_only": ("header", "footer", "filename", "header_metadata", "header_metadata_and_footer", "none"),
    "manifest": ("header", "footer", "filename", "none"),
}
SETTINGS = (
    "file_name", "file_uuid", "file_id", "conf_id", "header_record_count", "footer_record_count",
    "record_count_location", "record_count_filter", "add_file_and_record_id", "file_uuid_or_id",
    "field_separator", "metadata_record_count", "metadata_header_record", "datafile_extension",
    "table_schema", "insert_table_schema", "header_schema",
)


def with_all_settings(files: DataFrame) -> DataFrame:
    """Absent settings become null text columns."""
    return files.withColumns({c: F.lit(None).cast("string") for c in SETTINGS if c not in files.columns})


def _whole(text: Column) -> Column:
    """A count setting; negative counts are refused here."""
    n = as_int(text)
    return F.when(n >= 0, n)


def check_config(files: DataFrame, profile: str) -> DataFrame:
    """Add ``header_n, footer_n``, every failed check in ``config_errors`` and the
    resulting ``config_code`` (null when the settings are usable).

    All checks run. A missing location, id flag or id choice has its own code, which
    wins over failed checks; a missing count is a failed number check.
    """
    code = codes.PROFILES[profile]
    files = with_all_settings(files)
    location = F.lower(F.col("record_count_location"))
    checks: list[tuple[str, Column, str]] = []

    def number(column: str, label: str):
        checks.append(("number", _whole(F.col(column)).isNull(), codes.CHECK_MESSAGES["number"].format(label)))

    number("header_record_count", "Header Count")
    number("footer_record_count", "Footer Count")
    if profile == "data":
        number("metadata_record_count", "Metadata Record Count")
    known = location.isin(*LOCATIONS[profile])
    allowed = ", ".join(LOCATIONS[profile][:-1]) + " or none"
    checks.append(("location", ~known, f"{codes.CHECK_MESSAGES['location']}, allowed value are {allowed}"))
    unfiltered = ["none"] + (["header_metadata"] if profile == "data_only" else [])
    blank = F.coalesce(F.col("record_count_filter"), F.lit("")) == ""
    checks.append(("filter_blank", known & ~location.isin(*unfiltered) & blank, codes.CHECK_MESSAGES["filter_blank"]))
    checks.append(("id_flag", ~F.col("add_file_and_record_id").isin("0", "1"), codes.CHECK_MESSAGES["id_flag"]))
    required = ["record_count_location", "add_file_and_record_id"]
    if profile != "manifest":
        choice = F.lower(F.col("file_uuid_or_id"))
        checks.append(("file_id_choice", ~choice.isin("file_uuid", "file_id"), codes.CHECK_MESSAGES["file_id_choice"]))
        required.append("file_uuid_or_id")

    found = [
        F.when(F.coalesce(bad, F.lit(False)), F.struct(F.lit(code[cause]).alias("code"), F.lit(msg).alias("msg")))
        for cause, bad, msg in checks
    ]
    absent = F.lit(False)
    for c in required:
        absent = absent | F.col(c).isNull()
    return files.withColumns(
        {
            "header_n": _whole(F.col("header_record_count")),
            "footer_n": _whole(F.col("footer_record_count")),
            "config_errors": F.array_compact(F.array(*found)),
        }
    ).withColumn(
        "config_code",
        F.when(absent, F.lit(code["null_pointer"])).when(F.size("config_errors") > 0, F.lit(code["attribute"])),
    )


def metadata_line_setting(files: DataFrame) -> DataFrame:
    """Add ``metadata_line`` (0 when blank) and ``metadata_setting_code``."""
    code = codes.DATA_ONLY
    text = F.col("metadata_header_record")
    blank = F.coalesce(F.trim(text), F.lit("")) == ""
    number = as_int(text)
    word = F.lower(text).isin("header_metadata", "header_metadata_and_footer")
    return files.withColumns(
        {
            "metadata_line": F.when(blank, F.lit(0)).otherwise(number),
            "metadata_setting_code": F.when(blank | number.isNotNull(), F.lit(None).cast("string"))
            .when(word, F.lit(code["metadata_record"]))
            .otherwise(F.lit(code["illegal_argument"])),
        }
    )


def with_conf(files: DataFrame, conf: DataFrame, key: str = "conf_id", columns: list[str] | None = None) -> DataFrame:
    """Look up each file's configuration row; ``conf_error`` where there is none.

    One row per key, the smallest, so that the result does not depend on row order.
    """
    columns = columns or [c for c in conf.columns if c != key]
    one = conf.filter(F.col(key).isNotNull()).groupBy(key).agg(F.min(F.struct(*columns)).alias("__conf"))
    joined = files.join(broadcast_if_small(one), key, "left")
    return joined.select(
        *files.columns,
        *[F.col(f"__conf.{c}").alias(c) for c in columns],
        F.when(F.col("__conf").isNull(), F.lit(codes.CONF_MISSING)).alias("conf_error"),
    )
