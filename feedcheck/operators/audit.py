"""Audit rows: one per step of a file."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import codes

COLUMNS = ["log_uuid", "log_timestamp", "conf_id", "file_uuid", "file_name", "log_type_id", "log_message"]
_RANK = {"DEBUG": 1, "INFO": 2, "ERROR": 3}


def _stamped(events: DataFrame, node: str, now: Column | None) -> DataFrame:
    stamp = F.date_format(now if now is not None else F.current_timestamp(), "yyyy-MM-dd HH:mm:ss")
    return events.withColumns({"log_uuid": F.concat(F.lit(node + "-"), F.uuid()), "log_timestamp": stamp})


def at_least(events: DataFrame, min_level: str) -> DataFrame:
    """Drop events below a level; the first digit of ``log_type_id`` is the severity."""
    return events.filter(F.substring("log_type_id", 1, 1).cast("int") >= _RANK[min_level.upper()])


def audit_event(df: DataFrame, log_type_id, message, node: str = "0", now: Column | None = None) -> DataFrame:
    """One audit row per input row that has ``conf_id, file_uuid, file_name``."""
    code = F.lit(log_type_id) if isinstance(log_type_id, str) else log_type_id
    text = F.lit(message) if isinstance(message, str) else message
    events = df.select("conf_id", "file_uuid", "file_name", code.alias("log_type_id"), text.alias("log_message"))
    return _stamped(events, node, now).select(*COLUMNS)


def audit_rows(verdicts: DataFrame, profile: str, min_level: str = "DEBUG", node: str = "0", now: Column | None = None) -> DataFrame:
    """Start, failed checks, matched count and verdict of every file."""
    code = codes.PROFILES[profile]

    def event(kind: Column, message: Column) -> Column:
        return F.struct(kind.alias("code"), message.alias("msg"))

    matched = F.when(F.col("count_status") == "matched", event(F.lit(code["count_matched"]), F.lit("record counts matched")))
    steps = F.array(event(F.lit(code["start"]), F.lit("validation started")))
    steps = F.concat(
        steps,
        F.coalesce(F.col("config_errors"), F.array().cast("array<struct<code:string,msg:string>>")),
        F.array_compact(F.array(matched)),
        F.array(event(F.col("code"), F.col("message"))),
    )
    events = verdicts.select("conf_id", "file_uuid", "file_name", F.explode(steps).alias("e")).select(
        "conf_id", "file_uuid", "file_name", F.col("e.code").alias("log_type_id"), F.col("e.msg").alias("log_message")
    )
    return _stamped(at_least(events, min_level), node, now).select(*COLUMNS)


def write_audit(events: DataFrame, path: str, min_level: str = "INFO", batch_id: int | None = None) -> None:
    """Append to the audit table; with a batch id the batch's own folder is replaced, so
    that a repeated batch leaves no second copy."""
    events = at_least(events, min_level)
    if batch_id is None:
        events.write.mode("append").parquet(path)
    else:
        events.write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")


def audit_summary(events: DataFrame) -> DataFrame:
    """Events per code, with its level."""
    level = F.create_map(*[F.lit(x) for kv in codes.LEVELS.items() for x in kv])
    counts = events.groupBy("log_type_id").agg(F.count(F.lit(1)).alias("n"))
    return counts.withColumn("level", level[F.substring("log_type_id", 1, 1)])
