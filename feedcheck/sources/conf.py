"""The configuration table of feeds."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def read_conf(spark: SparkSession, source: str | dict, project: str | None = None, columns: list[str] | None = None) -> DataFrame:
    """Configuration rows of a project: a parquet path, or the options of a JDBC source.
    Filter and column choice are pushed into the source."""
    df = spark.read.format("jdbc").options(**source).load() if isinstance(source, dict) else spark.read.parquet(source)
    if project is not None:
        df = df.filter(F.col("project") == project)
    return df.select(*columns) if columns else df


def first_of_set(column: str, k: int):
    """The first ``k`` distinct values of a group, in order, as a comma list."""
    return F.array_join(F.slice(F.sort_array(F.collect_set(column)), 1, k), ",")


def feed_directories(conf: DataFrame, project: str | None = None) -> DataFrame:
    """Distinct directory, host list and port of a project."""
    if project is not None:
        conf = conf.filter(F.col("project") == project)
    return conf.select("directory", "hostname", "port").distinct()


def directory_rollup(conf: DataFrame, project: str | None = None) -> DataFrame:
    """One row per directory, host list and port: its regular expressions, all support
    addresses without repeats, and one of each other setting, the smallest.

    A directory without host, port or path is matched by no file and left out.
    """
    if project is not None:
        conf = conf.filter(F.col("project") == project)
    keys = ["directory", "hostname", "port"]
    conf = conf.dropna(subset=keys)

    def first(c):
        return first_of_set(c, 1).alias(c)

    addresses = F.array_distinct(F.flatten(F.collect_set(F.split("support_email_list", ","))))
    return conf.groupBy(*keys).agg(
        F.sort_array(F.collect_set("file_regex")).alias("regexes"),
        first("username"),
        first("private_key_path"),
        first("quarantine_directory"),
        F.array_join(F.sort_array(addresses), ",").alias("support_email_list"),
        first("project"),
    )


def explode_hosts(rollup: DataFrame) -> DataFrame:
    """One row per host of the comma list."""
    return rollup.withColumn("localhost", F.explode(F.split("hostname", ","))).withColumn("localhost", F.trim("localhost"))
