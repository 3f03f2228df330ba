"""Batch scans of lines, events, key/value snapshots and relational tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def scan_lines(table: DataFrame, day: str, line: str = "line", dt: str = "dt") -> DataFrame:
    """Raw lines of one day; the filter on the partition column prunes directories."""
    return table.where(F.col(dt) == day).select(F.col(line).alias("line"), F.col(dt).alias("dt"))


def scan_events(
    table: DataFrame, start: str, end: str, time: str = "time", dt: str = "dt"
) -> DataFrame:
    """Events of a closed time range; the day bounds follow from the time bounds."""
    days = F.col(dt).between(start[:10], end[:10])
    return table.where(days & F.col(time).between(start, end))


def scan_since(table: DataFrame, ts: str, now: Column, seconds: int) -> DataFrame:
    """Rows of the last `seconds` before `now`, oldest first."""
    since = now - F.make_dt_interval(secs=F.lit(seconds))
    return table.where((F.col(ts) >= since) & (F.col(ts) <= now)).orderBy(ts)


def search(table: DataFrame, order: str, **equal) -> DataFrame:
    """Rows matching every given value, sorted by time."""
    out = table
    for name, value in equal.items():
        out = out.where(F.col(name) == value)
    return out.orderBy(order)


def key_value(table: DataFrame, key: str, value: str) -> DataFrame:
    """Any table as a (key, value) snapshot of text."""
    return table.select(
        F.col(key).cast("string").alias("key"), F.col(value).cast("string").alias("value")
    )


def read_text(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.text(path)


def read_files(spark: SparkSession, path: str) -> DataFrame:
    """One row per file: (file, value)."""
    whole = spark.read.text(path, wholetext=True)
    return whole.select(F.col("_metadata.file_path").alias("file"), "value")


def read_ratings(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.csv(path, schema="user int, item int, rating float")


def jdbc_options(url: str, query: str, driver: str | None = None, user: str | None = None,
                 password: str | None = None, partition: tuple | None = None) -> dict[str, str]:
    """Options of a pushed-down sub-query; `partition` = (column, lower, upper, parts)."""
    options = {"url": url, "dbtable": f"({query}) t"}
    if driver:
        options["driver"] = driver
    if user is not None:
        options["user"] = user
    if password is not None:
        options["password"] = password
    if partition:
        column, lower, upper, parts = partition
        options.update(
            partitionColumn=column, lowerBound=str(lower), upperBound=str(upper),
            numPartitions=str(parts),
        )
    return options


def read_jdbc(spark: SparkSession, **kwargs) -> DataFrame:
    return spark.read.format("jdbc").options(**jdbc_options(**kwargs)).load()
