"""Counts per key, per window, and their merge into running totals."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clickloom.functions import clock


def count_per(df: DataFrame, keys: list, alias: str = "num") -> DataFrame:
    return df.groupBy(*keys).agg(F.count("*").alias(alias))


def count_per_window(
    df: DataFrame, ts: Column, size: str, keys: list[str], slide: str | None = None,
    start: str | None = None, alias: str = "num",
) -> DataFrame:
    """Tumbling or sliding count; `start` shifts the window grid (day at another clock)."""
    args = [a for a in (size, slide or (size if start else None), start) if a]
    return (
        df.groupBy(F.window(ts, *args).alias("w"), *keys)
        .agg(F.count("*").alias(alias))
        .select(F.col("w.start").alias("window_start"), *keys, alias)
    )


def active_keys(df: DataFrame, ts: Column, size: str, slide: str, keys: list[str]) -> DataFrame:
    """Distinct keys of each sliding window.

    Keys are first made distinct per slide-wide pane, so a busy key is expanded
    into its windows once per pane and not once per row.
    """
    panes = df.select(*keys, F.window(ts, slide)["start"].alias("__pane")).distinct()
    return (
        panes.withColumn("w", F.window("__pane", size, slide))
        .select(F.col("w.start").alias("window_start"), *keys)
        .distinct()
    )


def shares_by_adviser(rows: DataFrame, tz: str = "UTC") -> DataFrame:
    """Window counts (1 min) per share metric, adviser and day."""
    day = clock.format_millis(F.col("ms"), clock.DAY, tz)
    picked = rows.where(F.col("lcs_id") != "").select(
        F.concat("type", F.lit("_num")).alias("metric"), "lcs_id", day.alias("day"),
        clock.millis_to_ts(F.col("ms")).alias("ts"),
    )
    return count_per_window(picked, F.col("ts"), "1 minute", ["metric", "lcs_id", "day"])


def shares_by_message(rows: DataFrame) -> DataFrame:
    """Window counts (1 min) per share kind and message."""
    picked = rows.where(F.col("message_id") != "").select(
        F.concat("type", F.lit("_"), "message_id").alias("field"),
        clock.millis_to_ts(F.col("ms")).alias("ts"),
    )
    return count_per_window(picked, F.col("ts"), "1 minute", ["field"])


def merge_counts(old: DataFrame, delta: DataFrame, keys: list[str], value: str = "num") -> DataFrame:
    """old + delta per key; both sides are summed first, so no key is repeated on either."""
    both = old.select(*keys, value).unionByName(delta.select(*keys, value))
    return both.groupBy(*keys).agg(F.sum(value).alias(value))
