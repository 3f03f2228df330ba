"""Windowed streams with built-in operators, and the late-row side output."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from clickloom.functions import clock


def event_time(rows: DataFrame, ms: Column, delay: str, alias: str = "ts") -> DataFrame:
    """Event time and watermark: max(time) - delay. Allowed lateness is part of the delay."""
    return rows.withColumn(alias, clock.millis_to_ts(ms)).withWatermark(alias, delay)


def window_counts(rows: DataFrame, size: str, keys: list[str], slide: str | None = None,
                  start: str | None = None, ts: str = "ts") -> DataFrame:
    args = [a for a in (size, slide or (size if start else None), start) if a]
    return (
        rows.groupBy(F.window(ts, *args).alias("w"), *keys)
        .agg(F.count("*").alias("num"))
        .select(F.col("w.start").alias("window_start"), *keys, "num")
    )


def window_devices(rows: DataFrame, size: str, keys: list[str], device: str,
                   slide: str | None = None, ts: str = "ts", approximate: bool = False):
    """Distinct devices and last time per window.

    Exact form in two stateful steps (one row per device, then the count), so a
    window's devices are spread over the state store instead of one set.
    """
    spans = F.window(ts, size, slide) if slide else F.window(ts, size)
    if approximate:
        counted = rows.groupBy(spans.alias("w"), *keys).agg(
            F.approx_count_distinct(device).alias("online_counts"),
            F.max(ts).alias("count_time"),
        )
    else:
        per_device = rows.groupBy(spans.alias("w"), *keys, device).agg(F.max(ts).alias("t"))
        counted = per_device.groupBy("w", *keys).agg(
            F.count(device).alias("online_counts"), F.max("t").alias("count_time")
        )
    return counted.select(
        F.col("w.start").alias("window_start"), *keys, "online_counts", "count_time"
    )


def window_members(rows: DataFrame, size: str, keys: list[str], member: str,
                   slide: str | None = None, start: str | None = None, ts: str = "ts"):
    """Rows per member of each window (update mode gives early results).

    One state row per member; the text of a window is joined when it is read,
    with operators.skew.joined_text.
    """
    return window_counts(rows, size, [*keys, member], slide, start, ts)


def active_keys(rows: DataFrame, keys: list[str], size: str, slide: str, ts: str = "ts"):
    return window_counts(rows, size, keys, slide, ts=ts).drop("num")


def running_counts(rows: DataFrame, keys: list[str]) -> DataFrame:
    """Running total per key, for update or complete mode."""
    return rows.groupBy(*keys).agg(F.count("*").alias("num"))


def batch_watermark_ms(spark: SparkSession, checkpoint: str, batch_id: int) -> int:
    """The watermark the engine runs a batch with, from the query's own offset log (0: none yet).

    The engine writes it down before a batch begins, so a replay of the batch and a
    restarted query find the same value.
    """
    log = spark.read.text(f"{checkpoint}/offsets/{batch_id}")
    told = F.get_json_object("value", "$.batchWatermarkMs").cast("bigint")
    return log.agg(F.max(told)).first()[0] or 0


def late_rows(checkpoint: str, on_time: Callable, late: Callable, ts: str = "ts") -> Callable:
    """foreachBatch function that sends rows behind the watermark to `late` and the others to `on_time`.

    The stream has a watermark on `ts` (event_time) and runs with this checkpoint; what is
    late is the engine's decision: a row below the watermark of its batch.
    """

    def split(batch: DataFrame, batch_id: int) -> None:
        mark = F.timestamp_millis(F.lit(batch_watermark_ms(batch.sparkSession, checkpoint, batch_id)))
        batch.persist()
        try:
            # Rows without a time can't be late.
            is_late = F.coalesce(F.col(ts) < mark, F.lit(False))
            on_time(batch.where(~is_late), batch_id)
            late(batch.where(is_late), batch_id)
        finally:
            batch.unpersist()

    return split
