"""Who is online: distinct viewers per window and current members of rooms."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clickloom.functions.jsonmap import json_map, prop
from clickloom.operators import rules
from clickloom.operators.skew import PARTS, joined_text
from clickloom.operators.parsing import with_properties


def live_plays(events: DataFrame, device: str = "deviceId") -> DataFrame:
    """(lcs_id, title, device, time) of live heartbeats with adviser and device."""
    name, content = rules.LIVE_PLAY
    keys = ["v1_lcs_id", "v1_element_content", "v1_message_title", "deviceId"]
    rows = with_properties(events.where(F.col("event") == name), keys)
    return rows.where(
        (F.col("v1_element_content") == content)
        & (F.col("v1_lcs_id") != "")
        & (F.col(device) != "")
    ).select(
        F.col("v1_lcs_id").alias("lcs_id"), F.col("v1_message_title").alias("title"),
        F.col(device).alias("device"), "time",
    )


def viewers(df: DataFrame, keys: list[str], device: str, ts: str) -> DataFrame:
    """Distinct devices and last time per key."""
    per_device = df.groupBy(*keys, device).agg(F.max(ts).alias("__t"))
    return per_device.groupBy(*keys).agg(
        F.count(device).alias("online_counts"), F.max("__t").alias("count_time")
    )


SKETCH_LOG2 = 12  # registers of a sketch: 4,096, a standard error of about 1.6 %


def device_panes(df: DataFrame, ts: str, keys: list[str], device: str, slide: str = "5 seconds") -> DataFrame:
    """(keys, pane, devices, count_time): a sketch of the distinct devices of every pane, for a batch or a stream.

    A pane is one row of fixed size however many devices it has; sketches of panes are
    merged before the shuffle and may be stored and merged later on.
    """
    pane = F.window(F.col(ts), slide)["start"].alias("pane")
    return df.groupBy(*keys, pane).agg(
        F.hll_sketch_agg(F.col(device).cast("string"), F.lit(SKETCH_LOG2)).alias("devices"),
        F.max(ts).alias("count_time"),
    )


def viewers_of_panes(panes: DataFrame, keys: list[str], size: str = "60 seconds", slide: str = "5 seconds") -> DataFrame:
    """About how many devices each window had, from the union of its panes' sketches."""
    wide = panes.withColumn("window_start", F.window("pane", size, slide)["start"])
    united = wide.groupBy("window_start", *keys).agg(
        F.hll_union_agg("devices").alias("devices"), F.max("count_time").alias("count_time")
    )
    return united.select(
        "window_start", *keys, F.hll_sketch_estimate("devices").alias("estimate"), "count_time"
    )


def window_viewers(
    df: DataFrame,
    ts: str,
    keys: list[str],
    device: str,
    size: str = "60 seconds",
    slide: str | None = "5 seconds",
    approximate: bool = False,
) -> DataFrame:
    """Distinct devices and last time per key and (sliding) window.

    A device is reduced to one row per slide-wide pane before it is copied into
    its size/slide windows, and distinct counting runs per device, so neither a
    busy device nor a busy key is gathered in one place.
    """
    pane = F.window(F.col(ts), slide or size)["start"]
    panes = df.groupBy(*keys, F.col(device).alias("__d"), pane.alias("__pane")).agg(
        F.max(ts).alias("__t")
    )
    spans = F.window("__pane", size, slide) if slide else F.window("__pane", size)
    wide = panes.withColumn("w", spans).withColumn("window_start", F.col("w.start"))
    if approximate:
        return wide.groupBy("window_start", *keys).agg(
            F.approx_count_distinct("__d").alias("online_counts"),
            F.max("__t").alias("count_time"),
        )
    per_device = wide.groupBy("window_start", *keys, "__d").agg(F.max("__t").alias("__t"))
    return per_device.groupBy("window_start", *keys).agg(
        F.count("__d").alias("online_counts"), F.max("__t").alias("count_time")
    )


def window_text(
    df: DataFrame, ts: Column, keys: list[str], value: Column, alias: str,
    size: str, slide: str | None = None, start: str | None = None, parts: int = PARTS,
) -> DataFrame:
    """All values of a window joined with "|" (sorted), in parts by a hash of the value."""
    args = [a for a in (size, slide or (size if start else None), start) if a]
    rows = df.select(
        F.window(ts, *args)["start"].alias("window_start"), *keys, value.alias("__value")
    )
    return joined_text(rows, ["window_start", *keys], F.col("__value"), alias, "|", parts=parts)


def status_rows(lines: DataFrame, column: str = "value") -> DataFrame:
    """(room, uid, status, time) of online records; an empty status means offline."""
    m = F.col("m")
    status = prop(m, "is_online", "0")
    rows = lines.select(json_map(F.col(column)).alias("m")).select(
        prop(m, "extra_id").alias("room"), prop(m, "uid").alias("uid"),
        F.when(status == "", "0").otherwise(status).alias("status"),
        prop(m, "c_time").alias("time"),
    )
    return rows.where((F.col("room") != "") & (F.col("uid") != ""))


def latest_status(rows: DataFrame, ts: str = "time") -> DataFrame:
    """Last status of each (room, user); at equal times online wins."""
    return rows.groupBy("room", "uid").agg(
        F.max_by("status", F.struct(ts, "status")).alias("status"), F.max(ts).alias("time")
    )


def room_online(rows: DataFrame, ts: str = "time", room_length: int | None = 5) -> DataFrame:
    """Users online per room, for room ids of the given length."""
    now = latest_status(rows, ts)
    if room_length is not None:
        now = now.where(F.length("room") == room_length)
    return now.groupBy("room").agg(F.count_if(F.col("status") == "1").alias("online"))
