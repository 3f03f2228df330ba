"""Warehouse jobs: log ETL, labels, scores, row-key tables, live statistics."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickloom.operators import labels, parsing, schemas, storage, upserts
from clickloom.sinks import tables


def event_etl(lines: DataFrame, day: str) -> DataFrame:
    """Typed events of one day, in the column order of the daily log table."""
    picked = lines.where(F.col("dt") == day)
    return parsing.typed_events(picked, columns=schemas.LOG_COLUMNS, keep=("dt",))


def history_etl(lines: DataFrame, day: str, project: str = "", tz: str = "Asia/Shanghai",
                convert: bool = True) -> DataFrame:
    picked = lines.where(F.col("dt") == day)
    return parsing.history_events(picked, project=project, tz=tz, convert=convert, keep=("dt",))


def event_flatten(lines: DataFrame, day: str) -> DataFrame:
    return parsing.flat_events(lines.where(F.col("dt") == day), keep=("dt",))


def user_labels(events: DataFrame, advisers: DataFrame, keep_empty: bool = False) -> DataFrame:
    return labels.user_labels(events, advisers, keep_empty)


def user_scores(label_table: DataFrame, follows: DataFrame, before: DataFrame, as_of: str):
    """(component scores, merged total scores)."""
    scores = labels.user_scores(label_table, follows, as_of)
    return scores, labels.merge_scores(before, labels.total_score(scores))


def score_job(label_table: DataFrame, follows: DataFrame, before: DataFrame, as_of: str,
              path: str) -> None:
    """Write the scores once, then derive the merged totals from the written table.

    Reading back cuts the lineage without holding anything in executors. Run
    data (the update stamp) goes to its own table, not among the scores.
    """
    spark = label_table.sparkSession
    scores = labels.user_scores(label_table, follows, as_of).withColumn("dt", F.lit(as_of))
    tables.overwrite_partition(scores, f"{path}/scores")
    written = spark.read.parquet(f"{path}/scores").where(F.col("dt") == as_of).drop("dt")
    merged = labels.merge_scores(before, labels.total_score(written))
    tables.overwrite_table(merged, f"{path}/totals")
    stamp = spark.range(1).select(
        F.lit(as_of).alias("as_of"), F.current_timestamp().alias("updated_at")
    )
    tables.overwrite_table(stamp, f"{path}/runs")


def user_live_rooms(events: DataFrame) -> DataFrame:
    return storage.user_live_rooms(events)


def event_rowkeys(events: DataFrame, fallback: bool = True) -> DataFrame:
    return storage.event_cells(events, fallback)


def plate_symbols(hash_table: DataFrame) -> DataFrame:
    return parsing.exploded_symbols(hash_table)


def live_stats_insert(hash_table: DataFrame) -> DataFrame:
    return parsing.live_stats(hash_table)


def live_stats_upsert(target: DataFrame, hash_table: DataFrame, now,
                      wanted: DataFrame | None = None) -> DataFrame:
    """Keyed upsert of live rooms: an insert sets c_time and u_time, an update touches neither.

    `wanted` (one column notice_id) restricts the rooms, e.g. to today's notices.
    """
    source = parsing.live_info(hash_table).withColumns({"c_time": now, "u_time": now})
    if wanted is not None:
        source = source.join(wanted.select("notice_id").distinct(), "notice_id", "left_semi")
    return upserts.upsert(target, source, ["notice_id"], keep_on_update=["c_time", "u_time"])
