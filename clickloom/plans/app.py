"""Jobs on app events. Input: (event, properties, time, project) from parsing.envelope."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickloom.functions import clock
from clickloom.operators import answers, counters, online, progress, reads, routing, sessions


def page_visits(events: DataFrame, project: str | None = None, tz: str = "UTC") -> DataFrame:
    return routing.page_visits(events, project, tz)


def live_sessions(events: DataFrame, project: str | None = None,
                  gap_ms: int = sessions.GAP_MS, tz: str = "UTC") -> DataFrame:
    return sessions.live_sessions(routing.live_rows(events, project), gap_ms, tz=tz)


def visit_list(events: DataFrame, project: str | None = None,
               gap_ms: int = sessions.GAP_MS, tz: str = "UTC") -> DataFrame:
    """Page visits and live sessions as one list."""
    return page_visits(events, project, tz).unionByName(live_sessions(events, project, gap_ms, tz))


def article_reads(events: DataFrame, project: str | None = None,
                  gap_ms: int = reads.GAP_MS) -> DataFrame:
    """De-duplicated reads per article."""
    return reads.article_reads(routing.article_rows(events, project), gap_ms)


def article_reads_raw(events: DataFrame, project: str | None = None) -> DataFrame:
    """Plain row count per article."""
    return counters.count_per(routing.article_rows(events, project), ["message_id"])


def td_behaviour_detail(events: DataFrame, project: str | None = None, tz: str = "UTC"):
    return routing.td_detail(events, project, tz)


def content_plays(events: DataFrame, project: str | None = None, size: str = "10 minutes"):
    rows = routing.play_rows(events, project).withColumn("ts", clock.millis_to_ts(F.col("ms")))
    return counters.count_per_window(rows, F.col("ts"), size, ["type", "msg_id"])


def content_plays_total(events: DataFrame, project: str | None = None) -> DataFrame:
    return counters.count_per(routing.play_rows(events, project), ["type", "msg_id"])


def share_stats(events: DataFrame, project: str | None = None, tz: str = "UTC"):
    """(per adviser and day, per message), in one-minute windows."""
    rows = routing.share_rows(events, project)
    return counters.shares_by_adviser(rows, tz), counters.shares_by_message(rows)


def push_opens(events: DataFrame) -> DataFrame:
    return counters.count_per(routing.push_rows(events), ["notice_id"])


def course_routing(events: DataFrame, envs: dict[str, str]) -> DataFrame:
    return routing.course_routes(events, envs)


def course_progress(events: DataFrame, schedule: DataFrame, envs: dict[str, str]) -> DataFrame:
    """Watch progress; `schedule` has item, start_ms, end_ms (one row per item)."""
    return progress.watch_progress(progress.watch_marks(events, envs), schedule)


def answer_history(events: DataFrame, envs: dict[str, str]) -> DataFrame:
    return answers.answer_history(answers.answer_rows(events, envs))


def answer_flags(events: DataFrame, existing: DataFrame, envs: dict[str, str]) -> DataFrame:
    return answers.merge_flags(existing, answers.page_flags(answers.answer_rows(events, envs)))


def insurance_routing(events: DataFrame, project: str | None = None) -> DataFrame:
    return routing.cover_routes(events, project)


def insurance_mirror(events: DataFrame, envs: dict[str, str]) -> DataFrame:
    return routing.mirror(events, envs)


def online_viewers(events: DataFrame, size: str = "60 seconds", slide: str | None = "5 seconds"):
    """Distinct devices per adviser, title and sliding window."""
    rows = online.live_plays(events)
    ms = clock.text_to_millis(F.col("time"))
    rows = rows.withColumn("ts", clock.millis_to_ts(ms))
    return online.window_viewers(rows, "ts", ["lcs_id", "title"], "device", size, slide)


def room_online_users(lines: DataFrame, room_length: int | None = 5) -> DataFrame:
    return online.room_online(online.status_rows(lines), "time", room_length)
