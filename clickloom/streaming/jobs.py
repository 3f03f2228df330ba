"""Streaming jobs: one parsed stream, several routes, replay-safe sinks."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from clickloom.functions import clock
from clickloom.operators import answers, parsing, progress, routing, schemas
from clickloom.sinks import tables
from clickloom.streaming import running, stateful


def ingest(records: DataFrame, path: str, checkpoint: str, trigger: str | None = None,
           tz: str = "UTC") -> StreamingQuery:
    """Typed events appended to day partitions; the day follows from the event time."""
    typed = parsing.typed_events(records, "value", schemas.LOG_COLUMNS)
    ms = F.coalesce(clock.text_to_millis(F.col("time")), F.lit(0).cast("bigint"))
    return tables.stream_partitions(
        typed.withColumn("dt", clock.format_millis(ms, clock.DAY, tz)), path, checkpoint,
        trigger=trigger,
    )


def visits_step(path: str, project: str | None, tz: str = "UTC"):
    def step(batch: DataFrame, batch_id: int) -> None:
        rows = routing.page_visits(batch, project, tz)
        out = rows.select(F.lit("visits").alias("list"),
                          F.to_json(F.struct(*routing.VISIT_COLUMNS)).alias("value"))
        tables.append_lists(out, path, batch_id)

    return step


def course_step(path: str, envs: dict[str, str], tee: str | None = None):
    def step(batch: DataFrame, batch_id: int) -> None:
        rows = routing.course_routes(batch, envs)
        named = rows.withColumn("list", F.concat_ws("-", "route", "env"))
        tables.append_lists(named, path, batch_id, tee)

    return step


def insurance_step(path: str, project: str | None, envs: dict[str, str], tee: str | None = None):
    """The insurance routes as lists, each repeated under its tee, and the mirror per environment."""

    def step(batch: DataFrame, batch_id: int) -> None:
        routes = routing.cover_routes(batch, project).select(F.col("route").alias("list"), "value")
        tables.append_lists(routes, f"{path}/routes", batch_id, tee)
        copied = routing.mirror(batch, envs).select(F.col("env").alias("list"), "value")
        tables.append_lists(copied, f"{path}/mirror", batch_id)

    return step


def td_step(path: str, project: str | None, tz: str = "UTC"):
    def step(batch: DataFrame, batch_id: int) -> None:
        rows = routing.td_detail(batch, project, tz)
        out = rows.select(F.lit("td").alias("list"), F.to_json(F.struct("*")).alias("value"))
        tables.append_lists(out, path, batch_id)

    return step


def marks_step(path: str, envs: dict[str, str]):
    """Watch marks of each batch in their own partition; readers take the distinct marks."""

    def step(batch: DataFrame, batch_id: int) -> None:
        marks = progress.watch_marks(batch, envs).withColumn("batch", F.lit(batch_id))
        tables.overwrite_partition(marks, path, "batch")

    return step


def answers_step(path: str, envs: dict[str, str]):
    """History rows of the answering pages; the page flags are a running table."""

    def step(batch: DataFrame, batch_id: int) -> None:
        history = answers.answer_history(answers.answer_rows(batch, envs)).withColumn("batch", F.lit(batch_id))
        tables.overwrite_partition(history, f"{path}/history", "batch")

    return step


def _changes(path: str | None):
    """foreachBatch function that writes a running table's changed rows, or only keeps the state going."""

    def write(batch: DataFrame, batch_id: int) -> None:
        if path is None:
            batch.write.format("noop").mode("overwrite").save()
        else:
            tables.write_changes(batch, path, batch_id)

    return write


def running_tables(records: DataFrame, project: str | None, envs: dict[str, str], path: str | None,
                   checkpoint: str, trigger: str | None = None, tz: str = "UTC") -> StreamingQuery:
    """Shares per adviser and day and per message, push openings, plays and page flags as running totals.

    One query and one state for all of them; running.read_totals reads a table.
    """
    events = parsing.envelope(records, "value")
    found = running.totals(running.app_updates(events, project, envs, tz))
    return tables.stream_to(found, checkpoint, trigger, "update").foreachBatch(_changes(path)).start()


def course_progress(records: DataFrame, schedule: DataFrame, envs: dict[str, str], path: str | None,
                    checkpoint: str, trigger: str | None = None) -> StreamingQuery:
    """Progress of everyone who got a mark in a batch; running.read_progress reads the table.

    `schedule` is a table of item, start_ms and end_ms, which is read anew for each batch.
    """
    events = parsing.envelope(records, "value")
    found = running.stream_progress(events, schedule, envs)
    return tables.stream_to(found, checkpoint, trigger, "update").foreachBatch(_changes(path)).start()


def live_sessions(records: DataFrame, project: str | None, path: str, checkpoint: str,
                  trigger: str | None = None, tz: str = "UTC", delay: str = "10 seconds",
                  at_once: bool = False) -> StreamingQuery:
    """Enter and leave records of live rooms in the columns of the page visits, list "live".

    Both are written when a session has closed; with `at_once` the enter record comes as
    soon as the watermark rules out an earlier row, which costs a Python state call per key.

    Sessions keep state from batch to batch, so they are a query of their own,
    with batch numbers of their own.
    """
    events = parsing.envelope(records, "value")
    rows = routing.live_rows(events, project).where(F.col("ms").isNotNull())
    found = (stateful.stream_sessions if at_once else stateful.stream_closed_sessions)(rows, delay)

    def write(batch: DataFrame, batch_id: int) -> None:
        shown = batch.withColumns(
            {"time": clock.format_millis(F.col("ms"), tz=tz), "symbol": F.lit("")}
        )
        value = F.to_json(F.struct(*routing.VISIT_COLUMNS)).alias("value")
        tables.append_lists(shown.select(F.lit("live").alias("list"), value), path, batch_id)

    return tables.stream_to(found, checkpoint, trigger).foreachBatch(write).start()


def article_reads(records: DataFrame, project: str | None, path: str | None, checkpoint: str,
                  trigger: str | None = None) -> StreamingQuery:
    """De-duplicated reads as increments per batch; running.read_read_totals gives the totals."""
    events = parsing.envelope(records, "value")
    rows = routing.article_rows(events, project).where(F.col("ms").isNotNull())
    found = stateful.stream_reads(rows)
    return tables.stream_to(found, checkpoint, trigger).foreachBatch(_changes(path)).start()


def run(records: DataFrame, steps, checkpoint: str, trigger: str | None = None) -> StreamingQuery:
    """Parse line and properties once, run every step on the cached batch."""
    events = parsing.envelope(records, "value", parsed=True)
    return (
        tables.stream_to(events, checkpoint, trigger)
        .foreachBatch(tables.fan_out_batch(steps))
        .start()
    )
