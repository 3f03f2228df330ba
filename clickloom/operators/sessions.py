"""Live-room sessions: enter, stay, leave.

A session of a (user, room) ends when no row follows for `gap_ms`; the leave is
booked `linger_ms` after its last row.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from clickloom.functions import clock
from clickloom.operators.routing import VISIT_COLUMNS

GAP_MS = 15_000
LINGER_MS = 3_000


def gap_sessions(
    rows: DataFrame, keys: list[str], ms: str = "ms", gap_ms: int = GAP_MS, carry=()
) -> DataFrame:
    """One row per session: first_ms, last_ms, n_rows, and the carried columns of both ends.

    Rows of one key in one gap-wide bucket belong together, so they are reduced
    to one row before any shuffle. The window that stitches the buckets sees at
    most span / gap rows per key, however many events the key has.
    """
    ends = [F.col(ms).alias("ms"), *[F.col(c) for c in carry]]
    bucket = F.floor(F.col(ms) / F.lit(gap_ms)).alias("__bucket")
    buckets = rows.groupBy(*keys, bucket).agg(
        F.min(F.struct(*ends)).alias("first"),
        F.max(F.struct(*ends)).alias("last"),
        F.count("*").alias("n_rows"),
    )
    in_order = Window.partitionBy(*keys).orderBy("__bucket")
    silence = F.col("first.ms") - F.lag("last.ms").over(in_order)
    opened = F.when(silence <= gap_ms, 0).otherwise(1)
    numbered = buckets.withColumn("__open", opened).withColumn(
        "session", F.sum("__open").over(in_order)
    )
    return (
        numbered.groupBy(*keys, "session")
        .agg(
            F.min("first").alias("first"),
            F.max("last").alias("last"),
            F.sum("n_rows").alias("n_rows"),
        )
        .withColumns({"first_ms": F.col("first.ms"), "last_ms": F.col("last.ms")})
    )


def stay_seconds(first_ms, last_ms, linger_ms: int = LINGER_MS):
    return F.floor((last_ms - first_ms + linger_ms) / 1000).cast("bigint")


def live_sessions(
    rows: DataFrame, gap_ms: int = GAP_MS, linger_ms: int = LINGER_MS, tz: str = "UTC"
) -> DataFrame:
    """Enter and leave records of every live-room session, in the page-visit columns."""
    carry = ["title", "content", "message_id", "lcs_name"]
    sessions = gap_sessions(rows, ["uid", "lcs_id"], "ms", gap_ms, carry)

    def record(kind, end, ms, stay):
        return F.struct(
            F.lit(kind).alias("type"),
            *[F.col(f"{end}.{c}").alias(c) for c in carry],
            clock.format_millis(ms, tz=tz).alias("time"),
            stay.alias("stay_time"),
        )

    first, last = F.col("first_ms"), F.col("last_ms")
    both = F.array(
        record("enter_live", "first", first, F.lit(0).cast("bigint")),
        record("leave_live", "last", last + linger_ms, stay_seconds(first, last, linger_ms)),
    )
    out = sessions.select("uid", "lcs_id", F.explode(both).alias("r"))
    return out.select("uid", "lcs_id", "r.*", F.lit("").alias("symbol")).select(*VISIT_COLUMNS)
