"""Course-watch progress over a half-minute grid."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickloom.functions import clock, rowkeys
from clickloom.operators import rules
from clickloom.operators.routing import env_of, routed

STEP_MS = clock.HALF_MINUTE_MS
STEP_SECONDS = STEP_MS // 1000
WATCH_KEYS = [
    ("v1_element_content", "content"), ("v1_message_id", "item"),
    ("v1_custom_params", "offset"), ("v1_custom_params2", "uid"),
]


def mark_rows(events: DataFrame, envs: dict[str, str]) -> DataFrame:
    """(uid, item, env, mode, bucket) of every heartbeat and replay, repeats included.

    A live heartbeat marks its half minute (millis); a replay marks its offset
    in seconds. A replay whose offset is no number is rejected.
    """
    rows = routed(events, rules.COURSE_WATCH, WATCH_KEYS)
    bucket = F.when(
        F.col("type") == "live",
        clock.floor_millis(clock.text_to_millis(F.col("time")), STEP_MS),
    ).otherwise(F.col("offset").try_cast("bigint"))
    return rows.select(
        "uid", "item", env_of(F.col("project"), envs).alias("env"),
        F.col("type").alias("mode"), bucket.alias("bucket"),
    ).where(F.col("env").isNotNull() & F.col("bucket").isNotNull())


def watch_marks(events: DataFrame, envs: dict[str, str]) -> DataFrame:
    """Distinct (uid, item, env, mode, bucket) marks."""
    return mark_rows(events, envs).distinct()


def mark_cells(marks: DataFrame) -> DataFrame:
    key = rowkeys.watch_key(*[F.col(c) for c in ("uid", "item", "env", "mode", "bucket")])
    return marks.select(key.alias("row_key"), F.lit("1").alias("record"))


def grid(schedule: DataFrame) -> DataFrame:
    """(item, idx, point): the half-minute points of each item."""
    first = clock.grid_start(F.col("start_ms"), STEP_MS)
    points = F.transform(
        F.sequence(F.lit(0).cast("bigint"), clock.grid_size(F.col("start_ms"), F.col("end_ms")) - 1),
        lambda i: F.struct(i.alias("idx"), (first + i * STEP_MS).alias("point")),
    )
    return schedule.select("item", F.explode(points).alias("p")).select("item", "p.*")


def indexed(marks: DataFrame, schedule: DataFrame) -> DataFrame:
    """(uid, item, env, idx, points) of marks: the grid index of each and the size of its grid.

    The index follows from the mark by arithmetic; no grid is built. The schedule has
    one row per item; where it is large and one course holds most of the marks, adaptive
    execution splits that course's partition.
    """
    joined = marks.join(schedule.select("item", "start_ms", "end_ms"), "item")
    since = F.col("bucket") - clock.grid_start(F.col("start_ms"), STEP_MS)
    live = F.when(since % STEP_MS == 0, F.floor(since / STEP_MS))
    # Offsets are divided like whole numbers, towards zero.
    play = F.expr(f"bucket div {STEP_SECONDS}")
    index = F.when(F.col("mode") == "live", live).otherwise(play).cast("bigint")
    return joined.select(
        "uid", "item", "env", index.alias("idx"),
        clock.grid_size(F.col("start_ms"), F.col("end_ms"), STEP_MS).alias("points"),
    )


def watched_words(points: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, word, bits, points): the grid points seen by each key as bitmaps of 64 points.

    A row of a key without a point on the grid has no word and no bit. The bitmaps are
    merged before the shuffle, so it carries 16 bytes for each half hour watched, however
    often. A word is as short as a bitmap can be; the engine's own bitmaps take 4 kB each.
    """
    on_grid = (F.col("idx") >= 0) & (F.col("idx") < F.col("points"))
    word = F.when(on_grid, F.shiftright("idx", 6)).alias("word")
    bit = F.when(on_grid, F.expr("shiftleft(1L, CAST(idx & 63 AS INT))")).otherwise(F.lit(0).cast("bigint"))
    return (
        points.select(*keys, word, bit.alias("bit"), "points")
        .groupBy(*keys, "word")
        .agg(F.bit_or("bit").alias("bits"), F.max("points").alias("points"))
    )


def grid_hits(marks: DataFrame, schedule: DataFrame) -> DataFrame:
    """(item, idx, point, num): grid points with the number of users who watched them.

    The bitmaps of a user are merged over the environments, and their bits are told
    apart only then.
    """
    first = clock.grid_start(F.col("start_ms"), STEP_MS)
    words = watched_words(indexed(marks, schedule), ["uid", "item"]).where("word IS NOT NULL AND uid IS NOT NULL")
    places = F.filter(
        F.sequence(F.lit(0), F.lit(63)), lambda i: F.getbit(F.col("bits"), i) == 1
    )
    seen = words.select("item", "word", F.explode(places).alias("place"))
    seen = seen.select("item", (F.shiftleft("word", 6) + F.col("place")).alias("idx"))
    per_point = seen.groupBy("item", "idx").agg(F.count("*").alias("num"))
    return per_point.join(schedule.select("item", first.alias("first")), "item").select(
        "item", "idx", (F.col("first") + F.col("idx") * STEP_MS).alias("point"), "num"
    )


def watch_progress(marks: DataFrame, schedule: DataFrame) -> DataFrame:
    """percent and seconds watched per (uid, item, env), from the bits set in its bitmaps."""
    keys = ["uid", "item", "env"]
    return (
        watched_words(indexed(marks, schedule), keys)
        .groupBy(*keys)
        .agg(F.sum(F.bit_count("bits")).alias("__seen"), F.max("points").alias("__points"))
        .select(
            *keys,
            (F.col("__seen") / F.col("__points")).alias("percent"),
            (F.col("__seen") * STEP_SECONDS).alias("times"),
        )
    )


def item_schedule(items: DataFrame, notices: DataFrame) -> DataFrame:
    """Course item -> start and end of its notice (of several rows of a notice the earliest)."""
    first = notices.groupBy(F.col("id").alias("circle_notice_id")).agg(
        F.min(F.struct("start_time", "end_time")).alias("n")
    ).select("circle_notice_id", "n.*")
    return items.join(first, "circle_notice_id", "left").select(
        F.col("id").alias("item"), "start_time", "end_time"
    )


def progress_json(progress: DataFrame) -> DataFrame:
    text = F.to_json(
        F.struct(F.col("percent").cast("string").alias("percent"),
                 F.col("times").cast("string").alias("times"))
    )
    return progress.select("uid", "item", "env", text.alias("position"))
