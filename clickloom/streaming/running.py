"""Running tables kept in the engine's state: totals, flags, last rows and watched points.

A table is a stateful stream in update mode. Its state lives in the state store of
the query's checkpoint; every batch hands out the rows it changed, and the whole
table is read back from the checkpoint by the state data source. Nothing that was
written before is read or rewritten by a batch.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from clickloom.functions import clock
from clickloom.operators import answers, progress, rules
from clickloom.operators.parsing import with_properties
from clickloom.operators.routing import env_of, has_id
from clickloom.streaming.stateful import _frame

KEYS = [
    ("v1_element_content", "content"), ("v1_message_id", "message_id"), ("v1_lcs_id", "lcs_id"),
    ("v1_notice_id", "notice_id"), ("v1_uid", "uid"),
]
PLAY_MS = 600_000
# Tables of the app job and what their keys are made of.
TABLES = {
    "shares": ["metric", "lcs_id", "day"],
    "messages": ["field"],
    "pushes": ["notice_id"],
    "plays": ["window_ms", "type", "msg_id"],
    "flags": ["env", "ques_id", "uid"],
}


def app_updates(events: DataFrame, project: str | None, envs: dict[str, str], tz: str = "UTC") -> DataFrame:
    """(table, key, num, flags): every booking of an event, the properties read once.

    A share counts per adviser and day and per message, a push opening per notice, a play
    per ten minutes and content; a visit of an answering page sets its flag's bit.
    """
    rows = with_properties(events, KEYS)
    event, content = F.col("event"), F.col("content")
    ours = F.lit(True) if project is None else F.col("project") == project
    ms = clock.text_to_millis(F.col("time"))
    shared = ours & rules.SHARE.match(event, content) & ms.isNotNull()
    kind = rules.SHARE.code(content)
    played = ours & rules.CONTENT_PLAY.match(event, content) & (F.col("message_id") != "") & ms.isNotNull()
    env, page = env_of(F.col("project"), envs), rules.ANSWER_PAGE.code(content)
    bits = [x for i, name in enumerate(answers.FLAGS) for x in (F.lit(name), F.lit(1 << i))]
    flag = F.try_element_at(F.create_map(*bits), page)
    visited = rules.ANSWER_PAGE.match(event, content) & env.isNotNull()

    def booking(table: str, when: Column, *key: Column, flags: Column | None = None) -> Column:
        values = [k.cast("string") for k in key]
        return F.when(
            when,
            F.struct(F.lit(table).alias("table"), F.array(*values).alias("key"), F.lit(1).cast("bigint").alias("num"),
                     (F.lit(0) if flags is None else flags).cast("int").alias("flags")),
        )

    bookings = [
        booking("shares", shared & (F.col("lcs_id") != ""), F.concat(kind, F.lit("_num")), F.col("lcs_id"),
                clock.format_millis(ms, clock.DAY, tz)),
        booking("messages", shared & (F.col("message_id") != ""), F.concat(kind, F.lit("_"), "message_id")),
        booking("pushes", rules.PUSH_OPEN.match(event, content) & has_id(F.col("notice_id")), F.col("notice_id")),
        booking("plays", played, clock.floor_millis(ms, PLAY_MS), rules.CONTENT_PLAY.code(content), F.col("message_id")),
        booking("flags", visited, env, F.col("message_id"), F.col("uid"), flags=flag),
    ]
    # Most events book nothing; they are gone before the explode.
    hits = F.filter(F.array(*bookings), lambda b: b.isNotNull())
    return rows.select(F.inline(hits))


def totals(updates: DataFrame) -> DataFrame:
    """Running (num, flags) of each (table, key), for update mode: sums, and the bits ever set."""
    return updates.groupBy("table", "key").agg(F.sum("num").alias("num"), F.bit_or("flags").alias("flags"))


def last_rows(rows: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """The newest row of each key by `order` (ties: the greatest row), for update mode."""
    rest = [c for c in rows.columns if c not in keys]
    best = F.max_by(F.struct(*rest), F.struct(*order, *[F.col(c).alias(f"__{c}") for c in rest]))
    return rows.groupBy(*keys).agg(best.alias("row"))


def state_of(spark: SparkSession, checkpoint: str, variable: str | None = None, batch: int | None = None) -> DataFrame:
    """(key, value) of a stateful query as of its last batch, or as of `batch`."""
    reader = spark.read.format("statestore")
    if variable:
        reader = reader.option("stateVarName", variable)
    if batch is not None:
        reader = reader.option("batchId", batch)
    return reader.load(checkpoint).select("key", "value")


def read_totals(spark: SparkSession, checkpoint: str, table: str, batch: int | None = None) -> DataFrame:
    """A table of `totals` as its state has it: the columns of its key, num and flags."""
    state = state_of(spark, checkpoint, batch=batch).where(F.col("key.table") == table)
    value = [F.col(f"value.{f.name}") for f in state.schema["value"].dataType.fields][-2:]
    key = F.col("key.key")
    names = [F.get(key, F.lit(i)).alias(n) for i, n in enumerate(TABLES[table])]
    return state.select(*names, value[0].alias("num"), value[1].alias("flags"))


def read_flags(spark: SparkSession, checkpoint: str) -> DataFrame:
    """(env, ques_id, uid) with 1 or NULL for each page visited, as answers.page_flags gives it."""
    found = read_totals(spark, checkpoint, "flags")
    shown = [F.when(F.col("flags").bitwiseAND(1 << i) > 0, 1).alias(n) for i, n in enumerate(answers.FLAGS)]
    return found.select(*TABLES["flags"], *shown)


class WatchedPoints(StatefulProcessor):
    """Bits of the grid points a key has watched, 64 to a word; a batch touches its own words only."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.words = handle.getMapState("words", "word bigint", "bits bigint")
        self.seen = handle.getValueState("seen", "seen bigint, points bigint")

    def handleInputRows(self, key, rows, timerValues):
        fresh: dict[int, int] = {}
        points = None
        for pdf in rows:  # each chunk is reduced before the next one is read
            points = int(pdf["points"].iloc[0])
            for idx in pdf["idx"].dropna().astype("int64").unique().tolist():
                if 0 <= idx < points:
                    fresh[idx >> 6] = fresh.get(idx >> 6, 0) | 1 << (idx & 63)
        seen = self.seen.get()[0] if self.seen.exists() else 0
        for word, bits in fresh.items():
            old = self.words.getValue((word,))[0] % (1 << 64) if self.words.containsKey((word,)) else 0
            if bits & ~old:
                now = old | bits
                seen += now.bit_count() - old.bit_count()
                self.words.updateValue((word,), (now - (1 << 64) if now >> 63 else now,))
        self.seen.update((seen, points))
        names = ("uid", "item", "env")
        yield from _frame([{**dict(zip(names, key)), "percent": seen / points, "times": seen * progress.STEP_SECONDS}])

    def close(self) -> None:
        pass


PROGRESS = "uid string, item string, env string, percent double, times bigint"


def stream_progress(events: DataFrame, schedule: DataFrame, envs: dict[str, str]) -> DataFrame:
    """Progress of everyone who got a mark, for update mode; `schedule` is a table of item, start_ms, end_ms."""
    marked = progress.mark_rows(events, envs)
    return (
        progress.indexed(marked, schedule)
        .groupBy("uid", "item", "env")
        .transformWithStateInPandas(
            WatchedPoints(), outputStructType=PROGRESS, outputMode="Update", timeMode="None"
        )
    )


def read_progress(spark: SparkSession, checkpoint: str) -> DataFrame:
    """The progress of all keys as the state has it."""
    state = state_of(spark, checkpoint, "seen")
    seen, points = F.col("value.seen"), F.col("value.points")
    return state.select(
        "key.uid", "key.item", "key.env", (seen / points).alias("percent"),
        (seen * progress.STEP_SECONDS).alias("times"),
    )


def read_read_totals(spark: SparkSession, checkpoint: str) -> DataFrame:
    """Counted reads per article from the state of stateful.stream_reads."""
    state = state_of(spark, checkpoint, "total")
    return state.groupBy(F.col("key.message_id").alias("message_id")).agg(F.sum("value.n").alias("num"))
