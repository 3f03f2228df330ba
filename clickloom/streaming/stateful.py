"""Stateful stream processors: live sessions, read counter, online users.

State is kept per small key (user and room, user and article, room and shard),
so a popular room or article spreads over many state keys.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from clickloom.operators.reads import GAP_MS as READ_GAP_MS
from clickloom.operators.sessions import GAP_MS, LINGER_MS

STATE_STORE = {
    "spark.sql.streaming.stateStore.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    ),
    # All stores of an executor share one bound of native memory, however many queries keep state there.
    "spark.sql.streaming.stateStore.rocksdb.boundedMemoryUsage": "true",
    "spark.sql.streaming.stateStore.rocksdb.maxMemoryUsageMB": "1024",
}
CARRY = ["title", "content", "message_id", "lcs_name"]
SESSION_SCHEMA = (
    "type string, uid string, lcs_id string, title string, content string, message_id string,"
    " lcs_name string, ms bigint, stay_time bigint"
)


def _frame(records: list[dict]):
    """Output rows as plain objects, or nothing where there are none."""
    if records:
        yield pd.DataFrame(records).astype(object)


def use_rocksdb(spark) -> None:
    for key, value in STATE_STORE.items():
        spark.conf.set(key, value)


OPEN = "first bigint, last bigint, entered boolean, " + ", ".join(
    f"{end}_{c} string" for end in ("first", "last") for c in CARRY
)


class LiveSessions(StatefulProcessor):
    """Emits enter once a session's first row is certain and leave once the gap has passed.

    Rows may come in any order within the watermark's delay: the open sessions of
    a key are a list, and a row opens one, extends one or joins two. Nothing is
    emitted before the watermark rules out an earlier row.
    """

    def __init__(self, gap_ms: int = GAP_MS, linger_ms: int = LINGER_MS):
        self.gap_ms = gap_ms
        self.linger_ms = linger_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.sessions = handle.getListState("sessions", OPEN)

    def _row(self, kind, key, values, ms, stay):
        return {
            "type": kind, "uid": key[0], "lcs_id": key[1],
            **dict(zip(CARRY, values)), "ms": ms, "stay_time": stay,
        }

    def _open(self):
        """[(first, values), (last, values), entered] in time order."""
        n = len(CARRY)
        kept = [tuple(s) for s in self.sessions.get()]
        return sorted([(s[0], *s[3:3 + n]), (s[1], *s[3 + n:]), s[2]] for s in kept)

    def _timers(self, open_sessions):
        return {t for first, last, entered in open_sessions
                for t in (*([] if entered else [first[0]]), last[0] + self.gap_ms + 1)}

    def _keep(self, open_sessions, before):
        if open_sessions:
            self.sessions.put([
                (first[0], last[0], entered, *first[1:], *last[1:])
                for first, last, entered in open_sessions
            ])
        else:
            self.sessions.clear()
        now = self._timers(open_sessions)
        for t in before - now:
            self.handle.deleteTimer(t)
        for t in now - before:
            self.handle.registerTimer(t)

    def _joined(self, found):
        """Sessions in time order; those within the gap of each other become one."""
        out = []
        for first, last, entered in sorted(found):
            if out and first[0] - out[-1][1][0] <= self.gap_ms:
                out[-1] = [out[-1][0], max(out[-1][1], last), out[-1][2] or entered]
            else:
                out.append([first, last, entered])
        return out

    def handleInputRows(self, key, rows, timerValues):
        found = self._open()
        before = self._timers(found)
        for pdf in rows:  # each chunk is reduced before the next one is read
            new = [[r, r, False] for r in zip(pdf["ms"].astype(int), *[pdf[c] for c in CARRY])]
            found = self._joined(found + new)
        self._keep(found, before)
        yield from _frame([])

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
        now = expiredTimerInfo.getExpiryTimeInMs()
        found = self._open()
        before = self._timers(found) - {now}
        out, stay = [], []
        for first, last, entered in found:
            if not entered and first[0] <= now:
                out.append(self._row("enter_live", key, first[1:], first[0], 0))
                entered = True
            if last[0] + self.gap_ms + 1 <= now:
                seconds = (last[0] - first[0] + self.linger_ms) // 1000
                out.append(self._row("leave_live", key, last[1:], last[0] + self.linger_ms, seconds))
            else:
                stay.append([first, last, entered])
        self._keep(stay, before)
        yield from _frame(out)

    def close(self) -> None:
        pass


def stream_sessions(rows: DataFrame, delay: str = "10 seconds", gap_ms: int = GAP_MS,
                    linger_ms: int = LINGER_MS) -> DataFrame:
    """Live-room sessions of a stream with uid, lcs_id, the carried columns and ms."""
    timed = rows.withColumn("ts", F.timestamp_millis("ms")).withWatermark("ts", delay)
    picked = timed.select("uid", "lcs_id", *CARRY, "ms", "ts")
    return picked.groupBy("uid", "lcs_id").transformWithStateInPandas(
        LiveSessions(gap_ms, linger_ms),
        outputStructType=SESSION_SCHEMA,
        outputMode="Append",
        timeMode="EventTime",
    )


def stream_closed_sessions(rows: DataFrame, delay: str = "10 seconds", gap_ms: int = GAP_MS,
                           linger_ms: int = LINGER_MS) -> DataFrame:
    """The records of stream_sessions with built-in operators only, both when a session has closed.

    The engine merges the rows of a session in its own state, without Python; the enter
    record then comes as late as the leave record. stream_sessions gives it at once.
    """
    timed = rows.withColumn("ts", F.timestamp_millis("ms")).withWatermark("ts", delay)
    seen = F.struct("ms", *CARRY)
    closed = timed.groupBy("uid", "lcs_id", F.session_window("ts", f"{gap_ms} milliseconds")).agg(
        F.min(seen).alias("first"), F.max(seen).alias("last")
    )
    stay = F.floor((F.col("last.ms") - F.col("first.ms") + linger_ms) / 1000)

    def record(kind, end, ms, stay_time):
        return F.struct(
            F.lit(kind).alias("type"), *[F.col(f"{end}.{c}").alias(c) for c in CARRY],
            ms.cast("bigint").alias("ms"), stay_time.cast("bigint").alias("stay_time"),
        )

    both = F.array(
        record("enter_live", "first", F.col("first.ms"), F.lit(0)),
        record("leave_live", "last", F.col("last.ms") + linger_ms, stay),
    )
    return closed.select("uid", "lcs_id", F.inline(both)).select(
        "type", "uid", "lcs_id", *CARRY, "ms", "stay_time"
    )


def closed_sessions(rows: DataFrame, delay: str = "10 seconds", gap: str = "15 seconds",
                    linger_ms: int = LINGER_MS) -> DataFrame:
    """Finished sessions with built-in operators only: one row each, after the watermark.

    Each (user, room) is merged by the engine; prefer this where the enter
    record is not needed at once.
    """
    timed = rows.withColumn("ts", F.timestamp_millis("ms")).withWatermark("ts", delay)
    return (
        timed.groupBy("uid", "lcs_id", F.session_window("ts", gap))
        .agg(F.min("ms").alias("first_ms"), F.max("ms").alias("last_ms"),
             F.count("*").alias("n_rows"))
        .select(
            "uid", "lcs_id", "first_ms", "last_ms", "n_rows",
            F.floor((F.col("last_ms") - F.col("first_ms") + linger_ms) / 1000).alias("stay_time"),
        )
    )


class ReadCounter(StatefulProcessor):
    """Counts a read when it is the first, or more than the gap after the last counted one.

    The chain has to be followed in time order, so times wait until the watermark
    has passed them. The last counted time is forgotten once every later read
    counts anyway; the number counted stays in state, to be read by running.read_read_totals.
    """

    def __init__(self, gap_ms: int = READ_GAP_MS):
        self.gap_ms = gap_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.last = handle.getValueState("last", "ms bigint")
        self.waiting = handle.getMapState("waiting", "ms bigint", "n int")
        self.total = handle.getValueState("total", "n bigint")

    def handleInputRows(self, key, rows, timerValues):
        for pdf in rows:
            for t in pdf["ms"].unique().tolist():
                if not self.waiting.containsKey((t,)):
                    self.waiting.updateValue((t,), (1,))
                    self.handle.registerTimer(t)
        yield from _frame([])

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
        # Timers of a key come in the order of their times; those due by now are taken at once.
        now = expiredTimerInfo.getExpiryTimeInMs()
        last = self.last.get()[0] if self.last.exists() else None
        due = sorted(k[0] for k in self.waiting.keys() if k[0] <= now)
        old, counted = last, 0
        for t in due:
            self.waiting.removeKey((t,))
            if last is None or t > last + self.gap_ms:
                counted += 1
                last = t
        if last != old:
            self.last.update((last,))
            self.handle.registerTimer(last + self.gap_ms + 1)
        elif last is not None and now > last + self.gap_ms and not due:
            self.last.clear()
        if counted:
            self.total.update(((self.total.get()[0] if self.total.exists() else 0) + counted,))
        yield from _frame([{"message_id": key[0], "uid": key[1], "num": counted}] if counted else [])

    def close(self) -> None:
        pass


def stream_reads(rows: DataFrame, delay: str = "20 seconds", gap_ms: int = READ_GAP_MS):
    """(message_id, uid, num) increments of counted reads; the totals are in the state."""
    timed = rows.withColumn("ts", F.timestamp_millis("ms")).withWatermark("ts", delay)
    return (
        timed.select("message_id", "uid", "ms", "ts")
        .groupBy("message_id", "uid")
        .transformWithStateInPandas(
            ReadCounter(gap_ms),
            outputStructType="message_id string, uid string, num bigint",
            outputMode="Append",
            timeMode="EventTime",
        )
    )


class OnlineUsers(StatefulProcessor):
    """Members of one shard of a room: added on status 1, removed on status 0."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.members = handle.getMapState("members", "uid string", "time string")
        self.size = handle.getValueState("size", "n bigint")

    def handleInputRows(self, key, rows, timerValues):
        last = pd.DataFrame(columns=["uid", "status", "time"])
        for pdf in rows:  # one row a user is left of each chunk before the next one is read
            both = pd.concat([last, pdf[["uid", "status", "time"]]]) if len(last) else pdf[["uid", "status", "time"]]
            last = both.sort_values(["time", "status"]).drop_duplicates("uid", keep="last")
        size = self.size.get()[0] if self.size.exists() else 0
        for row in last.itertuples(index=False):
            known = self.members.containsKey((row.uid,))
            if row.status == "1":
                size += 0 if known else 1
                self.members.updateValue((row.uid,), (row.time,))
            elif row.status == "0" and known:
                self.members.removeKey((row.uid,))
                size -= 1
        self.size.update((size,))
        yield from _frame([{"room": key[0], "shard": key[1], "online": size}])

    def close(self) -> None:
        pass


def stream_online(rows: DataFrame, shards: int = 16) -> DataFrame:
    """Current size of every changed (room, shard); a room is the sum of its shards."""
    shard = F.pmod(F.xxhash64("uid"), F.lit(shards)).cast("int").alias("shard")
    return (
        rows.select("room", shard, "uid", "status", "time")
        .groupBy("room", "shard")
        .transformWithStateInPandas(
            OnlineUsers(),
            outputStructType="room string, shard int, online bigint",
            outputMode="Update",
            timeMode="None",
        )
    )


def room_totals(shards: DataFrame) -> DataFrame:
    """Newest size of every shard (column `batch` orders the updates), summed per room."""
    now = shards.groupBy("room", "shard").agg(F.max_by("online", "batch").alias("online"))
    return now.groupBy("room").agg(F.sum("online").alias("online"))
