"""Streams against their batch forms, replays, late rows."""

import json
import os
import random
import time

from conftest import rows
from pyspark.sql import functions as F

from clickloom.functions import clock
from clickloom.operators import answers, counters, online, progress, reads, routing, sessions, upserts
from clickloom.plans import app
from clickloom.registry.base import COVER_ENVS, ENVS, Tables
from clickloom.sinks import tables
from clickloom.sources import streams
from clickloom.streaming import jobs, running, stateful, windows


def write_files(folder, batches):
    """One file per batch, in order."""
    folder.mkdir(parents=True, exist_ok=True)
    now = time.time() - 1000
    for i, batch in enumerate(batches):
        path = folder / f"{i:04d}.json"
        path.write_text("\n".join(json.dumps(r, ensure_ascii=False) for r in batch))
        import os

        os.utime(path, (now + i, now + i))
    return str(folder)


def read_json(spark, folder, schema):
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).json(folder)


def drain(query):
    query.awaitTermination()


def collected(df, path, checkpoint, mode="append"):
    """Run a stream to the end; every batch is kept with its number."""

    def keep(batch, batch_id):
        tables.overwrite_partition(batch.withColumn("batch", F.lit(batch_id)), path, "batch")

    drain(
        df.writeStream.outputMode(mode).option("checkpointLocation", checkpoint)
        .trigger(availableNow=True).foreachBatch(keep).start()
    )
    return df.sparkSession.read.parquet(path)


VISIT = "uid string, lcs_id string, title string, content string, message_id string," \
        " lcs_name string, ms bigint"


def visit(uid, ms, room="r"):
    return {"uid": uid, "lcs_id": room, "title": f"t{ms}", "content": "c", "message_id": "m",
            "lcs_name": "n", "ms": ms}


def shuffled(data, delay_ms, rnd):
    """Rows in an order that puts none behind a row more than the delay later."""
    return sorted(data, key=lambda r: r["ms"] + rnd.randrange(delay_ms))


def check_sessions(spark, tmp_path, data, step):
    batches = [data[i:i + step] for i in range(0, len(data), step)]
    batches += [[visit("end", 9_000_000)], [visit("end", 9_100_000)]]
    folder = write_files(tmp_path / "in", batches)
    batch = sessions.live_sessions(spark.createDataFrame([tuple(r.values()) for r in data], VISIT))
    for name in ("stream_sessions", "stream_closed_sessions"):
        out = getattr(stateful, name)(read_json(spark, folder, VISIT))
        got = collected(out, str(tmp_path / f"out-{name}"), str(tmp_path / f"cp-{name}")).where("uid <> 'end'")
        shown = got.select("type", "uid", "title", clock.format_millis(F.col("ms")).alias("time"),
                           "stay_time")
        assert rows(shown) == rows(batch, "type", "uid", "title", "time", "stay_time")


def test_live_sessions_stream_equals_batch_out_of_order(spark, tmp_path):
    rnd = random.Random(3)
    data = [visit(f"u{rnd.randrange(6)}", 1_000_000 + rnd.randrange(600) * 1000) for _ in range(150)]
    check_sessions(spark, tmp_path, shuffled(data, 9_000, rnd), 30)


def test_a_late_row_joins_two_sessions(spark, tmp_path):
    times = [0, 10_000, 30_000, 22_000]
    check_sessions(spark, tmp_path, [visit("u", 1_000_000 + t) for t in times], 2)


def test_rows_a_gap_apart_are_one_session(spark, tmp_path):
    times = [0, sessions.GAP_MS, 2 * sessions.GAP_MS + 1]
    check_sessions(spark, tmp_path, [visit("u", 1_000_000 + t) for t in times], 3)


def test_closed_sessions_stream(spark, tmp_path):
    data = [visit("u", 1_000_000), visit("u", 1_010_000), visit("u", 1_040_000)]
    folder = write_files(tmp_path / "in", [data, [visit("end", 9_000_000)], [visit("end", 9_200_000)]])
    out = stateful.closed_sessions(read_json(spark, folder, VISIT))
    got = collected(out, str(tmp_path / "out"), str(tmp_path / "cp")).where("uid = 'u'")
    assert rows(got, "first_ms", "last_ms", "n_rows", "stay_time") == [
        (1_000_000, 1_010_000, 2, 13), (1_040_000, 1_040_000, 1, 3)]


READ = "message_id string, uid string, ms bigint"


def check_reads(spark, tmp_path, data, step):
    end = [[{"message_id": "end", "uid": "end", "ms": 9_000_000 + i * 1_000_000}] for i in range(2)]
    folder = write_files(tmp_path / "in", [data[i:i + step] for i in range(0, len(data), step)] + end)
    out = stateful.stream_reads(read_json(spark, folder, READ))
    got = collected(out, str(tmp_path / "out"), str(tmp_path / "cp")).where("uid <> 'end'")
    per_article = got.groupBy("message_id").agg(F.sum("num").alias("num"))
    batch = reads.article_reads(spark.createDataFrame([tuple(r.values()) for r in data], READ))
    assert rows(per_article, "message_id", "num") == rows(batch, "message_id", "num")


def test_read_counter_stream_equals_batch_out_of_order(spark, tmp_path):
    rnd = random.Random(5)
    data = [{"message_id": f"a{rnd.randrange(3)}", "uid": f"u{rnd.randrange(5)}",
             "ms": 1_000_000 + rnd.randrange(900) * 1000} for _ in range(300)]
    check_reads(spark, tmp_path, shuffled(data, 19_000, rnd), 50)


def test_an_earlier_read_comes_late(spark, tmp_path):
    times = [100_000, 90_000, 195_000]
    check_reads(spark, tmp_path, [{"message_id": "a", "uid": "u", "ms": t} for t in times], 1)


STATUS = "room string, uid string, status string, time string"


def test_online_users_stream_equals_batch(spark, tmp_path):
    rnd = random.Random(7)
    data = [
        {"room": f"1000{rnd.randrange(3)}", "uid": f"u{rnd.randrange(20)}",
         "status": rnd.choice("01"), "time": f"{1000 + i}"} for i in range(200)
    ]
    folder = write_files(tmp_path / "in", [data[i:i + 40] for i in range(0, 200, 40)])
    out = stateful.stream_online(read_json(spark, folder, STATUS), shards=4)
    got = collected(out, str(tmp_path / "out"), str(tmp_path / "cp"), "update")
    batch = online.room_online(spark.createDataFrame([tuple(r.values()) for r in data], STATUS))
    assert rows(stateful.room_totals(got), "room", "online") == rows(batch, "room", "online")


EVENT = "event_type string, user_id bigint, ms bigint"


def _event_files(spark, sf, tmp_path, parts=4):
    """Events of the test data as ordered files, plus a closing row far in the future."""
    e = Tables(spark, sf).events.select("event_type", "user_id", "ms").orderBy("ms")
    data = [r.asDict() for r in e.collect()]
    step = len(data) // parts + 1
    batches = [data[i:i + step] for i in range(0, len(data), step)]
    far = {"event_type": "end", "user_id": -1, "ms": data[-1]["ms"] + 10**9}
    batches += [[far], [{**far, "ms": far["ms"] + 10**9}]]
    return e, write_files(tmp_path / "in", batches)


def test_window_counts_stream_equals_batch(spark, sf, tmp_path):
    e, folder = _event_files(spark, sf, tmp_path)
    timed = windows.event_time(read_json(spark, folder, EVENT), F.col("ms"), "40 seconds")
    out = windows.window_counts(timed, "10 minutes", ["event_type"])
    got = collected(out, str(tmp_path / "out"), str(tmp_path / "cp")).where("event_type <> 'end'")
    batch = counters.count_per_window(
        e.withColumn("ts", F.timestamp_millis("ms")), F.col("ts"), "10 minutes", ["event_type"])
    assert rows(got, "window_start", "event_type", "num") == rows(
        batch, "window_start", "event_type", "num")


def test_sliding_devices_stream_equals_batch(spark, sf, tmp_path):
    e, folder = _event_files(spark, sf, tmp_path)
    timed = windows.event_time(read_json(spark, folder, EVENT), F.col("ms"), "10 seconds")
    out = windows.window_devices(timed, "60 minutes", ["event_type"], "user_id", "30 minutes")
    got = collected(out, str(tmp_path / "out"), str(tmp_path / "cp")).where("event_type <> 'end'")
    batch = online.window_viewers(
        e.withColumn("ts", F.timestamp_millis("ms")), "ts", ["event_type"], "user_id",
        "60 minutes", "30 minutes")
    names = ["window_start", "event_type", "online_counts", "count_time"]
    assert rows(got, *names) == rows(batch, *names)


def test_day_members_fire_early(spark, tmp_path):
    data = [{"event_type": "r", "user_id": i % 2, "ms": 1_704_067_200_000 + i} for i in range(4)]
    folder = write_files(tmp_path / "in", [data[:2], data[2:]])
    timed = windows.event_time(read_json(spark, folder, EVENT), F.col("ms"), "1 hour")
    out = windows.window_members(timed, "1 day", ["event_type"], "user_id", start="16 hours")
    got = collected(out, str(tmp_path / "out"), str(tmp_path / "cp"), "update")
    assert rows(got.where("batch = 0"), "user_id", "num") == [(0, 1), (1, 1)]
    assert rows(got.where("batch = 1"), "user_id", "num") == [(0, 2), (1, 2)]
    assert str(got.first()["window_start"]) == "2023-12-31 16:00:00"


def test_running_counts_update(spark, tmp_path):
    data = [{"event_type": "r", "user_id": 1, "ms": i} for i in range(3)]
    folder = write_files(tmp_path / "in", [data[:1], data[1:]])
    out = windows.running_counts(read_json(spark, folder, EVENT), ["event_type"])
    got = collected(out, str(tmp_path / "out"), str(tmp_path / "cp"), "update")
    assert rows(got, "batch", "num") == [(0, 1), (1, 3)]


def test_repeated_polls_are_dropped(spark, tmp_path):
    data = [{"event_type": "r", "user_id": i, "ms": 1000 * (i + 1)} for i in range(6)]
    folder = write_files(tmp_path / "in", [data[:4], data[2:]])
    timed = read_json(spark, folder, EVENT).withColumn("ts", F.timestamp_millis("ms"))
    out = streams.without_repeats(timed, ["user_id"], "ts", "1 hour")
    got = collected(out, str(tmp_path / "out"), str(tmp_path / "cp"))
    assert rows(got, "user_id") == [(i,) for i in range(6)]


def run_late(spark, tmp_path, folder):
    source = windows.event_time(read_json(spark, folder, EVENT), F.col("ms"), "40 seconds")

    def into(name):
        def write(batch, batch_id):
            tables.overwrite_partition(
                batch.withColumn("batch", F.lit(batch_id)), str(tmp_path / name), "batch")
        return write

    split = windows.late_rows(str(tmp_path / "cp"), into("ok"), into("late"))
    drain(source.writeStream.option("checkpointLocation", str(tmp_path / "cp"))
          .trigger(availableNow=True).foreachBatch(split).start())


def test_late_rows_equal_what_the_engine_drops_after_a_restart_too(spark, tmp_path):
    rnd = random.Random(9)
    data = [{"event_type": "e", "user_id": i, "ms": 1_000_000 + i * 2_000 + rnd.randrange(-70_000, 10_000)} for i in range(120)]
    folder = write_files(tmp_path / "in", [data[i:i + 30] for i in range(0, 60, 30)])
    run_late(spark, tmp_path, folder)
    write_files(tmp_path / "more", [data[i:i + 30] for i in range(60, 120, 30)])
    for i in range(2):  # the stream goes on where it was
        os.rename(tmp_path / "more" / f"{i:04d}.json", tmp_path / "in" / f"{2 + i:04d}.json")
        run_late(spark, tmp_path, folder)
    late, mark, top = set(), None, 0
    for i in range(0, 120, 30):
        late |= {r["user_id"] for r in data[i:i + 30] if mark is not None and r["ms"] < mark}
        top = max(top, *(r["ms"] for r in data[i:i + 30]))
        mark = top - 40_000
    got = {r.user_id for r in spark.read.parquet(str(tmp_path / "late")).collect()}
    kept = {r.user_id for r in spark.read.parquet(str(tmp_path / "ok")).collect()}
    assert got == late and len(late) > 5 and kept == set(range(120)) - late


def test_late_rows_go_aside(spark, tmp_path):
    first = [{"event_type": "a", "user_id": 1, "ms": 100_000}]
    second = [
        {"event_type": "on time", "user_id": 2, "ms": 100_001},
        {"event_type": "within", "user_id": 3, "ms": 60_001},
        {"event_type": "late", "user_id": 4, "ms": 59_999},
    ]
    folder = write_files(tmp_path / "in", [first, second])
    run_late(spark, tmp_path, folder)
    assert rows(spark.read.parquet(str(tmp_path / "late")), "event_type") == [("late",)]
    assert rows(spark.read.parquet(str(tmp_path / "ok")), "event_type") == [
        ("a",), ("on time",), ("within",)]


def _line_files(spark, sf, tmp_path, parts=3):
    lines = [r["line"] for r in Tables(spark, sf).app_lines.orderBy("event_id").collect()]
    folder = tmp_path / "lines"
    folder.mkdir()
    step = len(lines) // parts + 1
    for i in range(parts):
        (folder / f"{i:03d}.txt").write_text("\n".join(lines[i * step:(i + 1) * step]))
    return str(folder)


def test_app_job_fans_out_one_parsed_stream(spark, sf, tmp_path):
    folder = _line_files(spark, sf, tmp_path)
    out = str(tmp_path)
    steps = [
        jobs.visits_step(f"{out}/lists", "app"),
        jobs.course_step(f"{out}/course", ENVS, tee=":copy"),
        jobs.marks_step(f"{out}/marks", ENVS),
        jobs.answers_step(f"{out}/answers", ENVS),
    ]
    drain(jobs.run(streams.read_folder(spark, folder), steps, f"{out}/cp"))
    events = Tables(spark, sf).app_events.drop("event_id")
    lists = tables.read_lists(spark, f"{out}/lists")
    assert lists.count() == routing.page_visits(events, "app").count()
    drain(jobs.running_tables(streams.read_folder(spark, folder, 1), "app", ENVS, f"{out}/changes", f"{out}/cp2"))

    def table(name):
        return running.read_totals(spark, f"{out}/cp2", name)

    pushes = table("pushes")
    assert rows(pushes, "notice_id", "num") == rows(
        counters.count_per(routing.push_rows(events), ["notice_id"]), "notice_id", "num")
    shares = table("shares")
    direct = counters.count_per(
        routing.share_rows(events, "app").select(
            F.concat("type", F.lit("_num")).alias("metric"), "lcs_id",
            clock.format_millis(F.col("ms"), clock.DAY).alias("day")),
        ["metric", "lcs_id", "day"])
    assert rows(shares, "metric", "lcs_id", "day", "num") == rows(
        direct, "metric", "lcs_id", "day", "num")
    course = tables.read_lists(spark, f"{out}/course")
    assert course.where("list like '%:copy'").count() * 2 == course.count() > 0
    marks = spark.read.parquet(f"{out}/marks").drop("batch").distinct()
    # A replay offset that is all digits is read back as a number, as partition values are.
    assert marks.count() == progress.watch_marks(events, ENVS).count() > 0
    direct = answers.page_flags(answers.answer_rows(events, ENVS))
    columns = ["env", "ques_id", "uid", *answers.FLAGS]
    assert rows(running.read_flags(spark, f"{out}/cp2"), *columns) == rows(direct, *columns) != []
    history = spark.read.parquet(f"{out}/answers/history")
    assert history.count() >= answers.answer_history(answers.answer_rows(events, ENVS)).count() > 0
    # A batch hands out the rows it changed, each with its total so far.
    changes = spark.read.parquet(f"{out}/changes")
    newest = changes.groupBy("table", "key").agg(F.max_by("num", "batch").alias("num")).where("table = 'pushes'")
    assert rows(newest, F.get("key", F.lit(0)), "num") == rows(pushes, "notice_id", "num")


def test_insurance_td_counts_and_progress_routes(spark, sf, tmp_path):
    folder = _line_files(spark, sf, tmp_path)
    out = str(tmp_path)
    events = Tables(spark, sf).app_events.drop("event_id")
    marks = progress.watch_marks(events, ENVS).withColumn("item", F.col("item").cast("string"))
    span = marks.where("mode = 'live'").groupBy("item").agg(
        F.min("bucket").alias("start_ms"), F.max("bucket").alias("end_ms"))
    span.write.parquet(f"{out}/schedule")
    steps = [
        jobs.insurance_step(f"{out}/cover", "cover", COVER_ENVS, tee=":copy"),
        jobs.td_step(f"{out}/td", "app"),
    ]
    drain(jobs.run(streams.read_folder(spark, folder), steps, f"{out}/cp"))
    drain(jobs.running_tables(streams.read_folder(spark, folder, 1), "app", ENVS, None, f"{out}/cp2"))
    drain(jobs.course_progress(streams.read_folder(spark, folder, 1), spark.read.parquet(f"{out}/schedule"), ENVS,
                               f"{out}/changes", f"{out}/cp3"))

    start = clock.millis_to_ts(F.col("window_ms").cast("bigint")).alias("window_start")
    plays = running.read_totals(spark, f"{out}/cp2", "plays").select(start, "type", "msg_id", "num")
    direct = app.content_plays(events, "app")
    columns = ["window_start", "type", "msg_id", "num"]
    assert rows(plays, *columns) == rows(direct, *columns) != []
    per_message = running.read_totals(spark, f"{out}/cp2", "messages").select("field", "num")
    shared = counters.shares_by_message(routing.share_rows(events, "app"))
    assert rows(per_message) == rows(shared.groupBy("field").agg(F.sum("num"))) != []

    lists = tables.read_lists(spark, f"{out}/cover/routes")
    direct = rows(routing.cover_routes(events, "cover"), F.col("route").alias("list"), "value")
    assert rows(lists.where("list not like '%:copy'"), "list", "value") == direct != []
    assert rows(lists.where("list like '%:copy'"), F.replace("list", F.lit(":copy"), F.lit("")), "value") == direct
    copied = tables.read_lists(spark, f"{out}/cover/mirror")
    assert rows(copied, "list", "value") == rows(routing.mirror(events, COVER_ENVS), "env", "value") != []
    td = rows(routing.td_detail(events, "app").select(F.to_json(F.struct("*"))))
    assert rows(tables.read_lists(spark, f"{out}/td"), "value") == td != []

    done = running.read_progress(spark, f"{out}/cp3")
    columns = ["uid", "item", "env", "percent", "times"]
    direct = progress.watch_progress(marks, spark.read.parquet(f"{out}/schedule"))
    assert rows(done, *columns) == rows(direct, *columns) != []


def test_session_and_read_jobs_from_raw_lines(spark, sf, tmp_path):
    t = Tables(spark, sf)
    lines = [r["line"] for r in t.app_lines.orderBy("ts").collect()]
    parsed = [json.loads(x) for x in lines]
    ends = []
    for i in range(2):  # rows far in the future move the watermark past all others
        for name in ("视频直播页访问", "金股天下_文章访问"):
            last = next(x for x in parsed if x["properties"]["v1_element_content"] == name)
            late = {"userID": "end", "wx_uid": "end", "v1_message_title": "end", "v1_message_id": "end"}
            ends.append(json.dumps({**last, "time": 4_000_000_000_000 + i * 10**9,
                                    "properties": {**last["properties"], **late}}, ensure_ascii=False))
    folder = tmp_path / "lines"
    folder.mkdir()
    half = len(lines) // 2
    for i, part in enumerate([lines[:half], lines[half:], ends[:2], ends[2:]]):
        path = folder / f"{i}.txt"
        path.write_text("\n".join(part))
        os.utime(path, (time.time() - 1000 + i,) * 2)
    out = str(tmp_path)

    def records():
        return spark.readStream.option("maxFilesPerTrigger", 1).text(str(folder))

    drain(jobs.live_sessions(records(), "app", f"{out}/live", f"{out}/cp1"))
    drain(jobs.article_reads(records(), "app", f"{out}/reads", f"{out}/cp2"))
    events = t.app_events.drop("event_id")
    names = ["type", "uid", "title", "lcs_id", "time"]
    got = tables.read_lists(spark, f"{out}/live").select(
        F.from_json("value", ", ".join(f"{n} string" for n in names)).alias("v")).select("v.*")
    assert rows(got.where("uid <> 'end'"), *names) == rows(app.live_sessions(events, "app"), *names) != []
    counted = running.read_read_totals(spark, f"{out}/cp2").where("message_id <> 'end'")
    direct = app.article_reads(events, "app")
    assert rows(counted, "message_id", "num") == rows(direct, "message_id", "num") != []


def watch(uid, item, ms=None, offset=0):
    content = "财商_课程_直播" if ms else "财商_课程_回看"
    properties = {"v1_element_content": content, "v1_message_id": item, "v1_custom_params": str(offset), "v1_custom_params2": uid}
    return {"event": "CSH5Visit", "time": str(ms or 0), "project": next(iter(ENVS)), "properties": json.dumps(properties, ensure_ascii=False)}


def test_progress_stream_equals_batch_and_hands_out_active_keys_only(spark, tmp_path):
    rnd = random.Random(4)
    plan = [("a", 0, 9_000_000), ("b", 60_000, 130_000)]
    batches = [[watch(f"u{rnd.randrange(4)}", rnd.choice("ab"), rnd.randrange(1, 10_000_000)) if rnd.random() < 0.6
                else watch(f"u{rnd.randrange(4)}", rnd.choice("ab"), None, rnd.choice([-5, 0, rnd.randrange(9_000), "x"]))
                for _ in range(60)] for _ in range(3)]
    batches.append([watch("u1", "a", 30_000), watch("u1", "a", 30_001), watch("none", "c", 30_000)])
    folder = write_files(tmp_path / "in", batches)
    schema = "event string, time string, project string, properties string"
    schedule = spark.createDataFrame(plan, "item string, start_ms bigint, end_ms bigint")
    found = running.stream_progress(read_json(spark, folder, schema), schedule, ENVS)
    got = collected(found, str(tmp_path / "out"), str(tmp_path / "cp"), "update")
    last = got.where("batch = 3")
    assert rows(last, "uid", "item") == [("u1", "a")]  # a batch costs what it brings
    events = spark.createDataFrame([tuple(r.values()) for b in batches for r in b], "event string, time string, project string, properties string")
    direct = progress.watch_progress(progress.watch_marks(events, ENVS), schedule)
    columns = ["uid", "item", "env", "percent", "times"]
    assert rows(running.read_progress(spark, str(tmp_path / "cp")), *columns) == rows(direct, *columns)
    assert rows(got.groupBy("uid", "item", "env").agg(F.max_by(F.struct("percent", "times"), "batch").alias("x")).select(
        "uid", "item", "env", "x.*"), *columns) == rows(direct, *columns)
    plain = {}
    for r in progress.watch_marks(events, ENVS).collect():
        for item, start, end in plan:
            if item == r.item:
                first = (start // 30_000 + 1) * 30_000
                points = max((end - first) // 30_000 + 1, 1)
                idx = (r.bucket - first) // 30_000 if r.mode == "live" else int(r.bucket / 30)
                plain.setdefault((r.uid, r.item, r.env), set()).update({idx} if 0 <= idx < points else set())
    assert {tuple(r)[:3]: r.times for r in direct.collect()} == {k: 30 * len(v) for k, v in plain.items()}


def test_totals_survive_a_restart_and_count_a_batch_once(spark, tmp_path):
    schema = "table string, key array<string>, num bigint, flags int"
    data = [{"table": "pushes", "key": [k], "num": n, "flags": 0} for k, n in (("a", 2), ("b", 1), ("a", 5))]
    folder = write_files(tmp_path / "in", [data[:2]])
    cp, path = str(tmp_path / "cp"), str(tmp_path / "out")

    def go():
        return collected(running.totals(read_json(spark, folder, schema)), path, cp, "update")

    go()
    go()  # nothing new: nothing is counted again
    assert rows(running.read_totals(spark, cp, "pushes"), "notice_id", "num") == [("a", 2), ("b", 1)]
    (tmp_path / "in" / "0001.json").write_text(json.dumps(data[2]))
    changes = go()
    assert rows(running.read_totals(spark, cp, "pushes"), "notice_id", "num") == [("a", 7), ("b", 1)]
    # The changed rows of the second batch are the keys it brought; the first batch's state can still be read.
    assert rows(changes.where("batch = 1"), F.get("key", F.lit(0)), "num") == [("a", 7)]
    assert rows(running.read_totals(spark, cp, "pushes", batch=0), "notice_id", "num") == [("a", 2), ("b", 1)]


def test_last_rows_are_the_latest_of_the_batch_form(spark, tmp_path):
    rnd = random.Random(6)
    data = [{"key": f"k{rnd.randrange(5)}", "v": rnd.randrange(100), "ms": rnd.randrange(40)} for _ in range(90)]
    folder = write_files(tmp_path / "in", [data[i:i + 30] for i in range(0, 90, 30)])
    schema = "key string, v bigint, ms bigint"
    found = running.last_rows(read_json(spark, folder, schema), ["key"], [F.col("ms")])
    got = collected(found, str(tmp_path / "out"), str(tmp_path / "cp"), "update")
    newest = got.groupBy("key").agg(F.max_by("row", "batch").alias("r")).select("key", "r.*")
    direct = upserts.latest(spark.createDataFrame([tuple(r.values()) for r in data], schema), ["key"], [F.col("ms")])
    assert rows(newest, "key", "v", "ms") == rows(direct, "key", "v", "ms")


def test_ingest_writes_day_partitions(spark, sf, tmp_path):
    folder = _line_files(spark, sf, tmp_path)
    out = str(tmp_path / "table")
    records = streams.read_folder(spark, folder)
    drain(jobs.ingest(records, out, str(tmp_path / "cp")))
    drain(jobs.ingest(records, out, str(tmp_path / "cp")))  # restart: nothing is read twice
    table = spark.read.parquet(out)
    expected = Tables(spark, sf).app_lines.groupBy("dt").count()
    got = table.groupBy(F.col("dt").cast("string").alias("dt")).count()
    assert rows(got) == rows(expected)


def test_text_sink_and_console(spark, tmp_path):
    data = [{"event_type": "r", "user_id": i, "ms": 1_704_067_200_000} for i in range(5)]
    folder = write_files(tmp_path / "in", [data])
    source = read_json(spark, folder, EVENT)
    query = tables.stream_text(
        source, str(tmp_path / "out"), str(tmp_path / "cp"),
        [F.col("event_type"), F.col("user_id")],
        clock.format_millis(F.col("ms"), clock.DAY), max_records=2)
    drain(query)
    got = spark.read.text(str(tmp_path / "out"))
    assert sorted(r["value"] for r in got.collect()) == [f"r|{i}" for i in range(5)]
    drain(tables.stream_console(source, str(tmp_path / "cp2"), "append"))


def test_union_of_streams(spark, tmp_path):
    a = write_files(tmp_path / "a", [[{"event_type": "a", "user_id": 1, "ms": 1}]])
    b = write_files(tmp_path / "b", [[{"event_type": "b", "user_id": 2, "ms": 2}]])
    both = read_json(spark, a, EVENT).unionByName(read_json(spark, b, EVENT))
    got = collected(both, str(tmp_path / "out"), str(tmp_path / "cp"))
    assert rows(got, "event_type") == [("a",), ("b",)]


def test_log_options():
    options = streams.log_options(
        "h:1", ["a", "b"], {"a": {0: 5, 1: 7}}, streams.records_per_trigger(4000, 3, 15), "g")
    assert json.loads(options["startingOffsets"]) == {"a": {"0": 5, "1": 7}}
    assert options["maxOffsetsPerTrigger"] == "180000"
    assert options["subscribe"] == "a,b"
    assert streams.log_options("h:1", ["a"])["startingOffsets"] == "latest"


def test_declared_schema_and_record_info(spark):
    line = '{"time": 1704067200000, "event": "LiveVisit", "properties": {"userID": "7"}}'
    records = spark.createDataFrame(
        [(0, 3, "k", line), (0, 4, "k", '{"time": 1}')],
        "partition int, offset bigint, key string, value string")
    typed = streams.declared(records, streams.EVENT_SCHEMA, ["event"])
    assert rows(typed, "event", "properties.userID") == [("LiveVisit", "7")]
    info = streams.record_info(records)
    assert rows(info)[0] == (0, 3, "k", "2024-01-01 00:00:00")
