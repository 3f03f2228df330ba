"""Hand-made frames: edge cases, and operators without an SQL twin against brute force."""

import json
import math
import random

import numpy as np
import pytest
from conftest import rows
from pyspark.sql import functions as F

from clickloom import session
from clickloom.functions import clock, rowkeys, words
from clickloom.functions.jsonmap import json_map, prop, put_fields
from clickloom.operators import (
    answers, bayes, counters, identity, keywords, labels, learning, online, parsing, progress,
    reads, routing, rules, schemas, sessions, similarity, skew, storage, upserts,
)
from clickloom.plans import warehouse
from clickloom.sinks import tables
from clickloom.sources import events as sources


def frame(spark, data, schema):
    return spark.createDataFrame(data, schema)


# ---- JSON --------------------------------------------------------------------


def test_json_map_forms(spark):
    lines = [
        '{"a":{"$x":1.5,"y":[1,2],"z":null},"b":null,"_t":"$q$","c":true}',
        "not json", "{}", "[1]", "{a:'u'}", None,
    ]
    df = frame(spark, [(i, x) for i, x in enumerate(lines)], "i int, v string")
    plain = {r[0]: r[1] for r in df.select("i", json_map(F.col("v"))).collect()}
    assert plain[0] == {"a": '{"$x":1.5,"y":[1,2],"z":null}', "b": "null", "_t": "$q$", "c": "true"}
    assert plain[1] == plain[2] == plain[3] == plain[5] == {}
    assert plain[4] == {"a": "u"}
    flat = df.where("i = 0").select(json_map(F.col("v"), "tmp", flatten_depth=2)).first()[0]
    assert flat == {"a_x": "1.5", "a_y": "[1,2]", "a_z": "null", "b": "null", "tmp_t": "$q$",
                    "c": "true"}
    stripped = df.where("i = 0").select(json_map(F.col("v"), "tmp", strip_dollar=True)).first()[0]
    assert stripped["tmp_t"] == "q"
    with pytest.raises(ValueError):
        json_map(F.col("v"), flatten_depth=3)


def test_put_fields_keeps_types_and_new_value_wins(spark):
    df = frame(spark, [('{"n":1.50,"o":{"x":1}}',), ('{"event":"old","n":1}',), ("{}",), ("bad",)],
               "v string")
    out = [r[0] for r in df.select(put_fields(F.col("v"), event=F.lit('e"'))).collect()]
    assert out[0] == '{"n":1.50,"o":{"x":1},"event":"e\\""}'
    assert json.loads(out[1])["event"] == 'e"'
    assert json.loads(out[2]) == json.loads(out[3]) == {"event": 'e"'}


def test_flat_and_typed_columns(spark):
    line = json.dumps({"_track_id": 5, "lib": {"$lib": "js"}, "time": 7,
                       "properties": {"$os": "x", "userID": "u"}, "ver": 2})
    df = frame(spark, [(line, "d")], "line string, dt string")
    flat = parsing.flat_events(df).first().asDict()
    assert list(flat) == schemas.FLAT_COLUMNS
    assert flat["tmp_track_id"] == "5" and flat["lib_lib"] == "js"
    assert flat["properties_os"] == "x" and flat["properties_userID"] == "u"
    assert flat["properties_city"] == ""
    typed = warehouse.event_etl(df, "d").first().asDict()
    assert list(typed) == [*schemas.LOG_COLUMNS, "dt"]
    assert typed["_track_id"] == "5" and typed["map_id"] == ""


def test_history_defaults(spark):
    df = frame(spark, [('{"userid":"u","$is_first_time":"1"}',),
                       ('{"properties":"{\\"p\\":1}","time":"bad","project":"x"}',)], "line string")
    got = parsing.history_events(df, project="app").collect()
    assert got[0]["time"] == "0" and got[0]["project"] == "app"
    packed = json.loads(got[0]["properties"])
    assert packed == {"$is_first_time": "true", "$is_first_day": "false", "userID": "u",
                      "deviceId": ""}
    assert got[1]["properties"] == '{"p":1}' and got[1]["project"] == "x"
    plain = parsing.history_events(df, convert=False).collect()
    assert plain[1]["time"] == "bad"
    assert "$is_first_day" not in json.loads(plain[0]["properties"])


def test_plate_without_members(spark):
    df = frame(spark, [("k", '{"plate_name":"p","symbol":[{"symbol":"s1"},{"symbol":"s2"}]}'),
                       ("l", '{"plate_name":"q"}'), ("m", "bad")], "key string, value string")
    assert rows(warehouse.plate_symbols(df)) == [("k", "p", "s1"), ("k", "p", "s2")]


def test_live_stats_defaults_and_minutes(spark):
    df = frame(spark, [("1", '{"live_id":"12","view_count":"x","old_user_staying_average":"90"}')],
               "key string, value string")
    got = parsing.live_stats(df).first().asDict()
    assert got["live_id"] == 12 and got["view_count"] == 0 and got["lcs_name"] == ""
    assert got["old_user_staying_average"] == 1.5
    assert [n for n, _ in schemas.LIVE_STATS] == list(got)


def test_labelled_text_needs_five_parts(spark):
    df = frame(spark, [("1|,|a,b|,|t|,|k1,k2|,|n",), ("1|,|a|,|t|,|k",), ("2|,|a|,|t|,| |,| ",)],
               "value string")
    assert rows(parsing.labelled_text(df), "id", "label_str", "total_words") == [
        ("1", "a", "k1 k2 n"), ("1", "b", "k1 k2 n")]


# ---- functions -----------------------------------------------------------------


def test_clock(spark):
    df = spark.range(1)
    got = df.select(
        clock.format_millis(F.lit(1_704_067_200_999)),
        clock.format_millis(F.lit(1_704_067_200_999), tz="Asia/Shanghai"),
        clock.parse_millis(F.lit("1970-01-01 08:00:00"), tz="Asia/Shanghai"),
        clock.parse_millis(F.lit("nonsense")),
        clock.grid_start(F.lit(31_000)), clock.grid_size(F.lit(31_000), F.lit(10)),
        clock.grid_size(F.lit(31_000), F.lit(120_000)),
        clock.seconds_to_minutes(F.lit("x")), clock.is_day(F.lit("2024-01-01")),
        clock.is_day(F.lit("2024-1-1")),
    ).first()
    assert tuple(got) == ("2024-01-01 00:00:00", "2024-01-01 08:00:00", 0, None, 60_000, 1, 3, 0.0,
                          True, False)


def test_word_filters(spark):
    tokens = ["一个", "好", "2020", "12%", "abc", "证券市场", "——"]
    df = frame(spark, [(tokens,)], "w array<string>")
    assert df.select(words.drop_patterns(F.col("w"), words.STOP_PATTERNS)).first()[0] == ["证券市场"]
    got = spark.range(1).select(words.strip_symbols(F.lit("价 格:\t12元。A-b　$")),
                                words.label_number(F.lit("C11-Space"))).first()
    assert tuple(got) == ("价格元Ab", 11.0)


def test_row_keys_sort_newest_first_and_spread(spark):
    df = spark.range(600).select(rowkeys.event_key(F.lit("hot"), F.col("id")).alias("k"), "id")
    salts = {r[0]: r[1] for r in df.groupBy(F.substring("k", 1, 1)).count().collect()}
    assert set(salts) == set("ABCDEF") and min(salts.values()) > 50
    bare = df.select("id", rowkeys.bare_key(F.col("k")).alias("b")).orderBy("b").collect()
    assert [r["id"] for r in bare] == list(range(599, -1, -1))


# ---- routing -------------------------------------------------------------------


def event(name, project, time=1_704_067_200_000, **props):
    return (name, json.dumps(props, ensure_ascii=False), str(time), project)


EVENT = "event string, properties string, time string, project string"


def test_every_rule_content_has_its_code(spark):
    for rule in (rules.PAGE_VISIT, rules.LIVE_VISIT, rules.TD_DETAIL, rules.CONTENT_PLAY,
                 rules.SHARE, rules.ANSWER_PAGE):
        data = [event(rule.events[0], "app", v1_element_content=c) for c in rule.codes]
        got = routing.routed(frame(spark, data, EVENT), rule, [("v1_element_content", "content")])
        assert {(r["content"], r["type"]) for r in got.collect()} == set(rule.codes.items())


def test_page_visits_filters(spark):
    content = "快讯详情页访问"
    data = [
        event("NativeAppVisit", "app", v1_element_content=content, userID="1"),
        event("NativeAppVisit", "other", v1_element_content=content),
        event("H5Visit", "app", v1_element_content=content),
        event("NativeAppVisit", "app", v1_element_content=content, v1_custom_params="直播"),
        event("NativeAppVisit", "app", v1_element_content="unknown"),
        ("NativeAppVisit", "broken", "1", "app"),
    ]
    got = routing.page_visits(frame(spark, data, EVENT), "app")
    assert rows(got, "type", "uid", "time", "stay_time") == [
        ("globalnews", "1", "2024-01-01 00:00:00", 0)]


def test_push_ids(spark):
    data = [event("LCSAppStart", "app", v1_element_content="推送启动app", v1_notice_id=i)
            for i in ("5", "5", "0", "", "(null)")]
    got = counters.count_per(routing.push_rows(frame(spark, data, EVENT)), ["notice_id"])
    assert rows(got) == [("5", 2)]


def test_insurance_row_takes_several_routes(spark):
    data = [
        event("BXVisit", "cover", v1_element_content="启见保_文章访问", v1_is_push="1",
              v1_element_type="启见保_营销活动", v1_message_id="9"),
        event("BXOther", "cover", v1_element_type="启见保_营销活动"),
        event("BXVisit", "cover", v1_element_content="启见保_推广/营销活动页领取",
              v1_page_title="page", v1_tg_name="group"),
        event("BXVisit", "else", v1_element_content="启见保_文章访问"),
        event("BXVisit", "cover", v1_element_content="nothing"),
    ]
    got = routing.cover_routes(frame(spark, data, EVENT), "cover").collect()
    found = sorted((r["route"], r["type"]) for r in got if r["type"])
    assert found == [("activity", "activity_visit"), ("article", "view_article"),
                     ("campaign", "shanzhen_receive"), ("push", "isPush")]
    # An event name without a code keeps its record but has no type.
    assert [r["route"] for r in got if r["type"] is None] == ["activity"]
    campaign = next(json.loads(r["value"]) for r in got if r["route"] == "campaign")
    assert list(campaign) == ["type", *schemas.CAMPAIGN_FIELDS]
    assert campaign["v1_tg_name"] == "group"
    article = next(json.loads(r["value"]) for r in got if r["route"] == "article")
    assert list(article) == ["type", *schemas.ARTICLE_FIELDS] and article["v1_message_id"] == "9"


def test_course_lists_and_environment(spark):
    data = [
        event("CSH5Visit", "course", v1_element_content="课程详情页访问"),
        event("CSH5Click", "course_test", v1_element_content="视频直播_点赞"),
        event("CSH5Click", "unknown", v1_element_content="视频直播_点赞"),
    ]
    got = routing.course_routes(frame(spark, data, EVENT),
                                {"course": "prod", "course_test": "test"})
    assert rows(got, "route", "env") == [
        ("behaviour", "prod"), ("behaviour", "test"), ("option", "prod")]


def test_rejected_contents_are_counted(spark):
    data = [event("NativeAppVisit", "app", v1_element_content="new")] * 2
    assert rows(routing.rejected(frame(spark, data, EVENT), rules.CONTENT_PLAY)) == [
        ("NativeAppVisit", "new", 2)]


def test_identity(spark):
    df = frame(spark, [("u", "d", "x"), ("", "d", "x"), ("", "", "x"), ("u", "", "x")],
               "userID string, deviceId string, distinct_id string")
    got = identity.with_identity(df).select("identity", "device").collect()
    assert [tuple(r) for r in got] == [("u", "d"), ("d", "d"), ("x", "x"), ("u", "")]


# ---- sessions and reads ----------------------------------------------------------


def test_sessions_and_stay(spark):
    def row(uid, kind, ms):
        return (uid, "room", f"t{ms}", kind, "m", "n", ms)

    data = [
        row("a", "enter", 0), row("a", "on", 14_000), row("a", "on", 29_000),  # gap of exactly 15 s
        row("a", "on", 44_001),  # more than 15 s: a new session
        row("b", "on", 5_000),  # a heartbeat alone opens one
        row("c", "enter", 0), row("c", "enter", 10_000),  # entering again goes on
    ]
    df = frame(spark, data, "uid string, lcs_id string, title string, content string,"
                            " message_id string, lcs_name string, ms bigint")
    got = rows(sessions.live_sessions(df), "uid", "type", "title", "time", "stay_time")
    t = "1970-01-01 00:00:"
    assert got == [
        ("a", "enter_live", "t0", t + "00", 0), ("a", "enter_live", "t44001", t + "44", 0),
        ("a", "leave_live", "t29000", t + "32", 32), ("a", "leave_live", "t44001", t + "47", 3),
        ("b", "enter_live", "t5000", t + "05", 0), ("b", "leave_live", "t5000", t + "08", 3),
        ("c", "enter_live", "t0", t + "00", 0), ("c", "leave_live", "t10000", t + "13", 13),
    ]


def greedy(times, gap):
    last, n = None, 0
    for t in sorted(set(times)):
        if last is None or t > last + gap:
            last, n = t, n + 1
    return n


@pytest.mark.parametrize("seed", [0, 3, 16])
def test_reads_match_brute_force(spark, seed):
    rnd = random.Random(seed)
    data = [(f"k{rnd.randrange(4)}", rnd.randrange(60_000)) for _ in range(1500)]
    data += [("hot", t) for t in range(0, 20_000, 7)]  # one key with most of the rows
    data += [("edge", t) for t in (0, 100, 101, 201, 202, 303, -500, -399)]
    df = frame(spark, data, "key string, ms bigint")
    expected = {}
    for key, t in data:
        expected.setdefault(key, []).append(t)
    for slice_ms in (100, 350, 800):
        got = reads.counted_reads(df, ["key"], "ms", 100, slice_ms)
        assert dict(rows(got)) == {k: greedy(v, 100) for k, v in expected.items()}
    with pytest.raises(ValueError):
        reads.counted_reads(df, ["key"], "ms", 100, 50)


def test_read_threshold(spark):
    data = [("a", "u", 0), ("a", "u", 100_000), ("b", "u", 0), ("b", "u", 100_001),
            ("a", "v", 0), ("c", "u", 0), ("c", "u", 60_000), ("c", "u", 120_000)]
    df = frame(spark, data, "message_id string, uid string, ms bigint")
    assert rows(reads.article_reads(df)) == [("a", 2), ("b", 2), ("c", 2)]


# ---- online, progress, answers --------------------------------------------------------


def test_status_rows(spark):
    def record(**x):
        return (json.dumps(x),)

    df = frame(spark, [
        record(extra_id="10001", uid="u", is_online="1", c_time="1"),
        record(extra_id="10001", uid="u", is_online="0", c_time="2"),
        record(extra_id="10001", uid="u", is_online="1", c_time="3"),
        record(extra_id="10001", uid="v", is_online="1", c_time="1"),
        record(extra_id="10001", uid="v", is_online="", c_time="2"),
        record(extra_id="10001", uid="w", is_online="0", c_time="5"),
        record(extra_id="10001", uid="w", is_online="1", c_time="5"),
        record(extra_id="999", uid="u", is_online="1", c_time="1"),
        record(extra_id="", uid="u", is_online="1", c_time="1"),
    ], "value string")
    now = online.status_rows(df)
    assert rows(online.room_online(now)) == [("10001", 2)]
    assert rows(online.room_online(now, room_length=None)) == [("10001", 2), ("999", 1)]


def test_watch_progress(spark):
    envs = {"course": "prod"}
    start = 1_704_067_210_000  # not on the grid: the first point is at :30
    live, play = "财商_课程_直播", "财商_课程_回看"

    def mark(content, time, offset="0", project="course"):
        return event("CSH5Visit", project, time, v1_element_content=content, v1_message_id="i",
                     v1_custom_params=offset, v1_custom_params2="u")

    data = [
        mark(live, start + 20_000), mark(live, start + 21_000),  # point 0, twice
        mark(live, start),  # before the first point
        mark(live, start + 110_000),  # on the last point
        mark(play, start, "65"), mark(play, start, "5"),  # points 2 and 0
        mark(play, start, "9999"), mark(play, start, "abc"),  # beyond the grid; no number
        mark(live, start, project="none"),
    ]
    marks = progress.watch_marks(frame(spark, data, EVENT), envs)
    plan = frame(spark, [("i", start, start + 110_000)],
                 "item string, start_ms bigint, end_ms bigint")
    assert progress.grid(plan).count() == 4
    got = progress.watch_progress(marks, plan)
    assert rows(got) == [("u", "i", "prod", 0.75, 90)]
    assert json.loads(progress.progress_json(got).first()["position"]) == {
        "percent": "0.75", "times": "90"}
    assert rows(progress.grid_hits(marks, plan), "idx", "num") == [(0, 1), (2, 1), (3, 1)]
    keys = [r[0] for r in progress.mark_cells(marks.where("mode = 'play'")).collect()]
    assert "u|i|prod|play|65" in keys


def test_answer_flags_merge(spark):
    envs = {"course": "prod"}

    def act(content, ques="q"):
        return event("CSH5Visit", "course", 1, v1_element_content=content, v1_message_id=ques,
                     v1_uid="u")

    data = [act("财商_题目解答页访问"), act("财商_题目解答页访问"), act("财商_图片打卡页访问"),
            act("财商_题目解答页_提交点击"), act("财商_评分结果页访问", "new"), act("other")]
    found = answers.answer_rows(frame(spark, data, EVENT), envs)
    history = answers.answer_history(found)
    assert sorted(r["type"] for r in history.collect()) == ["click", "enter", "enter", "enter"]
    old = frame(spark, [("prod", "q", "u", '{"x":"1","enter_answer_page":"0"}', 3),
                        ("prod", "untouched", "u", "", 3)],
                "env string, ques_id string, uid string, ext_info string, ques_relation_type int")
    got = {r["ques_id"]: r for r in answers.merge_flags(old, answers.page_flags(found)).collect()}
    assert json.loads(got["q"]["ext_info"]) == {
        "x": "1", "enter_answer_page": 1, "enter_course_sign_page": 1}
    assert got["q"]["ques_relation_type"] == 3
    assert json.loads(got["new"]["ext_info"]) == {"enter_score_page": 1}
    assert got["new"]["ques_relation_type"] == 1
    assert got["untouched"]["ext_info"] == ""


# ---- labels and scores ------------------------------------------------------------------


def test_label_rules_and_thresholds(spark):
    def act(name, content, adviser="a1", **who):
        who = {"userID": "u", **who}
        return event(name, "app", v1_element_content=content, v1_lcs_id=adviser, **who)

    data = [act("NativeAppVisit", "TD合约详情页"), act("NativeAppVisit", "理财师主页访问", "zz"),
            act("NativeAppVisit", "新闻详情页访问", userID="", deviceId="dev")]
    data += [act("LiveVisit", "视频直播播放")] * 3
    data += [act("LiveVisit", "视频直播播放", userID="fan")] * 4
    advisers = frame(spark, [("a1",), ("a1",)], "lcs_id string")
    got = labels.user_labels(frame(spark, data, EVENT), advisers)
    assert rows(got, "id", *rules.LABEL_FLAGS) == [
        ("dev", 0, 0, 0, 0, 0, 1), ("fan", 0, 0, 0, 0, 1, 0), ("u", 1, 0, 0, 0, 0, 0)]
    kept = labels.user_labels(frame(spark, data, EVENT), advisers, keep_empty=True)
    assert kept.where("id = ''").count() == 1


def test_every_rung_of_the_ladder(spark):
    # (value one day ago or None, day offset of a 1) -> score
    cases = {
        "a1": ([(1, 1)], 10), "b9": ([(2, 1)], 9), "b8": ([(1, 0), (3, 1)], 8),
        "c7": ([(4, 1)], 7), "c6": ([(1, 0), (7, 1)], 6), "d5": ([(8, 1)], 5),
        "d0": ([(1, 0), (15, 1)], 0), "e3": ([(16, 1)], 3), "e0": ([(1, 0), (30, 1)], 0),
        "old": ([(31, 1)], 0), "zero": ([(2, 0)], 0), "b over c": ([(2, 1), (5, 1)], 9),
    }
    data = [(k, f"2024-03-{31 - age:02d}" if age < 31 else "2024-02-29", v)
            for k, (marks, _s) in cases.items() for age, v in marks]
    base = [(k, "2024-01-01", 0) for k in cases]  # makes every id eligible
    df = frame(spark, data + base, "id string, dt string, flag int")
    follows = frame(spark, [("a1", "6"), ("b9", "3"), ("b8", "1"), ("c7", "x")],
                    "id string, follows string")
    got = labels.user_scores(df, follows, "2024-03-31", ["flag"])
    assert dict(rows(got, "id", "flag_score")) == {k: s for k, (_m, s) in cases.items()}
    assert {k: v for k, v in rows(got, "id", "user_follows_score") if v} == {
        "a1": 50, "b9": 40, "b8": 20}
    young = labels.user_scores(frame(spark, data, "id string, dt string, flag int"), follows,
                               "2024-03-31", ["flag"])
    assert rows(young, "id") == [("e0",), ("old",)]


def test_score_job_resets_missing_ids(spark, tmp_path):
    table = frame(spark, [("u", "2024-01-01", 1), ("u", "2024-03-30", 1)],
                  "id string, dt string, is_visit_account int")
    for flag in rules.LABEL_FLAGS:
        if flag != "is_visit_account":
            table = table.withColumn(flag, F.lit(0))
    before = frame(spark, [("gone", 9), ("u", 1), ("", 4)], "id string, score int")
    follows = frame(spark, [("u", "4")], "id string, follows string")
    warehouse.score_job(table, follows, before, "2024-03-31", str(tmp_path))
    assert rows(spark.read.parquet(f"{tmp_path}/totals")) == [("gone", 0), ("u", 50)]
    assert spark.read.parquet(f"{tmp_path}/runs").count() == 1


# ---- skew, merges, storage ------------------------------------------------------------------


def test_salted_join_equals_plain_join(spark):
    rnd = random.Random(1)
    left = frame(spark, [("hot" if i % 3 else f"k{rnd.randrange(9)}", i) for i in range(900)],
                 "k string, i int")
    right = frame(spark, [("hot", 1), ("k1", 2), ("k2", 3), ("none", 4)], "k string, v int")
    heavy = skew.heavy_keys(left, ["k"], 4)
    assert rows(heavy) == [("hot",)]
    for how in ("inner", "left", "left_semi", "left_anti"):
        plain = rows(left.join(right, "k", how))
        assert [tuple(map(str, r)) for r in rows(skew.salted_join(left, right, ["k"], ["i"], how)
                .select(*left.join(right, "k", how).columns).fillna(-1))] == [
                    tuple(map(str, r)) for r in rows(left.join(right, "k", how).fillna(-1))]
        assert len(rows(skew.salted_join(left, right, ["k"], ["i"], how, heavy=heavy))) == len(plain)
    with pytest.raises(ValueError):
        skew.salted_join(left, right, ["k"], ["i"], "full")


def test_joined_text_is_split_alike_at_every_size(spark):
    df = spark.range(1000).select(
        F.when(F.col("id") < 900, "hot").otherwise("cold").alias("k"), F.col("id").alias("v"))
    df = df.unionByName(df.where("v = 7")).unionByName(spark.sql("SELECT 'none' AS k, CAST(NULL AS BIGINT) AS v"))
    got = skew.joined_text(df, ["k"], F.col("v"), "text", "|", parts=5)
    found = {(r["k"], r["part"]): r["text"].split("|") for r in got.collect()}
    assert sorted(p for k, p in found if k == "hot") == list(range(5))
    assert sorted(int(x) for (k, _), t in found.items() if k == "hot" for x in t) == sorted([*range(900), 7])
    # The same value falls in the same part in any group, order and number of partitions.
    part = {x: p for (_, p), t in found.items() for x in t}
    other = skew.joined_text(df.orderBy(F.desc("v")).repartition(7).withColumn("k", F.lit("all")), ["k"],
                             F.col("v"), "text", "|", distinct=True, parts=5).collect()
    assert {x: r["part"] for r in other for x in r["text"].split("|")} == part
    assert rows(skew.value_counts(df, ["k"], F.col("v")).where("num > 1")) == [("hot", "7", 2)]


def test_blocks_meet_every_row_of_the_list(spark):
    listed = spark.range(50).select(F.col("id").alias("n"))
    for block in (3, 1000):
        got = skew.in_blocks(spark.range(20), listed, "n", ["id"], block, 4)
        pairs = got.select("id", F.explode("entries").alias("e")).select("id", "e.n")
        assert rows(pairs) == [(i, n) for i in range(20) for n in range(50)]
    assert skew.in_blocks(spark.range(3), listed.limit(0), "n", ["id"]).count() == 0


def test_upsert_rows(spark):
    target = frame(spark, [("a", 1, "t0"), ("b", 2, "t0")], "k string, v int, c_time string")
    source = frame(spark, [("b", 5, "t1"), ("c", 6, "t1"), ("c", 7, "t1")],
                   "k string, v int, c_time string")
    got = upserts.upsert(target, source, ["k"], keep_on_update=["c_time"], order=[F.col("v")])
    assert rows(got) == [("a", 1, "t0"), ("b", 5, "t0"), ("c", 7, "t1")]
    nulls = frame(spark, [("a", None, "t1")], "k string, v int, c_time string")
    assert rows(upserts.upsert(target, nulls, ["k"]).where("k = 'a'")) == [("a", None, "t1")]
    assert rows(upserts.insert_new(target, source.select("k", "v"), ["k"])) == [("c", 7)]


def test_live_info_upsert_keeps_times(spark):
    target = parsing.live_info(frame(spark, [('{"live_id":"1"}',)], "value string")).withColumns(
        {"c_time": F.lit("old"), "u_time": F.lit("old")})
    source = frame(spark, [('{"live_id":"1","view_count":"3"}',), ('{"live_id":"2"}',),
                           ('{"live_id":"3"}',)], "value string")
    wanted = frame(spark, [(1,), (2,)], "notice_id int")
    got = warehouse.live_stats_upsert(target, source, F.lit("now"), wanted)
    assert rows(got, "notice_id", "view_count", "c_time", "u_time") == [
        (1, 3, "old", "old"), (2, 0, "now", "now")]


def test_row_key_table_round_trip(spark, tmp_path):
    events = frame(spark, [
        ("Visit", json.dumps({"userID": f"u{i % 3}"}), str(1000 + i), "app", "d") for i in range(60)
    ] + [("NativeAppQuotLog", "{}", "1", "app", "d"), ("", "{}", "1", "app", "d")],
        "event string, properties string, time string, project string, distinct_id string")
    path = str(tmp_path / "cells")
    tables.write_cells(warehouse.event_rowkeys(events), path)
    table = spark.read.parquet(path)
    assert table.count() == 60
    assert storage.scan_salted_range(table, "u1|", "u1~").count() == 20
    assert sum(storage.scan_prefix(table, f"{s}|u2|").count() for s in "ABCDEF") == 20
    bare = f"u0|{rowkeys.LONG_MAX - 1003}"
    assert rows(storage.get_row(table, bare), "userid", "time") == [("u0", "1003")]
    plain = storage.event_cells(events, fallback=False)
    assert plain.count() == 60
    plan = storage.scan_prefix(table, "A|u1")._jdf.queryExecution().executedPlan().toString()
    assert "StringStartsWith(row_key" in plan
    for scan in (storage.scan_prefix(table, "A|u1"), storage.get_row(table, bare)):
        text = scan._jdf.queryExecution().executedPlan().toString()
        assert "PartitionFilters: [isnotnull(salt" in text, text


def test_partition_writers(spark, tmp_path):
    path = str(tmp_path / "t")
    day = frame(spark, [(1, "d1"), (2, "d2")], "v int, dt string")
    tables.overwrite_partition(day, path)
    tables.overwrite_partition(frame(spark, [(9, "d2")], "v int, dt string"), path)
    tables.append_partition(frame(spark, [(9, "d2")], "v int, dt string"), path)
    assert rows(spark.read.parquet(path), "v", F.col("dt").cast("string")) == [
        (1, "d1"), (9, "d2"), (9, "d2")]
    tables.overwrite_table(day, str(tmp_path / "u"))
    tables.write_day_text(day, str(tmp_path / "csv"))
    assert spark.read.csv(str(tmp_path / "csv")).count() == 2
    records = frame(spark, [("x", "{}")], "list string, value string")
    for _ in range(2):
        tables.append_lists(records, str(tmp_path / "l"), 0, tee=":test")
    assert rows(tables.read_lists(spark, str(tmp_path / "l")), "list") == [("x",), ("x:test",)]


def test_file_sources_and_jdbc_options(spark, tmp_path):
    (tmp_path / "r.csv").write_text("1,2,3.5\n")
    assert rows(sources.read_ratings(spark, str(tmp_path / "r.csv"))) == [(1, 2, 3.5)]
    (tmp_path / "w.txt").write_text("a\nb")
    assert sources.read_files(spark, str(tmp_path / "w.txt")).first()["value"] == "a\nb"
    assert sources.read_text(spark, str(tmp_path / "w.txt")).count() == 2
    (tmp_path / "s.txt").write_text("的\nThe\n,\n")
    assert keywords.stop_word_table(spark, str(tmp_path / "s.txt")).count() == 3
    options = sources.jdbc_options("jdbc:x", "select 1", user="u", partition=("id", 0, 9, 4))
    assert options["dbtable"] == "(select 1) t" and options["numPartitions"] == "4"
    target = tables.jdbc_target("jdbc:x", "t", password="p")
    assert target["batchsize"] == "10000" and target["password"] == "p"


# ---- text ------------------------------------------------------------------------------------


def _weights(spark, docs):
    data = [(d, t, float(w)) for d, terms in docs.items() for t, w in terms.items()]
    return frame(spark, data, "doc_id bigint, term string, weight double")


def _cosine(a, b):
    dot = sum(w * b.get(t, 0) for t, w in a.items())
    return dot / math.sqrt(sum(w * w for w in a.values()) * sum(w * w for w in b.values()))


@pytest.mark.parametrize("block", [2, 5, 64])
def test_similarity_matches_brute_force(spark, block):
    rnd = random.Random(block)
    docs = {}
    for d in range(60):
        # Every document has the common term; many share few others, so prefixes meet a lot.
        docs[d] = {"common": 1.0, **{f"t{rnd.randrange(12)}": rnd.choice([0.5, 1.0, 2.0])
                                     for _ in range(rnd.randrange(1, 5))}}
    docs[60] = {k: 2 * v for k, v in docs[0].items()}  # same direction: a copy
    docs[61] = {"alone": 3.0}
    docs[62] = {"common": 0.0}
    weights = _weights(spark, docs)
    groups = dict(rows(similarity.copy_groups(weights)))
    assert groups[60] == groups[0] and 62 not in groups
    heads = sorted(set(groups.values()))
    copies = {h: sum(1 for v in groups.values() if v == h) for h in heads}
    expected = {
        (x, y, copies[x], copies[y]): _cosine(docs[x], docs[y])
        for i, x in enumerate(heads) for y in heads[i + 1:] if _cosine(docs[x], docs[y]) >= 0.6
    }
    got = {(r["doc_1"], r["doc_2"], r["copies_1"], r["copies_2"]): r["similarity"]
           for r in similarity.similar_documents(weights, "doc_id", 0.6, block).collect()}
    assert got.keys() == expected.keys() and len(got) > 20
    assert all(abs(got[k] - expected[k]) < 1e-9 for k in got)
    with pytest.raises(ValueError):
        similarity.similar_documents(weights, "doc_id", 0.0)


def test_probes(spark):
    df = frame(spark, [(1, [1.0, 0.0]), (2, [1.0, 1.0])], "id int, v array<double>")
    got = similarity.nearest_to(df, df.where("id = 1"), "id", "v")
    assert [(r[0], r[1], round(r[2], 6)) for r in got.collect()] == [(2, 1, 0.707107)]
    assert len(rows(similarity.nearest_to(df, df, "id", "v"))) == 2


def test_naive_bayes_equals_library_model(spark):
    from pyspark.ml.classification import NaiveBayes
    from pyspark.ml.linalg import Vectors

    rnd = random.Random(2)
    terms = [f"t{i}" for i in range(8)]
    docs = {d: {t: float(rnd.randrange(1, 4)) for t in rnd.sample(terms, 4)} for d in range(40)}
    truth = {d: rnd.randrange(3) for d in docs}
    weights = _weights(spark, docs)
    known = frame(spark, [(d, truth[d]) for d in docs if d < 30], "doc_id bigint, label int")
    model_terms, priors = bayes.train(weights, known, "doc_id")
    got = dict(rows(bayes.predict(bayes.scores(weights, model_terms, priors, "doc_id"), "doc_id")))
    vectors = [(d, float(truth[d]), Vectors.sparse(8, [(terms.index(t), w) for t, w in x.items()]))
               for d, x in docs.items()]
    df = spark.createDataFrame(vectors, ["doc_id", "label", "features"])
    fitted = NaiveBayes(smoothing=1.0).fit(df.where("doc_id < 30"))
    expected = {r["doc_id"]: str(int(r["prediction"])) for r in fitted.transform(df).collect()}
    assert got == expected
    table = bayes.accuracy(spark.createDataFrame(list(got.items()), "doc_id bigint, prediction string"),
                           known, "doc_id").first()
    assert table["n_rows"] == 30 and 0 <= table["accuracy"] <= 1


def test_models_save_and_load(spark, tmp_path):
    from pyspark.ml import PipelineModel

    df = frame(spark, [(1, ["a", "b", "a"]), (2, ["b"]), (3, ["c"])], "doc_id int, words array<string>")
    model = learning.hashed_features().fit(df)
    model.write().overwrite().save(str(tmp_path / "m"))
    loaded = PipelineModel.load(str(tmp_path / "m"))
    entries = learning.stored_entries(F.col("features"))
    values = loaded.transform(df).select("doc_id", F.inline(entries)).groupBy("doc_id").agg(F.max("value"))
    assert dict(rows(values))[1] == pytest.approx(2 * math.log(4 / 2))


def test_recommender(spark):
    data = [(u, i, float((u * i) % 5)) for u in range(12) for i in range(8) if (u + i) % 3]
    ratings = frame(spark, data, "user int, item int, rating float")
    model = learning.recommender().fit(ratings)
    users = learning.recommendations(model, "users", n=3)
    assert users.count() == 36 and users.where("rank > 3").count() == 0
    some = ratings.select("item").distinct().where("item < 2")
    assert learning.recommendations(model, "items", some, 2).count() == 4
    assert learning.rmse(model.transform(ratings)) == pytest.approx(
        learning.rmse_table(model.transform(ratings)).first()[0])
    train, test = learning.split_by_hash(ratings, F.struct("user", "item"), 70)
    assert train.count() + test.count() == ratings.count() and test.count() > 0


def test_segmenter_hook_and_stop_words(spark):
    docs = frame(spark, [(1, "ab|cd|ab|zz")], "doc_id int, text string")
    stop = frame(spark, [("ZZ",), ("zz",)], "term string")
    got = keywords.tokens(docs, F.col("text"), ["doc_id"], (), stop,
                          segmenter=lambda c: F.split(c, r"\|"))
    assert rows(keywords.token_arrays(got, ["doc_id"])) == [(1, ["ab", "cd", "ab"])]
    assert prop(F.col("m"), "k") is not None


def test_stored_answers_keep_their_types(spark):
    keys = "env string, ques_id string, uid string"
    stored = '{"n":1,"o":{"a":[1]},"b":true,"s":"x"}'
    existing = spark.createDataFrame([("p", "1", "u", stored, 1), ("p", "2", "u", None, 1)],
                                     f"{keys}, ext_info string, ques_relation_type int")
    flags = spark.createDataFrame([("p", "1", "u"), ("p", "2", "u")], keys)
    flags = flags.withColumns({n: F.lit(1 if i == 0 else None).cast("int") for i, n in enumerate(answers.FLAGS)})
    got = [json.loads(r.ext_info) for r in answers.merge_flags(existing, flags).orderBy("ques_id").collect()]
    first = answers.FLAGS[0]
    assert got == [{"n": 1, "o": {"a": [1]}, "b": True, "s": "x", first: 1}, {first: 1}]


def test_intermediates_can_be_dropped(spark, tmp_path, monkeypatch):
    assert session.intermediates(spark).startswith(session.shared_folder(spark))
    monkeypatch.setattr(session, "intermediates", lambda _: str(tmp_path / "app"))
    assert session.cut_lineage(spark.range(3)).count() == 3
    assert list((tmp_path / "app").iterdir())
    session.drop_intermediates(spark)
    assert not (tmp_path / "app").exists()


def test_tables_of_reads_compose_in_any_grouping():
    rnd = random.Random(8)
    gap, width = 10, 25
    for _ in range(300):
        times = sorted({rnd.randrange(0, 400) for _ in range(rnd.randrange(1, 60))})
        slices = {}
        for t in times:
            slices.setdefault(t // width, []).append(t)
        held = [(no, reads._lines_of(np.array(ts), gap, no * width + gap)) for no, ts in sorted(slices.items())]
        for _ in range(3):  # neighbours are joined in drawn groups until one table is left
            parts = held
            while len(parts) > 1:
                at, joined = 0, []
                while at < len(parts):
                    n = rnd.randrange(1, 4)
                    group = parts[at:at + n]
                    joined.append((group[0][0], reads.composed([x[1] for x in group], group[0][0] * width)))
                    at += n
                parts = joined
            last, counted = None, 0
            for t in times:
                if last is None or t > last + gap:
                    last, counted = t, counted + 1
            assert parts[0][1][0][2] == counted
            assert all(len(lines) <= gap + 1 for _, lines in parts)


def test_no_group_of_reads_holds_more_than_its_share(spark):
    rows_ = [("hot", 1_000 * i * 800) for i in range(5_000)] + [("cold", 5), ("cold", 50)]
    df = spark.createDataFrame(rows_, "key string, ms bigint")
    sizes = []
    plain = reads._composed
    try:
        reads._composed = lambda parts: sizes.append(parts) or plain(parts)
        got = reads.counted_reads(df, ["key"], "ms", 100_000)
    finally:
        reads._composed = plain
    assert len(sizes) == 3  # 5,000 slices in rounds of 64: 79, then 2, then 1
    assert rows(got, "key", "num") == [("cold", 1), ("hot", 5_000)]


def test_watch_bitmaps_against_sets(spark):
    rnd = random.Random(3)
    data = [(f"u{rnd.randrange(3)}", rnd.choice(["i", None]), rnd.randrange(-70, 400), 300) for _ in range(2_000)]
    data += [("out", "i", 500, 300), (None, "i", 63, 300), (None, "i", 64, 300), ("edge", "i", 299, 300)]
    df = spark.createDataFrame(data, "uid string, item string, idx bigint, points bigint")
    words = progress.watched_words(df, ["uid", "item"])
    got = {}
    for r in words.collect():
        bits = (r.bits or 0) % (1 << 64)
        found = {64 * r.word + i for i in range(64) if bits >> i & 1} if r.word is not None else set()
        assert (r.word is None) == (not found)
        got[r.uid, r.item] = got.get((r.uid, r.item), set()) | found
    expected = {}
    for uid, item, idx, points in data:
        expected.setdefault((uid, item), set()).update({idx} if 0 <= idx < points else set())
    assert got == expected


def test_terms_are_counted_without_shuffling_tokens(spark):
    texts = [(1, "a b a"), (2, "B c 7"), (2, "b"), (3, None), (4, ""), (None, "z"), (None, "z y"), (5, "a c")]
    docs = frame(spark, texts, "doc_id int, text string")
    got = keywords.document_terms(docs, F.col("text"), ["doc_id"], [r"^[0-9]+$"])
    plain = keywords.term_counts(keywords.tokens(docs, F.col("text"), ["doc_id"], [r"^[0-9]+$"]), ["doc_id"])
    assert sorted(map(str, got.collect())) == sorted(map(str, plain.collect())) and got.count() == 8
    words = keywords.document_words(docs, F.col("text"), ["doc_id"])
    arrays = keywords.token_arrays(keywords.tokens(docs, F.col("text"), ["doc_id"]), ["doc_id"])
    assert sorted(map(str, words.collect())) == sorted(map(str, arrays.collect()))
    once = docs.where("doc_id IN (1, 5)").coalesce(1)
    for df in (keywords.document_terms(once, F.col("text"), ["doc_id"]),
               keywords.document_words(once, F.col("text"), ["doc_id"])):
        assert "Exchange" not in df._jdf.queryExecution().executedPlan().toString()


def test_frequent_terms_are_joined_where_they_are(spark):
    tf = frame(spark, [(d, t, 1) for d in range(20) for t in ("the", "of", f"t{d}")],
               "doc_id int, term string, tf bigint")
    table = frame(spark, [("the", 1.0)] + [(f"t{d}", 2.0) for d in range(0, 20, 2)], "term string, v double")
    frequent = keywords.hot_terms(keywords.doc_frequency(tf), 10)
    assert rows(frequent) == [("of",), ("the",)]
    for how in ("inner", "left"):
        got, plain = keywords.term_join(tf, table, frequent, how), tf.join(table, "term", how)
        assert sorted(map(str, got.select("doc_id", "term", "v").collect())) == sorted(
            map(str, plain.select("doc_id", "term", "v").collect()))


def test_top_terms_of_runs_and_scattered_rows(spark):
    rnd = random.Random(5)
    data = [(d, f"t{i}", rnd.choice([0.1, 0.2, 0.2 + 1e-12, 0.3])) for d in range(9) for i in range(40)]
    scattered = rnd.sample(data, len(data))
    for digits in (None, 9):
        expected = set()
        for d in range(9):
            own = sorted((-(w if digits is None else round(w, digits)), t) for i, t, w in data if i == d)
            expected |= {(d, t, k) for k, (_, t) in enumerate(own[:5], 1)}
        for given in (data, scattered):
            df = frame(spark, given, "doc_id int, term string, weight double")
            got = keywords.top_terms(df, ["doc_id"], 5, digits).select("doc_id", "term", "rank")
            assert set(map(tuple, got.collect())) == expected
    kept = frame(spark, data, "doc_id int, term string, weight double").coalesce(1)
    held = kept.mapInArrow(keywords._best_of_runs(["doc_id"], 1, 0.0), kept.schema)
    assert held.count() < 9 * 40


def test_labels_beside_texts_train_the_same_model(spark):
    docs = frame(spark, [(1, "a b"), (2, "b c"), (2, "b"), (3, "c"), (4, "a")], "doc_id int, text string")
    known = frame(spark, [(1, "x"), (2, "y"), (2, "x"), (2, "x"), (9, "y")], "doc_id int, label string")
    carried = bayes.with_labels(docs, known, "doc_id")
    tf = keywords.document_terms(carried, F.col("text"), ["doc_id", bayes.LABELS])
    weights = tf.withColumn("weight", F.col("tf").cast("double"))
    plan = bayes.train(weights, known, "doc_id")
    joined = bayes.train(weights.drop(bayes.LABELS), known, "doc_id")
    for a, b in zip(plan, joined):
        assert sorted(map(str, a.collect())) == sorted(map(str, b.collect()))


def test_vectors_travel_once_per_batch_of_blocks(spark, monkeypatch):
    # Sixty documents in the same three directions, all under one common prefix term.
    rows_ = [(i, 0, [0, 1 + i % 3], [0.6, 0.8]) for i in range(60)]
    singles = frame(spark, rows_, "doc_id bigint, copies bigint, tids array<bigint>, ws array<double>")
    postings = singles.select("doc_id", F.lit(0).alias("term"), F.lit(15).alias("blocks"))
    seen, plain = spark.sparkContext.accumulator(0), similarity._match_blocks

    def counted(*given):
        match = plain(*given)

        def count(pdf):
            seen.add(len(pdf))
            return match(pdf)

        return count

    monkeypatch.setattr(similarity, "_match_blocks", counted)
    found = similarity.common_term_pairs(postings, singles, "doc_id", 0.9, 4)
    expected = {(a, b) for a in range(60) for b in range(a + 1, 60) if (a - b) % 3 == 0}
    assert set(map(tuple, found.select("doc_1", "doc_2").collect())) == expected
    assert seen.value == 60  # one batch holds all blocks of the term
    monkeypatch.setattr(similarity, "SENT", 5)
    again = similarity.common_term_pairs(postings, singles, "doc_id", 0.9, 4)
    assert set(map(tuple, again.select("doc_1", "doc_2").collect())) == expected


def _brute_force(docs, threshold):
    names = sorted(docs)
    return {(x, y): _cosine(docs[x], docs[y]) for i, x in enumerate(names) for y in names[i + 1:]
            if _cosine(docs[x], docs[y]) >= threshold}


def test_only_related_documents_get_vectors(spark, monkeypatch):
    # Forty documents under one rare term and otherwise on their own; two of them nearly alike.
    docs = {d: {"shared": 1.0, **{f"{d}-{i}": 1.0 for i in range(6)}} for d in range(40)}
    docs[40] = {**docs[7], "more": 0.5}
    written, plain = [], similarity.cut_lineage

    def counted(df):
        out = plain(df)
        if {"vec", "tids", "entries"} & set(out.columns):
            written.append(out.count())
        return out

    monkeypatch.setattr(similarity, "cut_lineage", counted)
    found = similarity.similar_documents(_weights(spark, docs), "doc_id", 0.8)
    got = {(r["doc_1"], r["doc_2"]): r["similarity"] for r in found.collect()}
    expected = _brute_force(docs, 0.8)
    assert got.keys() == expected.keys() == {(7, 40)}
    assert abs(got[7, 40] - expected[7, 40]) < 1e-9
    assert written and max(written) == 2


@pytest.mark.parametrize("parts", [1, 6])
def test_similarity_of_rows_in_pieces(spark, parts):
    # Families of long documents with string ids, whose rows come in two runs or anyhow.
    rnd, docs = random.Random(parts), {}
    for family in range(6):
        base = [f"w{rnd.randrange(900)}" for _ in range(120)]
        for member in range(4):
            kept = rnd.sample(base, 120 - 12 * member)
            docs[f"{family}/{member}"] = {
                **{t: rnd.choice([1.0, 1.5, 2.0]) for t in kept},
                **{f"w{rnd.randrange(900)}": 1.0 for _ in range(10)},
            }
    data = [(d, t, w) for d, terms in docs.items() for t, w in terms.items()]
    runs = [x for half in (0, 1) for x in data if hash(x[1][-1]) % 2 == half]
    rows_ = [(d, t, w, sum(t in terms for terms in docs.values()) * 100) for d, t, w in runs]
    weights = frame(spark, rows_, "doc_id string, term string, weight double, df bigint").coalesce(1)
    weights = weights.repartition(parts, "term") if parts > 1 else weights
    expected = _brute_force(docs, 0.8)
    got = {(r["doc_1"], r["doc_2"]): r["similarity"]
           for r in similarity.similar_documents(weights, "doc_id", 0.8, 10).collect()}
    assert got.keys() == expected.keys() and len(got) > 5
    assert all(abs(got[k] - expected[k]) < 1e-9 for k in got)
