"""Parsing, routing and the app-event jobs."""

from __future__ import annotations

from pyspark.sql import functions as F

from clickloom.functions import clock
from clickloom.functions.jsonmap import json_map, prop
from clickloom.operators import (
    answers, identity, online, parsing, progress, routing, rules, schemas, storage,
)
from clickloom.plans import app as jobs
from clickloom.plans import warehouse
from clickloom.registry.base import (
    APP_CTE, COVER_ENVS, ENVS, EVENT_CTE, ORACLES, Tables, part_of, query, time_text,
)

GAP_6H = 6 * 3600 * 1000
DAY_MS = 24 * 3600 * 1000


# ---- parsing -----------------------------------------------------------------


@query(
    "json_map_lookup",
    f"WITH {EVENT_CTE} SELECT event_id, CAST(k AS VARCHAR) AS k, '' AS nope FROM e",
)
def json_map_lookup(spark, sf):
    m = json_map(F.col("props"))
    return Tables(spark, sf).table("events").select(
        "event_id", prop(m, "k").alias("k"), prop(m, "nope").alias("nope")
    )


@query(
    "event_envelope",
    f"""WITH {APP_CTE}
        SELECT event_id, event, CAST(ms AS VARCHAR) AS time, project FROM a""",
)
def event_envelope(spark, sf):
    return Tables(spark, sf).app_events.select("event_id", "event", "time", "project")


@query(
    "property_columns",
    f"""WITH {APP_CTE}
        SELECT event_id, content AS v1_element_content, msg AS v1_message_id, title,
               '' AS v1_symbol, param AS v1_custom_params FROM a""",
)
def property_columns(spark, sf):
    keys = [
        "v1_element_content", "v1_message_id", ("v1_message_title", "title"), "v1_symbol",
        "v1_custom_params",
    ]
    rows = parsing.with_properties(Tables(spark, sf).app_events, keys)
    return rows.drop("event", "properties", "time", "project")


@query(
    "event_etl",
    f"""WITH {APP_CTE}
        SELECT CAST(event_id AS VARCHAR) AS _track_id, CAST(ms AS VARCHAR) AS time,
               'track' AS type, 'd' || CAST(user_id AS VARCHAR) AS distinct_id, event,
               CAST(ms + 5 AS VARCHAR) AS _flush_time, '' AS map_id,
               CAST(user_id AS VARCHAR) AS user_id, '' AS recv_time, '' AS extractor,
               '' AS project_id, project, '2' AS ver, strftime(ts, '%Y-%m-%d') AS dt
        FROM a""",
)
def event_etl(spark, sf):
    lines = Tables(spark, sf).app_lines
    rows = parsing.typed_events(lines, columns=schemas.LOG_COLUMNS, keep=("dt",))
    return rows.drop("lib", "properties")


_FLAT_VALUES = {
    "ver": "'2'", "lib_lib": "'js'", "lib_lib_version": "'1.2'", "project": "project",
    "type": "'track'", "tmp_track_id": "CAST(event_id AS VARCHAR)",
    "user_id": "CAST(user_id AS VARCHAR)", "distinct_id": "'d' || CAST(user_id AS VARCHAR)",
    "tmp_flush_time": "CAST(ms + 5 AS VARCHAR)", "time": "CAST(ms AS VARCHAR)", "event": "event",
    "properties_deviceId": "device", "properties_userID": "uid",
    "properties_device_id": "device",
    "properties_is_first_day": "CASE WHEN value > 100 THEN 'true' ELSE 'false' END",
    "properties_v1_element_content": "content", "properties_v1_message_title": "title",
    "properties_v1_lcs_name": "'n-' || event_type", "properties_v1_lcs_id": "event_type",
    "properties_v1_custom_params": "param",
    "properties_v1_custom_params2": "CAST(user_id AS VARCHAR)",
    "properties_v1_message_id": "msg",
}


@query(
    "event_flatten",
    f"WITH {APP_CTE} SELECT "
    + ", ".join(f"""{_FLAT_VALUES.get(c, "''")} AS "{c}" """ for c in schemas.FLAT_COLUMNS)
    + " FROM a",
)
def event_flatten(spark, sf):
    return parsing.flat_events(Tables(spark, sf).app_lines)


def _history_lines(t: Tables):
    line = F.struct(
        F.col("event_id").alias("_track_id"),
        F.date_format(F.col("ts"), clock.TEXT_MILLIS).alias("time"),
        F.col("event_type").alias("event"),
        F.col("user_id").cast("string").alias("userid"),
        F.concat(F.lit("dev"), F.col("k").cast("string")).alias("deviceid"),
        F.when(F.col("value") > 50, "1").otherwise("0").alias("$is_first_time"),
        F.when(F.col("event_type") == "signup", "1").alias("$is_first_day"),
        F.col("k").cast("string").alias("extra"),
    )
    return t.events.select("event_id", F.to_json(line).alias("line"),
                           F.date_format("ts", clock.DAY).alias("dt"))


@query(
    "history_etl",
    f"""WITH {EVENT_CTE}
        SELECT CAST(event_id AS VARCHAR) AS _track_id, CAST(ms - 28800000 AS VARCHAR) AS time,
               event_type AS event, CAST(user_id AS VARCHAR) AS user_id, 'app' AS project,
               CAST(user_id AS VARCHAR) AS p_user, 'dev' || CAST(k AS VARCHAR) AS p_device,
               CASE WHEN value > 50 THEN 'true' ELSE 'false' END AS p_first_time,
               CASE WHEN event_type = 'signup' THEN 'true' ELSE 'false' END AS p_first_day,
               CAST(k AS VARCHAR) AS p_extra, true AS envelope_dropped
        FROM e""",
)
def history_etl(spark, sf):
    rows = parsing.history_events(_history_lines(Tables(spark, sf)), project="app")
    p = json_map(F.col("properties"))
    return rows.select(
        "_track_id", "time", "event", "user_id", "project",
        prop(p, "userID").alias("p_user"), prop(p, "deviceId").alias("p_device"),
        prop(p, "$is_first_time").alias("p_first_time"),
        prop(p, "$is_first_day").alias("p_first_day"),
        prop(p, "extra").alias("p_extra"),
        (~F.map_contains_key(p, "time") & ~F.map_contains_key(p, "userid")).alias(
            "envelope_dropped"
        ),
    )


@query(
    "history_plain",
    f"""WITH {EVENT_CTE}
        SELECT CAST(event_id AS VARCHAR) AS _track_id, strftime(ts, '%Y-%m-%d %H:%M:%S.%g') AS time,
               CAST(user_id AS VARCHAR) AS p_user, 'dev' || CAST(k AS VARCHAR) AS p_device,
               CASE WHEN value > 50 THEN '1' ELSE '0' END AS p_first_time,
               CASE WHEN event_type = 'signup' THEN '1' ELSE '' END AS p_first_day,
               CAST(k AS VARCHAR) AS p_extra
        FROM e""",
)
def history_plain(spark, sf):
    """History lines whose flags and clock text are left as they are."""
    rows = parsing.history_events(_history_lines(Tables(spark, sf)), convert=False)
    p = json_map(F.col("properties"))
    return rows.select(
        "_track_id", "time", prop(p, "userID").alias("p_user"), prop(p, "deviceId").alias("p_device"),
        prop(p, "$is_first_time").alias("p_first_time"),
        prop(p, "$is_first_day").alias("p_first_day"), prop(p, "extra").alias("p_extra"),
    )


@query(
    "enriched_properties",
    f"""WITH {APP_CTE}
        SELECT event_id, event AS event_in, CAST(ms AS VARCHAR) AS time_in, msg AS message_in,
               value AS number_in FROM a""",
)
def enriched_properties(spark, sf):
    rows = parsing.enriched(Tables(spark, sf).app_events, "event", "time")
    v = F.col("value")
    return rows.select(
        "event_id",
        F.get_json_object(v, "$.event").alias("event_in"),
        F.get_json_object(v, "$.time").alias("time_in"),
        F.get_json_object(v, "$.v1_message_id").alias("message_in"),
        F.get_json_object(v, "$.value").cast("double").alias("number_in"),
    )


@query(
    "json_key_discovery",
    f"""WITH {APP_CTE}
        SELECT key, count(*) AS n_rows FROM (
          SELECT unnest(['tmp_track_id', 'time', 'type', 'distinct_id', 'lib_lib',
            'lib_lib_version', 'event', 'tmp_flush_time', 'user_id', 'project', 'ver',
            'properties_userID', 'properties_deviceId', 'properties_device_id',
            'properties_wx_uid', 'properties_is_first_day', 'properties_v1_element_content',
            'properties_v1_element_type', 'properties_v1_message_id',
            'properties_v1_message_title', 'properties_v1_lcs_id', 'properties_v1_lcs_name',
            'properties_v1_custom_params', 'properties_v1_custom_params2',
            'properties_v1_notice_id', 'properties_v1_uid', 'properties_v1_page_title',
            'properties_v1_is_push', 'properties_value']) AS key FROM a) GROUP BY key""",
)
def json_key_discovery(spark, sf):
    return parsing.json_keys(Tables(spark, sf).app_lines)


@query(
    "json_merged_types",
    """WITH v AS (
          SELECT unnest(json_keys(j)) AS key, j FROM (
            SELECT json_object('id', event_id, 'at', CASE WHEN event_id % 2 = 0 THEN event_id END,
              'amount', value, 'mixed', CASE WHEN event_id % 3 = 0 THEN to_json(event_type) ELSE to_json(user_id) END,
              'flag', event_id % 2 = 1) AS j FROM events)),
        t AS (SELECT key, json_type(j, '$.' || key) AS t FROM v)
        SELECT key, count(*) AS n_rows, CASE
          WHEN count(*) FILTER (t <> 'NULL') = 0 THEN 'VOID'
          WHEN bool_and(t IN ('UBIGINT', 'BIGINT', 'NULL')) THEN 'BIGINT'
          WHEN bool_and(t IN ('UBIGINT', 'BIGINT', 'DOUBLE', 'NULL')) THEN 'DECIMAL'
          WHEN bool_and(t IN ('VARCHAR', 'NULL')) THEN 'STRING'
          WHEN bool_and(t IN ('BOOLEAN', 'NULL')) THEN 'BOOLEAN' ELSE 'VARIANT' END AS type
        FROM t GROUP BY key""",
)
def json_merged_types(spark, sf):
    odd = F.col("event_id") % 2 == 1
    mixed = F.when(F.col("event_id") % 3 == 0, F.to_json(F.struct(F.col("event_type").alias("mixed")))).otherwise(
        F.to_json(F.struct(F.col("user_id").alias("mixed")))
    )
    rest = F.to_json(
        F.struct(F.col("event_id").alias("id"), F.when(~odd, F.col("event_id")).alias("at"),
                 F.col("value").cast("decimal(18,4)").alias("amount"), odd.alias("flag")),
        {"ignoreNullFields": "false"},
    )
    line = F.concat(F.rtrim(rest, F.lit("}")), F.lit(","), F.ltrim(mixed, F.lit("{")))
    found = parsing.merged_types(Tables(spark, sf).table("events").select(line.alias("line")))
    # DECIMAL(p,s) of any size counts as a decimal.
    kind = F.regexp_extract("type", "^[A-Z]+", 0).alias("type")
    return found.select("key", kind, "n_rows")


@query(
    "json_key_sets",
    "SELECT 'k' AS keys, count(*) AS n_rows FROM events",
)
def json_key_sets(spark, sf):
    return parsing.json_schemas(Tables(spark, sf).table("events"), "props")


@query(
    "plate_symbols",
    f"""WITH {EVENT_CTE}
        SELECT CAST(event_id AS VARCHAR) AS plate, 'p' || CAST(k AS VARCHAR) AS plate_name,
               unnest(['s' || CAST(k AS VARCHAR), 'u' || CAST(user_id AS VARCHAR)]) AS symbol
        FROM e WHERE event_type <> 'error'""",
)
def plate_symbols(spark, sf):
    def member(prefix, column):
        return F.struct(
            F.concat(F.lit(prefix), F.col(column).cast("string")).alias("symbol"),
            F.lit("n").alias("name"),
        )

    members = F.when(
        F.col("event_type") != "error", F.array(member("s", "k"), member("u", "user_id"))
    )
    value = F.struct(
        F.concat(F.lit("p"), F.col("k").cast("string")).alias("plate_name"),
        members.alias("symbol"),
    )
    table = Tables(spark, sf).events.select(
        F.col("event_id").cast("string").alias("key"), F.to_json(value).alias("value")
    )
    return warehouse.plate_symbols(table)


_STAT_SQL = {
    "live_id": "CAST(event_id AS BIGINT)", "circle_id": "CAST(k AS BIGINT)",
    "lcs_id": "CAST(user_id AS BIGINT)", "lcs_name": "event_type",
    "view_count": "CAST(floor(value) AS INTEGER)", "comment_count": "CAST(0 AS INTEGER)",
    "old_user_staying_average": "round(value / 60, 1)",
    "new_user_staying_max": "CAST(k AS INTEGER)",
}


def _stat_default(kind: str) -> str:
    if kind == "string":
        return "''"
    if kind == "minutes":
        return "CAST(0 AS DOUBLE)"
    return f"CAST(0 AS {'BIGINT' if kind == 'bigint' else 'INTEGER'})"


def _stat_table(t: Tables):
    value = F.struct(
        F.col("event_id").alias("live_id"), F.col("k").cast("string").alias("circle_id"),
        F.col("user_id").alias("lcs_id"), F.col("event_type").alias("lcs_name"),
        F.floor("value").cast("string").alias("view_count"),
        F.lit("many").alias("comment_count"),
        F.col("value").cast("string").alias("old_user_staying_average"),
        F.col("k").alias("new_user_staying_max"),
    )
    return t.events.select(
        F.col("event_id").cast("string").alias("key"), F.to_json(value).alias("value"), "ts"
    )


@query(
    "live_stats_typed",
    f"WITH {EVENT_CTE} SELECT "
    + ", ".join(f"{_STAT_SQL.get(n, _stat_default(k))} AS {n}" for n, k in schemas.LIVE_STATS)
    + " FROM e",
)
def live_stats_typed(spark, sf):
    return warehouse.live_stats_insert(_stat_table(Tables(spark, sf)))


@query(
    "live_stats_upsert",
    f"""WITH {EVENT_CTE},
        old AS (SELECT * FROM e WHERE ts < TIMESTAMP '2024-01-20'),
        new AS (SELECT * FROM e WHERE ts >= TIMESTAMP '2024-01-10')
        SELECT CAST(COALESCE(n.event_id, o.event_id) AS INTEGER) AS notice_id,
               CAST(COALESCE(floor(n.value), floor(o.value)) AS INTEGER) AS view_count,
               COALESCE(n.value, 0.0) AS old_user_staying_average,
               CASE WHEN o.event_id IS NOT NULL THEN 'before' ELSE 'today' END AS c_time,
               CASE WHEN o.event_id IS NOT NULL THEN 'before' ELSE 'today' END AS u_time
        FROM old o FULL JOIN new n ON o.event_id = n.event_id""",
)
def live_stats_upsert(spark, sf):
    table = _stat_table(Tables(spark, sf))
    old = parsing.live_info(table.where("ts < timestamp_ntz'2024-01-20'")).select(
        "notice_id", "view_count", F.lit(0.0).alias("old_user_staying_average"),
        F.lit("before").alias("c_time"), F.lit("before").alias("u_time"),
    )
    new = table.where("ts >= timestamp_ntz'2024-01-10'")
    return warehouse.live_stats_upsert(old, new, F.lit("today"))


@query(
    "labelled_text_rows",
    """SELECT CAST(doc_id AS VARCHAR) AS id, unnest([lang, source]) AS label_str,
              text AS title, source AS keyword, lang AS news_label,
              source || ' ' || lang AS total_words
       FROM documents""",
)
def labelled_text_rows(spark, sf):
    line = F.concat_ws(
        "|,|", "doc_id", F.concat_ws(",", "lang", "source"), "text", "source", "lang"
    )
    return parsing.labelled_text(Tables(spark, sf).documents.select(line.alias("value")))


@query(
    "nulls_to_empty",
    """SELECT CAST(event_id AS VARCHAR) AS event_id,
              CASE WHEN event_type = 'error' THEN '' ELSE event_type END AS event_type,
              CASE WHEN value < 5 THEN '' ELSE CAST(user_id AS VARCHAR) END AS user_id
       FROM events""",
)
def nulls_to_empty(spark, sf):
    e = Tables(spark, sf).table("events")
    return parsing.all_text(
        e.select(
            "event_id", F.when(F.col("event_type") != "error", F.col("event_type")).alias(
                "event_type"),
            F.when(F.col("value") >= 5, F.col("user_id")).alias("user_id"),
        )
    )


# ---- filters, identity, storage ---------------------------------------------


@query(
    "identity_fallback",
    f"""WITH {APP_CTE}
        SELECT event_id,
               CASE WHEN uid <> '' THEN uid WHEN device <> '' THEN device
                    ELSE 'd' || CAST(user_id AS VARCHAR) END AS identity,
               CASE WHEN uid = '' AND device = '' THEN 'd' || CAST(user_id AS VARCHAR)
                    ELSE device END AS device
        FROM a""",
)
def identity_fallback(spark, sf):
    lines = Tables(spark, sf).app_lines
    typed = parsing.typed_events(lines, keep=("event_id",))
    rows = parsing.with_properties(typed, ["userID", "deviceId"])
    return identity.with_identity(rows).select("event_id", "identity", "device")


@query(
    "identity_union",
    f"""WITH {APP_CTE}, ids AS (
          SELECT device AS id FROM a UNION ALL SELECT device FROM a UNION ALL SELECT uid FROM a)
        SELECT id, count(*) AS num FROM ids WHERE id <> '' GROUP BY id""",
)
def identity_union(spark, sf):
    keys = [("$device_id", "d1"), ("deviceId", "d2"), ("userID", "u")]
    rows = parsing.with_properties(Tables(spark, sf).app_events, keys)
    ids = identity.per_identity(rows, ["d1", "d2", "u"])
    return ids.groupBy("id").agg(F.count("*").alias("num"))


@query(
    "loggable_events",
    f"""WITH {APP_CTE} SELECT event_id, event FROM a
        WHERE event IS NOT NULL AND event <> '' AND event <> 'NativeAppQuotLog'""",
)
def loggable_events(spark, sf):
    return storage.loggable(Tables(spark, sf).app_events).select("event_id", "event")


@query(
    "event_cells",
    f"""WITH {APP_CTE}
        SELECT CASE WHEN uid <> '' THEN uid WHEN device <> '' THEN device
                    ELSE 'd' || CAST(user_id AS VARCHAR) END || '|'
               || CAST(9223372036854775807 - ms AS VARCHAR) AS bare_key,
               true AS salted,
               CASE WHEN uid <> '' THEN uid WHEN device <> '' THEN device
                    ELSE 'd' || CAST(user_id AS VARCHAR) END AS userid,
               CAST(ms AS VARCHAR) AS time, event,
               CASE WHEN uid = '' AND device = '' THEN 'd' || CAST(user_id AS VARCHAR)
                    ELSE device END AS deviceid, project
        FROM a WHERE event <> 'NativeAppQuotLog'""",
)
def event_cells(spark, sf):
    typed = parsing.typed_events(Tables(spark, sf).app_lines)
    cells = warehouse.event_rowkeys(typed)
    key = F.col("row_key")
    return cells.select(
        key.substr(F.lit(3), F.length(key)).alias("bare_key"),
        key.substr(1, 2).rlike(r"^[A-F]\|$").alias("salted"),
        "userid", "time", "event", "deviceid", "project",
    )


@query(
    "author_view_cells",
    """SELECT CAST(o_custkey AS VARCHAR) || '-'
              || CAST(epoch_us(CAST(o_orderdate AS TIMESTAMP)) // 1000 AS VARCHAR) AS bare_key,
              CAST(o_orderkey AS VARCHAR) AS id, o_orderstatus AS title,
              CASE WHEN o_totalprice < 100000 THEN '' ELSE o_orderpriority END AS summary
       FROM orders""",
)
def author_view_cells(spark, sf):
    views = Tables(spark, sf).table("orders").select(
        F.col("o_orderkey").alias("id"), F.col("o_custkey").alias("p_uid"),
        F.col("o_orderstatus").alias("title"),
        F.when(F.col("o_totalprice") >= 100000, F.col("o_orderpriority")).alias("summary"),
        F.col("o_orderdate").alias("c_time"),
    )
    cells = storage.view_cells(views, clock.to_millis(F.col("c_time")))
    key = F.col("row_key")
    return cells.select(
        key.substr(F.lit(3), F.length(key)).alias("bare_key"), "id", "title", "summary"
    )


@query(
    "user_live_rooms",
    f"""WITH {APP_CTE}, r AS (
          SELECT DISTINCT reverse(uid) AS row_key, msg FROM a
          WHERE event = 'LiveVisit' AND content = '视频直播播放' AND uid <> '')
        SELECT row_key, {part_of('msg')} AS part, string_agg(msg, '-' ORDER BY msg) AS extra_ids
        FROM r GROUP BY ALL""",
)
def user_live_rooms(spark, sf):
    return warehouse.user_live_rooms(Tables(spark, sf).app_events)


@query(
    "event_project_filter",
    f"""WITH {APP_CTE} SELECT event, count(*) AS num FROM a
        WHERE project = 'app'
          AND event IN ('LiveVisit', 'NativeAppVisit', 'NativeAppLeave', 'NativeAppClick')
        GROUP BY event""",
)
def event_project_filter(spark, sf):
    rows = routing.of_project(Tables(spark, sf).app_events, "app")
    kept = rows.where(rules.PAGE_VISIT.event_match(F.col("event")))
    return kept.groupBy("event").agg(F.count("*").alias("num"))


@query(
    "environment_of_project",
    f"""WITH {APP_CTE}
        SELECT event_id, CASE project WHEN 'course' THEN 'prod' WHEN 'course_test' THEN 'test'
               END AS env FROM a""",
)
def environment_of_project(spark, sf):
    env = routing.env_of(F.col("project"), ENVS)
    return Tables(spark, sf).app_events.select("event_id", env.alias("env"))


@query(
    "content_without_code",
    f"""WITH {APP_CTE} SELECT event, content, count(*) AS num FROM a
        WHERE project = 'app' AND event = 'NativeAppVisit'
          AND content NOT IN ('视频_播放页面访问', '动态详情页访问')
        GROUP BY event, content""",
)
def content_without_code(spark, sf):
    rows = routing.rejected(Tables(spark, sf).app_events, rules.CONTENT_PLAY, "app")
    return rows.withColumnRenamed("n_rows", "num")


# ---- visits, sessions, reads -------------------------------------------------


@query(
    "page_visits",
    f"""WITH {APP_CTE}
        SELECT CASE slot WHEN 0 THEN 'globalnews' WHEN 1 THEN 'leave_video' WHEN 2 THEN 'symbol'
                    ELSE 'enter_video' END AS type,
               uid, title, content, msg AS message_id, event_type AS lcs_id,
               'n-' || event_type AS lcs_name, {time_text('ms')} AS time,
               CAST(0 AS BIGINT) AS stay_time, '' AS symbol
        FROM a WHERE slot BETWEEN 0 AND 4 AND param <> '直播'""",
)
def page_visits(spark, sf):
    return jobs.page_visits(Tables(spark, sf).app_events, "app")


def _session_sql(base: str, keys: str, gap: int, extra: str = "") -> str:
    """Gap sessions by lag over single rows."""
    return f"""
      s1 AS (SELECT *, CASE WHEN ms - lag(ms) OVER w <= {gap} THEN 0 ELSE 1 END AS fresh
             FROM {base} WINDOW w AS (PARTITION BY {keys} ORDER BY ms)),
      s2 AS (SELECT *, sum(fresh) OVER (PARTITION BY {keys} ORDER BY ms
                                        ROWS UNBOUNDED PRECEDING) AS session FROM s1)"""


@query(
    "live_sessions",
    f"""WITH {APP_CTE}, l AS (
          SELECT uid, event_type AS lcs_id, 'n-' || event_type AS lcs_name, title, content,
                 msg AS message_id, ms
          FROM a WHERE slot IN (5, 6, 7, 48) AND param <> '直播' AND title <> ''),
        {_session_sql('l', 'uid, lcs_id', GAP_6H)},
        g AS (SELECT uid, lcs_id, lcs_name, session, min(ms) AS m1, max(ms) AS m2,
                     arg_min(title, ms) AS t1, arg_max(title, ms) AS t2,
                     arg_min(content, ms) AS c1, arg_max(content, ms) AS c2,
                     arg_min(message_id, ms) AS i1, arg_max(message_id, ms) AS i2
              FROM s2 GROUP BY uid, lcs_id, lcs_name, session)
        SELECT 'enter_live' AS type, uid, t1 AS title, c1 AS content, i1 AS message_id, lcs_id,
               lcs_name, {time_text('m1')} AS time, CAST(0 AS BIGINT) AS stay_time, '' AS symbol
        FROM g
        UNION ALL
        SELECT 'leave_live', uid, t2, c2, i2, lcs_id, lcs_name, {time_text('m2 + 3000')},
               (m2 - m1 + 3000) // 1000, '' FROM g""",
)
def live_sessions(spark, sf):
    return jobs.live_sessions(Tables(spark, sf).app_events, "app", GAP_6H)


@query(
    "visit_list",
    f"SELECT * FROM ({ORACLES['page_visits']}) UNION ALL BY NAME SELECT * FROM ({ORACLES['live_sessions']})",
)
def visit_list(spark, sf):
    return jobs.visit_list(Tables(spark, sf).app_events, "app", GAP_6H)


@query(
    "gap_sessions",
    f"""WITH {EVENT_CTE}, {_session_sql('e', 'user_id', GAP_6H)}
        SELECT user_id, min(ms) AS first_ms, max(ms) AS last_ms, count(*) AS n_rows,
               (max(ms) - min(ms) + 3000) // 1000 AS stay_time
        FROM s2 GROUP BY user_id, session""",
)
def gap_sessions(spark, sf):
    from clickloom.operators import sessions

    rows = sessions.gap_sessions(Tables(spark, sf).events, ["user_id"], "ms", GAP_6H)
    stay = sessions.stay_seconds(F.col("first_ms"), F.col("last_ms"))
    return rows.select("user_id", "first_ms", "last_ms", "n_rows", stay.alias("stay_time"))


def _reads_sql(base: str, keys: str, on: str, gap: int) -> str:
    """Greedy chain: follow, from each key's first row, the next row beyond the gap."""
    return f"""
      r AS (SELECT DISTINCT {keys}, ms FROM {base}),
      nx AS (SELECT *, min(ms) OVER (PARTITION BY {keys} ORDER BY ms
               RANGE BETWEEN {gap + 1} FOLLOWING AND UNBOUNDED FOLLOWING) AS nxt FROM r),
      chain AS (
        SELECT {keys}, min(ms) AS ms FROM r GROUP BY {keys}
        UNION ALL
        SELECT {', '.join('nx.' + k.strip() for k in keys.split(','))}, nx.nxt
        FROM chain c JOIN nx ON {on.replace('x.', 'c.').replace('y.', 'nx.')} AND c.ms = nx.ms
        WHERE nx.nxt IS NOT NULL)"""


@query(
    "reads_deduplicated",
    f"""WITH RECURSIVE {EVENT_CTE},
        {_reads_sql('e', 'user_id, event_type',
                    'x.user_id = y.user_id AND x.event_type = y.event_type', DAY_MS)}
        SELECT user_id, event_type, count(*) AS num FROM chain GROUP BY user_id, event_type""",
)
def reads_deduplicated(spark, sf):
    from clickloom.operators import reads

    return reads.counted_reads(
        Tables(spark, sf).events, ["user_id", "event_type"], "ms", DAY_MS
    )


@query(
    "article_reads",
    f"""WITH RECURSIVE {APP_CTE},
        t AS (SELECT msg AS message_id, uid, ms FROM a WHERE slot = 8 AND uid <> ''),
        {_reads_sql('t', 'message_id, uid',
                    'x.message_id = y.message_id AND x.uid = y.uid', 100_000)}
        SELECT message_id, count(*) AS num FROM chain GROUP BY message_id""",
)
def article_reads(spark, sf):
    return jobs.article_reads(Tables(spark, sf).app_events, "app")


@query(
    "article_reads_raw",
    f"""WITH {APP_CTE} SELECT msg AS message_id, count(*) AS num FROM a
        WHERE slot = 8 AND uid <> '' GROUP BY msg""",
)
def article_reads_raw(spark, sf):
    return jobs.article_reads_raw(Tables(spark, sf).app_events, "app")


@query(
    "td_behaviour_detail",
    f"""WITH {APP_CTE}
        SELECT uid, CASE slot WHEN 8 THEN 'artiVisit' WHEN 9 THEN 'menu' WHEN 10 THEN 'push'
                         WHEN 11 THEN 'artiClick' WHEN 12 THEN 'artiList' END AS type,
               content, title, '' AS msg_type, param AS tuisong_param, {time_text('ms')} AS time
        FROM a WHERE slot BETWEEN 8 AND 12 AND uid <> ''""",
)
def td_behaviour_detail(spark, sf):
    return jobs.td_behaviour_detail(Tables(spark, sf).app_events, "app")


# ---- counters ----------------------------------------------------------------


@query(
    "content_plays",
    f"""WITH {APP_CTE}
        SELECT time_bucket(INTERVAL 10 MINUTE, ts, TIMESTAMP '2024-01-01') AS window_start,
               CASE slot WHEN 13 THEN 'vedio' ELSE 'dynamic' END AS type, msg AS msg_id,
               count(*) AS num
        FROM a WHERE slot IN (13, 14) GROUP BY ALL""",
)
def content_plays(spark, sf):
    rows = jobs.content_plays(Tables(spark, sf).app_events, "app")
    return rows.withColumn("window_start", F.col("window_start").cast("timestamp_ntz"))


@query(
    "content_plays_total",
    f"""WITH {APP_CTE}
        SELECT CASE slot WHEN 13 THEN 'vedio' ELSE 'dynamic' END AS type, msg AS msg_id,
               count(*) AS num
        FROM a WHERE slot IN (13, 14) GROUP BY ALL""",
)
def content_plays_total(spark, sf):
    return jobs.content_plays_total(Tables(spark, sf).app_events, "app")


_SHARE = """CASE slot WHEN 15 THEN 'view_share' WHEN 16 THEN 'view_share'
            WHEN 17 THEN 'dynamic_share' ELSE 'video_share' END"""


@query(
    "shares_by_adviser",
    f"""WITH {APP_CTE}
        SELECT time_bucket(INTERVAL 1 MINUTE, ts, TIMESTAMP '2024-01-01') AS window_start,
               {_SHARE} || '_num' AS metric, event_type AS lcs_id,
               strftime(ts, '%Y-%m-%d') AS day, count(*) AS num
        FROM a WHERE slot BETWEEN 15 AND 18 GROUP BY ALL""",
)
def shares_by_adviser(spark, sf):
    rows, _ = jobs.share_stats(Tables(spark, sf).app_events, "app")
    return rows.withColumn("window_start", F.col("window_start").cast("timestamp_ntz"))


@query(
    "shares_by_message",
    f"""WITH {APP_CTE}
        SELECT time_bucket(INTERVAL 1 MINUTE, ts, TIMESTAMP '2024-01-01') AS window_start,
               {_SHARE} || '_' || msg AS field, count(*) AS num
        FROM a WHERE slot BETWEEN 15 AND 18 GROUP BY ALL""",
)
def shares_by_message(spark, sf):
    _, rows = jobs.share_stats(Tables(spark, sf).app_events, "app")
    return rows.withColumn("window_start", F.col("window_start").cast("timestamp_ntz"))


@query(
    "push_opens",
    f"""WITH {APP_CTE} SELECT msg AS notice_id, count(*) AS num FROM a
        WHERE slot = 19 AND msg <> '0' GROUP BY msg""",
)
def push_opens(spark, sf):
    return jobs.push_opens(Tables(spark, sf).app_events)


# ---- courses and answers -----------------------------------------------------


@query(
    "course_routing",
    f"""WITH {APP_CTE}, c AS (
          SELECT *, CASE project WHEN 'course' THEN 'prod' ELSE 'test' END AS env FROM a
          WHERE slot IN (20, 21, 22))
        SELECT 'behaviour' AS route, env, content, CAST(ms AS VARCHAR) AS time,
               event AS value_event, msg AS value_message FROM c
        UNION ALL
        SELECT 'option', env, content, CAST(ms AS VARCHAR), event, msg FROM c
        WHERE slot IN (20, 21)""",
)
def course_routing(spark, sf):
    rows = jobs.course_routing(Tables(spark, sf).app_events, ENVS)
    return rows.select(
        "route", "env", F.col("v1_element_content").alias("content"), "time",
        F.get_json_object("value", "$.event").alias("value_event"),
        F.get_json_object("value", "$.v1_message_id").alias("value_message"),
    )


_MARKS = """marks AS (
  SELECT DISTINCT CAST(user_id AS VARCHAR) AS uid, msg AS item,
         CASE project WHEN 'course' THEN 'prod' ELSE 'test' END AS env,
         CASE WHEN slot = 24 THEN 'play' ELSE 'live' END AS mode,
         CASE WHEN slot = 24 THEN TRY_CAST(param AS BIGINT) ELSE ms // 30000 * 30000 END AS bucket
  FROM a WHERE slot IN (23, 24, 49) AND (slot <> 24 OR TRY_CAST(param AS BIGINT) IS NOT NULL)),
plan AS (SELECT CAST(k AS VARCHAR) AS item, min(ms) AS start_ms, max(ms) AS end_ms
         FROM a GROUP BY k)"""
_GRID = """grid AS (
  SELECT item, i AS idx, (start_ms // 30000 + 1 + i) * 30000 AS point
  FROM plan, LATERAL (SELECT unnest(range(
    0, greatest((end_ms - (start_ms // 30000 + 1) * 30000) // 30000 + 1, 1))) AS i))"""


@query("watch_marks", f"WITH {APP_CTE}, {_MARKS} SELECT * FROM marks")
def watch_marks(spark, sf):
    return progress.watch_marks(Tables(spark, sf).app_events, ENVS)


def _schedule(t: Tables):
    """Each k stands for a course item that runs from its first to its last event."""
    return t.events.groupBy(F.col("k").cast("string").alias("item")).agg(
        F.min("ms").alias("start_ms"), F.max("ms").alias("end_ms")
    )


@query(
    "course_progress",
    f"""WITH {APP_CTE}, {_MARKS}, {_GRID},
        size AS (SELECT item, count(*) AS n FROM grid GROUP BY item),
        seen AS (
          SELECT DISTINCT uid, m.item, env, idx FROM marks m JOIN grid g
            ON m.item = g.item AND m.mode = 'live' AND m.bucket = g.point
          UNION
          SELECT DISTINCT uid, m.item, env, idx FROM marks m JOIN grid g
            ON m.item = g.item AND m.mode = 'play' AND m.bucket // 30 = g.idx)
        SELECT m.uid, m.item, m.env, count(DISTINCT s.idx) / CAST(max(z.n) AS DOUBLE) AS percent,
               count(DISTINCT s.idx) * 30 AS times
        FROM (SELECT DISTINCT uid, item, env FROM marks) m
        JOIN size z ON m.item = z.item
        LEFT JOIN seen s ON m.uid = s.uid AND m.item = s.item AND m.env = s.env
        GROUP BY m.uid, m.item, m.env""",
)
def course_progress(spark, sf):
    t = Tables(spark, sf)
    return jobs.course_progress(t.app_events, _schedule(t), ENVS)


@query(
    "grid_points_watched",
    f"""WITH {APP_CTE}, {_MARKS}, {_GRID}
        SELECT g.item, g.idx, g.point, count(m.uid) AS num
        FROM grid g LEFT JOIN (SELECT DISTINCT item, bucket, uid FROM marks WHERE mode = 'live') m
          ON m.item = g.item AND m.bucket = g.point
        GROUP BY ALL HAVING count(m.uid) > 0""",
)
def grid_points_watched(spark, sf):
    t = Tables(spark, sf)
    marks = progress.watch_marks(t.app_events, ENVS).where("mode = 'live'")
    return progress.grid_hits(marks, _schedule(t))


@query(
    "item_schedule",
    """SELECT o.o_orderkey AS item, c.c_name AS start_time, c.c_mktsegment AS end_time
       FROM orders o LEFT JOIN (SELECT * FROM customer WHERE c_acctbal > 0) c
         ON o.o_custkey = c.c_custkey""",
)
def item_schedule(spark, sf):
    t = Tables(spark, sf)
    items = t.table("orders").select(
        F.col("o_orderkey").alias("id"), F.col("o_custkey").alias("circle_notice_id")
    )
    notices = t.table("customer").where("c_acctbal > 0").select(
        F.col("c_custkey").alias("id"), F.col("c_name").alias("start_time"),
        F.col("c_mktsegment").alias("end_time"),
    )
    return progress.item_schedule(items, notices)


_ANSWERS = """ans AS (
  SELECT DISTINCT CASE project WHEN 'course' THEN 'prod' ELSE 'test' END AS env,
         CAST(user_id AS VARCHAR) AS uid, msg AS ques_id, slot, ms, title,
         'p' || CAST(k AS VARCHAR) AS page_title,
         CASE WHEN slot = 28 THEN 'click' ELSE 'enter' END AS type
  FROM a WHERE slot BETWEEN 25 AND 28)"""


@query(
    "answer_history",
    f"""WITH {APP_CTE}, {_ANSWERS}
        SELECT env, uid, 'answer_question' AS category, ques_id AS relation_id, type,
               '' AS remark, page_title, title AS message_title, '' AS action FROM ans""",
)
def answer_history(spark, sf):
    return jobs.answer_history(Tables(spark, sf).app_events.drop("event_id"), ENVS)


@query(
    "answer_flags",
    f"""WITH {APP_CTE}, {_ANSWERS},
        old AS (SELECT DISTINCT 'prod' AS env, CAST(user_id AS VARCHAR) AS uid, msg AS ques_id
                FROM a WHERE slot = 0),
        f AS (SELECT env, uid, ques_id,
                max(CASE WHEN slot = 25 THEN '1' END) AS p1,
                max(CASE WHEN slot = 26 THEN '1' END) AS p2,
                max(CASE WHEN slot = 27 THEN '1' END) AS p3
              FROM ans WHERE type = 'enter' GROUP BY ALL)
        SELECT COALESCE(o.env, f.env) AS env, COALESCE(o.uid, f.uid) AS uid,
               COALESCE(o.ques_id, f.ques_id) AS ques_id,
               CASE WHEN o.env IS NOT NULL THEN 'x' END AS kept,
               p1 AS enter_answer_page, p2 AS enter_score_page, p3 AS enter_course_sign_page,
               '{{' || concat_ws(',',
                 CASE WHEN o.env IS NOT NULL THEN '"kept":"x","n":1,"o":{{"a":[1]}},"b":true' END,
                 CASE WHEN p1 = '1' THEN '"enter_answer_page":1' END,
                 CASE WHEN p2 = '1' THEN '"enter_score_page":1' END,
                 CASE WHEN p3 = '1' THEN '"enter_course_sign_page":1' END) || '}}' AS ext_info,
               CAST(CASE WHEN o.env IS NOT NULL THEN 7 ELSE 1 END AS INTEGER)
                 AS ques_relation_type
        FROM old o FULL JOIN f ON o.env = f.env AND o.uid = f.uid AND o.ques_id = f.ques_id""",
)
def answer_flags(spark, sf):
    t = Tables(spark, sf)
    existing = (
        parsing.with_properties(t.app_events, ["v1_uid", "v1_message_id", "v1_element_content"])
        .where(F.col("v1_element_content") == "快讯详情页访问")
        .select(
            F.lit("prod").alias("env"), F.col("v1_message_id").alias("ques_id"),
            F.col("v1_uid").alias("uid"), F.lit('{"kept":"x","n":1,"o":{"a":[1]},"b":true}').alias("ext_info"),
            F.lit(7).alias("ques_relation_type"),
        )
        .distinct()
    )
    rows = jobs.answer_flags(t.app_events.drop("event_id"), existing, ENVS)
    shown = [F.get_json_object("ext_info", f"$.{n}").alias(n) for n in ["kept", *answers.FLAGS]]
    return rows.select("env", "uid", "ques_id", *shown, "ext_info", "ques_relation_type")


# ---- insurance ---------------------------------------------------------------

_BEHAVIOUR_SQL = {
    "v1_element_content": "content", "v1_message_title": "title", "v1_message_id": "msg",
    "v1_custom_params": "param", "wx_uid": "uid", "v1_lcs_name": "'n-' || event_type",
    "v1_lcs_id": "event_type", "v1_element_type": "element_type",
    "v1_is_push": "CASE WHEN value > 30 THEN '1' ELSE '0' END",
    "v1_page_title": "'p' || CAST(k AS VARCHAR)", "v1_custom_params2": "CAST(user_id AS VARCHAR)",
}


@query(
    "behaviour_record",
    f"WITH {APP_CTE} SELECT event, project, CAST(ms AS VARCHAR) AS time, "
    + ", ".join(f"{_BEHAVIOUR_SQL.get(c, chr(39) * 2)} AS {c}" for c in schemas.BEHAVIOUR_PROPERTIES)
    + " FROM a WHERE project = 'cover'",
)
def behaviour_record(spark, sf):
    rows = routing.behaviour_rows(Tables(spark, sf).app_events, "cover")
    return rows.drop("event_id")


@query(
    "insurance_routing",
    f"""WITH {APP_CTE}, c AS (SELECT *, CASE WHEN value > 30 THEN '1' ELSE '0' END AS pushed
                              FROM a WHERE project = 'cover'),
        r AS (
          SELECT *, 'article' AS route, CASE slot WHEN 29 THEN 'view_article'
            WHEN 30 THEN 'video_past_click' ELSE 'video_visit' END AS type
          FROM c WHERE slot IN (29, 30, 31)
          UNION ALL
          SELECT *, 'push', 'isPush' FROM c WHERE event = 'BXVisit' AND pushed = '1'
          UNION ALL
          SELECT *, 'activity', CASE event WHEN 'BXVisit' THEN 'activity_visit'
            ELSE 'activity_click' END FROM c WHERE slot IN (38, 39)
          UNION ALL
          SELECT *, 'plan', CASE slot WHEN 32 THEN 'planbook_visit' WHEN 33 THEN 'planbook_click'
            ELSE 'live_h5_visit' END FROM c WHERE slot IN (32, 33, 34)
          UNION ALL
          SELECT *, 'assess', 'se_visit' FROM c WHERE slot = 35
          UNION ALL
          SELECT *, 'campaign', CASE slot WHEN 36 THEN 'shanzhen_receive'
            ELSE 'shanzhen_visit' END FROM c WHERE slot IN (36, 37))
        SELECT route, type, type AS value_type, CAST(ms AS VARCHAR) AS time, content,
               CASE WHEN route IN ('assess', 'campaign') THEN NULL ELSE title END AS value_title,
               CASE WHEN route = 'push' THEN pushed END AS value_push,
               uid AS value_uid,
               CASE WHEN route = 'campaign' THEN CAST(user_id AS VARCHAR) END AS value_params2
        FROM r""",
)
def insurance_routing(spark, sf):
    rows = jobs.insurance_routing(Tables(spark, sf).app_events, "cover")

    def field(path):
        return F.get_json_object("value", f"$.{path}")

    return rows.select(
        "route", "type", field("type").alias("value_type"), "time",
        F.col("v1_element_content").alias("content"),
        field("v1_message_title").alias("value_title"), field("v1_is_push").alias("value_push"),
        field("wx_uid").alias("value_uid"), field("v1_custom_params2").alias("value_params2"),
    )


@query(
    "insurance_mirror",
    f"""WITH {APP_CTE}
        SELECT CASE project WHEN 'cover' THEN 'prod' ELSE 'test' END AS env, event,
               CAST(ms AS VARCHAR) AS time, event AS value_event, value AS value_number
        FROM a WHERE project IN ('cover', 'cover_test')""",
)
def insurance_mirror(spark, sf):
    rows = jobs.insurance_mirror(Tables(spark, sf).app_events, COVER_ENVS)
    return rows.select(
        "env", "event", "time", F.get_json_object("value", "$.event").alias("value_event"),
        F.get_json_object("value", "$.value").cast("double").alias("value_number"),
    )


# ---- online ------------------------------------------------------------------


@query(
    "online_viewers",
    f"""WITH {APP_CTE}, l AS (
          SELECT event_type AS lcs_id, title, device, ts, ms FROM a
          WHERE event = 'LiveVisit' AND content = '视频直播播放' AND device <> ''),
        w AS (SELECT *, time_bucket(INTERVAL 5 SECOND, ts, TIMESTAMP '2024-01-01')
                        - to_seconds(5 * i) AS window_start
              FROM l, range(12) g(i))
        SELECT window_start, lcs_id, title, count(DISTINCT device) AS online_counts,
               max(make_timestamp(ms * 1000)) AS count_time
        FROM w GROUP BY ALL""",
)
def online_viewers(spark, sf):
    rows = jobs.online_viewers(Tables(spark, sf).app_events)
    return rows.withColumns(
        {c: F.col(c).cast("timestamp_ntz") for c in ("window_start", "count_time")}
    )


_STATUS = """st AS (
  SELECT lpad(CAST(k AS VARCHAR), CASE WHEN k < 10 THEN 4 ELSE 5 END, '0') AS room,
         CAST(user_id AS VARCHAR) AS uid,
         CASE WHEN event_type IN ('click', 'view', 'purchase') THEN '1' ELSE '0' END AS status,
         CAST(ms AS VARCHAR) AS time
  FROM e),
latest AS (SELECT room, uid, status, time FROM (
  SELECT *, row_number() OVER (PARTITION BY room, uid ORDER BY time DESC, status DESC) AS rn
  FROM st) WHERE rn = 1)"""


def _status_lines(t: Tables):
    width = F.when(F.col("k") < 10, F.lit(4)).otherwise(F.lit(5))
    status = (
        F.when(F.col("event_type").isin("click", "view", "purchase"), "1")
        .when(F.col("event_type") == "error", "")
        .otherwise("0")
    )
    record = F.struct(
        F.lpad(F.col("k").cast("string"), width, F.lit("0")).alias("extra_id"),
        F.col("user_id").cast("string").alias("uid"), status.alias("is_online"),
        F.col("ms").cast("string").alias("c_time"),
    )
    return t.events.select(F.to_json(record).alias("value"))


@query(
    "latest_status",
    f"WITH {EVENT_CTE}, {_STATUS} SELECT room, uid, status, time FROM latest",
)
def latest_status(spark, sf):
    return online.latest_status(online.status_rows(_status_lines(Tables(spark, sf))))


@query(
    "room_online_users",
    f"""WITH {EVENT_CTE}, {_STATUS}
        SELECT room, count(*) FILTER (WHERE status = '1') AS online FROM latest
        WHERE length(room) = 5 GROUP BY room""",
)
def room_online_users(spark, sf):
    return jobs.room_online_users(_status_lines(Tables(spark, sf)))
