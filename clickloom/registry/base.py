"""Registration of checked queries and the frames Spark derives for them from the tables.

The tables hold no raw app log, so `app_lines` turns every event row into one
JSON line. The tracked action follows from `props.k` (two values of k per
action), the message from the value, the adviser from the event type.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from clickloom.functions import clock
from clickloom.operators import parsing
from clickloom.operators.skew import PARTS
from clickloom.session import configure

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

ENVS = {"course": "prod", "course_test": "test"}
COVER_ENVS = {"cover": "prod", "cover_test": "test"}
AS_OF = "2024-01-31"

# (event, project, element content, element type) of each action.
ACTIONS = [
    ("NativeAppVisit", "app", "快讯详情页访问", ""),
    ("NativeAppLeave", "app", "视频页面离开_播放时长", ""),
    ("NativeAppVisit", "app", "个股_个股详情页访问", ""),
    ("NativeAppClick", "app", "首页_视频直播_内容模块", ""),
    ("NativeAppClick", "app", "发现_视频直播_常态视频区域", ""),
    ("LiveVisit", "app", "视频直播页访问", ""),
    ("LiveVisit", "app", "视频直播播放", ""),
    ("LiveVisit", "app", "视频直播播放", ""),
    ("TDVisit", "app", "金股天下_文章访问", ""),
    ("TDGZHClick", "app", "金股天下_菜单栏点击", ""),
    ("TDGZHVisit", "app", "金股天下_推送点击", ""),
    ("TDClick", "app", "金股天下_文章点击", ""),
    ("TDVisit", "app", "金股天下_文章列表访问", ""),
    ("NativeAppVisit", "app", "视频_播放页面访问", ""),
    ("NativeAppVisit", "app", "动态详情页访问", ""),
    ("NativeAppClick", "app", "观点详情页_页中分享按钮", ""),
    ("H5Click", "app", "观点详情页_底部栏_分享按钮", ""),
    ("NativeAppClick", "app", "动态详情页_底部栏_分享按钮", ""),
    ("NativeAppClick", "app", "视频播放页面_分享按钮", ""),
    ("LCSAppStart", "app", "推送启动app", ""),
    ("CSH5Visit", "course", "课程详情页访问", ""),
    ("CSH5Click", "course_test", "课程详情页_购买", ""),
    ("CSH5Click", "course", "视频直播_弹幕", ""),
    ("CSH5Visit", "course", "财商_课程_直播", ""),
    ("CSH5Visit", "course_test", "财商_课程_回看", ""),
    ("CSH5Visit", "course", "财商_题目解答页访问", ""),
    ("CSH5Visit", "course", "财商_评分结果页访问", ""),
    ("CSH5Visit", "course_test", "财商_图片打卡页访问", ""),
    ("CSH5Click", "course", "财商_题目解答页_提交点击", ""),
    ("BXVisit", "cover", "启见保_文章访问", ""),
    ("BXClick", "cover", "启见保_视频页面往期点击", ""),
    ("BXVisit", "cover", "启见保_视频页面访问", ""),
    ("BXVisit", "cover", "展业助手_计划书详情页访问", ""),
    ("BXClick", "cover", "展业助手_计划书详情页_点击投保", ""),
    ("BXVisit", "cover", "视频直播H5访问", ""),
    ("BXVisit", "cover", "启见保_保障测评页面访问", ""),
    ("BXClick", "cover", "启见保_推广/营销活动页领取", ""),
    ("BXVisit", "cover", "启见保_推广/营销活动页访问", ""),
    ("BXVisit", "cover", "活动页", "启见保_营销活动"),
    ("BXClick", "cover", "活动页", "启见保_营销活动"),
    ("BXVisit", "cover_test", "启见保_文章访问", ""),
    ("NativeAppVisit", "app", "TD合约详情页", ""),
    ("NativeAppClick", "app", "行情_T+D", ""),
    ("H5Visit", "app", "TD开户页", ""),
    ("NativeAppVisit", "app", "理财师主页访问", ""),
    ("NativeAppVisit", "app", "新闻详情页访问", ""),
    ("H5Visit", "app", "其他", ""),
    ("NativeAppQuotLog", "app", "", ""),
    ("LiveVisit", "app", "视频直播播放", ""),
    ("CSH5Visit", "course", "财商_课程_直播", ""),
]


def query(name: str, sql: str | None = None):
    """Register a query with its oracle (None: rows-only, tested on fixtures instead)."""

    def register(fn):
        if name in QUERIES:
            raise ValueError(f"{name} is registered twice")
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return register


class Tables:
    """Lazy frames over one test-data folder."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = configure(spark)
        self.folder = folder

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")

    @cached_property
    def events(self) -> DataFrame:
        """Events with millis and k."""
        k = F.get_json_object("props", "$.k").cast("int")
        return self.table("events").withColumns({"ms": clock.to_millis(F.col("ts")), "k": k})

    @cached_property
    def app_lines(self) -> DataFrame:
        """(event_id, ts, line, dt): one JSON line per event row."""
        slot = F.expr("k div 2") + 1

        def listed(i) -> Column:
            return F.element_at(F.array(*[F.lit(a[i]) for a in ACTIONS]), slot.cast("int"))

        msg = F.floor("value").cast("string")
        user = F.col("user_id").cast("string")
        uid = F.when(F.col("event_type") == "error", "").otherwise(user)
        device = F.when(F.col("event_type").isin("error", "view"), "").otherwise(
            F.concat(F.lit("dev"), user)
        )
        fields = {
            "userID": uid,
            "deviceId": device,
            "$device_id": device,
            "wx_uid": uid,
            "$is_first_day": F.col("value") > 100,
            "v1_element_content": listed(2),
            "v1_element_type": listed(3),
            "v1_message_id": msg,
            "v1_message_title": F.when(F.col("value") >= 100, "").otherwise(F.concat(F.lit("t"), msg)),
            "v1_lcs_id": F.col("event_type"),
            "v1_lcs_name": F.concat(F.lit("n-"), F.col("event_type")),
            "v1_custom_params": F.when(F.col("value") < 1, "直播").otherwise(msg),
            "v1_custom_params2": user,
            "v1_notice_id": msg,
            "v1_uid": user,
            "v1_page_title": F.concat(F.lit("p"), F.col("k").cast("string")),
            "v1_is_push": F.when(F.col("value") > 30, "1").otherwise("0"),
            "value": F.col("value"),
        }
        properties = F.struct(*[c.alias(n) for n, c in fields.items()])
        line = F.struct(
            F.col("event_id").alias("_track_id"),
            F.col("ms").alias("time"),
            F.lit("track").alias("type"),
            F.concat(F.lit("d"), user).alias("distinct_id"),
            F.struct(F.lit("js").alias("$lib"), F.lit("1.2").alias("$lib_version")).alias("lib"),
            listed(0).alias("event"),
            properties.alias("properties"),
            (F.col("ms") + 5).alias("_flush_time"),
            F.col("user_id"),
            listed(1).alias("project"),
            F.lit(2).alias("ver"),
        )
        return self.events.select(
            "event_id", "ts", F.to_json(line).alias("line"),
            F.date_format("ts", clock.DAY).alias("dt"),
        )

    @cached_property
    def app_events(self) -> DataFrame:
        return parsing.envelope(self.app_lines, keep=("event_id",))

    @cached_property
    def documents(self) -> DataFrame:
        return self.table("documents")


def _sql_list(i: int) -> str:
    return "[" + ", ".join("'" + a[i].replace("'", "''") + "'" for a in ACTIONS) + "]"


# The same rows for the oracles, as plain columns and without any JSON line.
EVENT_CTE = """e AS (
  SELECT *, epoch_us(ts) // 1000 AS ms, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k
  FROM events)"""
APP_CTE = EVENT_CTE + f""", a AS (
  SELECT event_id, ts, ms, user_id, event_type, value, k, k // 2 AS slot,
         {_sql_list(0)}[k // 2 + 1] AS event,
         {_sql_list(1)}[k // 2 + 1] AS project,
         {_sql_list(2)}[k // 2 + 1] AS content,
         {_sql_list(3)}[k // 2 + 1] AS element_type,
         CAST(CAST(floor(value) AS BIGINT) AS VARCHAR) AS msg,
         CASE WHEN event_type = 'error' THEN '' ELSE CAST(user_id AS VARCHAR) END AS uid,
         CASE WHEN event_type IN ('error', 'view') THEN ''
              ELSE 'dev' || CAST(user_id AS VARCHAR) END AS device,
         CASE WHEN value >= 100 THEN '' ELSE 't' || CAST(CAST(floor(value) AS BIGINT) AS VARCHAR)
              END AS title,
         CASE WHEN value < 1 THEN '直播' ELSE CAST(CAST(floor(value) AS BIGINT) AS VARCHAR)
              END AS param
  FROM e)"""
WORDS_CTE = """tok AS (
  SELECT doc_id, term FROM (
    SELECT doc_id, unnest(regexp_split_to_array(lower(text), '[^\\p{L}\\p{N}]+')) AS term
    FROM documents) WHERE term <> ''),
tf AS (SELECT doc_id, term, count(*) AS tf FROM tok GROUP BY doc_id, term),
df AS (SELECT term, count(*) AS df FROM tf GROUP BY term),
nd AS (SELECT count(*) AS n FROM documents),
wt AS (SELECT tf.doc_id, tf.term, tf.tf, df.df,
              tf.tf * ln((nd.n + 1.0) / (df.df + 1.0)) AS weight
       FROM tf JOIN df ON tf.term = df.term, nd)"""


def part_of(value: str) -> str:
    """SQL of the part that joined_text puts a value in."""
    return f"CAST(CAST('0x' || substr(md5({value}), 1, 8) AS BIGINT) % {PARTS} AS INTEGER)"


def time_text(ms: str) -> str:
    """SQL text of a millis expression, second precision."""
    return f"strftime(make_timestamp(({ms}) * 1000), '%Y-%m-%d %H:%M:%S')"
