"""Filters, codes and fan-out of app events.

Inputs have the columns event, properties, time (millis text) and project.
Project names are deployment settings, so they are arguments.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clickloom.functions import clock
from clickloom.operators import rules, schemas
from clickloom.operators.parsing import PARSED, enriched, with_properties

VISIT_KEYS = [
    ("v1_element_content", "content"), ("v1_message_title", "title"),
    ("v1_message_id", "message_id"), ("v1_lcs_id", "lcs_id"), ("v1_lcs_name", "lcs_name"),
    ("userID", "uid"), ("v1_symbol", "symbol"), ("v1_custom_params", "custom_params"),
]
VISIT_COLUMNS = [
    "type", "uid", "title", "content", "message_id", "lcs_id", "lcs_name", "time", "stay_time",
    "symbol",
]


def of_project(events: DataFrame, project: str | None) -> DataFrame:
    return events if project is None else events.where(F.col("project") == project)


def routed(
    events: DataFrame,
    rule: rules.Rule,
    keys,
    project: str | None = None,
    content: str = "v1_element_content",
) -> DataFrame:
    """Events a rule accepts, with the wanted properties and the code as `type`.

    The event and project filters come first and can reach the scan; the
    properties are read once.
    """
    picked = of_project(events, project).where(rule.event_match(F.col("event")))
    named = next((k[1] for k in keys if isinstance(k, tuple) and k[0] == content), content)
    return (
        with_properties(picked, keys)
        .where(F.col(named).isin(*rule.codes))
        .withColumn("type", rule.code(F.col(named)))
    )


def not_denied(column: Column) -> Column:
    return ~column.isin(*rules.DENIED_PARAMS)


def has_id(column: Column) -> Column:
    return ~column.isin(*rules.MISSING_IDS)


def env_of(project: Column, envs: dict[str, str]) -> Column:
    """Environment name of a project; NULL for a project that is not listed."""
    pairs = [F.lit(x) for item in envs.items() for x in item]
    return F.try_element_at(F.create_map(*pairs), project)


def page_visits(events: DataFrame, project: str | None = None, tz: str = "UTC") -> DataFrame:
    ms = clock.text_to_millis(F.col("time"))
    return (
        routed(events, rules.PAGE_VISIT, VISIT_KEYS, project)
        .where(not_denied(F.col("custom_params")))
        .withColumn("time", clock.format_millis(ms, tz=tz))
        .withColumn("stay_time", F.lit(0).cast("bigint"))
        .select(*VISIT_COLUMNS)
    )


def live_rows(events: DataFrame, project: str | None = None) -> DataFrame:
    """Enter and heartbeat rows of live rooms, with the time in millis (`ms`)."""
    return (
        routed(events, rules.LIVE_VISIT, VISIT_KEYS, project)
        .where(not_denied(F.col("custom_params")) & (F.col("title") != ""))
        .withColumn("ms", clock.text_to_millis(F.col("time")))
    )


TD_KEYS = [
    ("wx_uid", "uid"), ("v1_element_content", "content"), ("v1_message_title", "title"),
    ("v1_message_type", "msg_type"), ("v1_custom_params", "tuisong_param"),
    ("v1_message_id", "message_id"),
]


def td_detail(events: DataFrame, project: str | None = None, tz: str = "UTC") -> DataFrame:
    ms = clock.text_to_millis(F.col("time"))
    return (
        routed(events, rules.TD_DETAIL, TD_KEYS, project)
        .where(F.col("uid") != "")
        .withColumn("time", clock.format_millis(ms, tz=tz))
        .select("uid", "type", "content", "title", "msg_type", "tuisong_param", "time")
    )


def article_rows(events: DataFrame, project: str | None = None) -> DataFrame:
    """(message_id, uid, ms) of every article read."""
    return (
        routed(events, rules.ARTICLE_READ, TD_KEYS, project)
        .where(F.col("uid") != "")
        .select("message_id", "uid", clock.text_to_millis(F.col("time")).alias("ms"))
    )


def play_rows(events: DataFrame, project: str | None = None) -> DataFrame:
    keys = [("v1_element_content", "content"), ("v1_message_id", "msg_id")]
    return (
        routed(events, rules.CONTENT_PLAY, keys, project)
        .where(F.col("msg_id") != "")
        .select("type", "msg_id", clock.text_to_millis(F.col("time")).alias("ms"))
    )


def share_rows(events: DataFrame, project: str | None = None) -> DataFrame:
    keys = [
        ("v1_element_content", "content"), ("v1_message_id", "message_id"),
        ("v1_lcs_id", "lcs_id"),
    ]
    return routed(events, rules.SHARE, keys, project).select(
        "type", "message_id", "lcs_id", clock.text_to_millis(F.col("time")).alias("ms")
    )


def push_rows(events: DataFrame) -> DataFrame:
    keys = [("v1_element_content", "content"), ("v1_notice_id", "notice_id")]
    return (
        routed(events, rules.PUSH_OPEN, keys)
        .where(has_id(F.col("notice_id")))
        .select("notice_id", clock.text_to_millis(F.col("time")).alias("ms"))
    )


def fan_out(events: DataFrame, routes: list[tuple[str, Column]], alias: str = "route") -> DataFrame:
    """One output row per route whose predicate holds; rows matching none disappear."""
    hits = F.filter(
        F.array(*[F.when(pred, F.lit(name)) for name, pred in routes]), lambda r: r.isNotNull()
    )
    return events.withColumn(alias, F.explode(hits))


def course_routes(events: DataFrame, envs: dict[str, str]) -> DataFrame:
    """Course events as enriched JSON, per target list (behaviour/option) and environment."""
    picked = (
        events.where(rules.COURSE_BEHAVIOUR.event_match(F.col("event")))
        .withColumn("env", env_of(F.col("project"), envs))
        .where(F.col("env").isNotNull())
    )
    content = F.col("v1_element_content")
    routes = [
        (name, content.isin(*rule.codes))
        for name, rule in (("behaviour", rules.COURSE_BEHAVIOUR), ("option", rules.COURSE_OPTION))
    ]
    return enriched(
        fan_out(with_properties(picked, ["v1_element_content"]), routes), "event", "time"
    ).select("route", "env", "v1_element_content", "time", "value")


def behaviour_rows(events: DataFrame, project: str | None = None) -> DataFrame:
    """The 29-field behaviour record."""
    picked = of_project(events, project)
    return with_properties(picked, schemas.BEHAVIOUR_PROPERTIES).drop("properties", PARSED)


def _coded(column: str, codes: dict[str, str]) -> tuple[Column, Column]:
    rule = rules.Rule((), codes)
    return F.col(column).isin(*codes), rule.code(F.col(column))


def cover_routes(events: DataFrame, project: str | None = None) -> DataFrame:
    """Insurance behaviour records: (route, type, value); a row may take several routes.

    One pass: every matching route adds one element to an array that is exploded.
    """
    rows = behaviour_rows(events, project)
    article, article_code = _coded("v1_element_content", rules.COVER_ARTICLE)
    plan, plan_code = _coded("v1_element_content", rules.COVER_PLAN)
    assess, assess_code = _coded("v1_element_content", rules.COVER_ASSESS)
    campaign, campaign_code = _coded("v1_element_content", rules.COVER_CAMPAIGN)
    pushed = (F.col("event") == rules.COVER_PUSH_EVENT) & (F.col("v1_is_push") == "1")
    activity = F.col("v1_element_type") == rules.COVER_ACTIVITY_TYPE
    activity_code = rules.Rule((), rules.COVER_ACTIVITY).code(F.col("event"))
    table = [
        ("article", article, article_code, schemas.ARTICLE_FIELDS),
        ("push", pushed, F.lit("isPush"), schemas.PUSH_FIELDS),
        ("activity", activity, activity_code, schemas.ACTIVITY_FIELDS),
        ("plan", plan, plan_code, schemas.PLAN_FIELDS),
        ("assess", assess, assess_code, schemas.ASSESS_FIELDS),
        ("campaign", campaign, campaign_code, schemas.CAMPAIGN_FIELDS),
    ]
    hits = []
    for name, pred, code, fields in table:
        value = F.to_json(F.struct(code.alias("type"), *fields))
        hit = F.struct(F.lit(name).alias("route"), code.alias("type"), value.alias("value"))
        hits.append(F.when(pred, hit))
    picked = rows.withColumn(
        "hit", F.explode(F.filter(F.array(*hits), lambda h: h.isNotNull()))
    )
    return picked.select("hit.route", "hit.type", "hit.value", "v1_element_content", "time")


def mirror(events: DataFrame, envs: dict[str, str]) -> DataFrame:
    """Every event of the listed projects as enriched JSON with its environment."""
    tagged = events.withColumn("env", env_of(F.col("project"), envs))
    return enriched(tagged.where(F.col("env").isNotNull()), "event").select(
        "env", "event", "time", "value"
    )


def rejected(events: DataFrame, rule: rules.Rule, project: str | None = None) -> DataFrame:
    """Count of events whose name fits a rule but whose content has no code."""
    keys = [("v1_element_content", "content")]
    picked = of_project(events, project).where(rule.event_match(F.col("event")))
    return (
        with_properties(picked, keys)
        .where(~F.col("content").isin(*rule.codes))
        .groupBy("event", "content")
        .agg(F.count("*").alias("n_rows"))
    )
