"""Homework answering: behaviour history and page flags."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickloom.functions.jsonmap import TYPED, merged_fields
from clickloom.operators import rules
from clickloom.operators.routing import env_of
from clickloom.operators.parsing import PARSED, with_properties

KEYS = [
    ("v1_element_content", "content"), ("v1_message_title", "message_title"),
    ("v1_message_id", "ques_id"), ("v1_page_title", "page_title"), ("v1_uid", "uid"),
    ("v1_remark", "remark"), ("v1_action", "action"),
]
FLAGS = list(rules.ANSWER_PAGE.codes.values())
CATEGORY = "answer_question"
RELATION = 1


def answer_rows(events: DataFrame, envs: dict[str, str]) -> DataFrame:
    """Distinct answering events with env, kind (click/enter) and page flag.

    Distinct over the whole input: the same event in two partitions acts once.
    """
    content = F.col("content")
    page = rules.ANSWER_PAGE.code(content)
    click = rules.ANSWER_CLICK.code(content)
    rows = with_properties(events.where(rules.ANSWER_CLICK.event_match(F.col("event"))), KEYS)
    return (
        rows.withColumns(
            {
                "env": env_of(F.col("project"), envs),
                "page": page,
                "type": F.coalesce(click, F.when(page.isNotNull(), F.lit("enter"))),
            }
        )
        .where(F.col("type").isNotNull() & F.col("env").isNotNull())
        .drop("properties", "event", "project", PARSED)
        .dropDuplicates()
    )


def answer_history(rows: DataFrame) -> DataFrame:
    return rows.select(
        "env", "uid", F.lit(CATEGORY).alias("category"), F.col("ques_id").alias("relation_id"),
        "type", "remark", "page_title", "message_title", "action",
    )


def page_flags(rows: DataFrame) -> DataFrame:
    """1 or NULL per visited page, for each (env, question, user)."""
    flags = [F.max(F.when(F.col("page") == name, 1)).alias(name) for name in FLAGS]
    return rows.where(F.col("page").isNotNull()).groupBy("env", "ques_id", "uid").agg(*flags)


def merge_flags(existing: DataFrame, flags: DataFrame) -> DataFrame:
    """Existing rows (env, ques_id, uid, ext_info, ques_relation_type) with the flags set.

    Flags are added to the stored JSON as the number 1; other fields keep their type and
    nesting; unknown pairs are inserted.
    """
    keys = ["env", "ques_id", "uid"]
    set_now = F.map_filter(
        F.create_map(*[x for n in FLAGS for x in (F.lit(n), F.col(n).cast("int"))]),
        lambda _k, v: v.isNotNull(),
    ).cast(TYPED)
    joined = existing.join(flags.withColumn("__hit", F.lit(True)), keys, "full")
    merged = merged_fields(F.col("ext_info"), set_now)
    return joined.select(
        *keys,
        F.when(F.col("__hit"), merged).otherwise(F.col("ext_info")).alias("ext_info"),
        F.coalesce(F.col("ques_relation_type"), F.lit(RELATION)).alias("ques_relation_type"),
    )
