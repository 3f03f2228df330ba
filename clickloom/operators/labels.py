"""Behaviour labels and recency scores of users."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clickloom.operators import rules
from clickloom.operators.identity import per_identity
from clickloom.operators.parsing import with_properties
from clickloom.operators.skew import salted_join

ID_COLUMNS = ["$device_id", "deviceId", "userID"]


def rule_number(event: Column, content: Column, listed: Column) -> Column:
    """Position of the first label rule that holds; NULL if none does."""
    out = None
    for i, (_flag, name, text, needs_listed) in enumerate(rules.LABEL_RULES):
        hit = (event == name) & (content == text)
        if needs_listed:
            hit = hit & listed
        out = F.when(hit, i) if out is None else out.when(hit, i)
    return out


def user_labels(
    events: DataFrame, advisers: DataFrame, keep_empty: bool = False
) -> DataFrame:
    """Six 0/1 flags per identity (device id, app device, user id), one scan.

    `advisers` has one column lcs_id. Events are counted per identity, rule text
    and adviser before they meet the adviser list, so the join sees few rows.
    """
    keys = [(c, f"__id{i}") for i, c in enumerate(ID_COLUMNS)]
    rows = with_properties(events, [*keys, "v1_element_content", "v1_lcs_id"])
    ids = per_identity(rows, [alias for _c, alias in keys], "id", keep_empty)
    counted = ids.groupBy("id", "event", "v1_element_content", "v1_lcs_id").agg(
        F.count("*").alias("n")
    )
    listed = advisers.select(F.col("lcs_id").alias("v1_lcs_id"), F.lit(True).alias("listed"))
    joined = salted_join(counted, listed.distinct(), ["v1_lcs_id"], ["id"], "left")
    number = rule_number(
        F.col("event"), F.col("v1_element_content"), F.coalesce("listed", F.lit(False))
    )
    flags = []
    for i, flag in enumerate(rules.LABEL_FLAGS):
        hits = F.sum(F.when(F.col("rule") == i, F.col("n")).otherwise(0))
        above = rules.LABEL_THRESHOLDS.get(flag, 0)
        flags.append(F.when(hits > above, 1).otherwise(0).alias(flag))
    return joined.select("id", "n", number.alias("rule")).groupBy("id").agg(*flags)


# Age in days of each recency bucket, newest first.
BUCKETS = {"a": (1, 1), "b": (2, 3), "c": (4, 7), "d": (8, 15), "e": (16, 30)}
# Rungs of the score ladder (value of "a", bucket that must be 1, score).
LADDER = [
    (1, "a", 10), (None, "b", 9), (0, "b", 8), (None, "c", 7), (0, "c", 6), (None, "d", 5),
    (None, "e", 3),
]
# Score from the number of followed advisers (at least, score).
FOLLOW_STEPS = [(6, 50), (3, 40), (1, 20)]
BASE_AGE = 30


def recency_flags(labels: DataFrame, as_of: str, flags=None) -> DataFrame:
    """Per id, the maximum of each flag in each age bucket (NULL: no row), and `__base`.

    One conditional aggregate over one scan. The partition filter on dt is left
    to the caller's table; rows of the as-of day or later do not count.
    """
    flags = flags or rules.LABEL_FLAGS
    age = F.date_diff(F.lit(as_of).cast("date"), F.col("dt").cast("date"))
    aggs = []
    for flag in flags:
        for name, (young, old) in BUCKETS.items():
            aggs.append(F.max(F.when(age.between(young, old), F.col(flag))).alias(f"{flag}__{name}"))
    return labels.groupBy("id").agg(
        F.max(F.when(age >= BASE_AGE, 1).otherwise(0)).alias("__base"), *aggs
    )


def ladder_score(flag: str) -> Column:
    out = None
    for a, bucket, score in LADDER:
        newest = F.col(f"{flag}__a")
        hit = F.col(f"{flag}__{bucket}") == 1
        if a is None:
            hit = hit & newest.isNull()
        elif bucket != "a":
            hit = hit & (newest == a)
        out = F.when(hit, score) if out is None else out.when(hit, score)
    return out.otherwise(0)


def follow_score(follows: Column) -> Column:
    out = None
    for least, score in FOLLOW_STEPS:
        hit = follows >= least
        out = F.when(hit, score) if out is None else out.when(hit, score)
    return out.otherwise(0)


def user_scores(
    labels: DataFrame, follows: DataFrame, as_of: str, flags=None, only_base: bool = True
) -> DataFrame:
    """Component scores per id: `<flag>_score` and user_follows_score.

    Only ids with a label at least 30 days old are scored, unless only_base is off.
    """
    flags = flags or rules.LABEL_FLAGS
    recent = recency_flags(labels, as_of, flags)
    if only_base:
        recent = recent.where("__base = 1")
    counts = follows.select(F.col("id"), F.col("follows").try_cast("int").alias("follows"))
    joined = recent.join(counts.groupBy("id").agg(F.max("follows").alias("follows")), "id", "left")
    return joined.select(
        "id",
        *[ladder_score(flag).alias(f"{flag}_score") for flag in flags],
        follow_score(F.col("follows")).alias("user_follows_score"),
    )


def total_score(scores: DataFrame) -> DataFrame:
    parts = [F.col(c) for c in scores.columns if c.endswith("_score")]
    total = parts[0]
    for part in parts[1:]:
        total = total + part
    return scores.select("id", total.alias("score"))


def merge_scores(before: DataFrame, totals: DataFrame) -> DataFrame:
    """Every known id with its new score; ids not scored today get 0. Empty ids are dropped."""
    joined = before.select("id").distinct().join(totals, "id", "full")
    return joined.where(F.col("id") != "").select(
        "id", F.coalesce("score", F.lit(0)).alias("score")
    )
