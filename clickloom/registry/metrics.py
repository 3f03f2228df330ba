"""Windows, counters, labels and scores."""

from __future__ import annotations

from pyspark.sql import functions as F

from clickloom.functions import clock
from clickloom.operators import counters, labels, online, rules
from clickloom.plans import warehouse
from clickloom.registry.base import APP_CTE, AS_OF, EVENT_CTE, Tables, part_of, query

ORIGIN = "TIMESTAMP '2024-01-01'"


def _ntz(df, *names):
    return df.withColumns({n: F.col(n).cast("timestamp_ntz") for n in names})


# ---- windows -----------------------------------------------------------------


@query(
    "window_counts_10min",
    f"""SELECT time_bucket(INTERVAL 10 MINUTE, ts, {ORIGIN}) AS window_start, event_type,
               count(*) AS num FROM events GROUP BY ALL""",
)
def window_counts_10min(spark, sf):
    e = Tables(spark, sf).table("events")
    return counters.count_per_window(e, F.col("ts"), "10 minutes", ["event_type"])


@query(
    "window_devices_15s",
    f"""WITH {EVENT_CTE}
        SELECT time_bucket(INTERVAL 15 SECOND, ts, {ORIGIN}) AS window_start, event_type, k,
               count(DISTINCT user_id) AS online_counts, max(ts) AS count_time
        FROM e GROUP BY ALL""",
)
def window_devices_15s(spark, sf):
    e = Tables(spark, sf).events
    return online.window_viewers(e, "ts", ["event_type", "k"], "user_id", "15 seconds", None)


@query(
    "sliding_devices_60s",
    f"""WITH w AS (
          SELECT *, time_bucket(INTERVAL 5 SECOND, ts, {ORIGIN}) - to_seconds(5 * i)
                    AS window_start FROM events, range(12) g(i))
        SELECT window_start, event_type, count(DISTINCT user_id) AS online_counts,
               max(ts) AS count_time FROM w GROUP BY ALL""",
)
def sliding_devices_60s(spark, sf):
    e = Tables(spark, sf).table("events")
    return online.window_viewers(e, "ts", ["event_type"], "user_id")


@query(
    "sliding_devices_sketched",
    f"""WITH w AS (
          SELECT *, time_bucket(INTERVAL 5 SECOND, ts, {ORIGIN}) - to_seconds(5 * i)
                    AS window_start FROM events, range(12) g(i))
        SELECT window_start, event_type, count(DISTINCT user_id) AS online_counts,
               max(ts) AS count_time, TRUE AS within FROM w GROUP BY ALL""",
)
def sliding_devices_sketched(spark, sf):
    """Sketches of panes beside the exact count; the error is held to 10 % and half a device."""
    e = Tables(spark, sf).table("events")
    exact = online.window_viewers(e, "ts", ["event_type"], "user_id")
    about = online.viewers_of_panes(online.device_panes(e, "ts", ["event_type"], "user_id"), ["event_type"])
    both = exact.join(about.drop("count_time"), ["window_start", "event_type"], "full")
    error = F.abs(F.col("estimate") - F.col("online_counts"))
    within = F.coalesce(error <= 0.1 * F.col("online_counts") + 0.5, F.lit(False))
    return both.select("window_start", "event_type", "online_counts", "count_time", within.alias("within"))


@query(
    "sliding_counts_10s",
    f"""WITH w AS (
          SELECT *, time_bucket(INTERVAL 5 SECOND, ts, {ORIGIN}) - to_seconds(5 * i)
                    AS window_start FROM events, range(2) g(i))
        SELECT window_start, user_id, count(*) AS num FROM w GROUP BY ALL""",
)
def sliding_counts_10s(spark, sf):
    e = Tables(spark, sf).table("events")
    return counters.count_per_window(e, F.col("ts"), "10 seconds", ["user_id"], "5 seconds")


@query(
    "active_keys_30s",
    f"""WITH {EVENT_CTE}, w AS (
          SELECT *, time_bucket(INTERVAL 15 SECOND, ts, {ORIGIN}) - to_seconds(15 * i)
                    AS window_start FROM e, range(2) g(i))
        SELECT DISTINCT window_start, user_id, k FROM w""",
)
def active_keys_30s(spark, sf):
    e = Tables(spark, sf).events
    return counters.active_keys(e, F.col("ts"), "30 seconds", "15 seconds", ["user_id", "k"])


@query(
    "window_values_joined",
    f"""SELECT time_bucket(INTERVAL 1 HOUR, ts, {ORIGIN}) AS window_start, event_type,
               {part_of('CAST(user_id AS VARCHAR)')} AS part,
               string_agg(CAST(user_id AS VARCHAR), '|' ORDER BY CAST(user_id AS VARCHAR))
                 AS users
        FROM events GROUP BY ALL""",
)
def window_values_joined(spark, sf):
    e = Tables(spark, sf).table("events")
    return online.window_text(e, F.col("ts"), ["event_type"], F.col("user_id"), "users", "1 hour")


@query(
    "day_members_utc8",
    f"""WITH {EVENT_CTE}
        SELECT time_bucket(INTERVAL 1 DAY, ts, TIMESTAMP '2023-12-31 16:00:00') AS window_start,
               k, {part_of('CAST(user_id AS VARCHAR)')} AS part,
               string_agg(CAST(user_id AS VARCHAR), '|' ORDER BY CAST(user_id AS VARCHAR))
                 AS users
        FROM e GROUP BY ALL""",
)
def day_members_utc8(spark, sf):
    e = Tables(spark, sf).events
    return online.window_text(
        e, F.col("ts"), ["k"], F.col("user_id"), "users", "1 day", start="16 hours"
    )


@query(
    "running_total",
    f"WITH {EVENT_CTE} SELECT k, count(*) AS num FROM e GROUP BY k",
)
def running_total(spark, sf):
    return counters.count_per(Tables(spark, sf).events, ["k"])


@query(
    "viewers_per_room",
    f"""WITH {EVENT_CTE}
        SELECT event_type, k, count(DISTINCT user_id) AS online_counts, max(ts) AS count_time
        FROM e GROUP BY ALL""",
)
def viewers_per_room(spark, sf):
    return online.viewers(Tables(spark, sf).events, ["event_type", "k"], "user_id", "ts")


@query(
    "daily_counts",
    f"""WITH {EVENT_CTE}
        SELECT event_type AS metric, k, strftime(ts, '%Y-%m-%d') AS day, count(*) AS num
        FROM e GROUP BY ALL""",
)
def daily_counts(spark, sf):
    day = F.date_format("ts", clock.DAY).alias("day")
    return counters.count_per(
        Tables(spark, sf).events, [F.col("event_type").alias("metric"), "k", day]
    )


# ---- labels and scores -------------------------------------------------------

# Label table derived from the events: which kinds of action a user had on a day.
_FLAG_RULES = [
    ("is_visit_contractvarieties", "event_type = 'click'"),
    ("is_visit_marketprice", "event_type = 'view'"),
    ("is_visit_account", "event_type = 'purchase'"),
    ("is_visit_lcspage", "event_type = 'signup'"),
    ("is_visit_tdlive", "event_type = 'error'"),
    ("is_visit_tdinformation", "value > 100"),
]
_LABEL_SQL = """lab AS (
  SELECT CAST(user_id AS VARCHAR) AS id, CAST(ts AS DATE) AS dt, """ + ", ".join(
    f"max(CASE WHEN {rule} THEN 1 ELSE 0 END) AS {flag}" for flag, rule in _FLAG_RULES
) + " FROM events GROUP BY ALL)"


def _label_table(t: Tables):
    flags = [F.max(F.when(F.expr(rule), 1).otherwise(0)).alias(flag) for flag, rule in _FLAG_RULES]
    return t.table("events").groupBy(
        F.col("user_id").cast("string").alias("id"), F.date_format("ts", clock.DAY).alias("dt")
    ).agg(*flags)


def _follow_table(t: Tables):
    """Follower counts: users with at least one expensive event, counted as text."""
    return (
        t.table("events").where("value > 80")
        .groupBy(F.col("user_id").cast("string").alias("id"))
        .agg(F.count("*").cast("string").alias("follows"))
    )


_FOLLOW_SQL = """fol AS (SELECT CAST(user_id AS VARCHAR) AS id, count(*) AS follows
  FROM events WHERE value > 80 GROUP BY 1)"""
_AGES = [("a", 1, 1), ("b", 2, 3), ("c", 4, 7), ("d", 8, 15), ("e", 16, 30)]


def _score_joins() -> str:
    """One sub-query per age bucket, joined to the base ids."""
    out = []
    for name, young, old in _AGES:
        maxima = ", ".join(f"max({flag}) AS {flag}" for flag, _r in _FLAG_RULES)
        out.append(
            f"""LEFT JOIN (SELECT id, {maxima} FROM lab
                WHERE dt BETWEEN DATE '{AS_OF}' - {old} AND DATE '{AS_OF}' - {young}
                GROUP BY id) {name} ON t.id = {name}.id"""
        )
    return "\n".join(out)


def _score_case(flag: str) -> str:
    return f"""CAST(CASE WHEN a.{flag} = 1 THEN 10
      WHEN b.{flag} = 1 THEN CASE WHEN a.{flag} IS NULL THEN 9 ELSE 8 END
      WHEN c.{flag} = 1 THEN CASE WHEN a.{flag} IS NULL THEN 7 ELSE 6 END
      WHEN d.{flag} = 1 AND a.{flag} IS NULL THEN 5
      WHEN e.{flag} = 1 AND a.{flag} IS NULL THEN 3 ELSE 0 END AS INTEGER) AS {flag}_score"""


_SCORES_SQL = f"""{_LABEL_SQL}, {_FOLLOW_SQL}, sc AS (
  SELECT t.id, {', '.join(_score_case(flag) for flag, _r in _FLAG_RULES)},
         CAST(CASE WHEN f.follows > 5 THEN 50 WHEN f.follows >= 3 THEN 40
              WHEN f.follows >= 1 THEN 20 ELSE 0 END AS INTEGER) AS user_follows_score
  FROM (SELECT DISTINCT id FROM lab WHERE dt <= DATE '{AS_OF}' - 30) t
  {_score_joins()}
  LEFT JOIN fol f ON t.id = f.id)"""


@query(
    "recency_flags",
    f"""WITH {_LABEL_SQL} SELECT id, """
    + ", ".join(
        f"""max(CASE WHEN dt BETWEEN DATE '{AS_OF}' - {old} AND DATE '{AS_OF}' - {young}
            THEN {flag} END) AS {flag}__{name}"""
        for flag, _r in _FLAG_RULES for name, young, old in _AGES
    )
    + " FROM lab GROUP BY id",
)
def recency_flags(spark, sf):
    return labels.recency_flags(_label_table(Tables(spark, sf)), AS_OF).drop("__base")


@query("user_scores", f"WITH {_SCORES_SQL} SELECT * FROM sc")
def user_scores(spark, sf):
    t = Tables(spark, sf)
    return labels.user_scores(_label_table(t), _follow_table(t), AS_OF)


@query(
    "user_scores_merged",
    f"""WITH {_SCORES_SQL},
        tot AS (SELECT id, CAST({' + '.join(f'{flag}_score' for flag, _r in _FLAG_RULES)}
                + user_follows_score AS INTEGER) AS score FROM sc),
        old AS (SELECT DISTINCT CAST(c_custkey AS VARCHAR) AS id FROM customer)
        SELECT COALESCE(o.id, t.id) AS id, COALESCE(t.score, 0) AS score
        FROM old o FULL JOIN tot t ON o.id = t.id""",
)
def user_scores_merged(spark, sf):
    t = Tables(spark, sf)
    before = t.table("customer").select(F.col("c_custkey").cast("string").alias("id"))
    return warehouse.user_scores(_label_table(t), _follow_table(t), before, AS_OF)[1]


_HITS = {
    "is_visit_contractvarieties": "slot = 41",
    "is_visit_marketprice": "slot = 42",
    "is_visit_account": "slot = 43",
    "is_visit_lcspage": "slot = 44 AND event_type IN ('click', 'view', 'error')",
    "is_visit_tdlive": "slot IN (6, 7, 48) AND event_type IN ('click', 'view', 'error')",
    "is_visit_tdinformation": "slot = 45",
}


@query(
    "user_labels",
    f"""WITH {APP_CTE}, ids AS (
          SELECT *, device AS id FROM a UNION ALL SELECT *, device FROM a
          UNION ALL SELECT *, uid FROM a)
        SELECT id, """
    + ", ".join(
        f"""CAST(CASE WHEN count(*) FILTER (WHERE {cond}) > {3 if 'live' in flag else 0}
            THEN 1 ELSE 0 END AS INTEGER) AS {flag}"""
        for flag, cond in _HITS.items()
    )
    + " FROM ids WHERE id <> '' GROUP BY id",
)
def user_labels(spark, sf):
    t = Tables(spark, sf)
    # Three of the five event types stand for listed advisers.
    advisers = t.table("events").where(F.col("event_type").isin("click", "view", "error")).select(
        F.col("event_type").alias("lcs_id")
    ).distinct()
    return warehouse.user_labels(t.app_events, advisers)


@query(
    "adviser_membership",
    """SELECT event_id, event_type IN (SELECT event_type FROM events WHERE value > 400) AS listed
       FROM events""",
)
def adviser_membership(spark, sf):
    from clickloom.operators.skew import salted_join

    e = Tables(spark, sf).table("events").select("event_id", "event_type", "value")
    listed = e.where("value > 400").select("event_type").distinct().withColumn("hit", F.lit(True))
    rows = salted_join(e, listed, ["event_type"], ["event_id"], "left")
    return rows.select("event_id", F.coalesce("hit", F.lit(False)).alias("listed"))


@query(
    "label_sums",
    """SELECT user_id, """
    + ", ".join(
        f"""CAST(CASE WHEN count(*) FILTER (WHERE {rule}) > {3 if 'live' in flag else 0}
            THEN 1 ELSE 0 END AS INTEGER) AS {flag}"""
        for flag, rule in _FLAG_RULES
    )
    + " FROM events GROUP BY user_id",
)
def label_sums(spark, sf):
    aggs = []
    for flag, rule in _FLAG_RULES:
        least = rules.LABEL_THRESHOLDS.get(flag, 0)
        hits = F.sum(F.when(F.expr(rule), 1).otherwise(0))
        aggs.append(F.when(hits > least, 1).otherwise(0).alias(flag))
    return Tables(spark, sf).table("events").groupBy("user_id").agg(*aggs)


@query(
    "score_sum",
    f"""WITH {_SCORES_SQL}
        SELECT id, CAST({' + '.join(f'{flag}_score' for flag, _r in _FLAG_RULES)}
               + user_follows_score AS INTEGER) AS score FROM sc""",
)
def score_sum(spark, sf):
    t = Tables(spark, sf)
    return labels.total_score(labels.user_scores(_label_table(t), _follow_table(t), AS_OF))


@query(
    "rating_error",
    f"""WITH {EVENT_CTE}, r AS (SELECT user_id, k, avg(value) AS rating FROM e GROUP BY ALL),
        m AS (SELECT k, avg(rating) AS prediction FROM r GROUP BY k)
        SELECT round(sqrt(avg((m.prediction - r.rating) * (m.prediction - r.rating))), 6) AS rmse
        FROM r JOIN m ON r.k = m.k""",
)
def rating_error(spark, sf):
    from clickloom.operators import learning

    ratings = Tables(spark, sf).events.groupBy("user_id", "k").agg(F.avg("value").alias("rating"))
    means = ratings.groupBy("k").agg(F.avg("rating").alias("prediction"))
    out = learning.rmse_table(ratings.join(means, "k"))
    return out.select(F.round("rmse", 6).alias("rmse"))
