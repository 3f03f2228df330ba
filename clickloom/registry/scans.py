"""Scans, stored tables and keyed merges."""

from __future__ import annotations

from pyspark.sql import functions as F

from clickloom.functions import rowkeys
from clickloom.operators import counters, storage, upserts
from clickloom.registry.base import EVENT_CTE, Tables, query
from clickloom.sources import events as sources


@query(
    "lines_of_day",
    """SELECT event_id, props AS line, strftime(ts, '%Y-%m-%d') AS dt FROM events
       WHERE strftime(ts, '%Y-%m-%d') = '2024-01-10'""",
)
def lines_of_day(spark, sf):
    t = Tables(spark, sf)
    table = t.events.select(
        F.struct("event_id", "props").alias("line"), F.date_format("ts", "yyyy-MM-dd").alias("dt")
    )
    rows = sources.scan_lines(table, "2024-01-10")
    return rows.select("line.event_id", F.col("line.props").alias("line"), "dt")


@query(
    "events_in_time_range",
    """SELECT event_id, ts FROM events
       WHERE ts BETWEEN TIMESTAMP '2024-01-05 06:00:00' AND TIMESTAMP '2024-01-07 18:00:00'""",
)
def events_in_time_range(spark, sf):
    table = Tables(spark, sf).table("events").withColumn("dt", F.col("ts").cast("date"))
    rows = sources.scan_events(table, "2024-01-05 06:00:00", "2024-01-07 18:00:00", "ts")
    return rows.select("event_id", "ts")


@query(
    "key_value_snapshot",
    """SELECT CAST(conv_id AS VARCHAR) || ':' || CAST(turn AS VARCHAR) AS key, text AS value
       FROM conversations""",
)
def key_value_snapshot(spark, sf):
    rows = Tables(spark, sf).table("conversations")
    keyed = rows.withColumn("id", F.concat_ws(":", "conv_id", "turn"))
    return sources.key_value(keyed, "id", "text")


@query("search_user", "SELECT event_id, ts, user_id FROM events WHERE user_id = 7")
def search_user(spark, sf):
    rows = sources.search(Tables(spark, sf).table("events"), "ts", user_id=7)
    return rows.select("event_id", "ts", "user_id")


@query(
    "recent_events",
    """SELECT event_id, ts FROM events
       WHERE ts BETWEEN TIMESTAMP '2024-01-30 06:00:00' AND TIMESTAMP '2024-01-30 12:00:00'""",
)
def recent_events(spark, sf):
    now = F.lit("2024-01-30 12:00:00").cast("timestamp_ntz")
    rows = sources.scan_since(Tables(spark, sf).table("events"), "ts", now, 6 * 3600)
    return rows.select("event_id", "ts")


def _order_cells(spark, sf):
    """Order rows keyed by salt (from the order number), customer and order."""
    bare = F.concat_ws("|", F.lpad(F.col("o_custkey").cast("string"), 8, "0"), "o_orderkey")
    key = F.concat_ws("|", rowkeys.salt_letter(rowkeys.salt_number(F.col("o_orderkey"))), bare)
    return Tables(spark, sf).table("orders").select(key.alias("row_key"), "o_orderkey", "o_custkey")


_ORDER_KEY = """chr(65 + CAST(o_orderkey % 6 AS INTEGER)) || '|' ||
  lpad(CAST(o_custkey AS VARCHAR), 8, '0') || '|' || CAST(o_orderkey AS VARCHAR)"""


@query(
    "row_key_prefix",
    f"""SELECT row_key, o_orderkey FROM (SELECT {_ORDER_KEY} AS row_key, o_orderkey FROM orders)
        WHERE starts_with(row_key, 'B|000001')""",
)
def row_key_prefix(spark, sf):
    return storage.scan_prefix(_order_cells(spark, sf), "B|000001").select("row_key", "o_orderkey")


@query(
    "salted_range_scan",
    f"""SELECT {_ORDER_KEY} AS row_key, o_orderkey FROM orders
        WHERE o_custkey >= 100 AND o_custkey < 300""",
)
def salted_range_scan(spark, sf):
    cells = _order_cells(spark, sf)
    rows = storage.scan_salted_range(cells, "00000100", "00000300")
    return rows.select("row_key", "o_orderkey")


@query(
    "point_get",
    "SELECT o_orderkey, o_custkey, o_totalprice FROM orders WHERE o_orderkey = 77",
)
def point_get(spark, sf):
    orders = Tables(spark, sf).table("orders")
    bare = F.col("o_orderkey").cast("string")
    key = F.concat_ws("|", rowkeys.salt_letter(rowkeys.text_salt(bare)), bare)
    row = storage.get_row(orders.withColumn("row_key", key), "77")
    return row.select("o_orderkey", "o_custkey", "o_totalprice")


@query(
    "event_row_keys",
    f"""WITH {EVENT_CTE}
        SELECT event_id,
          chr(65 + CAST((user_id + ms) % 6 AS INTEGER)) || '|' || CAST(user_id AS VARCHAR) || '|'
            || CAST(9223372036854775807 - ms AS VARCHAR) AS event_key,
          chr(65 + CAST((user_id + ms) % 6 AS INTEGER)) || '-' || CAST(user_id AS VARCHAR) || '-'
            || CAST(ms AS VARCHAR) AS view_key,
          reverse(CAST(user_id AS VARCHAR)) AS user_key,
          reverse(CAST(user_id AS VARCHAR)) || '|' || CAST(k AS VARCHAR) || '|prod|live|'
            || CAST(ms // 30000 * 30000 AS VARCHAR) AS watch_key
        FROM e""",
)
def event_row_keys(spark, sf):
    from clickloom.functions import clock

    e = Tables(spark, sf).events
    salt = rowkeys.salt_number(F.col("user_id") + F.col("ms"))
    user, ms = F.col("user_id"), F.col("ms")
    return e.select(
        "event_id",
        rowkeys.event_key(user, ms, salt).alias("event_key"),
        rowkeys.view_key(user, ms, salt).alias("view_key"),
        rowkeys.reversed_key(user).alias("user_key"),
        rowkeys.watch_key(
            user, F.col("k"), F.lit("prod"), F.lit("live"), clock.floor_millis(ms, 30_000)
        ).alias("watch_key"),
    )


@query(
    "latest_cells",
    f"""WITH {EVENT_CTE}
        SELECT row_key, event_id, ms FROM (
          SELECT CAST(user_id AS VARCHAR) || '|' || CAST(k AS VARCHAR) AS row_key, event_id, ms,
                 row_number() OVER (PARTITION BY user_id, k ORDER BY ms DESC, event_id DESC) AS rn
          FROM e) WHERE rn = 1""",
)
def latest_cells(spark, sf):
    e = Tables(spark, sf).events
    cells = e.select(F.concat_ws("|", "user_id", "k").alias("row_key"), "event_id", "ms")
    return storage.last_cells(cells, [F.col("ms"), F.col("event_id")])


@query(
    "counters_merged",
    """SELECT user_id, event_type, count(*) AS num FROM events GROUP BY user_id, event_type""",
)
def counters_merged(spark, sf):
    e = Tables(spark, sf).table("events")
    noon = F.lit("2024-01-15 12:00:00").cast("timestamp_ntz")
    keys = ["user_id", "event_type"]
    old = counters.count_per(e.where(F.col("ts") < noon), keys)
    delta = counters.count_per(e.where(F.col("ts") >= noon), keys)
    return counters.merge_counts(old, delta, keys)


@query(
    "hash_overwrite",
    """SELECT CAST(c_custkey AS VARCHAR) AS key,
              CASE WHEN c_acctbal < 0 THEN 'DEBT' ELSE c_mktsegment END AS value
       FROM customer""",
)
def hash_overwrite(spark, sf):
    customers = Tables(spark, sf).table("customer")
    table = sources.key_value(customers, "c_custkey", "c_mktsegment")
    debt = customers.where("c_acctbal < 0").withColumn("v", F.lit("DEBT"))
    return upserts.overwrite_fields(table, sources.key_value(debt, "c_custkey", "v"))


@query("set_add", "SELECT DISTINCT user_id, event_type FROM events")
def set_add(spark, sf):
    e = Tables(spark, sf).table("events").select("user_id", "event_type", "ts")
    noon = F.lit("2024-01-15 12:00:00").cast("timestamp_ntz")
    members = e.where(F.col("ts") < noon).select("user_id", "event_type").distinct()
    return upserts.add_to_set(members, e.where(F.col("ts") >= noon))


@query(
    "orders_upsert",
    """SELECT COALESCE(t.o_orderkey, s.o_orderkey) AS o_orderkey,
              CASE WHEN s.o_orderkey IS NOT NULL THEN s.o_totalprice + 1
                   ELSE t.o_totalprice END AS o_totalprice,
              CASE WHEN t.o_orderkey IS NOT NULL THEN 'old' ELSE 'new' END AS c_time
       FROM (SELECT * FROM orders WHERE o_orderdate < DATE '1998-01-01') t
       FULL JOIN (SELECT * FROM orders WHERE o_orderstatus = 'F') s
         ON t.o_orderkey = s.o_orderkey""",
)
def orders_upsert(spark, sf):
    orders = Tables(spark, sf).table("orders")
    target = orders.where("o_orderdate < timestamp_ntz'1998-01-01'").select(
        "o_orderkey", "o_totalprice", F.lit("old").alias("c_time")
    )
    source = orders.where("o_orderstatus = 'F'").select(
        "o_orderkey", (F.col("o_totalprice") + 1).alias("o_totalprice"),
        F.lit("new").alias("c_time"),
    )
    return upserts.upsert(target, source, ["o_orderkey"], keep_on_update=["c_time"])


@query(
    "insert_if_absent",
    """SELECT o_orderkey, o_custkey FROM orders s WHERE o_orderstatus = 'F' AND NOT EXISTS (
         SELECT 1 FROM orders t WHERE t.o_orderdate < DATE '1998-01-01'
           AND t.o_orderkey = s.o_orderkey)""",
)
def insert_if_absent(spark, sf):
    orders = Tables(spark, sf).table("orders")
    target = orders.where("o_orderdate < timestamp_ntz'1998-01-01'")
    source = orders.where("o_orderstatus = 'F'").select("o_orderkey", "o_custkey")
    return upserts.insert_new(target, source, ["o_orderkey"])


@query(
    "nation_suppliers_outer",
    """SELECT COALESCE(n.n_nationkey, s.k) AS nationkey, n.n_name AS n_name,
              s.num AS num
       FROM (SELECT * FROM nation WHERE n_regionkey < 3) n
       FULL JOIN (SELECT s_nationkey AS k, count(*) AS num FROM supplier GROUP BY 1) s
         ON n.n_nationkey = s.k""",
)
def nation_suppliers_outer(spark, sf):
    t = Tables(spark, sf)
    nations = t.table("nation").where("n_regionkey < 3").select(
        F.col("n_nationkey").alias("nationkey"), "n_name"
    )
    counts = t.table("supplier").groupBy(F.col("s_nationkey").alias("nationkey")).agg(
        F.count("*").alias("num")
    )
    return nations.join(counts, "nationkey", "full")


@query("part_prefix", "SELECT p_partkey, p_name FROM part WHERE p_name LIKE 'blue%'")
def part_prefix(spark, sf):
    return Tables(spark, sf).table("part").where(F.col("p_name").like("blue%")).select(
        "p_partkey", "p_name"
    )


@query(
    "part_union",
    """SELECT p_partkey, p_name FROM part WHERE p_name LIKE 'blue%'
       UNION ALL SELECT p_partkey, p_name FROM part WHERE p_size > 25""",
)
def part_union(spark, sf):
    parts = Tables(spark, sf).table("part")
    cols = ["p_partkey", "p_name"]
    blue = parts.where(F.col("p_name").like("blue%")).select(*cols)
    return blue.unionByName(parts.where("p_size > 25").select(*cols))


@query(
    "users_both_and_only",
    """SELECT user_id, 'both' AS kind FROM (
         SELECT user_id FROM events WHERE event_type = 'purchase' AND value > 50
         INTERSECT SELECT user_id FROM events WHERE event_type = 'error' AND value > 50)
       UNION ALL
       SELECT user_id, 'only' AS kind FROM (
         SELECT user_id FROM events WHERE event_type = 'purchase' AND value > 50
         EXCEPT SELECT user_id FROM events WHERE event_type = 'error' AND value > 50)""",
)
def users_both_and_only(spark, sf):
    e = Tables(spark, sf).table("events").where("value > 50")
    bought = e.where("event_type = 'purchase'").select("user_id")
    failed = e.where("event_type = 'error'").select("user_id")
    both = bought.intersect(failed).withColumn("kind", F.lit("both"))
    return both.unionByName(bought.subtract(failed).withColumn("kind", F.lit("only")))


@query(
    "distinct_rows",
    f"WITH {EVENT_CTE} SELECT DISTINCT user_id, event_type, k FROM e",
)
def distinct_rows(spark, sf):
    return Tables(spark, sf).events.select("user_id", "event_type", "k").dropDuplicates()


@query("distinct_ids", "SELECT DISTINCT user_id FROM events")
def distinct_ids(spark, sf):
    return Tables(spark, sf).table("events").select("user_id").distinct()


@query(
    "top_events",
    "SELECT event_id, value FROM events ORDER BY value DESC, event_id LIMIT 20",
)
def top_events(spark, sf):
    e = Tables(spark, sf).table("events").select("event_id", "value")
    return e.orderBy(F.desc("value"), "event_id").limit(20)


@query(
    "events_by_time",
    "SELECT event_id, ts, user_id FROM events ORDER BY ts, event_id",
)
def events_by_time(spark, sf):
    return Tables(spark, sf).table("events").select("event_id", "ts", "user_id").orderBy(
        "ts", "event_id"
    )


@query(
    "orders_per_day",
    """SELECT CAST(d AS DATE) AS day, count(o.o_orderkey) AS num
       FROM generate_series(DATE '1995-01-01', DATE '2001-12-31', INTERVAL 1 DAY) g(d)
       LEFT JOIN orders o ON CAST(o.o_orderdate AS DATE) = CAST(d AS DATE)
       GROUP BY 1""",
)
def orders_per_day(spark, sf):
    from clickloom.operators.parsing import days_between

    orders = Tables(spark, sf).table("orders")
    counted = (
        orders.groupBy(F.col("o_orderdate").cast("date").alias("day"))
        .agg(F.count("*").alias("num"))
    )
    days = spark.range(1).select(F.explode(days_between("1995-01-01", "2001-12-31")).alias("day"))
    return days.join(counted, "day", "left").select("day", F.coalesce("num", F.lit(0)).alias("num"))
