"""Times the headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line."""

from __future__ import annotations

import glob
import json
import os
import sys
import tempfile
import time

from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from clickloom import registry  # noqa: E402
from clickloom.registry.base import COVER_ENVS, ENVS, Tables  # noqa: E402
from clickloom.session import build_session  # noqa: E402
from clickloom.sources import streams  # noqa: E402
from clickloom.streaming import jobs  # noqa: E402
from clickloom.streaming.stateful import use_rocksdb  # noqa: E402

HEADLINE = [
    "event_envelope", "event_etl", "event_flatten", "history_etl", "page_visits", "live_sessions",
    "gap_sessions", "reads_deduplicated", "article_reads", "content_plays", "shares_by_adviser",
    "course_routing", "course_progress", "answer_flags", "insurance_routing", "online_viewers",
    "sliding_devices_60s", "window_devices_15s", "room_online_users", "user_labels",
    "user_scores_merged", "user_live_rooms", "event_cells", "salted_range_scan", "orders_upsert",
    "live_stats_upsert", "word_count", "term_weights", "top_terms", "daily_keywords",
    "text_classifier", "document_similarity",
]


def spread(spark, folder: str, files: int) -> str:
    """A copy of the tables in several files each: one small file would be read by a single core."""
    target = tempfile.mkdtemp(prefix="clickloom-bench-")
    for path in glob.glob(f"{folder}/*.parquet"):
        table = spark.read.parquet(path).repartition(files)
        table.write.parquet(f"{target}/{os.path.basename(path)}")
    return target


LINES = 540_000  # of one batch: 4,000 a second and partition, nine partitions, 15 seconds


def app_stream(spark, folder: str, files: int) -> tuple[float, int]:
    """(seconds, lines) of the merged app job over one batch of raw lines: every route, table and sink.

    The routes without state share one parsed batch; running tables, course progress, live
    sessions and article reads keep state and are queries of their own, run one after another.
    The lines of the tables are said again until there are enough of them.
    """
    out = tempfile.mkdtemp(prefix="clickloom-stream-")
    t = Tables(spark, folder)
    lines = t.app_lines.select(F.col("line").alias("value"))
    times = -(-LINES // lines.count())
    copies = lines.withColumn("n", F.explode(F.sequence(F.lit(1), F.lit(times)))).limit(LINES).select("value")
    copies.repartition(files).write.text(f"{out}/lines")
    count = spark.read.text(f"{out}/lines").count()
    span = t.events.groupBy(F.col("k").cast("string").alias("item")).agg(
        F.min("ms").alias("start_ms"), F.max("ms").alias("end_ms")
    )
    span.write.parquet(f"{out}/schedule")
    steps = [
        jobs.visits_step(f"{out}/visits", "app"),
        jobs.course_step(f"{out}/course", ENVS, tee=":copy"),
        jobs.insurance_step(f"{out}/insurance", "app", COVER_ENVS, tee=":copy"),
        jobs.td_step(f"{out}/td", "app"),
        jobs.marks_step(f"{out}/marks", ENVS),
        jobs.answers_step(f"{out}/answers", ENVS),
    ]
    use_rocksdb(spark)

    def records():
        return streams.read_folder(spark, f"{out}/lines", files)

    start = time.perf_counter()
    queries = {
        "routes": lambda cp: jobs.run(records(), steps, cp),
        "totals": lambda cp: jobs.running_tables(records(), "app", ENVS, f"{out}/totals", cp),
        "progress": lambda cp: jobs.course_progress(
            records(), spark.read.parquet(f"{out}/schedule"), ENVS, f"{out}/progress", cp
        ),
        "live": lambda cp: jobs.live_sessions(records(), "app", f"{out}/live", cp),
        "reads": lambda cp: jobs.article_reads(records(), "app", f"{out}/reads", cp),
    }
    for name, begin in queries.items():
        begun = time.perf_counter()
        begin(f"{out}/cp-{name}").awaitTermination()
        print(f"app_stream {name}: {time.perf_counter() - begun:.1f} s", file=sys.stderr)
    return time.perf_counter() - start, count


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    sf = os.path.basename(folder.rstrip("/"))
    cpus = os.environ.get("BENCH_CPUS", "8")
    only = sys.argv[1:]
    spark = build_session(
        "clickloom-bench",
        f"local[{cpus}]",
        **{
            "spark.ui.enabled": "false",
            "spark.sql.shuffle.partitions": cpus,
            "spark.driver.memory": "12g",
            "spark.ui.showConsoleProgress": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    queries = registry.queries()
    folder = spread(spark, folder, int(cpus))
    # One pass over a table, so that no query pays for the start of the engine.
    spark.read.parquet(f"{folder}/events.parquet").groupBy("event_type").count().collect()
    times = {}
    for name in HEADLINE:
        if only and name not in only:
            continue
        start = time.perf_counter()
        queries[name](spark, folder).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - start, 3)
    lines = None
    if not only or "app_stream" in only:
        try:
            seconds, lines = app_stream(spark, folder, int(cpus))
            times["app_stream"] = round(seconds, 3)
        except Exception as error:  # the other figures count all the same
            print(f"app_stream failed: {error}", file=sys.stderr)
    try:
        spark.stop()
    except Exception as error:
        print(f"the session was gone: {error}", file=sys.stderr)
    print(
        json.dumps(
            {
                "metric": "headline_total",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "app_stream_lines": lines,
                "sf": sf,
            }
        )
    )


if __name__ == "__main__":
    main()
