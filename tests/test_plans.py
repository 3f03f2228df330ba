"""What the plans must look like: pushed filters, pruned columns, one scan, no cross joins."""

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from clickloom.operators import counters, labels, rules
from clickloom.registry.base import Tables
from clickloom.sources import events as sources

QUERIES = entry.queries()
# These fit a model while they are built.
FITTED = {"hashed_features", "hashed_feature_totals", "naive_bayes_model", "recommended_items",
          "recommended_users", "recommended_items_ranked", "recommended_users_ranked"}


def plan(df):
    utils = df.sparkSession._jvm.PythonSQLUtils
    return utils.explainString(df._jdf.queryExecution(), "formatted")


def test_time_range_reaches_the_scan(spark, sf):
    table = Tables(spark, sf).table("events").withColumn("dt", F.col("ts").cast("date"))
    text = plan(sources.scan_events(table, "2024-01-05 06:00:00", "2024-01-07 18:00:00", "ts")
                .select("event_id"))
    assert "GreaterThanOrEqual(ts" in text and "LessThanOrEqual(ts" in text
    assert "ReadSchema: struct<event_id:bigint,ts:timestamp_ntz>" in text


def test_window_count_reads_two_columns(spark, sf):
    e = Tables(spark, sf).table("events")
    text = plan(counters.count_per_window(e, F.col("ts"), "10 minutes", ["event_type"]))
    assert "ReadSchema: struct<ts:timestamp_ntz,event_type:string>" in text
    assert "partial_count" in text


def test_scores_scan_the_labels_once(spark, tmp_path):
    columns = ", ".join(f"1 AS {flag}" for flag in rules.LABEL_FLAGS)
    spark.sql(f"SELECT 'u' AS id, '2024-01-01' AS dt, {columns}").write.parquet(f"{tmp_path}/l")
    spark.sql("SELECT 'u' AS id, '3' AS follows").write.parquet(f"{tmp_path}/f")
    scores = labels.user_scores(spark.read.parquet(f"{tmp_path}/l"),
                                spark.read.parquet(f"{tmp_path}/f"), "2024-02-01")
    assert plan(scores).count("ReadSchema") == 2


def test_cells_read_line_and_properties_once(spark, sf):
    cells = QUERIES["event_cells"](spark, sf)
    assert cells._jdf.queryExecution().executedPlan().toString().count("from_json(") == 2


@pytest.mark.parametrize("name", sorted(set(QUERIES) - FITTED))
def test_no_cross_join(spark, sf, name):
    text = plan(QUERIES[name](spark, sf))
    assert "CartesianProduct" not in text
    assert "BroadcastNestedLoopJoin" not in text
