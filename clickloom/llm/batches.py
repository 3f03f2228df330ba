"""Batches that Python workers are handed."""

from __future__ import annotations

from pyspark.sql import SparkSession

SIZE = "spark.sql.execution.arrow.maxRecordsPerBatch"
ROWS = 1_000


def small(spark: SparkSession, rows: int = ROWS) -> None:
    """Hand Python workers at most `rows` rows at once, unless the session says fewer.

    Texts are large, and several workers share an executor's memory. The setting
    is read when a plan is run, so it stays.
    """
    held = int(spark.conf.get(SIZE))
    if held <= 0 or held > rows:
        spark.conf.set(SIZE, rows)
