"""Batch and streaming writers. All stream writers are safe to replay a batch."""

from __future__ import annotations

from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor

from pyspark import inheritable_thread_target
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

def overwrite_partition(df: DataFrame, path: str, dt: str = "dt") -> None:
    """Replace only the partitions that occur in df."""
    (
        df.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(dt)
        .parquet(path)
    )


def append_partition(df: DataFrame, path: str, dt: str = "dt") -> None:
    """Plain append; a rerun repeats the rows, so overwrite_partition is the default choice."""
    df.write.mode("append").partitionBy(dt).parquet(path)


def overwrite_table(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").parquet(path)


def write_day_text(df: DataFrame, path: str, dt: str = "dt") -> None:
    """Text output with one directory per day."""
    df.write.mode("overwrite").partitionBy(dt).csv(path)


def write_cells(cells: DataFrame, path: str) -> None:
    """Row-key table: sorted files, one directory per salt."""
    from clickloom.operators.storage import salted_layout

    salted_layout(cells).write.mode("overwrite").partitionBy("salt").parquet(path)


def jdbc_target(url: str, table: str, driver: str | None = None, user: str | None = None,
                password: str | None = None, batch: int = 10_000) -> dict[str, str]:
    options = {"url": url, "dbtable": table, "batchsize": str(batch)}
    for key, value in (("driver", driver), ("user", user), ("password", password)):
        if value is not None:
            options[key] = value
    return options


def insert_jdbc(df: DataFrame, mode: str = "append", **kwargs) -> None:
    """Bulk insert, in batches, one transaction per partition."""
    df.write.format("jdbc").options(**jdbc_target(**kwargs)).mode(mode).save()


def append_lists(df: DataFrame, path: str, batch_id: int, tee: str | None = None,
                 list_name: str = "list", value: str = "value") -> None:
    """JSON records to their named lists; `tee` repeats every record under list + suffix.

    Each batch owns one directory per list, so a replayed batch replaces itself.
    """
    rows = df.select(F.col(list_name).alias("list"), F.col(value).alias("value"))
    if tee:
        names = F.array(F.col("list"), F.concat("list", F.lit(tee)))
        rows = rows.withColumn("list", F.explode(names))
    (
        rows.withColumn("batch", F.lit(batch_id))
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("list", "batch")
        .text(path)
    )


def read_lists(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.text(path).select("list", "batch", "value")


def write_changes(changed: DataFrame, path: str, batch_id: int) -> None:
    """The rows of a running table that a batch changed, under its number; a replay replaces itself.

    The table itself is in the state of its query (streaming.running), so these folders
    are for readers that follow the changes, and may be deleted once they were read.
    """
    overwrite_partition(changed.withColumn("batch", F.lit(batch_id)), path, "batch")


def stream_to(
    df: DataFrame, checkpoint: str, trigger: str | None = None, mode: str = "append"
) -> DataStreamWriter:
    """Writer with a checkpoint; without a trigger it takes what is there and stops."""
    writer = df.writeStream.outputMode(mode).option("checkpointLocation", checkpoint)
    if trigger:
        return writer.trigger(processingTime=trigger)
    return writer.trigger(availableNow=True)


def stream_partitions(
    df: DataFrame, path: str, checkpoint: str, dt: str = "dt", trigger: str | None = None
) -> StreamingQuery:
    """Append to day partitions; offsets are committed with the files."""
    return stream_to(df, checkpoint, trigger).partitionBy(dt).format("parquet").start(path)


def stream_text(
    df: DataFrame, path: str, checkpoint: str, columns: list[Column], day: Column,
    trigger: str | None = None, max_records: int | None = None,
) -> StreamingQuery:
    """Lines joined with "|" in one directory per day; files roll at `max_records`."""
    rows = df.select(F.concat_ws("|", *columns).alias("value"), day.alias("day"))
    writer = stream_to(rows, checkpoint, trigger).partitionBy("day").format("text")
    if max_records:
        writer = writer.option("maxRecordsPerFile", max_records)
    return writer.start(path)


def stream_console(df: DataFrame, checkpoint: str, mode: str = "update", trigger=None):
    return stream_to(df, checkpoint, trigger, mode).format("console").start()


def fan_out_batch(steps: list[Callable[[DataFrame, int], None]]):
    """foreachBatch function that parses a batch once and runs every step on it.

    The steps write to different places, so their jobs run side by side; the
    batch fails if one of them fails.
    """

    def run(batch: DataFrame, batch_id: int) -> None:
        batch.persist()
        try:
            with ThreadPoolExecutor(len(steps)) as pool:
                target = inheritable_thread_target(batch.sparkSession)
                done = [pool.submit(target(step), batch, batch_id) for step in steps]
                for future in done:
                    future.result()
        finally:
            batch.unpersist()

    return run
