"""Streaming sources. All of them give the record columns of a message log."""

from __future__ import annotations

import json
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

RECORD_COLUMNS = ["key", "value", "topic", "partition", "offset", "timestamp"]


def start_offsets(offsets: dict[str, dict[int, int]]) -> str:
    """Explicit start offset per topic and partition, as the source option wants it."""
    return json.dumps({t: {str(p): o for p, o in parts.items()} for t, parts in offsets.items()})


def log_options(
    servers: str,
    topics: list[str],
    offsets: dict[str, dict[int, int]] | None = None,
    per_trigger: int | None = None,
    group: str | None = None,
) -> dict[str, str]:
    """Options of the message-log source.

    per_trigger replaces a rate per second and partition: rate * partitions * seconds.
    """
    options = {
        "kafka.bootstrap.servers": servers,
        "subscribe": ",".join(topics),
        "startingOffsets": start_offsets(offsets) if offsets else "latest",
    }
    if per_trigger:
        options["maxOffsetsPerTrigger"] = str(per_trigger)
    if group:
        options["kafka.group.id"] = group
    return options


def records_per_trigger(rate: int, partitions: int, seconds: int) -> int:
    return rate * partitions * seconds


def read_log(spark: SparkSession, **kwargs) -> DataFrame:
    """Message log as text records; needs the connector on the class path."""
    raw = spark.readStream.format("kafka").options(**log_options(**kwargs)).load()
    return raw.select(
        F.col("key").cast("string"), F.col("value").cast("string"), "topic", "partition",
        "offset", "timestamp",
    )


def read_folder(spark: SparkSession, path: str, files_per_trigger: int = 1) -> DataFrame:
    """The same columns from a folder of text files, one line per record."""
    lines = spark.readStream.option("maxFilesPerTrigger", files_per_trigger).text(path)
    return lines.select(
        F.lit(None).cast("string").alias("key"),
        "value",
        F.col("_metadata.file_name").alias("topic"),
        F.lit(0).alias("partition"),
        F.col("_metadata.file_block_start").alias("offset"),
        F.col("_metadata.file_modification_time").alias("timestamp"),
    )


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    return spark.readStream.text(path)


CORRUPT = "_corrupt_record"
REJECT = "reject"
MODES = ("drop", "reject", "fail")


def checked(
    records: DataFrame, schema: T.StructType | str, required=(), name: str = "declared", value: str = "value"
) -> DataFrame:
    """Every record with its fields by a declared schema, its text and why it is rejected (NULL: it is not).

    A text that is missing, no JSON or of another type than declared is rejected, and so is
    a row that lacks a required field. What was read of a rejected text stays in its
    fields. Both numbers are observed as `name`: a batch reader gets them from its
    Observation, a stream's progress carries them as observedMetrics.
    """
    fields = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
    wide = T.StructType([*fields.fields, T.StructField(CORRUPT, T.StringType())])
    read = F.from_json(value, wide, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT})
    rows = records.select(F.col(value).alias("__text"), read.alias("v"))
    lacking = [F.when(F.col(f"v.{f}").isNull(), f"no {f}") for f in required]
    why = F.coalesce(
        F.when(F.col("__text").isNull(), "no text"),
        F.when(F.col("v").isNull() | F.col(f"v.{CORRUPT}").isNotNull(), "not as declared"),
        *lacking,
    )
    out = rows.select(*[F.col(f"v.{f.name}") for f in fields], F.col("__text").alias(value), why.alias(REJECT))
    return out.observe(
        name,
        F.count_if(F.col(REJECT).isNull()).alias("accepted"),
        F.count_if(F.col(REJECT).isNotNull()).alias("rejected"),
    )


def declared(
    records: DataFrame, schema: T.StructType | str, required=(), mode: str = "drop", name: str = "declared"
) -> DataFrame:
    """Values read with a declared schema.

    Rejected rows are left out (`drop`, their number is observed), stay with their text
    and the reason (`reject`, to be parted by with_rejects), or end the job (`fail`).
    """
    if mode not in MODES:
        raise ValueError(f"mode is one of {', '.join(MODES)}")
    rows = checked(records, schema, required, name)
    if mode == "reject":
        return rows
    if mode == "fail":
        told = F.concat(F.lit("record rejected: "), F.col(REJECT))
        rows = rows.withColumn(REJECT, F.when(F.col(REJECT).isNotNull(), F.raise_error(told).cast("string")))
    return rows.where(F.col(REJECT).isNull()).drop("value", REJECT)


def with_rejects(accept: Callable[[DataFrame, int], None], reject: Callable[[DataFrame, int], None]) -> Callable:
    """foreachBatch function over rows of `declared(mode="reject")`: each goes to exactly one of the two."""

    def split(batch: DataFrame, batch_id: int) -> None:
        batch.persist()
        try:
            accept(batch.where(F.col(REJECT).isNull()).drop("value", REJECT), batch_id)
            reject(batch.where(F.col(REJECT).isNotNull()).select("value", REJECT), batch_id)
        finally:
            batch.unpersist()

    return split


# Declared schema of a tracked event, nested as it is sent.
EVENT_SCHEMA = T.StructType(
    [
        T.StructField("_track_id", T.LongType()),
        T.StructField("time", T.LongType()),
        T.StructField("type", T.StringType()),
        T.StructField("distinct_id", T.StringType()),
        T.StructField("event", T.StringType()),
        T.StructField("project", T.StringType()),
        T.StructField(
            "properties",
            T.StructType(
                [
                    T.StructField("userID", T.StringType()),
                    T.StructField("deviceId", T.StringType()),
                    T.StructField("$is_first_day", T.BooleanType()),
                    T.StructField("v1_element_content", T.StringType()),
                    T.StructField("v1_message_id", T.StringType()),
                    T.StructField("v1_message_title", T.StringType()),
                    T.StructField("v1_lcs_id", T.StringType()),
                ]
            ),
        ),
    ]
)


def record_info(records: DataFrame, tz: str = "UTC") -> DataFrame:
    """Partition, offset, key and the event's own time as text."""
    from clickloom.functions import clock
    from clickloom.functions.jsonmap import json_map, prop

    time = prop(json_map(F.col("value")), "time")
    return records.select(
        "partition", "offset", "key",
        clock.format_millis(clock.text_to_millis(time), tz=tz).alias("event_time"),
    )


def without_repeats(stream: DataFrame, keys: list[str], ts: str, delay: str) -> DataFrame:
    """Overlapping polls deliver a row again: keep its first arrival within the delay."""
    return stream.withWatermark(ts, delay).dropDuplicatesWithinWatermark(keys)
