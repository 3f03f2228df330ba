"""Who caused an event."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def filled(column: Column) -> Column:
    return F.nullif(column, F.lit(""))


def with_identity(
    events: DataFrame, user: str = "userID", device: str = "deviceId", distinct: str = "distinct_id"
) -> DataFrame:
    """User id, else device id, else distinct id; an empty device is filled only with the last."""
    no_user = filled(F.col(user)).isNull()
    no_device = filled(F.col(device)).isNull()
    fallback = F.coalesce(filled(F.col(user)), filled(F.col(device)), F.col(distinct))
    device_out = F.when(no_user & no_device, F.col(distinct)).otherwise(F.col(device))
    return events.withColumns({"identity": fallback, "device": device_out})


def per_identity(
    events: DataFrame, columns: list[str], alias: str = "id", keep_empty: bool = False
) -> DataFrame:
    """One row per identity column of each event, in a single scan."""
    out = events.withColumn(alias, F.explode(F.array(*[F.col(c) for c in columns])))
    return out if keep_empty else out.where((F.col(alias) != "") & F.col(alias).isNotNull())
