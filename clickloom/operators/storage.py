"""Sorted key/value tables as partitioned files: build, get, prefix scan, salted range scan."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clickloom.functions import rowkeys
from clickloom.operators import rules
from clickloom.operators.identity import with_identity
from clickloom.operators.parsing import all_text, with_properties


def loggable(events: DataFrame) -> DataFrame:
    """Events that have a name and are not the quote log."""
    event = F.col("event")
    return events.where(event.isNotNull() & (event != "") & (event != rules.IGNORED_EVENT))


def event_cells(events: DataFrame, fallback: bool = True) -> DataFrame:
    """(row_key, userid, time, event, deviceid, project, properties).

    With `fallback` an event without user takes its device or distinct id.
    """
    named = with_properties(loggable(events), ["userID", "deviceId"])
    if fallback:
        named = with_identity(named)
    else:
        named = named.withColumns({"identity": F.col("userID"), "device": F.col("deviceId")})
    key = rowkeys.event_key(F.col("identity"), F.col("time").cast("bigint"))
    return named.select(
        key.alias("row_key"), F.col("identity").alias("userid"), F.col("time").cast("string"),
        "event", F.col("device").alias("deviceid"), "project", "properties",
    )


def view_cells(views: DataFrame, ms: Column) -> DataFrame:
    """Adviser articles keyed by salt, author and creation time; NULL cells become empty."""
    picked = views.where(F.col("p_uid").isNotNull() & F.col("c_time").isNotNull())
    keyed = picked.withColumn("__key", rowkeys.view_key(F.col("p_uid"), ms))
    text = all_text(keyed).where(F.col("c_time") != "")
    cells = [c for c in ("id", "ind_id", "title", "summary", "content", "p_time")
             if c in text.columns]
    return text.select(F.col("__key").alias("row_key"), *cells)


def user_live_rooms(events: DataFrame) -> DataFrame:
    """(row_key, extra_ids, part): distinct live rooms of each user, joined with "-"."""
    from clickloom.operators.skew import joined_text

    name, content = rules.LIVE_PLAY
    keys = ["userID", "v1_message_id", "v1_element_content"]
    read = with_properties(events.where(F.col("event") == name), keys)
    user, room = F.col("userID"), F.col("v1_message_id")
    picked = read.where(
        (F.col("v1_element_content") == content) & (user != "") & (room != "")
    ).select(rowkeys.reversed_key(user).alias("row_key"), room.alias("room"))
    return joined_text(picked, ["row_key"], F.col("room"), "extra_ids", "-", distinct=True)


def last_cells(cells: DataFrame, order: list[Column]) -> DataFrame:
    """A put of an existing row key replaces it: last write wins."""
    from clickloom.operators.upserts import latest

    return latest(cells, ["row_key"], order)


def salted_layout(cells: DataFrame) -> DataFrame:
    """Range-partitioned and sorted by row key, so files prune on key ranges.

    Row keys start with their salt, so a range of partitions serves each salt
    and a busy user spreads over all of them.
    """
    return (
        cells.withColumn("salt", F.col("row_key").substr(1, 1))
        .repartitionByRange("row_key")
        .sortWithinPartitions("row_key")
    )


def of_salt(table: DataFrame, letter: str | Column) -> DataFrame:
    """A table laid out by salt is read in that one folder."""
    if "salt" not in table.columns or (isinstance(letter, str) and not letter):
        return table
    return table.where(F.col("salt") == letter)


def scan_prefix(table: DataFrame, prefix: str, key: str = "row_key") -> DataFrame:
    return of_salt(table, prefix[:1]).where(F.col(key).startswith(prefix))


def scan_salted_range(
    table: DataFrame, start: str, stop: str, sep: str = "|", key: str = "row_key",
    salts: int = rowkeys.SALTS,
) -> DataFrame:
    """Keys whose unsalted part is in [start, stop), in every salt.

    One key range per salt: each is a plain comparison that the scan can prune on.
    """
    wanted = F.lit(False)
    for i in range(salts):
        head = chr(65 + i) + sep
        wanted = wanted | ((F.col(key) >= head + start) & (F.col(key) < head + stop))
    return table.where(wanted)


def get_row(table: DataFrame, bare_key: str, sep: str = "|", key: str = "row_key") -> DataFrame:
    """Point read by unsalted key; the salt is computed from it, so one key is looked up."""
    letter = rowkeys.salt_letter(rowkeys.text_salt(F.lit(bare_key)))
    salted = F.concat_ws(sep, letter, F.lit(bare_key))
    return of_salt(table, letter).where(F.col(key) == salted)
