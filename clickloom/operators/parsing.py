"""JSON lines to typed rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clickloom.functions import clock
from clickloom.functions.jsonmap import json_map, prop, props, put_fields, wide_props
from clickloom.operators import schemas


def read_once(df: DataFrame, values: list[Column]) -> DataFrame:
    """Append the values as columns that later filters do not reach through.

    A filter on a plain projected column would be pushed below the projection
    and read the JSON again for every condition; a generator output is not.
    """
    return df.select("*", F.inline(F.array(F.struct(*values))))


# Name of the column that holds the properties read as a map.
PARSED = "property_map"


def envelope(
    lines: DataFrame, column: str = "line", keep: tuple[str, ...] = (), parsed: bool = False
) -> DataFrame:
    """(event, properties, time, project) of each line; the input of every route.

    With `parsed` the properties are read at once and carried along as a map, for
    a frame that is cached and serves several routes.
    """
    read = lines.select(*keep, json_map(F.col(column)).alias("m"))
    fields = props(F.col("m"), ["event", "properties", "time", "project"])
    rows = read_once(read, fields).drop("m")
    return rows.withColumn(PARSED, json_map(F.col("properties"))) if parsed else rows


def _property_map(events: DataFrame, column: str):
    known = column == "properties" and PARSED in events.columns
    return F.col(PARSED) if known else json_map(F.col(column))


def with_properties(events: DataFrame, keys, column: str = "properties") -> DataFrame:
    """Add property columns (missing: empty text), reading the properties once."""
    read = events.withColumn("__p", _property_map(events, column))
    return read_once(read, props(F.col("__p"), keys)).drop("__p")


def typed_events(lines: DataFrame, column: str = "line", columns=None, keep=()) -> DataFrame:
    """One text column per envelope key, by default in the order of the event table."""
    parsed = lines.select(*keep, json_map(F.col(column)).alias("m"))
    names = columns or schemas.EVENT_COLUMNS
    return read_once(parsed, props(F.col("m"), names)).select(*names, *keep)


def flat_events(lines: DataFrame, column: str = "line", keep=()) -> DataFrame:
    """The 82 flattened columns: outer and inner keys joined, "$" dropped from inner keys."""
    flat = lines.select(
        *keep, json_map(F.col(column), key_prefix="tmp", flatten_depth=2).alias("m")
    )
    struct, columns = wide_props(F.col("m"), schemas.FLAT_COLUMNS)
    return flat.select(*keep, struct.alias("v")).select(*columns("v"), *keep)


def history_events(
    lines: DataFrame,
    column: str = "line",
    project: str = "",
    tz: str = "Asia/Shanghai",
    convert: bool = True,
    keep=(),
) -> DataFrame:
    """Flat history lines to typed events.

    Keys outside the envelope become the properties (unless the line brings its
    own), with the ids renamed. With `convert` the two first-visit flags turn
    into true/false and the clock text into epoch millis.
    """
    m = F.col("m")
    rest = F.map_filter(m, lambda k, _v: ~k.isin(schemas.HISTORY_ENVELOPE))
    fields = [F.lit("userID"), prop(m, "userid"), F.lit("deviceId"), prop(m, "deviceid")]
    if convert:
        for flag in ("$is_first_time", "$is_first_day"):
            shown = F.when(prop(m, flag) == "1", "true").otherwise("false")
            fields += [F.lit(flag), shown]
    packed = F.to_json(F.map_concat(rest, F.create_map(*fields)))
    time = prop(m, "time", schemas.HISTORY_EPOCH if convert else "")
    if convert:
        time = clock.parse_millis(time, clock.TEXT_MILLIS, tz).cast("string")
    special = {
        "time": time,
        "properties": F.coalesce(F.try_element_at(m, F.lit("properties")), packed),
        "user_id": prop(m, "userid"),
        "project": prop(m, "project", project),
    }
    parsed = lines.select(*keep, json_map(F.col(column)).alias("m"))
    columns = [special.get(c, prop(m, c)).alias(c) for c in schemas.EVENT_COLUMNS]
    return parsed.select(*columns, *keep)


def enriched(events: DataFrame, *fields: str) -> DataFrame:
    """Properties JSON with envelope fields put in, as column `value`."""
    read = events.withColumn("__p", _property_map(events, "properties"))
    value = put_fields(F.col("properties"), F.col("__p"), **{f: F.col(f) for f in fields})
    return read.withColumn("value", value).drop("__p")


def exploded_symbols(
    hash_table: DataFrame, key: str = "key", value: str = "value"
) -> DataFrame:
    """(plate, plate_name, symbol): one row per member; a plate without members gives none."""
    parsed = hash_table.select(F.col(key).alias("plate"), json_map(F.col(value)).alias("m"))
    members = F.from_json(prop(F.col("m"), "symbol"), "array<struct<symbol:string,name:string>>")
    return (
        parsed.select("plate", prop(F.col("m"), "plate_name").alias("plate_name"),
                      F.explode(members).alias("member"))
        .select("plate", "plate_name", F.col("member.symbol").alias("symbol"))
    )


def _stat(m: Column, key: str, kind: str) -> Column:
    if kind == "string":
        return prop(m, key)
    if kind == "minutes":
        return clock.seconds_to_minutes(prop(m, key, "0.0"))
    return F.coalesce(prop(m, key, "0").try_cast(kind), F.lit(0).cast(kind))


def live_stats(hash_table: DataFrame, value: str = "value") -> DataFrame:
    """The 29 typed statistics of each live room."""
    parsed = hash_table.select(json_map(F.col(value)).alias("m"))
    return parsed.select(*[_stat(F.col("m"), n, k).alias(n) for n, k in schemas.LIVE_STATS])


def live_info(hash_table: DataFrame, value: str = "value") -> DataFrame:
    """The typed columns of the live information table."""
    parsed = hash_table.select(json_map(F.col(value)).alias("m"))
    return parsed.select(
        *[_stat(F.col("m"), src, kind).alias(name) for name, src, kind in schemas.LIVE_INFO]
    )


def labelled_text(lines: DataFrame, column: str = "value") -> DataFrame:
    """Five-part labelled lines, one row per label; blank texts are dropped."""
    parts = F.split(F.col(column), r"\|,\|", 5)
    rows = lines.select(parts.alias("p")).where(F.size("p") == 5)
    words = F.translate(F.concat_ws(",", F.col("p")[3], F.col("p")[4]), ",", " ")
    return rows.select(
        F.col("p")[0].alias("id"),
        F.explode(F.split(F.col("p")[1], ",")).alias("label_str"),
        F.col("p")[2].alias("title"),
        F.col("p")[3].alias("keyword"),
        F.col("p")[4].alias("news_label"),
        words.alias("total_words"),
    ).where(F.trim("total_words") != "")


def json_keys(lines: DataFrame, column: str = "line", flatten_depth: int = 2) -> DataFrame:
    """Every (flattened) key that occurs, with the number of rows carrying it."""
    parsed = json_map(F.col(column), key_prefix="tmp", flatten_depth=flatten_depth)
    return (
        lines.select(F.explode(F.map_keys(parsed)).alias("key"))
        .groupBy("key")
        .agg(F.count("*").alias("n_rows"))
    )


def json_schemas(lines: DataFrame, column: str = "line") -> DataFrame:
    """The key sets that occur, with their counts (schema drift at a glance)."""
    keys = F.array_join(F.array_sort(F.json_object_keys(column)), ",")
    return lines.groupBy(keys.alias("keys")).agg(F.count("*").alias("n_rows"))


def all_text(df: DataFrame) -> DataFrame:
    """Every column as text, NULL as empty text."""
    return df.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in df.columns])


def days_between(start: str, end: str) -> Column:
    """One row per day when exploded."""
    return F.sequence(F.lit(start).cast("date"), F.lit(end).cast("date"))


def merged_types(lines: DataFrame, column: str = "line") -> DataFrame:
    """(key, type, n_rows): the type that holds every value of each outermost key, over all rows.

    Types of a key are merged by the engine row by row before the shuffle, so nothing
    is sampled; nested objects come with the merged types of their fields. A text that is
    no JSON object has no keys.
    """
    outer = F.try_variant_get(F.try_parse_json(column), "$", "map<string, variant>")
    pairs = lines.select(F.explode(outer).alias("key", "value"))
    return pairs.groupBy("key").agg(
        F.schema_of_variant_agg("value").alias("type"), F.count("*").alias("n_rows")
    )
