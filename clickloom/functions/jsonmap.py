"""One JSON reader for the whole engine: object text -> map<string,string>.

Nested objects stay JSON text and can be read again; a JSON null becomes the
text "null"; anything that is not an object becomes an empty map.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

LENIENT = {"allowUnquotedFieldNames": "true", "allowSingleQuotes": "true"}
TYPED = "map<string,variant>"
MAP = "map<string,string>"


def _raw(text: Column) -> Column:
    return F.from_json(text, MAP, LENIENT)


def _no_nulls(parsed: Column) -> Column:
    return F.transform_values(parsed, lambda _k, v: F.coalesce(v, F.lit("null")))


def empty_map() -> Column:
    return F.create_map().cast(MAP)


def json_map(
    text: Column,
    key_prefix: str | None = None,
    strip_dollar: bool = False,
    flatten_depth: int = 1,
) -> Column:
    """Read a JSON object.

    key_prefix     put before keys that start with "_" (``_x`` -> ``tmp_x`` for "tmp")
    strip_dollar   drop every "$" from the values
    flatten_depth  2 joins outer and inner keys with "_" and drops "$" from them
    """
    parsed = F.coalesce(_no_nulls(_raw(text)), empty_map())
    if key_prefix:
        parsed = F.transform_keys(
            parsed,
            lambda k, _v: F.when(k.startswith("_"), F.concat(F.lit(key_prefix), k)).otherwise(k),
        )
    if flatten_depth == 2:
        parsed = _flatten(parsed)
    elif flatten_depth != 1:
        raise ValueError("flatten_depth is 1 or 2")
    if strip_dollar:
        parsed = F.transform_values(parsed, lambda _k, v: F.replace(v, F.lit("$"), F.lit("")))
    return parsed


def _flatten(parsed: Column) -> Column:
    def pair(key, value):
        return F.struct(key.alias("key"), value.alias("value"))

    def widen(entry):
        outer = entry["key"]
        inner = F.transform(
            # Only text that opens an object is read again.
            F.map_entries(
                F.when(F.ltrim(entry["value"]).startswith("{"), _raw(entry["value"]))
            ),
            lambda i: pair(
                F.replace(F.concat_ws("_", outer, i["key"]), F.lit("$"), F.lit("")),
                F.coalesce(i["value"], F.lit("null")),
            ),
        )
        return F.coalesce(inner, F.array(pair(outer, entry["value"])))

    return F.map_from_entries(F.flatten(F.transform(F.map_entries(parsed), widen)))


def prop(parsed: Column, key: str, default: str = "") -> Column:
    """One property, or the default where the key is absent."""
    return F.coalesce(F.try_element_at(parsed, F.lit(key)), F.lit(default))


def props(parsed: Column, keys, default: str = "") -> list[Column]:
    """A select list of properties; a (key, alias) pair renames."""
    out = []
    for key in keys:
        source, alias = key if isinstance(key, tuple) else (key, key)
        out.append(prop(parsed, source, default).alias(alias))
    return out


def wide_props(parsed: Column, keys, default: str = "") -> tuple[Column, Callable[[str], list[Column]]]:
    """(struct column, function giving the select list over it) for long key lists.

    One pass turns the map into a struct; dozens of single map lookups would
    make one generated method too large for the JIT.
    """
    schema = ", ".join(f"`{key}` string" for key in keys)
    struct = F.from_json(F.to_json(parsed), schema)

    def over(name):
        return [F.coalesce(F.col(name)[key], F.lit(default)).alias(key) for key in keys]

    return struct, over


def merged_fields(text: Column, fields: Column) -> Column:
    """JSON object text with the fields of a map of variants set; all others keep type and nesting."""
    stored = F.coalesce(F.from_json(text, TYPED), F.create_map().cast(TYPED))
    return F.to_json(F.map_concat(stored, fields))


def put_fields(text: Column, parsed: Column | None = None, **fields: Column) -> Column:
    """JSON object text with extra text fields set, keeping the types of the other fields.

    The new fields are spliced before the closing brace; only an object that
    already has one of them is rebuilt from its map, so that the new value wins.
    Text that is no object counts as an empty one. `parsed` is the map of the
    text, where the caller has it already.
    """
    if parsed is None:
        parsed = json_map(text)
    extra = F.to_json(F.struct(*[c.alias(n) for n, c in fields.items()]))
    body = F.trim(text)
    spliced = F.concat(
        body.substr(F.lit(1), F.length(body) - 1), F.lit(","), extra.substr(F.lit(2), F.length(extra))
    )
    clash = F.lit(False)
    for name in fields:
        clash = clash | F.map_contains_key(parsed, name)
    pairs = [x for n, c in fields.items() for x in (F.lit(n), c)]
    rebuilt = merged_fields(text, F.create_map(*pairs).cast(TYPED))
    return F.when(F.size(parsed) == 0, extra).when(clash, rebuilt).otherwise(spliced)
