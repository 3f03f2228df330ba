"""Keyed merges of tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def latest(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """Last row of each key by `order` (ties: greatest row).

    An aggregate, not a window: rows of a hot key are reduced before the shuffle.
    """
    rest = [c for c in df.columns if c not in keys]
    best = F.max_by(F.struct(*rest), F.struct(*order, *[F.col(c).alias(f"__{c}") for c in rest]))
    picked = df.groupBy(*keys).agg(best.alias("__row"))
    return picked.select(*keys, "__row.*").select(*df.columns)


def upsert(
    target: DataFrame,
    source: DataFrame,
    keys: list[str],
    keep_on_update: list[str] | None = None,
    order: list[Column] | None = None,
) -> DataFrame:
    """Rows of the source replace or extend the target.

    Source columns missing from the target are ignored. A target column that the
    source lacks, or that is in `keep_on_update`, keeps its old value on update;
    on insert it takes the source value (or NULL). Of several source rows with
    one key the last by `order` counts.
    """
    keep = set(keep_on_update or [])
    src = latest(source, keys, order or []).select(
        *keys,
        *[F.col(c).alias(f"__s_{c}") for c in source.columns if c not in keys],
        F.lit(True).alias("__new"),
    )
    joined = target.withColumn("__old", F.lit(True)).join(src, keys, "full")
    out = []
    for name in target.columns:
        if name in keys:
            out.append(F.col(name))
            continue
        shown = F.col(f"__s_{name}") if name in source.columns else F.lit(None)
        if name in keep or name not in source.columns:
            value = F.when(F.col("__old"), F.col(name)).otherwise(shown)
        else:
            value = F.when(F.col("__new"), shown).otherwise(F.col(name))
        out.append(value.alias(name))
    return joined.select(*out)


def insert_new(target: DataFrame, source: DataFrame, keys: list[str]) -> DataFrame:
    """Source rows whose key the target lacks (INSERT ... WHERE NOT EXISTS)."""
    return latest(source, keys, []).join(target.select(*keys), keys, "left_anti")


def add_to_set(members: DataFrame, new: DataFrame) -> DataFrame:
    return members.unionByName(new.select(*members.columns)).distinct()


def overwrite_fields(table: DataFrame, new: DataFrame, key: str = "key", value: str = "value"):
    """Hash overwrite: the new value of a field wins."""
    return upsert(table, new.select(key, value), [key])


def full_outer_default(
    old: DataFrame, new: DataFrame, keys: list[str], value: str, default
) -> DataFrame:
    """Every key of either side with the new value, or the default where there is none."""
    joined = old.select(*keys).distinct().join(new.select(*keys, value), keys, "full")
    return joined.select(*keys, F.coalesce(F.col(value), F.lit(default)).alias(value))
