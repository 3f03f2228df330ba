"""Joins and groupings that hold when one key has a third of all rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SALT = "__salt"
PARTS = 16


def heavy_keys(df: DataFrame, keys: list[str], ways: int = 64) -> DataFrame:
    """Keys with more than 1/ways of the rows: fewer than `ways` of them, whatever the data."""
    counts = df.groupBy(*keys).agg(F.count("*").alias("__n"))
    total = counts.agg(F.sum("__n")).scalar()
    return counts.where(F.col("__n") * ways > total).select(*keys)


def salted_join(
    left: DataFrame,
    right: DataFrame,
    keys: list[str],
    spread: list[str],
    how: str = "inner",
    salts: int = 16,
    heavy: DataFrame | None = None,
) -> DataFrame:
    """Equi-join whose left side may be skewed on `keys`.

    With `heavy` (a bounded list from heavy_keys) the left rows of those keys get a salt
    from the `spread` columns and their right rows are copied once per salt, so a hot key
    is joined by `salts` tasks. Without it the join is a plain one: adaptive execution
    broadcasts a right side whose measured size is small, and splits skewed partitions.
    """
    if how not in ("inner", "left", "left_semi", "left_anti"):
        raise ValueError("only joins that keep the left side can be salted")
    salt = F.pmod(F.xxhash64(*spread), F.lit(salts)).cast("int")
    copies = F.sequence(F.lit(0), F.lit(salts - 1))
    if heavy is None:
        return left.join(right, keys, how)
    flags = F.broadcast(heavy.select(*keys).withColumn("__hot", F.lit(True)))
    hot = F.coalesce(F.col("__hot"), F.lit(False))
    salted_left = (
        left.join(flags, keys, "left")
        .withColumn(SALT, F.when(hot, salt).otherwise(F.lit(0)))
        .drop("__hot")
    )
    salted_right = (
        right.join(flags, keys, "left")
        .withColumn(SALT, F.explode(F.when(hot, copies).otherwise(F.array(F.lit(0)))))
        .drop("__hot")
    )
    return salted_left.join(salted_right, [*keys, SALT], how).drop(SALT)


def in_blocks(
    rows: DataFrame, listed: DataFrame, key: str, spread: list[str], block: int = 256, slots: int = 16
) -> DataFrame:
    """Every row with every row of a stated list, a block of the list at a time.

    The list is cut into blocks of about `block` rows by a hash of `key`. A row
    goes once to each block, which comes as the array `entries`; `slots` copies
    of a block share its rows out. The join is on block and slot, however long
    the list is.
    """
    blocks = F.greatest(F.lit(1), F.ceil(listed.agg(F.count("*")).scalar() / block)).cast("int")
    entry = F.struct(*listed.columns)
    packed = (
        listed.groupBy(F.pmod(F.xxhash64(key), blocks).cast("int").alias("__block"))
        .agg(F.collect_list(entry).alias("entries"))
        .withColumn("__slot", F.explode(F.sequence(F.lit(0), F.lit(slots - 1))))
    )
    sent = rows.withColumn("__block", F.explode(F.sequence(F.lit(0), blocks - 1))).withColumn(
        "__slot", F.pmod(F.xxhash64(*spread), F.lit(slots)).cast("int")
    )
    return sent.join(packed, ["__block", "__slot"]).drop("__block", "__slot")


def value_counts(df: DataFrame, keys: list[str], value: Column, alias: str = "value") -> DataFrame:
    """(keys, value, num): the values of each group as rows, for groups of any size."""
    return df.groupBy(*keys, value.cast("string").alias(alias)).agg(F.count("*").alias("num"))


def joined_text(
    df: DataFrame,
    keys: list[str],
    value: Column,
    alias: str,
    separator: str,
    distinct: bool = False,
    parts: int = PARTS,
) -> DataFrame:
    """(keys, part, text): sorted values of each group, joined into a text for each part.

    The part is a hash of the value alone, so every group is split alike, at
    every size and on every retry; a part without values has no row. A null
    value is left out. `parts` grows with the largest group a caller expects;
    value_counts has the same content as rows.
    """
    counted = value_counts(df, keys, value, "__v").where(F.col("__v").isNotNull())
    digits = F.conv(F.substring(F.md5("__v"), 1, 8), 16, 10).cast("bigint")
    part = F.pmod(digits, F.lit(parts)).cast("int").alias("part")
    again = F.lit(1) if distinct else F.col("num").cast("int")
    held = counted.select(*keys, part, F.struct("__v", again.alias("num")).alias("__x"))
    repeated = F.transform(
        F.array_sort(F.collect_list("__x")), lambda x: F.array_repeat(x["__v"], x["num"])
    )
    return held.groupBy(*keys, "part").agg(F.array_join(F.flatten(repeated), separator).alias(alias))
