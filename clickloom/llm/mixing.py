"""Mixing of sources to target weights by pivotal dependent rounding.

A document of a source whose target is p times its size is taken floor(p) times
for sure, and once more with the fractional part as its probability. These
fractions are settled in pairs: copy mass, weighed by the documents' sizes, moves
between two of them in a random direction until one is 0 or 1, so the words taken
stay what they were expected to be. Small blocks are settled by a fold each; the one
document a block leaves over goes up a reduction tree of ever fewer blocks.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from clickloom.session import cut_lineage

WORDS = "[^\\x20\\x09-\\x0D]+"
WEIGHTS = (1, 2, 3)
MOST = 3  # times its own size that a source or a document may be taken
BLOCK = 64


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORDS)), F.lit(0)).cast("long")


def ranked_sources(sources: DataFrame) -> DataFrame:
    """Number the sources from 0 by code point, null last, without one task for all of them."""
    dealt = sources.withColumn("__null", F.col("source").isNull()).repartitionByRange("__null", "source")
    dealt = cut_lineage(dealt.withColumn("__part", F.spark_partition_id()))
    order = Window.partitionBy("__part").orderBy("__null", "source")
    before = dealt.groupBy("__part").agg(F.count(F.lit(1)).alias("__n"))
    # A row for each partition of the range: a handful beside the sources.
    before = before.withColumn(
        "__before", F.sum("__n").over(Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1))
    ).select("__part", F.coalesce("__before", F.lit(0)).alias("__before"))
    return dealt.join(before, "__part").withColumn(
        "rank", F.row_number().over(order) - 1 + F.col("__before")
    ).drop("__part", "__before", "__null")


def targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST) -> DataFrame:
    """(source, source_size, target) from (source, source_size).

    The total is shared by weight; a target stops at `most` times its source's
    size and the excess is shared again by weight, until none is above.
    """
    listed = F.array(*[F.lit(w).cast("double") for w in weights])
    weight = F.element_at(listed, (F.col("rank") % len(weights) + 1).cast("int"))
    table = cut_lineage(
        ranked_sources(sizes).select("source", "source_size", weight.alias("weight"))
    )
    cap = F.col("source_size") * float(most)
    total = table.agg(F.sum("source_size")).first()[0] or 0
    level, capped = 0.0, -1
    while True:
        # Sources at their cap for this level keep it; the rest share what is left.
        at_cap = F.col("weight") * level >= cap
        left, heavy, held = table.agg(
            F.lit(float(total)) - F.coalesce(F.sum(F.when(at_cap, cap)), F.lit(0.0)),
            F.sum(F.when(~at_cap, F.col("weight"))),
            F.count(F.when(at_cap, 1)),
        ).first()
        if held == capped or not heavy:
            break
        level, capped = max(level, left / heavy), held
    return table.select(
        "source", "source_size", F.least(F.col("weight") * level, cap).alias("target")
    )


def _uniform(seed: int, *columns: Column) -> Column:
    """A number in (0, 1) that depends on the columns alone."""
    bits = F.shiftrightunsigned(F.xxhash64(F.lit(seed), *columns), 11)
    return (bits.cast("double") + 0.5) / float(1 << 53)


def _settle(units: DataFrame, blocks: Column, keys: list[str], seed: int) -> DataFrame:
    """Fold each block: (keys, done: array of (unit, taken), left: the unit not settled yet)."""
    unit = F.struct(F.col("__unit").alias("unit"), F.col("__mass").alias("mass"), F.col("__p").alias("p"))
    grouped = units.groupBy(*keys, blocks.alias("__block")).agg(F.sort_array(F.collect_list(unit)).alias("__all"))

    def fold(state: Column, b: Column) -> Column:
        a = state["left"]
        # Mass that can go from b to a (up) or from a to b (down), in words.
        up = F.least((1 - a["p"]) * a["mass"], b["p"] * b["mass"])
        down = F.least(a["p"] * a["mass"], (1 - b["p"]) * b["mass"])
        rises = _uniform(seed, a["unit"], b["unit"]) * (up + down) < down
        moved = F.when(rises, up).otherwise(-down)
        pa, pb = a["p"] + moved / a["mass"], b["p"] - moved / b["mass"]
        # Exactly one bound was reached; which one is told without rounding errors.
        first_ends = F.when(rises, (1 - a["p"]) * a["mass"] <= b["p"] * b["mass"]).otherwise(
            a["p"] * a["mass"] <= (1 - b["p"]) * b["mass"]
        )
        ended = F.struct(
            F.when(first_ends, a["unit"]).otherwise(b["unit"]).alias("unit"),
            F.when(first_ends, rises).otherwise(~rises).cast("int").alias("taken"),
        )
        stays = F.struct(
            F.when(first_ends, b["unit"]).otherwise(a["unit"]).alias("unit"),
            F.when(first_ends, b["mass"]).otherwise(a["mass"]).alias("mass"),
            F.greatest(F.lit(0.0), F.least(F.lit(1.0), F.when(first_ends, pb).otherwise(pa))).alias("p"),
        )
        return F.struct(F.concat(state["done"], F.array(ended)).alias("done"), stays.alias("left"))

    none = F.slice(F.transform("__all", lambda x: F.struct(x["unit"].alias("unit"), F.lit(0).alias("taken"))), 1, 0)
    start = F.struct(
        none.alias("done"),
        F.element_at("__all", 1).alias("left"),
    )
    rest = F.slice("__all", 2, F.size("__all"))
    return grouped.withColumn("__state", F.aggregate(rest, start, fold)).select(
        *keys, "__block", F.col("__state.done").alias("done"), F.col("__state.left").alias("left")
    )


def rounded(units: DataFrame, keys: list[str], seed: int = 0, block: int = BLOCK) -> DataFrame:
    """(unit, taken) for rows of (keys, __unit of any type, __mass above 0, __p between 0 and 1).

    Blocks are hashes of the unit, so one key with a third of all rows has a
    third of the blocks. The tree ends when each key has one unit left, which is
    drawn by its fraction alone.
    """
    parts = []
    while True:
        counts = cut_lineage(units.groupBy(*keys).agg(F.count(F.lit(1)).alias("__n")))
        most = counts.agg(F.max("__n")).first()[0] or 0
        if most <= 1:
            break
        many = F.ceil(F.col("__n") / block)
        blocks = F.pmod(F.xxhash64(F.lit(seed + len(parts)), F.col("__unit")), many)
        sized = units.join(
            counts.withColumnsRenamed({k: f"__{k}" for k in keys}), [F.col(k).eqNullSafe(F.col(f"__{k}")) for k in keys]
        )
        settled = cut_lineage(_settle(sized, blocks, keys, seed + len(parts)))
        parts.append(settled.select(F.explode("done").alias("__d")).select("__d.unit", "__d.taken"))
        units = settled.select(
            *keys, F.col("left.unit").alias("__unit"), F.col("left.mass").alias("__mass"),
            F.col("left.p").alias("__p"),
        )
    drawn = (_uniform(seed + 7, F.col("__unit")) < F.col("__p")).cast("int")
    found = units.select(F.col("__unit").alias("unit"), drawn.alias("taken"))
    for part in parts:
        found = found.unionByName(part)
    return found


def mix(
    docs: DataFrame,
    doc_id: str = "doc_id",
    source: str = "source",
    text: str = "text",
    weights: tuple[int, ...] = WEIGHTS,
    most: int = MOST,
    seed: int = 0,
) -> DataFrame:
    """(doc_id, source, size, source_size, target, copies): a row for each document.

    The size is the number of words, 0 for null; a null source is a source, the last.
    Documents without words are settled by their own fraction alone, as their copies
    cost nothing. A source without any words has target 0 and all its documents
    once. Repeated rows are documents each. Copies depend on id, source and size
    alone, so reruns agree. An empty table gives an empty result.
    """
    named = docs.select(F.col(doc_id).alias("doc_id"), F.col(source).alias("source"),
                        word_count(F.col(text)).alias("size"))
    # Rows alike in all three are one row and a number, so no id is a hot key.
    rows = cut_lineage(named.groupBy("doc_id", "source", "size").agg(F.count(F.lit(1)).alias("__rows")))
    sizes = rows.groupBy("source").agg(F.sum(F.col("size") * F.col("__rows")).alias("source_size"))
    wanted = cut_lineage(targets(sizes, weights, most))
    expected = F.when(F.col("source_size") == 0, 1.0).otherwise(F.col("target") / F.col("source_size"))
    shares = wanted.withColumn("__expected", expected).withColumnRenamed("source", "__source")
    every = (
        rows.join(shares, F.col("source").eqNullSafe(F.col("__source")))
        .withColumn("__number", F.explode(F.sequence(F.lit(1).cast("long"), "__rows")))
        .withColumn("__sure", F.floor("__expected"))
        .withColumn("__p", F.col("__expected") - F.col("__sure"))
        .withColumn("__unit", F.struct("doc_id", "source", "size", F.col("__number").alias("number")))
    )
    open_ = (F.col("__p") > 0) & (F.col("size") > 0)
    units = every.where(open_).select("source", "__unit", F.col("size").cast("double").alias("__mass"), "__p")
    settled = rounded(units, ["source"], seed)
    alone = every.where(~open_)
    alone = alone.select(F.col("__unit").alias("unit"), (_uniform(seed + 7, F.col("__unit")) < F.col("__p")).cast("int").alias("taken"))
    return (
        settled.unionByName(alone)
        .select("unit.*", "taken")
        .join(shares, F.col("source").eqNullSafe(F.col("__source")))
        .select(
            "doc_id", "source", "size", "source_size", "target",
            (F.floor("__expected") + F.col("taken")).cast("int").alias("copies"),
        )
    )


def apply_mix(docs: DataFrame, mixed: DataFrame, doc_id: str = "doc_id", source: str = "source",
              text: str = "text") -> DataFrame:
    """The rows of `docs`, each as often as `mixed` takes it; rows taken 0 times go."""
    def key(d, s, size):
        return F.to_json(F.struct(d.alias("d"), s.alias("s"), size.alias("n")))

    taken = mixed.groupBy(key(F.col("doc_id"), F.col("source"), F.col("size")).alias("__key")).agg(
        F.sum("copies").alias("__copies"), F.count(F.lit(1)).alias("__rows")
    )
    keyed = docs.withColumn("__key", key(F.col(doc_id), F.col(source), word_count(F.col(text))))
    # Rows alike share their copies as evenly as whole numbers can.
    number = F.row_number().over(Window.partitionBy("__key").orderBy(F.col(text)))
    share = F.floor(F.col("__copies") / F.col("__rows")) + (number <= F.col("__copies") % F.col("__rows")).cast("long")
    counted = keyed.join(taken.where("__copies > 0"), "__key").withColumn("__share", share).where("__share > 0")
    return counted.withColumn("__copy", F.explode(F.sequence(F.lit(1).cast("long"), "__share"))).select(docs.columns)
