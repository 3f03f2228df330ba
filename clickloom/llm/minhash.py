"""Document fingerprints by one-permutation MinHash, in DataFrame functions only.

Each shingle is hashed once; the upper bits name its bin and the smallest hash of
each bin stays. An empty bin takes the value of another bin, found by a fixed
sequence of probes that all documents share (optimal densification). Four low
bits of each value are packed, and likeness is corrected for chance agreement.
"""

from __future__ import annotations

import random
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

SHINGLE = 5
BIN_BITS = 8
BINS = 1 << BIN_BITS
LOW_BITS = 4
PACKED = 64 // LOW_BITS  # values in one long
PROBES = 4
CAPITALS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
WHITE = "\t\n\x0b\x0c\r"


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """`body` of a value that is worked out once for each row."""
    return F.get(F.transform(F.array(value), body), 0)


def _long(value: int) -> Column:
    return F.lit(value).cast("long")


def _bin(h: Column) -> Column:
    return F.shiftright(h, 64 - BIN_BITS) + BINS // 2


def _probe_tables() -> list[Column]:
    """For each probe the bin that an empty bin looks at: draws of a generator with a fixed seed."""
    draw = random.Random(BINS)
    return [F.array(*[F.lit(draw.randrange(BINS)) for _ in range(BINS)]) for _ in range(PROBES)]


def shingle_hashes(text: Column) -> Column:
    """Hashes of the five-word shingles of a text; fewer words, none included, make one shingle."""
    # One kind of blank between words and no capital A-Z.
    plain = F.translate(F.coalesce(text, F.lit("")), CAPITALS + WHITE, CAPITALS.lower() + " " * len(WHITE))
    words = F.split(F.trim(plain), " +")

    def of_words(w: Column) -> Column:
        def at(i: Column) -> Column:
            return F.xxhash64(*[F.get(w, i + k) for k in range(SHINGLE)])

        return F.when(F.size(w) <= SHINGLE, F.array(F.xxhash64(w))).otherwise(
            F.transform(F.sequence(F.lit(0), F.size(w) - SHINGLE), at)
        )

    return _let(F.transform(words, lambda w: F.xxhash64(w)), of_words)


def _densified(least: Column) -> Column:
    """Least hashes of the filled bins, in their order, to one value for every bin."""

    def dense(filled: Column) -> Column:
        return F.transform(
            F.sequence(F.lit(0), F.lit(BINS - 1)),
            lambda b: F.get(least, F.array_position(filled, b.cast("long")).cast("int") - 1),
        )

    def fill(filled: Column, values: Column) -> Column:
        def of_bin(b: Column) -> Column:
            probes = [F.get(values, F.get(t, b)) for t in _probe_tables()]
            # Then the filled bin that comes first in an order of this bin's own.
            ranked = F.transform(
                least, lambda h: F.struct(F.xxhash64(b, _bin(h)).alias("r"), h.alias("h"))
            )
            # A borrowed value is hashed with the bin, or few values would agree by chance in many bins.
            return F.coalesce(F.get(values, b), F.xxhash64(b, F.coalesce(*probes, F.array_min(ranked)["h"])))

        return F.transform(F.sequence(F.lit(0), F.lit(BINS - 1)), of_bin)

    return _let(
        F.transform(least, lambda h: _bin(h).cast("long")),
        lambda filled: _let(dense(filled), lambda values: fill(filled, values)),
    )


def _packed(values: Column) -> Column:
    """Low bits of every value, sixteen values to a long."""
    return F.transform(
        F.sequence(F.lit(0), F.lit(BINS // PACKED - 1)),
        lambda i: F.aggregate(
            F.slice(values, i * PACKED + 1, PACKED),
            _long(0),
            lambda acc, h: F.shiftleft(acc, LOW_BITS).bitwiseOR(h.bitwiseAND((1 << LOW_BITS) - 1)),
        ),
    )


def fingerprint(text: Column) -> Column:
    """array<bigint> of the packed low bits of all bins; equal texts have equal ones.

    Null is empty. A-Z count as a-z and any ASCII white space as one blank. Texts
    without a word share one fingerprint.
    """

    def of_sorted(h: Column) -> Column:
        # Sorted, the first hash of each bin is its least.
        return F.filter(h, lambda x, i: (i == 0) | (_bin(x) != _bin(F.get(h, i - 1))))

    least = _let(F.sort_array(shingle_hashes(text)), of_sorted)
    return _let(_let(least, _densified), _packed)


def likeness(a: Column, b: Column) -> Column:
    """Estimated share of common shingles, 0 to 1, corrected for equal low bits by chance."""
    ones = sum(1 << (LOW_BITS * i) for i in range(PACKED))
    ones -= (1 << 64) if ones >> 63 else 0

    def differing(x: Column, y: Column) -> Column:
        d = x.bitwiseXOR(y)
        # Gather the bits of each value in its lowest one; the mask leaves no sign bit.
        d = d.bitwiseOR(F.shiftrightunsigned(d, 2))
        d = d.bitwiseOR(F.shiftrightunsigned(d, 1))
        return F.bit_count(d.bitwiseAND(_long(ones)))

    unlike = F.aggregate(F.zip_with(a, b, differing), F.lit(0), lambda acc, n: acc + n)
    chance = 1.0 / (1 << LOW_BITS)
    share = (1 - unlike / F.lit(float(BINS)) - chance) / (1 - chance)
    return F.greatest(F.lit(0.0), F.least(F.lit(1.0), share))


def as_text(packed: Column) -> Column:
    return F.array_join(F.transform(packed, lambda x: F.lpad(F.lower(F.hex(x)), 16, "0")), "")


def fingerprints(docs: DataFrame, text: str = "text", name: str = "minhash") -> DataFrame:
    """Add the fingerprint of each whole text as column `name` (replaced if there)."""
    return docs.withColumn(name, fingerprint(F.col(text)))


def _block(doc_id: Column, cuts: list[int]) -> Column:
    """How many cuts lie below the id, by bisection; -1 for a null id."""
    steps = [1 << i for i in reversed(range(len(cuts).bit_length()))]
    if not cuts:
        return F.when(doc_id.isNull(), -1).otherwise(0)
    listed = F.array(*[_long(c) for c in cuts])
    found = F.aggregate(
        F.array(*map(F.lit, steps)),
        F.lit(0),
        lambda at, s: F.when(
            (at + s <= len(cuts)) & (F.get(listed, at + s - 1) < doc_id), at + s
        ).otherwise(at),
    )
    return F.when(doc_id.isNull(), -1).otherwise(found)


def with_next(docs: DataFrame, carried: list[str], doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Add next_<c> for each carried column: its value in the next row by descending id.

    After the last row comes the first. Equal ids go by their text, null ids come
    last. Ids are cut at approximate quantiles into blocks, a few for each shuffle
    partition; the row that follows a block is copied into it, so that no task
    orders more than a block. Rows with a null id are one block.
    """
    spark = docs.sparkSession
    number = 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    at = F.array(*[F.lit(i / number) for i in range(1, number)])
    found = docs.agg(F.percentile_approx(doc_id, at, F.lit(max(10_000, 4 * number)))).first()[0]
    block = _block(F.col(doc_id), sorted(set(found or [])))
    # The largest id of each block: as many as there are blocks.
    heads = docs.groupBy(block.alias("b")).agg(F.max(doc_id).alias("head")).orderBy(F.desc("b")).collect()
    above = {heads[i].head: heads[i - 1].b for i in range(len(heads))}
    copies = F.array(F.struct(block.alias("block"), F.lit(False).alias("copy")))
    for head, b in above.items():
        if head is None:
            copies = F.when(
                F.col(doc_id).isNull(), F.concat(copies, F.array(F.struct(F.lit(b).alias("block"), F.lit(True).alias("copy"))))
            ).otherwise(copies)
    known = {h: b for h, b in above.items() if h is not None}
    if known:
        where = F.create_map(*[x for h, b in known.items() for x in (_long(h), F.lit(b))])
        extra = F.struct(F.get(F.array(where[F.col(doc_id)]), 0).alias("block"), F.lit(True).alias("copy"))
        is_head = F.col(doc_id).isin(list(known))
        copies = F.when(is_head, F.concat(copies, F.array(extra))).otherwise(copies)
    order = Window.partitionBy("__at.block").orderBy(
        "__at.copy", F.col(doc_id).desc_nulls_last(), F.col(text).asc_nulls_first()
    )
    dealt = docs.withColumn("__at", F.explode(copies))
    dealt = dealt.withColumns({f"next_{c}": F.lead(c).over(order) for c in carried})
    return dealt.where(~F.col("__at.copy")).drop("__at")


def edited(text: Column, following: Column) -> Column:
    """The text with its last third replaced by as much of the beginning of the following one."""
    cut = F.floor(F.length(text) / 3).cast("int")
    return F.concat(
        F.substring(text, F.lit(1), F.length(text) - cut), F.substring(following, F.lit(1), cut)
    )
