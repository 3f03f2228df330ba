"""Near-duplicates by SimHash, linked through segment popcounts.

A fingerprint is cut into segments of two bits and mapped to the vector of their
bit counts. The Manhattan distance of two such vectors never exceeds the Hamming
distance of the fingerprints, so fingerprints within `bits` differ by at most
bits // 2 in one half of the vector. Each half is a grid of unit cells; a
fingerprint is joined with those in its own cell and in the neighbouring cells,
and every candidate pair is verified on the fingerprints themselves.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clickloom.llm import batches
from clickloom.llm.components import components
from clickloom.session import cut_lineage

SEED = 42
BLOCK = 2048  # fingerprints of one cell compared at once; larger cells are dealt over block pairs


def fingerprint(text: str | None, words: int = 3) -> int:
    """The 64 bits set in over half the hashes of a text's shingles, as an unsigned number.

    A-Z count as a-z, words are parted by ASCII white space. Fewer words than a
    shingle has make one shingle; no word gives 0.
    """
    # UTF-8 bytes: lower() and split() know ASCII alone there, as wanted.
    parts = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not parts:
        return 0
    joined, size = b" ".join(parts), min(words, len(parts))
    ends = np.cumsum(np.fromiter(map(len, parts), np.int64, len(parts)) + 1) - 1
    begins = np.concatenate(([0], ends[:-1] + 1))
    number = len(parts) - size + 1
    counts = np.zeros(64, np.int64)
    digest = xxhash.xxh64_intdigest
    for i in range(0, number, 1 << 16):  # a very long text goes through in runs
        spans = zip(begins[i : min(i + (1 << 16), number)].tolist(),
                    ends[i + size - 1 : i + size - 1 + (1 << 16)].tolist(), strict=False)
        h = np.array([digest(joined[a:b], SEED) for a, b in spans], "<u8")
        counts += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int.from_bytes(np.packbits(counts * 2 > number, bitorder="little").tobytes(), "little")


def fingerprints(docs: DataFrame, text: str = "text", words: int = 3, name: str = "simhash") -> DataFrame:
    """Add the fingerprint of each whole text as a (signed) long; null counts as empty."""

    @F.pandas_udf("long")
    def run(series: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in series:
            found = np.array([fingerprint(t, words) for t in batch], np.uint64)
            yield pd.Series(found.view(np.int64))

    batches.small(docs.sparkSession)
    return docs.withColumn(name, run(F.col(text)))


def _cells(half: np.ndarray, side: int) -> tuple[np.ndarray, list[tuple[np.ndarray, np.ndarray]]]:
    """The cell of each 32-bit half, and (rows, cell) of each step up along one axis."""
    ones = np.uint64(0x55555555)
    counts = (half & ones) + ((half >> np.uint64(1)) & ones)  # two bits a segment: 0, 1 or 2
    own = counts | np.uint64(side << 32)
    steps = []
    for axis in range(16):
        rows = np.flatnonzero((counts >> np.uint64(2 * axis)) & np.uint64(3) < 2)
        steps.append((rows, own[rows] + np.uint64(1 << (2 * axis))))
    return own, steps


def _keys(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """(cell, own, fp): a row for a fingerprint's cell and each upper neighbour, in both halves.

    Of two neighbouring cells one is above the other, so a step up from one side
    meets the own cell of the other.
    """
    for batch in batches:
        fp = batch["fp"].to_numpy().view(np.uint64)
        for side in (0, 1):
            own, steps = _cells((fp >> np.uint64(32 * side)) & np.uint64(0xFFFFFFFF), side)
            yield pd.DataFrame({"cell": own.view(np.int64), "own": True, "fp": fp.view(np.int64)})
            for rows, cell in steps:
                yield pd.DataFrame({"cell": cell.view(np.int64), "own": False, "fp": fp[rows].view(np.int64)})


def _forest(left: np.ndarray, right: np.ndarray, bits: int) -> list[tuple[int, int]]:
    """Edges that connect what pairs within `bits` connect: at most one fewer than there are nodes."""
    parent: dict[int, int] = {}

    def root(x: int) -> int:
        while parent.setdefault(x, x) != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    edges = []
    for i in range(0, len(left), 256):
        near = np.bitwise_count(left[i : i + 256, None] ^ right[None, :]) <= bits
        for a, b in zip(*(x.tolist() for x in np.nonzero(near)), strict=True):
            u, v = int(left[i + a]), int(right[b])
            ru, rv = root(u), root(v)
            if ru != rv:
                parent[ru] = rv
                edges.append((u, v))
    return edges


def _linked(bits: int):
    """For sorted rows of (cell, pair, side, own, fp): verified edges within each cell's block pair."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: list[np.ndarray] = []
        for batch in batches:
            rows = np.stack([batch["cell"], batch["pair"], batch["side"], batch["own"].astype(np.int64), batch["fp"]])
            # Rows of the last group may go on in the next batch.
            last = np.flatnonzero((np.diff(rows[0]) != 0) | (np.diff(rows[1]) != 0))
            if not len(last):
                held.append(rows)
                continue
            cut = last[-1] + 1
            yield _edges(np.concatenate([*held, rows[:, :cut]], 1), bits)
            held = [rows[:, cut:]]
        if held:
            yield _edges(np.concatenate(held, 1), bits)

    return run


def _edges(rows: np.ndarray, bits: int) -> pd.DataFrame:
    cell, pair, side, own = rows[:4]
    fp = rows[4].view(np.uint64)
    starts = np.flatnonzero(np.concatenate(([True], (np.diff(cell) != 0) | (np.diff(pair) != 0))))
    ends = np.append(starts[1:], len(cell))
    u, v = [], []
    sizes = ends - starts
    # Pairs of rows of one group; at least one of them stands in its own cell.
    for size in np.unique(sizes[(sizes > 1) & (sizes <= 16)]):
        at = starts[sizes == size]
        for i in range(size):
            for j in range(i + 1, size):
                a, b = at + i, at + j
                near = (own[a] + own[b] > 0) & (np.bitwise_count(fp[a] ^ fp[b]) <= bits)
                u.append(fp[a[near]])
                v.append(fp[b[near]])
    for start, end in zip(starts[sizes > 16], ends[sizes > 16], strict=True):
        s, o, f = side[start:end], own[start:end] > 0, fp[start:end]
        # side 0: within a block; 1 and 2: the two blocks of a pair of blocks.
        if s[0] == 0:
            edges = _forest(f[o], f, bits)
        else:
            edges = _forest(f[o & (s == 1)], f[s == 2], bits) + _forest(f[o & (s == 2)], f[s == 1], bits)
        if edges:
            found = np.array(edges, np.uint64)
            u.append(found[:, 0])
            v.append(found[:, 1])
    none = np.zeros(0, np.uint64)
    u, v = np.concatenate(u or [none]), np.concatenate(v or [none])
    return pd.DataFrame({"u": u.view(np.int64), "v": v.view(np.int64)})


def _dealt(keys: DataFrame, block: int) -> DataFrame:
    """Add pair and side: cells above `block` rows are cut into blocks, and each pair of blocks is a group."""
    large = keys.groupBy("cell").agg(F.count(F.lit(1)).alias("__n")).where(F.col("__n") > block)
    # Written first, so that its size is known when the join is planned.
    large = cut_lineage(large.select("cell", F.ceil(F.col("__n") / block).alias("__blocks")))
    blocks = F.coalesce("__blocks", F.lit(1)).cast("long")
    mine = F.pmod(F.xxhash64("fp"), blocks)
    groups = F.transform(
        F.sequence(F.lit(0).cast("long"), blocks - 1),
        lambda other: F.struct(
            (F.least(mine, other) * blocks + F.greatest(mine, other)).alias("pair"),
            F.when(other == mine, 0).when(mine < other, 1).otherwise(2).alias("side"),
        ),
    )
    return keys.join(large, "cell", "left").select("cell", "own", "fp", F.explode(groups).alias("__g")).select(
        "cell", "__g.pair", "__g.side", "own", "fp"
    )


def links(distinct: DataFrame, bits: int = 3, block: int = BLOCK) -> DataFrame:
    """(u, v) edges between distinct fingerprints `fp` that connect all pairs within `bits` bits.

    `bits` is at most 3: with two halves one of them then differs by 1 or 0.
    """
    if not 0 <= bits <= 3:
        raise ValueError("two halves prove candidates complete for at most 3 bits")
    keys = cut_lineage(distinct.select("fp").mapInPandas(_keys, "cell long, own boolean, fp long"))
    dealt = _dealt(keys, block).repartition("cell", "pair").sortWithinPartitions("cell", "pair")
    return dealt.mapInPandas(_linked(bits), "u long, v long")


def near_duplicates(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", words: int = 3, bits: int = 3
) -> DataFrame:
    """(id, simhash, component_id) for each row of `docs`: the smallest id reachable by links.

    Null and white texts have fingerprint 0 and are linked like any others. A null
    id counts for no component's smallest id; a component of such rows alone has
    null. Repeated rows and equal texts share a fingerprint and are one node. Texts
    are read whole, however long; other columns are left out. An empty table gives an
    empty one.
    """
    narrow, classes = _classed(docs, doc_id, text, words, bits)
    return narrow.join(classes, "simhash").select("id", "simhash", "component_id")


def _digest(text: Column) -> list[Column]:
    """128 bits that tell texts apart; null is no text's."""
    return [F.xxhash64(text).alias("__a"), F.xxhash64(F.lit(1), text).alias("__b")]


def _classed(docs: DataFrame, doc_id: str, text: str, words: int, bits: int) -> tuple[DataFrame, DataFrame]:
    """(id, __a, __b, simhash) of each row, and (simhash, root, component_id) of each fingerprint, both written."""
    narrow = docs.select(F.col(doc_id).alias("id"), F.col(text).alias("text"), *_digest(F.col(text)))
    narrow = cut_lineage(fingerprints(narrow, "text", words).drop("text"))
    nodes = cut_lineage(narrow.groupBy(F.col("simhash").alias("fp")).agg(F.min("id").alias("id")))
    roots = components(links(nodes, bits)).withColumnRenamed("node", "fp")
    whole = nodes.join(roots, "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    least = whole.groupBy("root").agg(F.min("id").alias("component_id"))
    return narrow, cut_lineage(whole.join(least, "root").select(F.col("fp").alias("simhash"), "root", "component_id"))


def keep_one(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", words: int = 3, bits: int = 3) -> DataFrame:
    """One row of `docs` for each component: that of the smallest id.

    Of rows alike in that id the one with the smallest text stays (null before the
    empty text), of rows alike in both any one. A component without any id keeps its
    smallest text. An id on unlike texts may stand in several components and is looked
    at in each. Null, empty and white texts are one component; long texts are read
    whole; columns of `docs` are returned as they are. An empty table gives an empty one.
    """
    narrow, classes = _classed(docs, doc_id, text, words, bits)
    # What bears the id of its component, or bears none where no row does; a text is in one component only.
    first = narrow.join(classes, "simhash").where(F.col("id").eqNullSafe(F.col("component_id")))
    first = cut_lineage(first.select(F.col("id").alias("__id"), "__a", "__b", F.col("root").alias("__root")).distinct())
    keyed = docs.select("*", F.struct(*_digest(F.col(text))).alias("__key"))
    met = keyed.join(
        first,
        F.col(doc_id).eqNullSafe(F.col("__id"))
        & (F.col("__key.__a") == F.col("__a")) & (F.col("__key.__b") == F.col("__b")),
    )
    kept = met.groupBy("__root").agg(
        F.min_by(F.struct(*docs.columns), F.struct(F.col(text))).alias("__row")
    )
    return kept.select("__row.*")


def hex_of(column: Column) -> Column:
    return F.lpad(F.lower(F.hex(column)), 16, "0")
