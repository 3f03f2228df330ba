"""De-duplicated read counter.

A read counts when it is the user's first of the article, or comes more than
`gap_ms` after the last read that counted. That chain is greedy, so it has to
be followed in time order. It is cut into slices that are worked on apart:

1. per (key, slice) the distinct times, sorted;
2. per slice a small table "entered with last counted time up to x -> leaves
   with last counted time y after n counts";
3. tables of neighbouring slices are composed into one, up to WAYS at a time, in
   rounds until one is left for each key. Composing is associative, so it needs
   no walk through a key's whole history.

A table holds at most one line per time in the first `gap_ms` of its slices and
usually one or two, since chains from near starts soon meet.
"""

from __future__ import annotations

from bisect import bisect_left

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clickloom.session import cut_lineage

GAP_MS = 100_000
WAYS = 64  # tables composed by one group of a round


LINES = T.ArrayType(T.StructType([T.StructField(n, T.LongType()) for n in ("upto", "exit", "n")]))


def _lines_of(times: np.ndarray, gap: int, slice_end_of_entries: int):
    """Transition table of a slice: a line for each possible first counted time.

    Every time points to the next one that would count after it; the pointers
    are doubled until all have left the slice.
    """
    size = len(times)
    if not size:
        return []
    following = np.append(np.searchsorted(times, times + gap, side="right"), size)
    leave = np.append(times, 0)
    count = np.append(np.ones(size, dtype=np.int64), 0)
    while following[0] < size:
        inside = following < size
        leave = np.where(inside, leave[following], leave)
        count = count + count[following]
        following = following[following]
    # Entry times lie before the slice, so no start beyond its first gap (plus one) is needed.
    starts = min(size, int(np.searchsorted(times, slice_end_of_entries, side="left")) + 1)
    leave, count = leave[:starts], count[:starts]
    last = np.append((leave[1:] != leave[:-1]) | (count[1:] != count[:-1]), True)
    upto = times[:starts] - gap - 1
    return [(int(u), int(e), int(n)) for u, e, n in zip(upto[last], leave[last], count[last])]


def _lines(gap_ms: int, slice_ms: int):
    @F.pandas_udf(LINES)
    def lines(times: pd.Series, slice_no: pd.Series) -> pd.Series:
        out = []
        for values, number in zip(times, slice_no):
            rows = _lines_of(np.asarray(values, dtype=np.int64), gap_ms, number * slice_ms + gap_ms)
            out.append([{"upto": u, "exit": e, "n": n} for u, e, n in rows])
        return pd.Series(out)

    return lines


def composed(tables: list[list[tuple[int, int, int]]], start: int) -> list[tuple[int, int, int]]:
    """One table that does what `tables` do one after another, for entries before `start`."""
    done: list[tuple[int, int, int]] = []
    for lines in tables:
        uptos = [line[0] for line in lines]
        joined = []
        for upto, leave, n in done:
            at = bisect_left(uptos, leave)  # the first line whose range holds the time left with
            if at < len(lines):
                leave, n = lines[at][1], n + lines[at][2]
            joined.append((upto, leave, n))
        # An entry above all lines so far has counted nothing and meets this table itself.
        joined += [line for line in lines if not done or line[0] > done[-1][0]]
        joined = joined[: bisect_left([line[0] for line in joined], start - 1) + 1]
        done = [a for a, b in zip(joined, [*joined[1:], None]) if b is None or a[1:] != b[1:]]
    return done


@F.pandas_udf(LINES)
def _composed(groups: pd.Series) -> pd.Series:
    out = []
    for parts in groups:
        tables = [[(r["upto"], r["exit"], r["n"]) for r in p["lines"]] for p in parts]
        out.append([{"upto": u, "exit": e, "n": n} for u, e, n in composed(tables, parts[0]["start"])])
    return pd.Series(out)


def counted_reads(
    reads: DataFrame,
    keys: list[str],
    ms: str = "ms",
    gap_ms: int = GAP_MS,
    slice_ms: int | None = None,
) -> DataFrame:
    """Number of counted reads per key, exact for any key size.

    The tables of neighbouring slices are composed in rounds, WAYS at a time, so no
    group holds more than WAYS tables however long the history of a key is.
    """
    slice_ms = slice_ms or 8 * gap_ms
    if slice_ms < gap_ms:
        raise ValueError("a slice is at least one gap long")
    slice_no = F.floor(F.col(ms) / F.lit(slice_ms)).cast("bigint").alias("__slice")
    slices = reads.groupBy(*keys, slice_no).agg(
        F.array_sort(F.collect_set(F.col(ms))).alias("__times")
    )
    solved = slices.select(
        *keys, "__slice", _lines(gap_ms, slice_ms)("__times", "__slice").alias("__lines")
    )
    # Written once: the span tells the number of rounds.
    solved = cut_lineage(solved)
    first, last = solved.agg(F.min("__slice"), F.max("__slice")).first()
    span = 0 if first is None else last - first
    solved = solved.select(
        *keys, (F.col("__slice") - F.lit(first or 0)).alias("__slice"), (F.col("__slice") * slice_ms).alias("__start"),
        "__lines",
    )
    while True:
        part = F.struct(F.col("__slice").alias("no"), F.col("__start").alias("start"), F.col("__lines").alias("lines"))
        group = F.floor(F.col("__slice") / WAYS).cast("bigint").alias("__slice")
        grouped = solved.groupBy(*keys, group).agg(F.array_sort(F.collect_list(part)).alias("__parts"))
        solved = grouped.select(
            *keys, "__slice", F.get("__parts", F.lit(0))["start"].alias("__start"), _composed("__parts").alias("__lines")
        )
        span //= WAYS
        if not span:
            break
    # Nothing counted before: the first line holds.
    return solved.select(*keys, F.coalesce(F.get("__lines", F.lit(0))["n"], F.lit(0)).cast("bigint").alias("num"))


def article_reads(
    reads: DataFrame, gap_ms: int = GAP_MS, article: str = "message_id", user: str = "uid"
) -> DataFrame:
    """Counted reads per article."""
    per_user = counted_reads(reads, [article, user], "ms", gap_ms)
    return per_user.groupBy(article).agg(F.sum("num").alias("num"))
