"""Periodic runs of words: stretches that repeat a block of words several times over.

The words of a text are appended one by one to a suffix automaton. Its link tree
is held as a link-cut forest whose paths carry the place where their substrings
last ended: an access from the newest prefix recolours the path to the root, and
every piece of path it passes names an earlier end `j` of all suffixes within a
range of lengths. Where the distance from `j` to the new end lies in that range,
two copies of a block meet: a square, with no occurrence of the block between the
two, so the block itself repeats nothing and the distance is the smallest period.
The square is then extended to both sides as far as the period holds.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clickloom.llm import batches

LEAST, EXPONENT = 6, 4


class Automaton:
    """Suffix automaton of a growing word sequence over a link-cut forest of its link tree.

    State 1 is the empty string, 0 is none. `up` is the parent inside a splay tree
    or, at its root, the state the path hangs on; the colour of a path is held at
    the root of its splay tree.
    """

    def __init__(self):
        self.next: list[dict[int, int]] = [{}, {}]
        self.length, self.link = [0, 0], [0, 0]
        self.left, self.right, self.up, self.colour = [0, 0], [0, 0], [0, 0], [-1, -1]
        self.last, self.size = 1, 0

    def _state(self, length: int, link: int, colour: int, moves: dict[int, int]) -> int:
        self.next.append(moves)
        self.length.append(length)
        self.link.append(link)
        self.left.append(0)
        self.right.append(0)
        self.up.append(link)
        self.colour.append(colour)
        return len(self.length) - 1

    def _splay(self, x: int) -> None:
        left, right, up = self.left, self.right, self.up
        above = []  # from x to the root of its splay tree
        y = x
        while (p := up[y]) and (left[p] == y or right[p] == y):
            above.append(p)
            y = p
        if not above:
            return
        colour = self.colour[y]

        def rotate(x: int, p: int) -> None:
            g = up[p]
            if left[p] == x:
                b = left[p] = right[x]
                right[x] = p
            else:
                b = right[p] = left[x]
                left[x] = p
            if b:
                up[b] = p
            if left[g] == p and g:
                left[g] = x
            elif right[g] == p and g:
                right[g] = x
            up[p], up[x] = x, g

        at = 0
        while at < len(above):
            p = above[at]
            if at + 1 < len(above):
                g = above[at + 1]
                if (left[g] == p) == (left[p] == x):
                    rotate(p, g)
                    rotate(x, p)
                else:
                    rotate(x, p)
                    rotate(x, g)
            else:
                rotate(x, p)
            at += 2
        self.colour[x] = colour

    def _insert_above(self, q: int, clone: int) -> None:
        """Hang q below its new parent, which takes q's old place."""
        self._splay(q)
        shallower = self.left[q]
        if shallower:
            self.left[q] = 0
            self.up[shallower] = self.up[q]
            self.colour[shallower] = self.colour[q]
        self.up[q] = clone
        self.colour[clone] = self.colour[q]

    def append(self, word: int) -> Iterator[tuple[int, int, int]]:
        """(earlier end, shortest length - 1, longest length) of suffixes seen before, longest first."""
        step, length, link = self.next, self.length, self.link
        end = self.size
        self.size += 1
        p = self.last
        new = self._state(length[p] + 1, 0, -1, {})
        while p and word not in step[p]:
            step[p][word] = new
            p = link[p]
        if not p:
            parent = 1
        else:
            q = step[p][word]
            if length[q] == length[p] + 1:
                parent = q
            else:
                parent = self._state(length[p] + 1, link[q], -1, dict(step[q]))
                self._insert_above(q, parent)
                link[q] = parent
                while p and step[p].get(word) == q:
                    step[p][word] = parent
                    p = link[p]
        link[new] = self.up[new] = parent
        self.last = new
        return self._access(new, end)

    def _access(self, new: int, end: int) -> list[tuple[int, int, int]]:
        right, up, colour, length = self.right, self.up, self.colour, self.length
        passed: list[tuple[int, int]] = []
        below, x = new, up[new]
        while x:
            self._splay(x)
            passed.append((colour[x], length[x]))
            if right[x]:
                colour[right[x]] = colour[x]
            right[x] = below
            below, x = x, up[x]
        self._splay(new)
        colour[new] = end
        lows = [n for _, n in passed[1:]] + [0]
        return [(c, low, high) for (c, high), low in zip(passed, lows, strict=True) if c >= 0]


def _runs_within(words: list[int], least: int, exponent: int) -> list[tuple[int, int, int]]:
    """(start, length, period) of the runs of a stretch, through its automaton."""
    found, reached = [], {}
    automaton, n = Automaton(), len(words)
    for end, word in enumerate(words):
        for earlier, low, high in automaton.append(word):
            period = end - earlier
            if not low < period <= high or exponent * period > n or reached.get(period, -1) >= end:
                continue
            last, first = end, end - 2 * period + 1
            while last + 1 < n and words[last + 1] == words[last + 1 - period]:
                last += 1
            while first > 0 and words[first - 1] == words[first - 1 + period]:
                first -= 1
            reached[period] = last
            if last - first + 1 >= max(least, exponent * period):
                found.append((first, last - first + 1, period))
    return found


def _stretches(ids: np.ndarray, least: int, exponent: int) -> Iterator[tuple[int, int]]:
    """(start, end) of the stretches that can hold runs; none is cut.

    Three words in a row that lie in a run of period q and `exponent` * q words or
    more come again in it, so they stand in it exponent - 1 times at least (least -
    2 times for q = 1). A stretch is where that holds for every three words; it is
    counted anew inside the stretches until nothing changes.
    """
    if len(ids) < max(least, exponent):
        return
    if max(least, exponent) < 3:
        yield 0, len(ids)
        return
    times = min(exponent - 1, max(least, exponent) - 2)
    _, pair = np.unique(ids[:-1] * (ids.max() + 1) + ids[1:], return_inverse=True)
    _, three = np.unique(pair[:-1] * np.int64(len(ids)) + ids[2:], return_inverse=True)
    at, group = np.arange(len(three)), np.zeros(len(three), np.int64)
    while len(at):
        _, inverse, count = np.unique(group * np.int64(len(ids)) + three[at], return_inverse=True, return_counts=True)
        held = at[count[inverse] >= times]
        new = np.concatenate(([0], np.cumsum(np.diff(held) != 1)))[: len(held)]
        sizes = np.bincount(new, minlength=1) if len(held) else np.zeros(0, np.int64)
        long = sizes[new] >= max(least, exponent) - 2 if len(held) else np.zeros(0, bool)
        held, new = held[long], new[long]
        same = len(held) == len(at)
        at, group = held, new
        if same:
            break
    if len(at):
        starts = at[np.concatenate(([True], np.diff(at) != 1))]
        ends = at[np.concatenate((np.diff(at) != 1, [True]))] + 3
        yield from zip(starts.tolist(), ends.tolist(), strict=True)


def runs(words: list, least: int = LEAST, exponent: int = EXPONENT) -> list[tuple[int, int, int]]:
    """(start, length, period) of every run of `words` by start, then period.

    A run is a stretch of smallest period q and at least max(least, exponent * q)
    words which no neighbour extends; `exponent` is at least 2.
    """
    if exponent < 2:
        raise ValueError("a run holds its block twice at least")
    numbers: dict = {}
    ids = np.array([numbers.setdefault(w, len(numbers)) for w in words], np.int64)
    found = []
    for start, end in _stretches(ids, least, exponent):
        inner = _runs_within(ids[start:end].tolist(), least, exponent)
        found.extend((start + first, length, period) for first, length, period in inner)
    return sorted(found, key=lambda r: (r[0], r[2]))


def _collapsed(words: list[bytes], found: list[tuple[int, int, int]]) -> bytes:
    """The words that no run holds after its first block, one space between them."""
    if not found:
        return b" ".join(words)
    dropped = np.zeros(len(words) + 1, np.int64)
    for start, length, period in found:
        dropped[start + period] += 1
        dropped[start + length] -= 1
    kept = np.flatnonzero(np.cumsum(dropped)[:-1] == 0)
    return b" ".join([words[i] for i in kept.tolist()])


def find_runs(
    docs: DataFrame, text: str = "text", least: int = LEAST, exponent: int = EXPONENT,
    runs_name: str = "runs", collapsed_name: str = "collapsed",
) -> DataFrame:
    """Add every run of a text's words, and the text with each run cut to its first block.

    `runs` is an array of (start, length, period) by start, then period, counted in
    words (parted by ASCII white space); `collapsed` joins the kept words by one
    space. Null and empty texts have no run and collapse to the empty text. Rows
    are handled one by one, so ties, repeated rows and other columns change nothing;
    the two names replace columns of the input that bear them. A text of any length
    is read whole: a row costs memory in proportion to its words, about 0.5 kB for
    each word of a stretch that may be periodic. An empty table gives an empty one.
    Python workers are handed fewer rows at once from then on (`batches.small`).
    """

    @F.pandas_udf("runs array<struct<start: long, length: long, period: long>>, collapsed string")
    def find(series: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for batch in series:
            held, texts = [], []
            for value in batch:
                words = (value or "").encode("utf-8", "surrogatepass").split()
                found = runs(words, least, exponent)
                held.append([{"start": s, "length": n, "period": p} for s, n, p in found])
                texts.append(_collapsed(words, found).decode("utf-8", "surrogatepass"))
            yield pd.DataFrame({"runs": held, "collapsed": texts})

    batches.small(docs.sparkSession)
    found = docs.withColumn("__periodic", find(F.col(text)))
    return found.withColumns(
        {runs_name: F.col("__periodic.runs"), collapsed_name: F.col("__periodic.collapsed")}
    ).drop("__periodic")


def longest(runs_column: Column) -> Column:
    """The run of greatest length; of equal ones that of smallest start, then period; null without runs."""
    keyed = F.transform(
        runs_column, lambda r: F.struct((-r.length).alias("n"), r.start.alias("start"), r.period.alias("period"))
    )
    return F.array_min(keyed)


def runs_text(runs_column: Column) -> Column:
    """A line `start,length,period` for each run."""
    lines = F.transform(runs_column, lambda r: F.concat_ws(",", r.start, r.length, r.period))
    return F.concat(F.array_join(lines, "\n"), F.when(F.size(runs_column) > 0, "\n").otherwise(""))


def repeated(text: str | None, doc_id: str | None) -> str | None:
    """The text of one id in ten with a part of its words said again to the end; other texts as they are.

    With h the checksum of the id and g = h // 10, words from a = g % n on become a
    block of 1 + (n - a) // (3 + g % 8) words over and over. No id changes nothing.
    """
    if doc_id is None or text is None or (h := zlib.crc32(doc_id.encode())) % 10:
        return text
    words = text.encode("utf-8", "surrogatepass").split()
    n, g = len(words), h // 10
    if n:
        a = g % n
        block = words[a : a + 1 + (n - a) // (3 + g % 8)]
        times = -(-(n - a) // len(block))
        words = [*words[:a], *(block * times)[: n - a]]
    return b" ".join(words).decode("utf-8", "surrogatepass")


def with_planted_repeats(text: Column, doc_id: Column) -> Column:
    """`repeated` of each row."""

    @F.pandas_udf("string")
    def run(texts: pd.Series, ids: pd.Series) -> pd.Series:
        return pd.Series([repeated(t, i) for t, i in zip(texts, ids, strict=True)], dtype=object)

    return run(text, doc_id.cast("string"))
