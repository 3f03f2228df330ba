"""Vectorised features of texts: words, shapes and character n-grams as hashed numbers.

All texts of a piece are joined into one array of code points. A hash of any
span then is one subtraction of prefix sums, so no Python runs per word.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np

PIECE = 1 << 18  # characters handled at once: bounds the memory of a task
BASE = np.uint64(0x9E3779B97F4A7C15 | 1)
MIX = np.uint64(0xFF51AFD7ED558CCD)


def pieces(texts: list[str | None], limit: int = PIECE) -> Iterator[tuple[np.ndarray, list[str]]]:
    """(rows, texts) in runs of about `limit` characters.

    A text above the limit is cut at white space into several entries of its
    row; its features are sums, so all of it counts (an n-gram over the cut does not).
    """
    rows, taken, size = [], [], 0
    for row, text in enumerate(texts):
        text = text or ""
        at = 0
        while True:
            end = len(text)
            if end - at > limit:
                cut = max(text.rfind(" ", at + 1, at + limit), text.rfind("\n", at + 1, at + limit))
                end = cut if cut > at else at + limit
            if size + end - at > limit and taken:
                yield np.array(rows), taken
                rows, taken, size = [], [], 0
            rows.append(row)
            taken.append(text[at:end])
            size += end - at + 1
            at = end
            if at >= len(text):
                break
    if taken:
        yield np.array(rows), taken


@lru_cache(maxsize=1)
def _powers(size: int) -> tuple[np.ndarray, np.ndarray]:
    inverse = np.uint64(pow(int(BASE), -1, 1 << 64))
    ones = np.ones(size, np.uint64)
    with np.errstate(over="ignore"):
        up, down = ones * BASE, ones * inverse
        up[0] = down[0] = 1
        return np.multiply.accumulate(up), np.multiply.accumulate(down)


@lru_cache(maxsize=1)
def letters() -> np.ndarray:
    """For each code point whether it is a letter."""
    return np.fromiter((chr(i).isalpha() for i in range(0x110000)), bool, 0x110000)


def mixed(h: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        h = h ^ (h >> np.uint64(33))
        h = h * MIX
        return h ^ (h >> np.uint64(29))


class Stream:
    """The code points of several texts, one white space between and around them."""

    def __init__(self, texts: list[str]):
        joined = "\n" + "\n".join(texts) + "\n"
        self.codes = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32)
        lengths = np.fromiter(map(len, texts), np.int64, len(texts))
        self.starts = np.cumsum(np.concatenate(([1], lengths + 1)))  # of texts, one more at the end
        self.texts = len(texts)

    def text_of(self, places: np.ndarray) -> np.ndarray:
        """For rising places the number of the text that holds them."""
        return np.searchsorted(self.starts, places, "right") - 1


def white(codes: np.ndarray) -> np.ndarray:
    return (codes == 32) | ((codes >= 9) & (codes <= 13))


class Hashes:
    """Hashes of spans of an array of numbers."""

    def __init__(self, values: np.ndarray):
        size = 1 << max(19, int(len(values)).bit_length())
        up, self.down = _powers(size)
        with np.errstate(over="ignore"):
            sums = np.cumsum((values.astype(np.uint64) + np.uint64(1)) * up[: len(values)])
        self.sums = np.concatenate((np.zeros(1, np.uint64), sums))

    def spans(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        with np.errstate(over="ignore"):
            return (self.sums[ends] - self.sums[starts]) * self.down[starts]


def word_spans(blank: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the runs between blanks; the array begins and ends with a blank."""
    edges = np.flatnonzero(blank[1:] != blank[:-1]) + 1
    return edges[::2], edges[1::2]


def buckets(h: np.ndarray, salt: int, bits: int) -> np.ndarray:
    with np.errstate(over="ignore"):
        salted = mixed(h + np.uint64(salt) * BASE)
    return (salted >> np.uint64(64 - bits)).astype(np.int64)


def character_ngrams(
    codes: np.ndarray, blank: np.ndarray, orders: tuple[int, ...], bits: int
) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(places, buckets) of the n-grams inside words, the blanks at a word's ends included."""
    hashes = Hashes(np.where(blank, np.uint32(32), codes))
    blanks = np.concatenate(([0], np.cumsum(blank)))
    for n in orders:
        if len(codes) < n:
            continue
        first = np.arange(len(codes) - n + 1)
        inner = blanks[n - 1 : len(codes)] - blanks[1 : len(codes) - n + 2]
        both = blank[: len(codes) - n + 1] & blank[n - 1 :] if n == 2 else False
        at = first[(inner == 0) & ~both] if n == 2 else first[inner == 0]
        yield at, buckets(hashes.spans(at, at + n), n, bits)


def sums_by(groups: np.ndarray, values: np.ndarray, size: int) -> np.ndarray:
    """Column sums of `values` for each group number below `size`."""
    if values.ndim == 1:
        return np.bincount(groups, values, size)
    return np.stack([np.bincount(groups, v, size) for v in values.T], 1)
