"""Spelling variants: words one code point apart, found through PartEnum signatures.

A word's letters with their repeats are a binary vector: the k-th occurrence of a
letter is a dimension. One inserted, deleted or replaced code point changes at most
two of them, so near words have vectors within Hamming distance two. PartEnum cuts
the dimensions into PARTS parts and enumerates every choice of PARTS - 2 of them: two
such vectors agree in all parts of one choice at least, so an equi-join of these exact
signatures misses no pair. One edit also leaves the first three or the last three of a
word's code points as they are, which goes into the join key. Candidates are then
verified by their edit distance.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Callable, Iterable, Iterator
from functools import lru_cache
from itertools import combinations

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickloom.llm import batches
from clickloom.session import cut_lineage

DISTANCE = 2
PARTS = 5
AFFIX = 3
LEAST_LENGTH, LEAST_COUNT, RATIO = 6, 5, 5
HELD = 200_000  # distinct words a task counts before it hands them on


def count_words(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    least_length: int = LEAST_LENGTH,
    edit: Callable[[str | None, Counter], Iterable[tuple[str, int]]] | None = None,
) -> DataFrame:
    """(word, n) of the maximal runs of Latin letters of whole texts, A-Z as a-z, over all rows.

    Only words of `least_length` code points and more are counted; null texts have
    none. `edit` maps (id as text, counts of a text's words) to the words and counts
    to take in their place. Repeated rows count again, and a null id is None. Each task
    sums its words before the shuffle.
    """
    # A run below the least length can't reach it by an edit that only shortens.
    pattern = re.compile(f"[A-Za-zÀ-ÿ]{{{least_length},}}")

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total: Counter = Counter()
        for frame in frames:
            for key, value in zip(frame["doc_id"].tolist(), frame["text"], strict=True):
                if not value:
                    continue
                lower = value.encode("utf-8", "surrogatepass").lower().decode("utf-8", "surrogatepass")
                words = pattern.findall(lower)
                if edit is None:
                    total.update(words)
                else:
                    for word, n in edit(key, Counter(words)):
                        if len(word) >= least_length:
                            total[word] += n
                if len(total) > HELD:
                    yield pd.DataFrame({"word": list(total), "n": list(total.values())})
                    total = Counter()
        if total:
            yield pd.DataFrame({"word": list(total), "n": list(total.values())})

    batches.small(docs.sparkSession)
    # An id goes as text: as a number a null would make all ids of a batch inexact.
    narrow = docs.select(F.col(doc_id).cast("string").alias("doc_id"), F.col(text).alias("text"))
    return narrow.mapInPandas(run, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))


@lru_cache(maxsize=1 << 16)
def _part(letter: str, occurrence: int, parts: int) -> int:
    return xxhash.xxh64_intdigest(f"{occurrence}{letter}".encode("utf-8", "surrogatepass")) % parts


def signatures(word: str, parts: int = PARTS, distance: int = DISTANCE) -> list[str]:
    """For each choice of parts - distance parts, the dimensions of the word's vector in them."""
    cells: list[list[str]] = [[] for _ in range(parts)]
    before = ""
    occurrence = 0
    for letter in sorted(word):
        occurrence = occurrence + 1 if letter == before else 0
        before = letter
        cells[_part(letter, occurrence, parts)].append(letter)
    held = ["".join(c) for c in cells]
    return ["\0".join(held[p] for p in chosen) for chosen in combinations(range(parts), parts - distance)]


def keys(word: str, parts: int = PARTS) -> list[int]:
    """Join keys of a word of AFFIX + 1 code points or more: signature with first and with last code points."""
    found = []
    for number, signature in enumerate(signatures(word, parts)):
        for side, affix in enumerate((word[:AFFIX], word[-AFFIX:])):
            joined = f"{number}\0{side}\0{affix}\0{signature}".encode("utf-8", "surrogatepass")
            found.append(xxhash.xxh64_intdigest(joined))
    return found


def near_pairs(words: DataFrame) -> DataFrame:
    """(a, b) with a < b for all words one inserted, deleted or replaced code point apart.

    `words` holds distinct non-null words of 2 * AFFIX code points or more.
    """

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            held = [keys(w) for w in frame["word"]]
            number = len(held[0]) if held else 0
            yield pd.DataFrame(
                {
                    "key": np.array(held, np.uint64).reshape(-1).view(np.int64),
                    "word": np.repeat(frame["word"].to_numpy(), number),
                }
            )

    batches.small(words.sparkSession)
    signed = cut_lineage(words.select("word").repartition("word").mapInPandas(run, "key long, word string"))
    left = signed.withColumnRenamed("word", "a")
    right = signed.withColumnRenamed("word", "b")
    met = left.join(right, "key").where(F.col("a") < F.col("b"))
    # Lengths part most candidates before the edit distance is worked out.
    met = met.where(F.abs(F.length("a") - F.length("b")) <= 1)
    return met.where(F.levenshtein("a", "b", 1) == 1).select("a", "b").distinct()


def variants(counts: DataFrame, least_count: int = LEAST_COUNT, ratio: int = RATIO) -> DataFrame:
    """(word, form, root, n, n_near, form_n) of every word of `counts` (word, n) with n >= least_count.

    The form of a word is its near word of largest n (of equal ones the smallest in
    code-point order) if that n is `ratio` times its own or more, else null; the
    root is where following forms ends. Words are at least 2 * AFFIX code points
    long. Words that are repeated in `counts` are summed; null words are left out.
    An empty table gives an empty one.
    """
    summed = counts.where("word IS NOT NULL").groupBy("word").agg(F.sum("n").alias("n"))
    words = cut_lineage(summed.where(F.col("n") >= least_count))
    pairs = cut_lineage(near_pairs(words))
    both = pairs.unionByName(pairs.select(F.col("b").alias("a"), F.col("a").alias("b")))
    known = words.select(F.col("word").alias("b"), F.col("n").alias("near_n"))
    best = both.join(known, "b").groupBy("a").agg(
        F.count(F.lit(1)).alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("n"), "b")).alias("best")
    )
    formed = words.join(best.withColumnRenamed("a", "word"), "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(-F.col("best.n") >= ratio * F.col("n"), F.col("best.b")).alias("form"),
        F.when(-F.col("best.n") >= ratio * F.col("n"), -F.col("best.n")).cast("long").alias("form_n"),
    )
    formed = cut_lineage(formed)
    rooted = roots(formed.where("form IS NOT NULL").select("word", F.col("form").alias("root")))
    found = formed.join(rooted, "word", "left")
    return found.select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def roots(steps: DataFrame) -> DataFrame:
    """(word, root): the end of each chain of `steps` (word, root), which hold no circle.

    Each round doubles the length of the step, so the rounds grow with the logarithm
    of the longest chain, and a chain of forms is as long as the logarithm of a count.
    """
    while True:
        further = steps.select(F.col("word").alias("root"), F.col("root").alias("__next"))
        joined = cut_lineage(steps.join(further, "root", "left").select("word", "root", "__next"))
        steps = joined.select("word", F.coalesce("__next", "root").alias("root"))
        if joined.where("__next IS NOT NULL").isEmpty():
            return steps


def with_slips(doc_id: str | None, counts: Counter) -> Iterator[tuple[str, int]]:
    """The words of a text, one in 199 of them without one code point.

    With h the checksum of `id:word`, a word is changed where 199 divides h: it
    loses the code point at h % length. Without an id none is changed.
    """
    if doc_id is None:
        yield from counts.items()
        return
    before = zlib.crc32(f"{doc_id}:".encode())
    for word, n in counts.items():
        h = zlib.crc32(word.encode("utf-8", "surrogatepass"), before)
        if h % 199 == 0:
            at = h % len(word)
            word = word[:at] + word[at + 1 :]
        yield word, n
