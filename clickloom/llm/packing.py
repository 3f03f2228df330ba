"""Best-fit packing of tokenised documents into sequences of a fixed length.

Lengths are all that matters for a packing, and there are no more of them than
a sequence has tokens. So the documents are counted by length, the packing is
made for the counts, and each document looks up its place by its length and its
number among those of that length. Pieces above a third of the capacity share a
sequence with one other at most: they are matched greedily, the largest with the
largest that fits. Smaller pieces go to the smallest gap that takes them.
"""

from __future__ import annotations

import json
import os
import re
import sys
from array import array
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import public_tokenizers
import pyarrow as pa
import tiktoken
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window
from tokenizers import Tokenizer

from clickloom.llm import batches
from clickloom.session import cut_lineage

CAPACITY = 2048
END = 0
WORDS_KEPT = 600_000  # words a worker remembers the ids of; then it starts anew
ROWS = 256

PIECES = "doc_id long, piece int, start long, length long, ids binary, part int, number long"

# Characters that every reading of the letter, digit and space classes agrees on.
_LETTERS = "A-Za-zÀ-ÖØ-öø-ÿ"
PLAIN = re.compile(f"[\\t\\n\\r!-~{_LETTERS}]+")
PARTS = r"'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


def _byte_of() -> dict[str, int]:
    """The byte each character of a byte-level token stands for: itself if it prints, else one from 256 on."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in shown]
    return {chr(b): b for b in shown} | {chr(256 + n): b for n, b in enumerate(hidden)}


def word_encoder(path: str) -> Callable[[str], list[int]] | None:
    """Ids of plain words by a merger that takes the ids for merge ranks; None for a tokenizer where they are not."""
    with open(path, encoding="utf-8") as file:
        held = json.load(file)
    model, splits = held["model"], held.get("pre_tokenizer") or {}
    usual = model["type"] == "BPE" and splits.get("type") == "ByteLevel" and splits.get("use_regex", True)
    if not usual or splits.get("add_prefix_space") or held.get("normalizer") or model.get("ignore_merges"):
        return None
    byte_of, added = _byte_of(), {t["content"] for t in held.get("added_tokens", [])}
    ranks = {bytes(byte_of[c] for c in t): n for t, n in model["vocab"].items() if t not in added}
    merged = ["".join(m.split(" ") if isinstance(m, str) else m) for m in model["merges"]]
    order = [model["vocab"][t] for t in merged]
    if order != sorted(set(order)) or len(ranks) != len(order) + 256:
        return None
    return tiktoken.Encoding("words", pat_str=PARTS, mergeable_ranks=ranks, special_tokens={}).encode_ordinary


class Encoder:
    """Token ids of whole texts as little-endian 32-bit numbers, as one plain call of the tokenizer gives them.

    Byte-level pairs are merged inside a word and the blank before it only, so each
    distinct word is encoded once. A text in which white space meets a blank, or which
    holds one of the tokenizer's added tokens, is encoded as one.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.tokenizer = Tokenizer.from_file(path)
        self.quick = word_encoder(path)
        self.known: dict[str, bytes] = {}
        # Each character of a byte-level token stands for one byte.
        vocabulary = self.tokenizer.get_vocab()
        self.lengths = np.zeros(max(vocabulary.values()) + 1, np.int64)
        for token, number in vocabulary.items():
            self.lengths[number] = len(token)
        added = self.tokenizer.get_added_tokens_decoder().values()
        blank = "".join(chr(i) for i in range(0x110000) if chr(i).isspace())
        apart = [re.escape(str(t.content)) for t in added if t.content]
        self.whole = re.compile("|".join([f"[{blank}] ", *apart]))

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of texts, each encoded as one."""
        found = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [np.array(x.ids, "<u4").tobytes() for x in found]

    def _learn(self, words: set[str]) -> None:
        """Ids of new words, each after a blank."""
        known, quick, plain, other = self.known, self.quick, PLAIN.fullmatch, []
        for word in words:
            if quick and plain(word):
                ids = array("I", quick(" " + word))
                if sys.byteorder == "big":
                    ids.byteswap()
                known[word] = ids.tobytes()
            else:
                other.append(word)
        known.update(zip(other, self.encode([" " + w for w in other]), strict=True))

    def ids(self, texts: list[str]) -> list[bytes]:
        """Ids of each text."""
        if len(self.known) > WORDS_KEPT:
            self.known = {}
        known, whole = self.known, self.whole.search
        firsts, rest = [], []
        for text in texts:
            first, *words = (text,) if whole(text) else text.split(" ")
            firsts.append(first)
            rest.append(words)
        missing = set().union(*rest).difference(known)
        if missing:
            self._learn(missing)
        held = [b"".join(map(known.__getitem__, words)) for words in rest]
        return [first + more for first, more in zip(self.encode(firsts), held, strict=True)]


@lru_cache(maxsize=2)
def encoder(path: str) -> Encoder:
    return Encoder(path)


def cut_lengths(totals: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(document, piece, start, length) of the pieces; only the first of a document may be below the capacity."""
    first = np.where(totals % capacity, totals % capacity, np.minimum(capacity, totals))
    number = 1 + (totals - first) // capacity
    doc = np.repeat(np.arange(len(totals)), number)
    piece = np.arange(len(doc)) - np.repeat(np.cumsum(number) - number, number)
    start = np.where(piece, first[doc] + (piece - 1) * capacity, 0)
    return doc, piece, start, np.where(piece, capacity, first[doc])


def _numbered(lengths: np.ndarray, seen: np.ndarray) -> np.ndarray:
    """Consecutive numbers of the pieces of each length, going on from `seen`, which is moved on."""
    order = np.argsort(lengths, kind="stable")
    fresh = np.concatenate(([True], np.diff(lengths[order]) != 0))
    begins = np.flatnonzero(fresh)
    rank = np.empty(len(lengths), np.int64)
    rank[order] = np.arange(len(lengths)) - begins[np.cumsum(fresh) - 1]
    number = rank + seen[lengths]
    seen += np.bincount(lengths, minlength=len(seen))
    return number


def tokenised(docs: DataFrame, doc_id: str, text: str, path: str, capacity: int) -> DataFrame:
    """Pieces with their ids, written once; `number` counts a part's pieces of equal length."""

    def run(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, seen = TaskContext.get().partitionId(), np.zeros(capacity + 1, np.int64)
        end = np.array([END], "<u4").tobytes()
        coder = encoder(path)
        for frame in frames:
            for at in range(0, frame.num_rows, ROWS):
                rows = frame.slice(at, ROWS)
                ids = coder.ids([t or "" for t in rows.column(1).to_pylist()])
                totals = np.fromiter(map(len, ids), np.int64, len(ids)) // 4 + 1
                doc, piece, start, length = cut_lengths(totals, capacity)
                # Pieces follow one another in one run of bytes.
                ends = np.concatenate(([0], np.cumsum(4 * length)))
                held = pa.LargeBinaryArray.from_buffers(
                    pa.large_binary(), len(length), [None, pa.py_buffer(ends), pa.py_buffer(end.join([*ids, b""]))]
                )
                columns = [
                    rows.column(0).take(pa.array(doc)), pa.array(piece, pa.int32()), pa.array(start),
                    pa.array(length), held.cast(pa.binary()), pa.array(np.full(len(doc), part), pa.int32()),
                    pa.array(_numbered(length, seen)),
                ]
                yield pa.RecordBatch.from_arrays(
                    columns, ["doc_id", "piece", "start", "length", "ids", "part", "number"]
                )

    batches.small(docs.sparkSession)
    narrow = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    return cut_lineage(narrow.mapInArrow(run, PIECES).withColumn("ids_crc32", F.crc32("ids")))


def plan(counts: dict[int, int], capacity: int) -> np.ndarray:
    """Rows (length, first number, first sequence, offset): where the pieces of a length go.

    The pieces of a length from a row's first number on, up to the next row's,
    go to consecutive sequences from its first sequence on, at its offset.
    """
    rows: list[tuple[int, int, int, int]] = []
    left, given, sequence = dict(counts), dict.fromkeys(counts, 0), 0
    gaps: dict[int, list[tuple[int, int]]] = {}  # room left -> (first sequence, number of them)

    def place(length: int, number: int, first: int, offset: int) -> None:
        rows.append((length, given[length], first, offset))
        given[length] += number
        left[length] -= number

    def leave(room: int, first: int, number: int) -> None:
        if room:
            gaps.setdefault(room, []).append((first, number))

    large = sorted((n for n in counts if 3 * n > capacity), reverse=True)
    for length in large:
        while left[length]:
            fits = [n for n in large if n + length <= capacity and left[n] - (n == length) > 0]
            if fits:
                other = max(fits)
                number = left[length] // 2 if other == length else min(left[length], left[other])
                place(length, number, sequence, 0)
                place(other, number, sequence, length)
                leave(capacity - length - other, sequence, number)
            else:
                number = left[length]
                place(length, number, sequence, 0)
                leave(capacity - length, sequence, number)
            sequence += number
    for length in sorted((n for n in counts if 3 * n <= capacity), reverse=True):
        while left[length]:
            room = min((r for r in gaps if r >= length), default=None)
            if room is None:  # new sequences, filled with as many of this length as fit
                number = -(-left[length] // (capacity // length))
                leave(capacity, sequence, number)
                sequence += number
                room = capacity
            first, number = gaps[room].pop()
            if not gaps[room]:
                del gaps[room]
            taken = min(number, left[length])
            place(length, taken, first, capacity - room)
            leave(room - length, first, taken)
            if taken < number:
                gaps.setdefault(room, []).append((first + taken, number - taken))
    return np.array(sorted(rows), np.int64).reshape(-1, 4)


def _dense(lengths: Column, capacity: int) -> Column:
    """The values of a map from lengths as an array with a place for each length."""
    every = F.sequence(F.lit(0).cast("long"), F.lit(capacity).cast("long"))
    return F.transform(every, lambda n: F.coalesce(F.try_element_at(lengths, n), F.lit(0).cast("long")))


def pack(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    path: str | None = None,
    capacity: int = CAPACITY,
) -> DataFrame:
    """(doc_id, piece, start, length, ids, ids_crc32, sequence_id, offset) of every piece.

    A document is its token ids and an end token; null text is empty, so it is
    the end token alone. Documents above the capacity are cut into full pieces but
    for the first. Repeated rows are packed each. Other columns are left out; an
    empty table gives an empty result. `ids` are little-endian 32-bit numbers. Strings
    that the tokenizer has as added tokens become these tokens, as in a plain call.
    A text is read whole, however long, and costs memory in proportion to its length.
    """
    path = path or public_tokenizers.path("byte_bpe_50k.json")
    pieces = tokenised(docs, doc_id, text, path, capacity)
    counts = pieces.groupBy("part", "length").agg(F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    counts = cut_lineage(counts.withColumn("before", F.coalesce(F.sum("n").over(before), F.lit(0))))
    # One row for each part of the input: how many pieces of each length the parts before it have.
    earlier = counts.groupBy("part").agg(F.map_from_entries(F.collect_list(F.struct("length", "before"))).alias("m"))
    earlier = cut_lineage(earlier.select("part", _dense(F.col("m"), capacity).alias("before")))
    # One row for each length, so never more rows than a sequence has tokens.
    totals = {r.length: r.n for r in counts.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    table = plan(totals, capacity)
    shift = max(totals.values(), default=0).bit_length() + 1
    keys = (table[:, 0] << shift) + table[:, 1]

    @F.pandas_udf("sequence_id long, offset long")
    def place(length: pd.Series, number: pd.Series) -> pd.DataFrame:
        at = np.searchsorted(keys, (length.to_numpy() << shift) + number.to_numpy(), "right") - 1
        return pd.DataFrame(
            {"sequence_id": table[at, 2] + number.to_numpy() - table[at, 1], "offset": table[at, 3]}
        )

    numbered = pieces.join(earlier, "part")
    overall = F.col("number") + F.get("before", F.col("length").cast("int"))
    placed = numbered.withColumn("__at", place("length", overall))
    return placed.select(
        "doc_id", "piece", "start", "length", "ids", "ids_crc32", "__at.sequence_id", "__at.offset"
    )
