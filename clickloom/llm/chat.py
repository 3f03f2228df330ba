"""Chat formatting with a loss mask aligned to token offsets.

A conversation is rendered as one text, its turns marked by control strings, and
encoded once with offsets: byte-level tokens follow each other, so their lengths give
them. The spans of the assistant's texts and those of the tokens are both sorted, so a
binary search tells which tokens the loss falls on.
Control strings inside texts are escaped by one backslash more, which can be undone.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import public_tokenizers
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickloom.llm import batches, packing

BEGIN, FINISH = "<|im_start|>", "<|im_end|>"
LEARNED = "assistant"
_PLAIN = re.compile(r"<(\\*)\|")
_ESCAPED = re.compile(r"<\\(\\*)\|")
_TURN = re.compile(re.escape(BEGIN) + r"([^\n]*)\n(.*?)" + re.escape(FINISH) + "\n", re.DOTALL)

FORMATTED = (
    "formatted string, ids array<int>, loss array<boolean>, loss_starts array<int>, loss_ends array<int>"
)


def escape(text: str) -> str:
    """No control string is left: each "<", backslashes, "|" gets one backslash more."""
    return _PLAIN.sub(r"<\\\1|", text)


def unescape(text: str) -> str:
    return _ESCAPED.sub(r"<\1|", text)


def _role(role: str) -> str:
    return escape(role.replace("\\", "\\\\").replace("\n", "\\n"))


def _role_back(role: str) -> str:
    return re.sub(r"\\(.)", lambda m: "\n" if m[1] == "n" else m[1], unescape(role))


def render(turns: list[tuple[str | None, str | None]]) -> tuple[str, list[tuple[int, int]]]:
    """The formatted text and the spans of the assistant's texts in it."""
    out, at, spans = [], 0, []
    for role, text in turns:
        head, body = f"{BEGIN}{_role(role or '')}\n", escape(text or "")
        if role == LEARNED and body:
            spans.append((at + len(head), at + len(head) + len(body)))
        out.append(f"{head}{body}{FINISH}\n")
        at += len(out[-1])
    return "".join(out), spans


def parse(formatted: str) -> list[tuple[str, str]]:
    """The turns back from a formatted text; null role and text come back as empty."""
    return [(_role_back(r), unescape(t)) for r, t in _TURN.findall(formatted)]


def loss_mask(offsets: np.ndarray, spans: list[tuple[int, int]]) -> tuple[np.ndarray, np.ndarray]:
    """(mask of tokens, their spans cut to the turn's): offsets and spans both rise.

    A token that reaches over a turn's edge is learned, its characters outside are
    not counted. A character of several tokens is in the span of each of them.
    """
    mask = np.zeros(len(offsets), bool)
    cut: list[np.ndarray] = []
    begins, ends = offsets[:, 0], offsets[:, 1]
    for begin, end in spans:
        first = np.searchsorted(ends, begin, "right")
        last = np.searchsorted(begins, end, "left")
        mask[first:last] = True
        cut.append(np.clip(offsets[first:last], begin, end))
    return mask, np.concatenate(cut) if cut else np.zeros((0, 2), np.int64)


def _merged(spans: np.ndarray) -> np.ndarray:
    """Spans that touch or overlap become one."""
    if not len(spans):
        return spans
    reach = np.maximum.accumulate(spans[:, 1])
    new = np.concatenate(([True], spans[1:, 0] > reach[:-1]))
    last = np.append(np.flatnonzero(new)[1:] - 1, len(spans) - 1)
    return np.stack([spans[new, 0], reach[last]], 1)


def token_offsets(text: str, lengths: np.ndarray) -> np.ndarray:
    """(begin, end) in characters of tokens of `lengths` bytes that follow each other in the text.

    A token with a part of a character has the whole character in its span.
    """
    ends = np.cumsum(lengths)
    begins = ends - lengths
    if not text.isascii():
        codes = np.frombuffer(text.encode("utf-32-le"), np.uint32)
        sizes = 1 + (codes >= 0x80).astype(np.int64) + (codes >= 0x800) + (codes >= 0x10000)
        edges = np.concatenate(([0], np.cumsum(sizes)))
        begins, ends = np.searchsorted(edges, begins, "right") - 1, np.searchsorted(edges, ends, "left")
    return np.stack([begins, ends], 1)


@dataclass(frozen=True)
class Formatted:
    text: str
    ids: np.ndarray
    mask: np.ndarray
    spans: np.ndarray


def format_one(turns: list[tuple[str | None, str | None]], path: str) -> Formatted:
    text, spans = render(turns)
    coder = packing.encoder(path)
    ids = np.frombuffer(coder.ids([text])[0], "<u4")
    offsets = token_offsets(text, coder.lengths[ids])
    mask, cut = loss_mask(offsets, spans)
    return Formatted(text, ids.astype(np.int32), mask, _merged(cut))


def format_conversations(
    rows: DataFrame,
    conv_id: str = "conv_id",
    turn: str = "turn",
    role: str = "role",
    text: str = "text",
    path: str | None = None,
) -> DataFrame:
    """(conv_id, formatted, ids, loss, loss_starts, loss_ends), a row for each conversation.

    Turns go by number; equal numbers by role and text, a null number first, and
    rows with a null conv_id are one conversation. Null role and text are empty.
    Repeated rows are turns of their own. `loss` marks tokens; the spans are the
    characters under the mask, cut to the assistant's texts. Other columns are left
    out. A conversation is one value of the result, so it is put together in one
    task, however long; many conversations never are.
    """
    path = path or public_tokenizers.path("byte_bpe_50k.json")
    fields = F.struct(
        F.col(turn).alias("turn"), F.coalesce(F.col(role), F.lit("")).alias("role"),
        F.coalesce(F.col(text), F.lit("")).alias("text"),
    )
    batches.small(rows.sparkSession)
    whole = rows.groupBy(F.col(conv_id).alias("conv_id")).agg(F.sort_array(F.collect_list(fields)).alias("turns"))

    @F.pandas_udf(FORMATTED)
    def run(series: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for batch in series:
            out = []
            for turns in batch:
                f = format_one([(t["role"], t["text"]) for t in turns], path)
                out.append((f.text, f.ids, f.mask, f.spans[:, 0], f.spans[:, 1]))
            yield pd.DataFrame(out, columns=["formatted", "ids", "loss", "loss_starts", "loss_ends"])

    return whole.withColumn("__f", run("turns")).select("conv_id", "__f.*")


DIGEST = "n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"


def read_back(formatted: DataFrame) -> DataFrame:
    """Digests of the formatted conversations, from the text and the loss spans alone."""
    from hashlib import sha256

    def sha(text: str) -> str:
        return sha256(text.encode("utf-8", "surrogatepass")).hexdigest()

    @F.pandas_udf(DIGEST)
    def run(batches: Iterator[tuple[pd.Series, pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
        for texts, starts, ends in batches:
            out = []
            for text, begin, end in zip(texts, starts, ends, strict=True):
                turns = parse(text)
                learned = "".join(unescape(text[a:b]) for a, b in zip(begin, end, strict=True))
                out.append((len(turns), sha("".join(f"{r}\n{t}\n" for r, t in turns)),
                            len(learned), sha(learned), len(text)))
            yield pd.DataFrame(out, columns=["n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"])

    return formatted.withColumn("__d", run("formatted", "loss_starts", "loss_ends")).select("conv_id", "__d.*")
