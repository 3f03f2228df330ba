"""Main text of web pages by a linear-chain conditional random field over leaf blocks.

A page is cut into leaf blocks: runs of text that no block-level tag interrupts.
Each block gets features of its ancestors (tags and the words of their classes,
ids and roles) and of its text; the field labels the chain of blocks of a page as
main text or not, and Viterbi's algorithm finds the best labels. The field is
trained in numpy on labelled pages, made from a page grammar with a fixed seed.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickloom.llm import batches
from clickloom.llm.pages import labelled_pages

BITS = 14
# Elements that begin and end a block of text; all others are part of their line.
BLOCK = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset "
    "figcaption figure footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav "
    "ol option optgroup p pre search section select summary table tbody td tfoot th thead tr ul".split()
)
# Elements without content, those whose content is characters up to the end tag, or to the end of the page,
# and those whose content is no text of the page up to their own end tag; without one they are like any other.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title iframe".split())
APART = frozenset("template svg".split())
# Their content stands for what a reader of the text alone does not get.
FALLBACK = frozenset("object canvas noscript".split())
# An opening tag of the second kind ends an open element of the first, up to the nearest container.
ENDED_BY = {
    "p": BLOCK - {"body", "html", "option", "optgroup"},
    "li": frozenset(["li"]), "dt": frozenset(["dt", "dd"]), "dd": frozenset(["dt", "dd"]),
    "tr": frozenset(["tr", "tbody", "tfoot"]), "td": frozenset(["td", "th", "tr", "tbody", "tfoot"]),
    "th": frozenset(["td", "th", "tr", "tbody", "tfoot"]), "option": frozenset(["option", "optgroup"]),
    "head": frozenset(["body"]),
}

_TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)|</?[a-zA-Z](?:[^>\"']|\"[^\"]*(?:\"|\Z)|'[^']*(?:'|\Z))*(?:>|\Z)", re.DOTALL)
_NAME = re.compile(r"</?([a-zA-Z][^\s/>]*)")
# One attribute: its whole name, then its value, so that no part of another name or value counts.
_ATTRIBUTE = re.compile(r"""([^\s/>=][^\s/>=]*)(?:\s*=\s*("[^"]*"?|'[^']*'?|[^\s>]*))?""")
_TELLING = frozenset("class id role itemprop aria-label".split())
_PART = re.compile(r"[a-z]+")
_HIDDEN = re.compile(r"(?:\A|;)\s*(?:display\s*:\s*none|visibility\s*:\s*hidden)\b")
HIDING = "!hidden"  # the mark of a hidden element among its words; it decides nothing by itself
_SPACE = re.compile(r"\s+")
# A slash at a tag's end closes elements of drawings and formulas only.
FOREIGN = frozenset("math svg".split())
NEAR = 48  # ancestors that features are taken from, the nearest; equal ones that follow each other are one


@dataclass
class Block:
    path: tuple  # of (tag, words of class, id and role) of the nearest ancestors, from above down
    text: str
    linked: int = 0  # characters inside links


@dataclass
class _Open:
    tag: str
    path: tuple


def _ends(tag: str, page: str) -> dict[int, int]:
    """Where the content of each closed element of that name begins, and where its own end tag ends."""
    begun: list[int] = []
    ends = {}
    for found in _TOKEN.finditer(page):
        name = _NAME.match(found[0])
        if not name or name[1].lower() != tag:
            continue
        if found[0][1] != "/":
            if tag not in FOREIGN or not found[0].endswith("/>"):
                begun.append(found.end())
        elif begun:
            ends[begun.pop()] = found.end()
    return ends


@lru_cache(maxsize=4096)
def _hints(tag_text: str) -> frozenset:
    """Words of the telling attributes, their whole values after "=", and the mark of a hidden element.

    Of a repeated attribute the first counts.
    """
    words, met = set(), set()
    for name, value in _ATTRIBUTE.findall(tag_text, _NAME.match(tag_text).end()):
        name = name.lower()
        if name in met:
            continue
        met.add(name)
        value = value.strip("\"'").lower()
        # A page opens an element hidden "until-found" when its text is searched for.
        if name == "hidden" and value != "until-found" or name == "style" and _HIDDEN.search(value):
            words.add(HIDING)
        elif name in _TELLING:
            words.update(_PART.findall(value))
            words.update("=" + v for v in value.split())
    return frozenset(words)


class _Elements:
    """The open elements; where those of a name and those that are blocks stand is known without a search."""

    def __init__(self):
        self.stack: list[_Open] = []
        self.named: dict[str, list[int]] = {}
        self.blocks: list[int] = []

    def push(self, tag: str, words: frozenset) -> None:
        above = self.stack[-1].path if self.stack else ()
        path = above if above and above[-1] == (tag, words) else (*above, (tag, words))[-NEAR:]
        self.named.setdefault(tag, []).append(len(self.stack))
        if tag in BLOCK:
            self.blocks.append(len(self.stack))
        self.stack.append(_Open(tag, path))

    def cut(self, index: int) -> bool:
        """Close all from an index on; True if a block was among them."""
        while len(self.stack) > index:
            self.named[self.stack.pop().tag].pop()
        held = len(self.blocks)
        while self.blocks and self.blocks[-1] >= index:
            self.blocks.pop()
        return len(self.blocks) < held

    def last(self, tag: str) -> int:
        """The innermost open element of a name that its end tag reaches, or -1; an inline end tag crosses no block."""
        places = self.named.get(tag)
        if not places or tag not in BLOCK and self.blocks and self.blocks[-1] > places[-1]:
            return -1
        return places[-1]

    def ended_by(self, tag: str) -> int:
        """The outermost open element that an opening tag ends by rule, up to the nearest container, or -1.

        One element of a kind ends another, so no more of them stand in a row than there are kinds.
        """
        ended = -1
        for index in reversed(self.blocks):
            known = self.stack[index].tag
            if known not in ENDED_BY:
                break
            if tag in ENDED_BY[known]:
                ended = index
        return ended

    def holds(self, tag: str) -> bool:
        return bool(self.named.get(tag))


def blocks(page: str | None) -> list[Block]:
    """Leaf blocks with text, in page order; markup that never ends is dropped, unclosed elements end by rule.

    The work grows with the page's length, however deep its elements stand.
    """
    page = page or ""
    out: list[Block] = []
    opened = _Elements()
    texts: list[str] = []
    linked = 0
    end = len(page)
    ends: dict[str, dict[int, int]] = {}

    def flush() -> None:
        nonlocal linked
        # Decoded at the end: a reference cut by nothing but markup is still none.
        text = _SPACE.sub(" ", "".join(texts)).strip()
        if text:
            out.append(Block(opened.stack[-1].path if opened.stack else (), text, min(linked, len(text))))
        texts.clear()
        linked = 0

    def add(text: str) -> None:
        nonlocal linked
        if text:
            text = html.unescape(text)
            texts.append(text)
            if opened.holds("a"):
                linked += len(text.strip())

    def close(index: int) -> None:
        if opened.blocks and opened.blocks[-1] >= index:
            flush()
        opened.cut(index)

    at = 0
    while at < end:
        found = _TOKEN.search(page, at)
        if not found:
            add(page[at:])
            break
        add(page[at : found.start()])
        at = found.end()
        token = found[0]
        name = _NAME.match(token)
        if not name:
            continue
        tag = name[1].lower()
        if tag in FALLBACK:
            texts.append(" ")
        if token[1] == "/":
            index = opened.last(tag)
            if index >= 0:
                close(index)
            elif tag in BLOCK:
                flush()
            continue
        if tag in RAW:
            stop = re.compile(rf"</{tag}(?=[\s/>])[^>]*>", re.IGNORECASE).search(page, at)
            at = stop.end() if stop else end
            texts.append(" ")
            continue
        if tag in APART:
            if tag not in ends:
                ends[tag] = _ends(tag, page)
            stop = at if tag in FOREIGN and token.endswith("/>") else ends[tag].get(at)
            texts.append(" ")
            if stop is not None:
                at = stop
                continue
        if tag == "br":
            texts.append(" ")
            continue
        if tag in BLOCK:
            flush()
            index = opened.ended_by(tag)
            if index >= 0:
                close(index)
        if tag in VOID or token.endswith("/>") and (tag in FOREIGN or opened.holds("math") or opened.holds("svg")):
            continue
        opened.push(tag, _hints(token))
    flush()
    return out


@lru_cache(maxsize=1 << 16)
def _bucket(name: str) -> int:
    # A hash that is the same in every worker.
    h = 2166136261
    for byte in name.encode():
        h = ((h ^ byte) * 16777619) & 0xFFFFFFFF
    return (h ^ (h >> 15)) & ((1 << BITS) - 1)


@lru_cache(maxsize=1 << 14)
def _of_path(path: tuple) -> tuple[int, ...]:
    names = []
    for tag, words in path:
        names.append(f"in:{tag}")
        names.extend(f"word:{w}" for w in words)
    lines = [tag for tag, _ in path if tag in BLOCK]
    names.append(f"leaf:{lines[-1] if lines else ''}")
    names.append(f"above:{'/'.join(lines[-2:])}")
    if path:
        names.extend(f"own:{w}" for w in path[-1][1])
    return tuple(dict.fromkeys(map(_bucket, names)))


def features(chain: list[Block]) -> list[list[int]]:
    out = []
    for block in chain:
        text = block.text
        words = text.count(" ") + 1
        ends = text[-1] in ".!?…:\"»”'"
        names = [
            "bias", f"links all:{block.linked >= len(text)}", f"sign:{'©' in text}", f"words:{min(words.bit_length(), 8)}", f"links:{4 * block.linked // len(text)}",
            f"ends:{ends}", f"stops:{min(3, text.count('. '))}", f"commas:{min(3, text.count(', '))}",
        ]
        out.append([*map(_bucket, names), *_of_path(block.path)])
    return out


@dataclass(frozen=True)
class Field:
    """Weights of features for the two labels and of steps between labels; 1 is main text."""

    state: np.ndarray
    step: np.ndarray
    begin: np.ndarray = field(default_factory=lambda: np.zeros(2))

    def scores(self, chain: list[list[int]]) -> np.ndarray:
        sizes = np.fromiter(map(len, chain), np.int64, len(chain))
        flat = np.fromiter((i for f in chain for i in f), np.int64, int(sizes.sum()))
        return np.add.reduceat(self.state[flat], np.cumsum(sizes) - sizes)

    def viterbi(self, chain: list[list[int]]) -> list[int]:
        scores = self.scores(chain).tolist()
        (a, b), (c, d) = self.step.tolist()
        zero, one = self.begin[0] + scores[0][0], self.begin[1] + scores[0][1]
        back = []
        for s in scores[1:]:
            from_zero, from_one = zero + a >= one + c, zero + b >= one + d
            back.append((0 if from_zero else 1, 0 if from_one else 1))
            zero, one = (
                s[0] + (zero + a if from_zero else one + c),
                s[1] + (zero + b if from_one else one + d),
            )
        labels = [0 if zero >= one else 1]
        for choice in reversed(back):
            labels.append(choice[labels[-1]])
        return labels[::-1]


def train(pages: list[list[tuple[Block, int]]], epochs: int = 12, rate: float = 0.2, l2: float = 1e-4) -> Field:
    """Fit by the gradient of the chains' likelihood (forward-backward), with adaptive steps."""
    model = Field(np.zeros((1 << BITS, 2)), np.zeros((2, 2)), np.zeros(2))
    seen = [np.full_like(x, 1e-4) for x in (model.state, model.step, model.begin)]
    chains = [(features([b for b, _ in p]), [y for _, y in p]) for p in pages if p]
    rng = np.random.default_rng(1)
    for _ in range(epochs):
        for i in rng.permutation(len(chains)):
            chain, labels = chains[i]
            scores, n = model.scores(chain), len(labels)
            forward, backward = np.zeros((n, 2)), np.zeros((n, 2))
            forward[0] = model.begin + scores[0]
            for t in range(1, n):
                forward[t] = scores[t] + np.logaddexp.reduce(forward[t - 1][:, None] + model.step, 0)
            for t in range(n - 2, -1, -1):
                backward[t] = np.logaddexp.reduce(model.step + scores[t + 1] + backward[t + 1], 1)
            total = np.logaddexp.reduce(forward[-1])
            expected = np.exp(forward + backward - total)
            error = expected.copy()
            error[np.arange(n), labels] -= 1
            step = np.zeros((2, 2))
            for t in range(1, n):
                step += np.exp(forward[t - 1][:, None] + model.step + scores[t] + backward[t] - total)
                step[labels[t - 1], labels[t]] -= 1
            flat = np.array([i for f in chain for i in f])
            at = np.repeat(np.arange(n), [len(f) for f in chain])
            ids, place = np.unique(flat, return_inverse=True)
            moved = np.stack([np.bincount(place, error[at, k]) for k in (0, 1)], 1)
            moved += l2 * model.state[ids]
            for values, which, spot, gradient in (
                (model.state, 0, ids, moved), (model.step, 1, slice(None), step),
                (model.begin, 2, slice(None), error[0]),
            ):
                seen[which][spot] += gradient**2
                values[spot] -= rate * gradient / np.sqrt(seen[which][spot])
    return model


def default_model() -> Field:
    """The field trained on the labelled pages; deterministic, a few seconds."""
    known = []
    for page, main in labelled_pages():
        known.append([(b, int(b.text in main)) for b in blocks(page)])
    return train(known)


def main_text(page: str | None, model: Field) -> str:
    chain = blocks(page)
    if not chain:
        return ""
    labels = model.viterbi(features(chain))
    return "\n".join(b.text for b, label in zip(chain, labels, strict=True) if label)


def extract(pages: DataFrame, model: Field, page: str = "html", name: str = "text") -> DataFrame:
    """Add the main text of each whole page as column `name` (replaced if there).

    Null, empty and text-free pages give an empty text. Blocks are in page order,
    joined by a newline; white space inside a block is one space. Repeated rows
    give equal texts and all rows stay. Pages are read whole, in time that grows with
    their length; an empty table gives an empty one.
    """

    @F.pandas_udf("string")
    def run(series: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in series:
            yield pd.Series([main_text(p, model) for p in batch], dtype=object)

    batches.small(pages.sparkSession)
    return pages.withColumn(name, run(F.col(page)))
