"""Toxicity: one subword bag of a whole text, averaged with learned weights, into a linear softmax.

Every hashed character n-gram has an embedding. A word's bag is the mean of its
n-grams, a text's bag the mean of its words' bags, each word weighted by the
exponential of a linear form of its own bag, so one insult is not lost among
thousands of plain words. Embeddings, weights and softmax are trained together in
numpy: first on words by the labels of the texts they stand in, then on whole
texts. In both, telling words are also met misspelt (a character replaced, dropped
or doubled), so an unseen misspelling is known by the n-grams it keeps. Letters set
apart by single blanks are read as one word.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickloom.llm import batches, codes

_WORD = re.compile(r"[^\x20\x09-\x0D]+")
_SPACED = re.compile(r"(?<![^\x20\x09-\x0D])[^\x20\x09-\x0D](?:\x20[^\x20\x09-\x0D]){3,}(?![^\x20\x09-\x0D])")
_SIGNS = list("abcdefghijklmnopqrstuvwxyz0123456789@$!*")


@dataclass(frozen=True)
class Settings:
    orders: tuple[int, ...] = (2, 3, 4, 5)
    open: tuple[int, ...] = (3, 5)  # odd orders also taken with their middle character left open
    bits: int = 20
    width: int = 8
    word_epochs: int = 6
    text_epochs: int = 20
    pure: float = 0.9  # a word is telling if this share of it stands in toxic texts,
    spread: float = 0.04  # it stands in this share of them
    often: float = 3.5  # and in more texts than this
    variants: int = 400  # misspellings of a telling word
    misspelt: float = 0.6  # chance of a telling word to be met misspelt in a step on texts
    form_weight: float = 2.0  # of a misspelling against the word itself
    sharpness: float = 4.0  # of the words' weights, before they are trained on texts
    stays: float = 0.6  # chance of an n-gram of a toxic word to stay in a step
    rate: float = 0.3
    batch: int = 4096
    seed: int = 1


@dataclass(frozen=True)
class Model:
    toxic: np.ndarray  # embedding times (toxic - clean) softmax weights, a number for each bucket
    weight: np.ndarray  # embedding times the form that weighs words
    bias: float
    settings: Settings


def _read(text: str) -> str:
    """Lower case, letters set apart by single blanks joined."""
    return _SPACED.sub(lambda m: m.group().replace(" ", ""), text.lower())


def _words(texts: list[str], settings: Settings):
    """(stream, starts of the words, (word numbers, buckets) of each order)."""
    stream = codes.Stream(texts)
    blank = codes.white(stream.codes)
    starts, _ = codes.word_spans(blank)
    number = np.zeros(len(blank), np.int64)
    number[starts] = 1
    number = np.cumsum(number) - 1
    hashes = codes.Hashes(np.where(blank, np.uint32(32), stream.codes))

    def grams():
        found = codes.character_ngrams(stream.codes, blank, settings.orders, settings.bits)
        for n, (at, bucket) in zip(settings.orders, found, strict=False):
            word = number[at + 1] if n > 2 else np.maximum(number[at], number[at + 1])
            yield word, bucket
            if n in settings.open:
                half = n // 2
                rest = codes.mixed(hashes.spans(at, at + half)) + hashes.spans(at + half + 1, at + n)
                yield word, codes.buckets(rest, settings.orders[-1] + n, settings.bits)

    return stream, starts, grams()


def misspellings(word: str, rng: np.random.Generator, many: int) -> list[str]:
    """`many` forms of the word, each with one character replaced, dropped or doubled.

    Half of those put in place are characters no text is likely to hold, so what is
    left of the word must tell by itself.
    """
    found = []
    for kind, at, sign, private in zip(
        rng.integers(0, 6, many), rng.integers(0, len(word), many),
        rng.integers(0, len(_SIGNS), many), rng.integers(0xE000, 0xF900, many),
    ):
        put = "" if kind == 4 else word[at] * 2 if kind == 5 else _SIGNS[sign] if kind < 3 else chr(private)
        found.append(word[:at] + put + word[at + 1 :])
    return found


class _Bags:
    """The n-grams of a list of words."""

    def __init__(self, words: list[str], settings: Settings):
        owners, buckets = [np.zeros(0, np.int32)], [np.zeros(0, np.int32)]
        for rows, part in codes.pieces(words):
            _, starts, grams = _words(part, settings)
            for word, bucket in grams:
                owners.append(rows[word].astype(np.int32))
                buckets.append(bucket.astype(np.int32))
        owner = np.concatenate(owners)
        order = np.argsort(owner, kind="stable")
        self.owner, self.bucket = owner[order], np.concatenate(buckets)[order]
        self.first = np.searchsorted(self.owner, np.arange(len(words) + 1))
        self.count = np.maximum(np.diff(self.first), 1)

    def grams(self, words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(place in `words`, bucket) of the words' n-grams."""
        sizes = np.diff(self.first)[words]
        place = np.repeat(np.arange(len(words)), sizes)
        shift = np.arange(len(place)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        return place, self.bucket[self.first[words][place] + shift]

    def means(self, table: np.ndarray) -> np.ndarray:
        return np.bincount(self.owner, table[self.bucket], len(self.count)) / self.count


class _Trainer:
    def __init__(self, bags: _Bags, settings: Settings):
        rng = np.random.default_rng(settings.seed)
        self.bags, self.rng, self.rate, self.stays = bags, rng, settings.rate, settings.stays
        self.batch = settings.batch
        self.embed = rng.random((1 << settings.bits, settings.width), np.float32) * np.float32(0.2) - np.float32(0.1)
        self.total = np.zeros_like(self.embed)
        self.toxic = rng.uniform(-0.5, 0.5, settings.width)  # toxic minus clean
        self.weigh = np.zeros(settings.width)
        self.bias = np.zeros(1)
        self.seen = [np.full(x.shape, 1e-4, x.dtype) for x in (self.embed, self.toxic, self.weigh, self.bias)]

    def on_words(self, words: np.ndarray, target: np.ndarray, weight: np.ndarray) -> None:
        """A step on words alone; word i is toxic with probability target[i]."""
        place, bucket = self.bags.grams(words)
        stays = (target[place] < 0.5) | (self.rng.random(len(place)) < self.stays)
        place, bucket = place[stays], bucket[stays]
        mean = self._means(place, bucket, words)
        error = weight * (_sigmoid(mean @ self.toxic + self.bias[0]) - target)
        ids, moved = self._back(place, bucket, words, error, np.zeros(len(words)))
        self._move(1, slice(None), error @ mean)
        self._move(3, slice(None), np.array([error.sum()]))
        self._move(0, ids, moved)

    def on_texts(self, text, word, times, y, weight) -> None:
        """A step on whole texts, given as rising (text, word, times) rows; y by text number."""
        which, sizes, share, logit, mean_logit = self.weighed(text, word, times)
        error = weight[which] * (_sigmoid(mean_logit + self.bias[0]) - y[which])
        by_row = np.repeat(error, sizes) * share
        by_weight = by_row * (logit - np.repeat(mean_logit, sizes))
        # A word of next to no weight moves nothing.
        felt = np.flatnonzero(share > 1e-3)
        words, at = np.unique(word[felt], return_inverse=True)
        by_row = np.bincount(at, by_row[felt], len(words))
        by_weight = np.bincount(at, by_weight[felt], len(words))
        toxic, weigh = np.zeros_like(self.toxic), np.zeros_like(self.weigh)
        self.total[:] = 0
        # The n-grams of all words at once would need much memory.
        for i in range(0, len(words), self.batch):
            part = slice(i, i + self.batch)
            place, bucket = self.bags.grams(words[part])
            mean = self._means(place, bucket, words[part])
            toxic += by_row[part] @ mean
            weigh += by_weight[part] @ mean
            ids, moved = self._back(place, bucket, words[part], by_row[part], by_weight[part])
            self.total[ids] += moved
        self._move(1, slice(None), toxic)
        self._move(2, slice(None), weigh)
        self._move(3, slice(None), np.array([error.sum()]))
        touched = np.flatnonzero(self.total.any(1))
        self._move(0, touched, self.total[touched])

    def weighed(self, text, word, times):
        """(text numbers, words of each, share and logit of each word, logit of each text) but for the bias."""
        toxic, logs = self.tables()
        logit, log = self.bags.means(toxic)[word], self.bags.means(logs)[word] + np.log(times)
        edges = np.flatnonzero(np.diff(text, prepend=-1))
        sizes = np.diff(np.append(edges, len(text)))
        share = np.exp(log - np.repeat(np.maximum.reduceat(log, edges), sizes))
        share /= np.repeat(np.add.reduceat(share, edges), sizes)
        return text[edges], sizes, share, logit, np.add.reduceat(share * logit, edges)

    def tables(self) -> tuple[np.ndarray, np.ndarray]:
        return tuple(self.embed @ form.astype(np.float32) for form in (self.toxic, self.weigh))

    def _means(self, place, bucket, words) -> np.ndarray:
        return codes.sums_by(place, self.embed[bucket], len(words)) / self.bags.count[words][:, None]

    def _back(self, place, bucket, words, error, pull):
        """(buckets, gradients) from those of each word's toxic logit and of the log of its weight."""
        back = (error[:, None] * self.toxic + pull[:, None] * self.weigh) / self.bags.count[words][:, None]
        ids, at = np.unique(bucket, return_inverse=True)
        return ids, codes.sums_by(at, back[place], len(ids)).reshape(len(ids), -1)

    def _move(self, which, ids, gradient) -> None:
        values = (self.embed, self.toxic, self.weigh, self.bias)[which]
        self.seen[which][ids] += gradient**2
        values[ids] -= self.rate * gradient / np.sqrt(self.seen[which][ids])


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -35, 35)))


def train(texts: list[str], labels: list[int], settings: Settings = Settings()) -> Model:
    """Fit on labelled texts. No sample, or none with a word: every text with a word scores 0.5."""
    y = np.array(labels, float)
    number, keys, sizes, word, times = {}, [], [], [], []
    for t in texts:
        held = Counter(_WORD.findall(_read(t)))
        keys.append(tuple(sorted(held, key=lambda w: (-len(w), w))[:3]))
        sizes.append(len(held))
        word.append(np.array([number.setdefault(w, len(number)) for w in held], np.int32))
        times.append(np.array(list(held.values()), np.float32))
    words = list(number)
    none = np.zeros(1 << settings.bits, np.float32)
    if not words:
        return Model(none, none, 0.0, settings)
    text = np.repeat(np.arange(len(texts), dtype=np.int32), sizes)
    word, times = np.concatenate(word), np.concatenate(times)

    # Copies count as one text: those that share their three longest words.
    alike = Counter(keys)
    single = np.array([1 / alike[k] for k in keys])
    # Every sixth text is held back for the bias.
    back = np.arange(len(y)) % 6 == 5
    text_all, word_all, times_all = text, word, times
    seen = ~back[text]
    text, word, times = text[seen], word[seen], times[seen]
    positive = min(max((single * y)[~back].sum() / single[~back].sum(), 1e-3), 1 - 1e-3)
    balance = single * np.where(y > 0, 0.5 / positive, 0.5 / (1 - positive))
    often = np.bincount(word, single[text], len(words))
    both = np.bincount(word, balance[text], len(words))
    share = np.bincount(word, (y * balance)[text], len(words)) / np.maximum(both, 1e-12)
    least = max(settings.often, settings.spread * (single * y)[~back].sum())
    telling = np.flatnonzero((share > settings.pure) & (often >= least))

    # Each telling word has a block of misspellings behind the words; one that is a word itself is none.
    rng = np.random.default_rng(settings.seed)
    extra = [v for i in telling for v in misspellings(words[i], rng, settings.variants)]
    block = np.full(len(words), -1)
    block[telling] = len(words) + settings.variants * np.arange(len(telling))
    wrong = np.array([len(v) < 3 or v in number for v in extra], bool)
    trainer = _Trainer(_Bags(words + extra, settings), settings)

    def misspelt(of: np.ndarray, chance: float) -> np.ndarray:
        """`of` with some of its telling words misspelt."""
        at = np.flatnonzero((block[of] >= 0) & (trainer.rng.random(len(of)) < chance))
        put = block[of[at]] + trainer.rng.integers(0, settings.variants, len(at))
        fits = ~wrong[put - len(words)] if len(at) else np.zeros(0, bool)
        out = of.copy()
        out[at[fits]] = put[fits]
        return out

    # A word of one text alone says little.
    used = np.flatnonzero(often > 1.5)
    forms = len(words) + np.flatnonzero(~wrong)
    origin = np.concatenate([np.arange(len(words)), np.repeat(telling, settings.variants)])
    for _ in range(settings.word_epochs):
        order = trainer.rng.permutation(np.concatenate([used, forms]))
        for i in range(0, len(order), settings.batch):
            part = order[i : i + settings.batch]
            of = origin[part]
            trainer.on_words(part, share[of], np.sqrt(both[of]) * np.where(part < len(words), 1.0, settings.form_weight))
    trainer.weigh = settings.sharpness * trainer.toxic
    for _ in range(settings.text_epochs):
        trainer.on_texts(text, misspelt(word, settings.misspelt), times, y, balance)
        # Words met already must not be forgotten.
        part = np.concatenate([trainer.rng.permutation(forms)[: settings.batch], trainer.rng.permutation(np.flatnonzero(often > 0))[: 2 * settings.batch]])
        of = origin[part]
        trainer.on_words(part, share[of], np.sqrt(both[of]) * np.where(part < len(words), 1.0, settings.form_weight))
    # The bias is fitted on texts held back, half as they are, half with their telling words misspelt.
    later = back[text_all]
    as_is = word_all[later]
    found = [
        trainer.weighed(text_all[later], of, times_all[later])
        for of in (as_is, misspelt(as_is, 1.0)) if later.any()
    ]
    bias = float(trainer.bias[0])
    if found:
        which = np.concatenate([f[0] for f in found])
        bias = _bias(np.concatenate([f[4] for f in found]), y[which], single[which], bias)
    toxic, weight = trainer.tables()
    return Model(toxic.astype(np.float32), weight.astype(np.float32), bias, settings)


def _bias(logit: np.ndarray, y: np.ndarray, weight: np.ndarray, else_: float) -> float:
    """The bias of least logistic loss; `else_` where only one class is there.

    Targets are drawn in a little from 0 and 1, so classes apart give a finite one.
    """
    ones, zeros = (weight * y).sum(), (weight * (1 - y)).sum()
    if not ones or not zeros:
        return else_
    target = np.where(y > 0, (ones + 1) / (ones + 2), 1 / (zeros + 2))
    low, high = -60.0, 60.0
    for _ in range(60):
        middle = (low + high) / 2
        if (weight * (_sigmoid(logit + middle) - target)).sum() < 0:
            low = middle
        else:
            high = middle
    return (low + high) / 2


def predict(model: Model, texts: list[str | None]) -> np.ndarray:
    """Scores from 0 to 1 of whole texts; a text without a word scores 0."""
    top, all_weights, logits = np.full(len(texts), -np.inf), np.zeros(len(texts)), np.zeros(len(texts))
    for rows, part in codes.pieces([_read(t or "") for t in texts]):
        stream, starts, grams = _words(part, model.settings)
        if not len(starts):
            continue
        toxic, log, count = np.zeros(len(starts)), np.zeros(len(starts)), np.zeros(len(starts))
        for word, bucket in grams:
            toxic += np.bincount(word, model.toxic[bucket], len(starts))
            log += np.bincount(word, model.weight[bucket], len(starts))
            count += np.bincount(word, minlength=len(starts))
        toxic, log = toxic / np.maximum(count, 1), log / np.maximum(count, 1)
        # Sums are kept against the largest weight of the text so far.
        text = rows[stream.text_of(starts)]
        edges = np.flatnonzero(np.diff(text, prepend=-1))
        which, sizes = text[edges], np.diff(np.append(edges, len(text)))
        most = np.maximum(top[which], np.maximum.reduceat(log, edges))
        kept = np.exp(top[which] - most)
        weight = np.exp(log - np.repeat(most, sizes))
        all_weights[which] = all_weights[which] * kept + np.add.reduceat(weight, edges)
        logits[which] = logits[which] * kept + np.add.reduceat(weight * toxic, edges)
        top[which] = most
    scores = _sigmoid(logits / np.maximum(all_weights, 1e-300) + model.bias)
    return np.where(np.isinf(top), 0.0, scores)


def score(docs: DataFrame, model: Model, text: str = "text", name: str = "score") -> DataFrame:
    """Add the toxicity score of each whole text as column `name` (replaced if there).

    Null, empty or white text scores 0. A text of any length is summed whole, in pieces.
    Repeated rows score alike, all rows stay; an empty table gives an empty result.
    Python workers get small batches from now on (`batches.small`).
    """

    @F.pandas_udf("double")
    def run(series: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in series:
            yield pd.Series(predict(model, batch.tolist()))

    batches.small(docs.sparkSession)
    return docs.withColumn(name, run(F.col(text)))
