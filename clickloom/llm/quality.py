"""Quality classifier: logistic regression on hashed word n-grams, trained with follow-the-regularised-leader.

Words are taken as written and by their shape (runs of capitals, small letters,
digits; other signs as they are; a word equal to the one before has a shape of
its own), each as 1- and 2-grams. A text's vector holds the share of each bucket
among its n-grams; its score is the sparse dot product with the weights.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickloom.llm import batches, codes

CAPITAL, SMALL, DIGIT, SAME = 1, 2, 3, 4


@dataclass(frozen=True)
class Settings:
    bits: int = 18
    scale: float = 10.0
    epochs: int = 8
    alpha: float = 0.3
    beta: float = 1.0
    l1: float = 0.001
    l2: float = 0.01
    seed: int = 1


@dataclass(frozen=True)
class Model:
    weights: np.ndarray
    bias: float
    settings: Settings


def _ngrams(texts: list[str], settings: Settings) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(text numbers, buckets) of each view and order."""
    stream = codes.Stream(texts)
    blank = codes.white(stream.codes)
    starts, ends = codes.word_spans(blank)
    if not len(starts):
        return
    text = stream.text_of(starts)
    surface = codes.Hashes(stream.codes).spans(starts, ends)
    near = text[1:] == text[:-1]
    same = np.concatenate(([False], near & (surface[1:] == surface[:-1])))

    kind = np.where(codes.letters()[stream.codes], SMALL, stream.codes + 8)
    capital = ((stream.codes >= 65) & (stream.codes <= 90)) | ((stream.codes >= 0xC0) & (stream.codes <= 0xDE))
    kind = np.where(capital, CAPITAL, kind)
    kind = np.where((stream.codes >= 48) & (stream.codes <= 57), DIGIT, kind)
    first = np.concatenate(([True], kind[1:] != kind[:-1])) & ~blank
    place = np.concatenate(([0], np.cumsum(first)))
    shape = codes.Hashes(kind[first]).spans(place[starts], place[ends])
    shape = np.where(same, np.uint64(SAME), codes.mixed(shape))

    for view, words in enumerate((codes.mixed(surface), shape)):
        yield text, codes.buckets(words, 2 * view + 1, settings.bits)
        with np.errstate(over="ignore"):
            pairs = words[:-1] * codes.BASE + words[1:]
        yield text[1:][near], codes.buckets(pairs[near], 2 * view + 2, settings.bits)


def train(texts: list[str], labels: list[int], settings: Settings = Settings()) -> Model:
    """Follow-the-regularised-leader over the sample; classes weigh the same in all. No sample: every score is 0.5."""
    y = np.array(labels, float)
    if not len(y):
        return Model(np.zeros(1 << settings.bits, np.float32), 0.0, settings)
    rng = np.random.default_rng(settings.seed)
    size = 1 << settings.bits
    z, n = np.zeros(size + 1), np.zeros(size + 1)
    rows = []
    for t in texts:
        found = [b for _, b in _ngrams([t], settings)]
        ids, counts = np.unique(np.concatenate(found or [np.zeros(0, np.int64)]), return_counts=True)
        rows.append((np.append(ids, size), np.append(settings.scale * counts / max(1, counts.sum()), 1.0)))
    positive = min(max(y.mean(), 1e-3), 1 - 1e-3)

    def weights(ids):
        zi = z[ids]
        w = -(zi - np.sign(zi) * settings.l1)
        w /= (settings.beta + np.sqrt(n[ids])) / settings.alpha + settings.l2
        return np.where(np.abs(zi) <= settings.l1, 0.0, w)

    for _ in range(settings.epochs):
        for i in rng.permutation(len(rows)):
            ids, x = rows[i]
            w = weights(ids)
            p = 1 / (1 + np.exp(-np.clip(w @ x, -35, 35)))
            # Classes are weighed to count alike, or a rare class is not learned.
            g = (p - y[i]) * x * (0.5 / (positive if y[i] else 1 - positive))
            sigma = (np.sqrt(n[ids] + g * g) - np.sqrt(n[ids])) / settings.alpha
            z[ids] += g - sigma * w
            n[ids] += g * g
    w = weights(np.arange(size + 1))
    return Model(w[:-1].astype(np.float32), float(w[-1]), settings)


def predict(model: Model, texts: list[str | None]) -> np.ndarray:
    """Scores from 0 to 1 of whole texts; a text without a word gets the score of the bias."""
    sums, counts = np.zeros(len(texts)), np.zeros(len(texts))
    for rows, part in codes.pieces(texts):
        for text, bucket in _ngrams(part, model.settings):
            sums += np.bincount(rows[text], model.weights[bucket], len(texts))
            counts += np.bincount(rows[text], minlength=len(texts))
    logit = model.bias + model.settings.scale * sums / np.maximum(counts, 1)
    return 1 / (1 + np.exp(-np.clip(logit, -35, 35)))


def score(docs: DataFrame, model: Model, text: str = "text", name: str = "score") -> DataFrame:
    """Add the quality score of each whole text as column `name` (replaced if there).

    Null counts as empty; an empty text or one of white space alone scores as
    the bias does. Repeated rows score alike and all rows stay.
    """

    @F.pandas_udf("double")
    def run(series: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in series:
            yield pd.Series(predict(model, batch.tolist()))

    batches.small(docs.sparkSession)
    return docs.withColumn(name, run(F.col(text)))
