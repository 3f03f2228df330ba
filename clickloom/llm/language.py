"""Language identification: averaged hashed subword embeddings with a linear softmax.

A text's character n-grams (inside words of letters, lower case) are hashed to
rows of an embedding table; their mean goes through a linear softmax. Both are
trained together by stochastic gradient descent in numpy on a bounded sample.
On a part of the sample held back, a temperature is fitted so that scores read
as probabilities, and a threshold below which a prediction is marked rejected.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickloom.llm import batches, codes

UNKNOWN = "und"


@dataclass(frozen=True)
class Settings:
    orders: tuple[int, ...] = (2, 3, 4)
    bits: int = 16
    width: int = 16
    epochs: int = 8
    rate: float = 0.5
    held_back: int = 5  # every n-th sample document calibrates
    kept: float = 0.995  # share of right predictions that the threshold lets through
    seed: int = 1


@dataclass(frozen=True)
class Model:
    languages: list[str]
    table: np.ndarray  # embedding times softmax weights: a row of logits for each bucket
    bias: np.ndarray
    temperature: float
    threshold: float
    settings: Settings


def _features(texts: list[str], settings: Settings) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(text numbers, buckets) for each n-gram order; no n-gram, no entry."""
    stream = codes.Stream([t.lower() for t in texts])
    blank = ~codes.letters()[stream.codes]
    for at, bucket in codes.character_ngrams(stream.codes, blank, settings.orders, settings.bits):
        # A window that begins with the blank before a text belongs to that text.
        yield stream.text_of(at + 1), bucket


def _softmax(logits: np.ndarray) -> np.ndarray:
    e = np.exp(logits - logits.max(1, keepdims=True))
    return e / e.sum(1, keepdims=True)


def _rows(texts: list[str], settings: Settings) -> list[tuple[np.ndarray, np.ndarray]]:
    """(buckets, shares) of each training text."""
    out = []
    for text in texts:
        found = [b for _, b in _features([text], settings)]
        ids, counts = np.unique(np.concatenate(found or [np.zeros(0, np.int64)]), return_counts=True)
        out.append((ids, (counts / max(1, counts.sum())).astype(np.float32)))
    return out


def _few_words(text: str, rng: np.random.Generator) -> str:
    words = text.split()
    size = int(rng.integers(1, 12))
    at = int(rng.integers(0, max(1, len(words) - size + 1)))
    return " ".join(words[at : at + size])


def train(texts: list[str], languages: list[str], settings: Settings = Settings()) -> Model:
    """Fit on texts with known languages; one language alone is predicted with score 1.

    Without any text to learn from every prediction is `und`.
    """
    names = sorted(set(languages))
    if not names:
        return Model([UNKNOWN], np.zeros((1 << settings.bits, 1), np.float32), np.zeros(1), 1.0, 0.0, settings)
    target = np.array([names.index(x) for x in languages])
    rng = np.random.default_rng(settings.seed)
    rows = _rows(texts, settings)
    # A few words of each text as well, so that short texts are learned.
    short = _rows([_few_words(t, rng) for t in texts], settings)
    embed = rng.uniform(-0.5, 0.5, (1 << settings.bits, settings.width)).astype(np.float32)
    weights = np.zeros((settings.width, len(names)), np.float32)
    bias = np.zeros(len(names), np.float32)
    number = np.arange(len(rows))
    fit = number[number % settings.held_back != 0] if len(rows) >= 10 * settings.held_back else number
    check = np.setdiff1d(number, fit) if len(fit) < len(number) else fit
    for epoch in range(settings.epochs):
        rate = settings.rate * (1 - epoch / settings.epochs)
        for i in rng.permutation(fit):
            ids, share = (short if epoch % 2 else rows)[i]
            if not len(ids):
                continue
            mean = share @ embed[ids]
            error = _softmax((mean @ weights + bias)[None])[0]
            error[target[i]] -= 1
            back = weights @ error
            weights -= rate * np.outer(mean, error)
            bias -= rate * 0.1 * error
            # A bucket moves by its share of the text, times the text's size as for a sum.
            embed[ids] -= (rate * 20 * share)[:, None] * back
    table = (embed @ weights).astype(np.float32)
    logits = np.stack([r[1] @ table[r[0]] + bias for r in rows])[check]
    best = (np.inf, 1.0)
    for temperature in np.geomspace(0.05, 20, 61):
        p = _softmax(logits / temperature)[np.arange(len(check)), target[check]]
        best = min(best, (float(-np.log(np.maximum(p, 1e-12)).mean()), float(temperature)))
    p = _softmax(logits / best[1])
    right = np.sort(p.max(1)[p.argmax(1) == target[check]])
    threshold = float(right[int(len(right) * (1 - settings.kept))]) if len(right) else 0.0
    return Model(names, table, bias, best[1], threshold, settings)


def predict(model: Model, texts: list[str | None]) -> pd.DataFrame:
    """Language, score and whether the score is below the threshold, for each whole text."""
    kinds = len(model.languages)
    sums, counts = np.zeros((len(texts), kinds)), np.zeros(len(texts))
    for rows, part in codes.pieces(texts):
        for text, bucket in _features(part, model.settings):
            # The texts come in order, so their entries are runs.
            edges = np.flatnonzero(np.diff(text, prepend=-1))
            if len(edges):
                np.add.at(sums, rows[text[edges]], np.add.reduceat(model.table[bucket], edges))
            counts += np.bincount(rows[text], minlength=len(texts))
    p = _softmax((sums / np.maximum(counts, 1)[:, None] + model.bias) / model.temperature)
    known = counts > 0
    return pd.DataFrame(
        {
            "lang_pred": np.where(known, np.array(model.languages, object)[p.argmax(1)], UNKNOWN),
            "score": np.where(known, p.max(1), 0.0),
            "rejected": ~known | (p.max(1) < model.threshold),
        }
    )


def identify(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """Add lang_pred, score and rejected to each row; columns of these names are replaced.

    A text that is null, empty or without any letter is `und` with score 0 and
    rejected. Repeated rows get equal results; every other column is passed on.
    """

    @F.pandas_udf("lang_pred string, score double, rejected boolean")
    def run(series: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for batch in series:
            yield predict(model, batch.tolist())

    batches.small(docs.sparkSession)
    found = docs.withColumn("__language", run(F.col(text)))
    return found.withColumns(
        {n: F.col(f"__language.{n}") for n in ("lang_pred", "score", "rejected")}
    ).drop("__language")
