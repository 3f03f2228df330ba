"""Personal data in texts by weak supervision.

Exact patterns give the base spans, which always stay. Looser patterns add
candidates: addresses with "at" and "dot" spelled out, numbers without their plus
sign or with unusual separators, and matches of the exact patterns that fail a check.
Labelers of three sorts vote on every candidate: patterns (form and check digits),
gazetteers (top-level names, calling codes, issuer prefixes) and context (words and
characters around it). Expectation-maximisation over the counts of vote patterns
estimates how reliable each labeler is for each kind, which gives a candidate's
probability. A logistic span classifier is trained on these probabilities from shape
and context features. A candidate it accepts is added where no base span lies, unless
a labeler votes against it.
"""

from __future__ import annotations

import re
from bisect import bisect, bisect_left
from collections.abc import Iterator
from itertools import accumulate
from typing import NamedTuple

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clickloom.llm import batches
from clickloom.session import cut_lineage

KINDS = ("email", "ip", "card", "phone")
BITS = 16  # of the classifier's feature numbers
PER_PATTERN = 100  # examples learned from for each kind and vote pattern, about
ACCEPT = 0.7

LOCAL = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-"
DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
# A digit run is taken whole, so a match can only begin where a run does.
IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")

LOOSE_AT = re.compile(r" ?[\[({] ?(?:at|@) ?[\])}] ?| at | @ ?|@ ", re.IGNORECASE)
LOOSE_DOMAIN = re.compile(
    r"[A-Za-z0-9-]{1,63}(?:(?: ?[\[({] ?(?:dot|\.) ?[\])}] ?| dot |\.)[A-Za-z0-9-]{1,63}){1,8}", re.IGNORECASE
)
LOOSE_IP = re.compile(r"(?<![0-9.])[0-9]{1,3}(?:(?: ?[\[({](?:\.|dot)[\])}] ?| \. | dot )[0-9]{1,3}){3}(?![0-9])")
LOOSE_CARD = re.compile(r"(?<![0-9])[0-9]{3,6}(?:[._/][0-9]{3,6}){2,4}(?![0-9])")
LOOSE_PHONE = re.compile(
    r"(?<![0-9A-Za-z+.-])(?:(?:\+|00 ?)[1-9][0-9]{0,2}[ .-]|[01][ .-])?(?:\([0-9]{2,4}\) ?|[0-9]{2,4}[ .-])"
    r"[0-9]{3,4}[ .-][0-9]{3,4}(?![0-9A-Za-z]|[.-][0-9])"
)

# Gazetteers: fixed values, in natural order.
TOP_LEVEL = frozenset("at be biz ch co com de edu es eu fr gov info int io it mil name net nl org uk us".split())
PLACES = frozenset("example gmail gmx hotmail mail outlook web yahoo".split())
CALLING = ("1", "31", "32", "33", "34", "39", "41", "43", "44", "49", "52", "54", "55", "81", "86", "91")
ISSUERS = ("2", "3", "4", "5", "6")
FUNCTION = frozenset("a an are be he her him is it look me she that the them these they this us was we you".split())
CUES = {
    "email": frozenset("address contact correo courriel email kontakt mail reach write".split()),
    "ip": frozenset("adresse address client from host ip login server visitor".split()),
    "card": frozenset("amex card carte credit karte kreditkarte mastercard tarjeta visa".split()),
    "phone": frozenset("call cell contact fax mobile phone ruf tel telefon telefono telephone".split()),
}
AGAINST = frozenset(
    "article build chapter figure id isbn item items license number order page pages part release section table "
    "version".split()
)

CANDIDATES = (
    "array<struct<kind: int, start: long, stop: long, base: boolean, votes: int, "
    "features: array<int>, text: string>>"
)
LABELERS = ("exact form", "usual form", "check", "gazetteer", "words before", "neighbours")


class Candidate(NamedTuple):
    kind: int
    start: int
    stop: int
    base: bool
    failed: bool  # an exact match that failed its check


def luhn(digits: str) -> bool:
    odd = [int(d) for d in digits[-1::-2]]
    even = [2 * int(d) for d in digits[-2::-2]]
    return (sum(odd) + sum(d - 9 if d > 9 else d for d in even)) % 10 == 0


def _octets(parts: list[str]) -> bool:
    cut = [p.lstrip("0") or "0" for p in parts]
    return all(len(p) <= 3 and int(p) <= 255 for p in cut)


def _only_digits(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def exact_matches(text: str) -> Iterator[Candidate]:
    """The leftmost non-overlapping matches of each kind's exact pattern, with the outcome of its check."""
    at, free = text.find("@"), 0
    while at >= 0:
        head = text[free:at]
        start = len(head.rstrip(LOCAL)) + free
        found = DOMAIN.match(text, at + 1) if start < at else None
        if found:
            yield Candidate(0, start, found.end(), True, False)
        free = found.end() if found else at + 1
        at = text.find("@", free)
    for m in IP.finditer(text):
        good = _octets(m[0].split("."))
        yield Candidate(1, m.start(), m.end(), good, not good)
    for m in CARD.finditer(text):
        digits = _only_digits(m[0])
        if 14 <= len(digits) <= 19:
            good = luhn(digits)
            yield Candidate(2, m.start(), m.end(), good, not good)
    if "+" in text:
        for m in PHONE.finditer(text):
            good = 10 <= len(_only_digits(m[0])) <= 15
            yield Candidate(3, m.start(), m.end(), good, not good)


def loose_matches(text: str, digits: bool) -> Iterator[Candidate]:
    """Matches of the looser patterns; a spelled-out "at" needs a spelled-out "dot" as well."""
    if "@" in text or " at " in text or "at]" in text or "at)" in text or "at}" in text or "At" in text or "AT" in text:
        free = 0
        for m in LOOSE_AT.finditer(text):
            head = text[max(free, m.start() - 64) : m.start()]
            start = m.start() - (len(head) - len(head.rstrip(LOCAL)))
            found = LOOSE_DOMAIN.match(text, m.end()) if start < m.start() else None
            if found and (m[0].lower() != " at " or "dot" in found[0].lower()):
                yield Candidate(0, start, found.end(), False, False)
                free = found.end()
    if digits:
        for kind, pattern in ((1, LOOSE_IP), (2, LOOSE_CARD), (3, LOOSE_PHONE)):
            for m in pattern.finditer(text):
                yield Candidate(kind, m.start(), m.end(), False, False)


WORDS = re.compile(r"[^\W\d_]+")


def votes(c: Candidate, span: str, before: list[str], left: str, right: str) -> list[int]:
    """One vote for each labeler: 1 for personal data, -1 against, 0 for neither."""
    digits = _only_digits(span)
    groups = [len(g) for g in re.findall("[0-9]+", span)]
    kind = KINDS[c.kind]
    exact = 1 if c.base else -1 if c.failed else 0
    if kind == "email":
        names = re.findall("[a-z0-9-]+", span.lower())
        usual = 1 if re.search(r"[\[({] ?(?:at|@)|@", span, re.IGNORECASE) else 0
        check = 1 if names and names[-1].isalpha() and len(names[-1]) >= 2 else -1
        listed = 1 if names and (names[-1] in TOP_LEVEL or PLACES & set(names)) else -1
        listed = -1 if FUNCTION & {n for n in names if n not in ("at", "dot")} and "@" not in span else listed
    elif kind == "ip":
        parts = re.findall("[0-9]+", span)
        usual = 1 if len(parts) == 4 and all(p == str(int(p[:9])) for p in parts) else -1
        check = 1 if _octets(parts) else -1
        listed = -1 if all(len(p) == 1 for p in parts) else 1
    elif kind == "card":
        usual = 1 if len(groups) == 1 or set(groups[:-1]) == {4} or groups == [4, 6, 5] else -1
        check = 1 if 13 <= len(digits) <= 19 and luhn(digits) else -1
        listed = 1 if digits.startswith(ISSUERS) else -1
    else:
        usual = 1 if len(groups) >= 3 and groups[-1] in (3, 4) and max(groups[-3:]) <= 4 else -1
        check = 1 if 10 <= len(digits) <= 15 else -1
        listed = 1 if span.lstrip("+0(").startswith(CALLING) and "+" in span or "(" in span else 0
    near = set(before)
    words = 1 if near & CUES[kind] else -1 if near & AGAINST else 0
    glued = left.isalnum() or right.isalnum() or left in "$€£#=/\\" and left != ""
    return [exact, usual, check, listed, words, -1 if glued else 1]


def _bucket(feature: str) -> int:
    return xxhash.xxh64_intdigest(feature.encode("utf-8", "surrogatepass")) >> (64 - BITS)


def features(c: Candidate, span: str, cast: list[int], before: list[str], left: str, right: str) -> list[int]:
    """Hashed features of shape, length, votes and context.

    Votes count alike for all kinds, so what a failed check means for one is known for
    another; the vote of the exact form is left out but for its rejections.
    """
    kind = KINDS[c.kind]
    short = span if len(span) <= 80 else span[:40] + span[-40:]
    shape = re.sub("[0-9]+", lambda m: f"9{min(len(m[0]), 9)}", re.sub(r"[^\W\d_]+", "a", short))
    tokens = re.findall(r"9[0-9]|a|.", shape, re.DOTALL)
    digits = _only_digits(span)
    held = [f"kind {kind}", f"{kind} digits {min(len(digits), 24)}"]
    held += [f"vote {name} {v}" for name, v in zip(LABELERS[1:], cast[1:], strict=True)]
    held += ["vote rejected"] if cast[0] < 0 else []
    held += [f"{kind} end {re.findall('[a-z0-9]+', span.lower())[-1:]}"]
    held += [f"{kind} part {''.join(tokens[i : i + 3])}" for i in range(max(1, len(tokens) - 2))]
    held += [f"{kind} before {w}" for w in before] + [f"{kind} left {left} right {right}"]
    return sorted({_bucket(f) for f in held})


class _Spans:
    """Spans that may overlap each other, to be asked whether they meet another."""

    def __init__(self, spans: list[tuple[int, int]]):
        spans = sorted(spans)
        self.starts = [a for a, _ in spans]
        self.ends = list(accumulate((b for _, b in spans), max))

    def meet(self, start: int, stop: int) -> bool:
        at = bisect_left(self.starts, stop) - 1  # the last one that begins before `stop`
        return at >= 0 and self.ends[at] > start


def candidates(text: str) -> list[dict]:
    """Every candidate of a text; exact matches first, then loose ones that overlap no base span."""
    digits = re.search("[0-9]", text) is not None
    found = list(exact_matches(text)) if digits or "@" in text else []
    seen = {(c.kind, c.start, c.stop) for c in found}
    base = _Spans([(c.start, c.stop) for c in found if c.base])
    found += [
        c for c in loose_matches(text, digits) if (c.kind, c.start, c.stop) not in seen and not base.meet(c.start, c.stop)
    ]
    out = []
    for c in found:
        span = text[c.start : c.stop]
        before = [w.lower() for w in WORDS.findall(text[max(0, c.start - 40) : c.start])][-4:]
        left, right = text[max(0, c.start - 1) : c.start], text[c.stop : c.stop + 1]
        cast = votes(c, span, before, left, right)
        pattern = 0
        for v in cast:
            pattern = 3 * pattern + v + 1
        out.append(
            {
                "kind": c.kind, "start": c.start, "stop": c.stop, "base": c.base, "votes": pattern,
                "features": features(c, span, cast, before, left, right), "text": span,
            }
        )
    return out


def vote_table(patterns: np.ndarray) -> np.ndarray:
    """The votes (0 against, 1 none, 2 for) of each pattern number, a column for each labeler."""
    places = 3 ** np.arange(len(LABELERS) - 1, -1, -1)
    return patterns[:, None] // places % 3


def reliabilities(
    kinds: np.ndarray, patterns: np.ndarray, counts: np.ndarray, rounds: int = 50
) -> tuple[np.ndarray, np.ndarray]:
    """(probability of each vote pattern, P(right vote | truth, some vote) as kind x truth x labeler) by EM.

    Votes are taken as independent given the truth, and a labeler's silence as no
    evidence. The start is the share of votes for among those cast. Two right votes and
    one wrong one are added to each count, so a labeler never seen is thought a little
    better than chance.
    """
    votes_of = vote_table(patterns)
    cast = np.maximum((votes_of != 1).sum(1), 1)
    p = ((votes_of == 2).sum(1) + 0.5) / (cast + 1)
    right = np.zeros((len(KINDS), 2, len(LABELERS)))
    for _ in range(rounds):
        prior = np.zeros(len(KINDS))
        for k in range(len(KINDS)):
            mine = kinds == k
            for truth, q in ((1, p), (0, 1 - p)):
                weight = (counts * q)[mine]
                agreed = weight @ (votes_of[mine] == 2 * truth)
                right[k, truth] = (agreed + 2) / (weight @ (votes_of[mine] != 1) + 3)
            prior[k] = ((counts * p)[mine].sum() + 1) / (counts[mine].sum() + 2)
        true, false = right[kinds, 1], right[kinds, 0]
        evidence = np.select(
            [votes_of == 2, votes_of == 0], [np.log(true / (1 - false)), np.log((1 - true) / false)], 0.0
        )
        odds = np.log(prior[kinds] / (1 - prior[kinds])) + evidence.sum(1)
        p = _logistic(odds)
    return p, right


def train(rows: list[list[int]], targets: np.ndarray, rounds: int = 300, rate: float = 0.5) -> np.ndarray:
    """Weights of a logistic model over bags of feature numbers, fitted to probabilities by adaptive steps."""
    weights, squares = np.zeros(1 << BITS), np.full(1 << BITS, 1e-8)
    if not rows:
        return weights
    owner = np.repeat(np.arange(len(rows)), [len(r) for r in rows])
    flat = np.concatenate([np.asarray(r, np.int64) for r in rows])
    for _ in range(rounds):
        error = _logistic(np.bincount(owner, weights[flat], len(rows))) - targets
        slope = np.bincount(flat, error[owner], 1 << BITS) / len(rows) + 1e-5 * weights
        squares += slope**2
        weights -= rate * slope / np.sqrt(squares)
    return weights


def _logistic(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def fit(found: DataFrame, per_pattern: int = PER_PATTERN) -> np.ndarray:
    """The span classifier learned from the candidates of `found` (candidates array).

    The driver gets the count of each kind and vote pattern, 4 * 3^6 rows at most, and
    about `per_pattern` examples of each, unlike in their features, chosen by hash.
    """
    each = found.select(F.explode("candidates").alias("c")).select("c.kind", "c.votes", "c.features")
    unlike = cut_lineage(each.groupBy("kind", "votes", "features").agg(F.count(F.lit(1)).alias("n")))
    counts = unlike.groupBy("kind", "votes").agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("examples")).toPandas()
    if not len(counts):
        return train([], np.zeros(0))
    counts = counts.sort_values(["kind", "votes"], ignore_index=True)
    kinds, patterns = counts["kind"].to_numpy(np.int64), counts["votes"].to_numpy(np.int64)
    p, _ = reliabilities(kinds, patterns, counts["n"].to_numpy(np.float64))
    span = 1 << 30
    shares = counts[["kind", "votes"]].assign(
        share=np.minimum(span * per_pattern // counts["examples"].to_numpy(), span), target=p
    )
    small = found.sparkSession.createDataFrame(shares)
    taken = unlike.join(F.broadcast(small), ["kind", "votes"])
    taken = taken.where(F.pmod(F.xxhash64("features"), F.lit(span)) < F.col("share"))
    sample = taken.select("features", "target").toPandas()
    order = sorted(range(len(sample)), key=lambda i: (list(sample["features"][i]), sample["target"][i]))
    rows = [list(sample["features"][i]) for i in order]
    return train(rows, sample["target"].to_numpy(np.float64)[order])


SPANS = "array<struct<kind: string, start: long, stop: long, base: boolean, score: double, text: string>>"


def _chosen(found: list, weights: np.ndarray, accept: float) -> list[dict]:
    """Base spans, and accepted candidates that overlap neither these nor one with a higher score."""
    scored = [(c, float(_logistic(weights[list(c["features"])].sum()))) for c in found]
    kept = [(c, s) for c, s in scored if c["base"]]
    base = _Spans([(c["start"], c["stop"]) for c, _ in kept])
    added: list[tuple] = []
    held: list[tuple[int, int]] = []  # of those added, in order
    for c, s in sorted(scored, key=lambda x: (-x[1], x[0]["start"], x[0]["kind"])):
        against = 0 in vote_table(np.array([c["votes"]]))
        if c["base"] or s < accept or against or base.meet(c["start"], c["stop"]):
            continue
        place = bisect(held, (c["start"], c["stop"]))
        if (place == 0 or held[place - 1][1] <= c["start"]) and (place == len(held) or c["stop"] <= held[place][0]):
            held.insert(place, (c["start"], c["stop"]))
            added.append((c, s))
    whole = sorted(kept + added, key=lambda x: (x[0]["start"], x[0]["kind"], x[0]["stop"]))
    return [
        {"kind": KINDS[c["kind"]], "start": c["start"], "stop": c["stop"], "base": bool(c["base"]), "score": s, "text": c["text"]}
        for c, s in whole
    ]


def find(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", accept: float = ACCEPT) -> DataFrame:
    """(doc_id, spans) for each row of `docs`: its personal data by start, then kind.

    A span is (kind, start, stop, base, score, text), counted in code points, stop
    exclusive; kinds come in the order of KINDS. Base spans of different kinds may
    overlap. Null and empty texts have none. Rows are judged one by one, so repeated
    rows, ties and null ids each keep their row; other columns are left out. Whole
    texts are read, however long. A table without candidates, or an empty one, gives
    base spans alone. Python workers are handed fewer rows at once from then on.
    """

    @F.pandas_udf(CANDIDATES)
    def scan(series: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in series:
            yield pd.Series([candidates(t) if t else [] for t in batch], dtype=object)

    batches.small(docs.sparkSession)
    found = cut_lineage(docs.select(F.col(doc_id).alias("doc_id"), scan(F.col(text)).alias("candidates")))
    weights = fit(found).astype(np.float32)

    @F.pandas_udf(SPANS)
    def choose(series: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in series:
            yield pd.Series([_chosen(list(c), weights, accept) if len(c) else [] for c in batch], dtype=object)

    return found.select("doc_id", choose("candidates").alias("spans"))


def listed(spans: Column) -> Column:
    """`kind:start:stop` of each span, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s.kind, s.start, s.stop)), ",")


def number(spans: Column, kind: str) -> Column:
    """How many of the spans are of a kind."""
    return F.size(F.filter(spans, lambda s: s.kind == kind)).cast("long")
