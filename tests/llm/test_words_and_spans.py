"""Spelling variants, periodic runs and personal data against brute force."""

import hashlib
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from clickloom.llm import periodic, personal, queries, spelling

DOCS = "doc_id long, text string, lang string, runs string, spans string, word string, n long"
LONG = "word " * 30_000
ODD = [None, "", " \t", "a a a a a a", "One two One two One two One two", "x" * 50_000, LONG, "ñandú çà ßé"]


def lower(text):
    return (text or "").translate({i: i + 32 for i in range(65, 91)})


def split(text):
    return re.findall("[^\x20\x09-\x0d]+", text or "")


@pytest.fixture(scope="module")
def odd(spark):
    """Nulls, empty and long texts, repeated rows, one id on unlike texts, clashing column names."""
    rows = [(i, t, None, "r", "s", "w", 1) for i, t in enumerate(ODD)]
    rows += [rows[3], rows[3], (4, "other", "en", None, None, None, None), (None, ODD[3], *[None] * 5)]
    return spark.createDataFrame(rows, DOCS)


@pytest.fixture(scope="module")
def empty(odd):
    return odd.limit(0)


@pytest.fixture(scope="module")
def texts(spark):
    """(id, text) of a small table."""
    rows = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text").collect()
    return {r.doc_id: r.text for r in rows}


# 11 spelling variants


def plain_near(a, b):
    """Exactly one inserted, deleted or replaced code point."""
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    short, long = sorted((a, b), key=len)
    return len(long) - len(short) == 1 and any(long[:i] + long[i + 1 :] == short for i in range(len(long)))


def plain_variants(counts, least=5, ratio=5):
    n = {w: c for w, c in counts.items() if c >= least}
    near = {w: [v for v in n if plain_near(w, v)] for w in n}
    form = {}
    for w, found in near.items():
        best = min(found, key=lambda v: (-n[v], v), default=None)
        form[w] = best if best and n[best] >= ratio * n[w] else None
    out = []
    for w in n:
        root = w
        while form[root]:
            root = form[root]
        out.append((w, form[w], root, n[w], len(near[w]), n[form[w]] if form[w] else None))
    return sorted(out)


def as_rows(frame):
    return sorted((r.word, r.form, r.root, r.n, r.n_near, r.form_n) for r in frame.collect())


def test_variants_against_all_pairs(spark):
    rng = random.Random(5)
    words = Counter()
    for _ in range(60):
        word = "".join(rng.choice("abcdé") for _ in range(rng.randint(6, 9)))
        words[word] += rng.randint(1, 900)
        for _ in range(rng.randint(0, 5)):  # a chain of slips
            i = rng.randrange(len(word) + 1)
            word = rng.choice([word[:i] + rng.choice("abcdé") + word[i:], word[:i] + rng.choice("xyz") + word[i + 1 :], word[:i] + word[i + 1 :]])
            if len(word) >= 6:
                words[word] += rng.choice([1, 5, 6, 30, 200])
    frame = spark.createDataFrame(list(words.items()), "word string, n long")
    expected = plain_variants(words)
    assert as_rows(spelling.variants(frame)) == expected
    assert sum(r[1] is not None for r in expected) > 20 and any(r[1] != r[2] for r in expected if r[1])
    # Counts in two rows are summed; null words and an empty table.
    twice = frame.unionByName(frame).unionByName(spark.createDataFrame([(None, 9)], "word string, n long"))
    assert as_rows(spelling.variants(twice, least_count=10)) == [
        (w, f, r, 2 * n, k, m and 2 * m) for w, f, r, n, k, m in expected
    ]
    assert spelling.variants(frame.limit(0)).count() == 0


def test_near_words_share_a_signature():
    rng = random.Random(2)
    for _ in range(3000):
        word = "".join(rng.choice("aabbcdefghié") for _ in range(rng.randint(6, 14)))
        i = rng.randrange(len(word))
        for other in (word[:i] + word[i + 1 :], word[:i] + "z" + word[i:], word[:i] + rng.choice("abz") + word[i + 1 :]):
            if other != word and len(other) >= 6:
                assert set(spelling.keys(word)) & set(spelling.keys(other))


def test_chains_of_forms_end_at_their_roots(spark):
    steps = spark.createDataFrame([(f"w{i}", f"w{i + 1}") for i in range(9)] + [("a", "b")], "word string, root string")
    assert {r.word: r.root for r in spelling.roots(steps).collect()} == {f"w{i}": "w9" for i in range(9)} | {"a": "b"}


def test_words_of_odd_rows(odd, empty):
    counts = {r.word: r.n for r in spelling.count_words(odd, least_length=3).collect()}
    expected = Counter(w for r in odd.collect() for w in re.findall("[A-Za-zÀ-ÿ]+", lower(r.text)) if len(w) >= 3)
    assert counts == expected and counts["word"] == 30_000 and max(map(len, counts)) == 50_000
    assert spelling.count_words(empty).count() == 0


def test_spelling_query_counts_slips(spark, texts):
    words = Counter()
    for i, t in texts.items():
        for run, n in Counter(re.findall("[A-Za-zÀ-ÿ]+", lower(t))).items():
            h = zlib.crc32(f"{i}:{run}".encode())
            if h % 199 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            words[run] += n if len(run) >= 6 else 0
    assert as_rows(queries.op11_spelling_variants(spark, "/root/testdata/sf0.001")) == plain_variants(words)


# 12 periodic runs


def plain_runs(words, least=6, exponent=4):
    """Of each period the stretches of equal words that far apart; the smallest period only."""
    out, n = [], len(words)
    for q in range(1, n // exponent + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            size = j - i + q
            if j > i and size >= max(least, exponent * q):
                part = words[i : i + size]
                if not any(part[r:] == part[: size - r] for r in range(1, q)):
                    out.append((i, size, q))
            i = max(j, i + 1)
    return sorted(out, key=lambda r: (r[0], r[2]))


def test_runs_against_all_periods():
    rng = random.Random(0)
    for _ in range(1500):
        kinds, n = rng.choice([1, 2, 2, 3, 5]), rng.randint(0, 60)
        words = [rng.randrange(kinds) for _ in range(n)]
        if n and rng.random() < 0.5:
            a, p = rng.randrange(n), rng.randint(1, 8)
            words = [words[i if i < a else min(a + (i - a) % p, n - 1)] for i in range(n)]
        for least, exponent in ((6, 4), (2, 2), (4, 3)):
            assert periodic.runs(words, least, exponent) == plain_runs(words, least, exponent), words


def test_a_block_of_thousands_of_words_and_runs_within_runs():
    block = [*range(2000), *[7] * 9]
    found = periodic.runs(block * 5)
    assert (0, 5 * len(block), len(block)) in found and len(found) == 6
    assert found == sorted([(0, 5 * 2009, 2009)] + [(2000 + 2009 * i, 9, 1) for i in range(5)])


def plain_row(i, text):
    words = split(text)
    if i is not None and text is not None:
        h = zlib.crc32(str(i).encode())
        g, n = h // 10, len(words)
        if h % 10 == 0 and n:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [w if k < a else words[a + (k - a) % p] for k, w in enumerate(words)]
    found = plain_runs(words)
    dropped = {k for s, n, q in found for k in range(s + q, s + n)}
    best = min(found, key=lambda r: (-r[1], r[0], r[2]), default=None)
    sha = lambda x: hashlib.sha256(x.encode()).hexdigest()
    return (
        i, len(found), *(best or (None,) * 3), 1000 * best[1] // best[2] if best else None,
        sha("".join(f"{s},{n},{q}\n" for s, n, q in found)), sha(" ".join(w for k, w in enumerate(words) if k not in dropped)),
    )


def test_runs_query_against_all_periods(spark, texts):
    short = {i: t for i, t in texts.items() if len(split(t)) < 1500}
    got = {r.doc_id: tuple(r) for r in queries.op12_periodic_runs(spark, "/root/testdata/sf0.001").collect()}
    assert set(got) == set(texts) and len(short) > 100
    for i, t in short.items():
        assert got[i] == plain_row(i, t)
    assert sum(r[1] > 0 for r in got.values()) > 5


def test_runs_of_odd_rows(odd, empty):
    rows = periodic.find_runs(odd).collect()
    assert len(rows) == odd.count()
    for r in rows:
        if len(r.text or "") < 10_000:
            found = plain_runs(split(r.text))
            assert [(x.start, x.length, x.period) for x in r.runs] == found
        assert r.text or r.collapsed == ""
    long = next(r for r in rows if r.text == LONG)
    assert [tuple(x) for x in long.runs] == [(0, 30_000, 1)] and long.collapsed == "word"
    assert set(periodic.find_runs(odd).columns) == {*odd.columns, "collapsed"}
    assert periodic.find_runs(empty).count() == 0


# 13 personal data


BASE = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def plain_luhn(digits):
    twice = [int(c) * (1 + i % 2) for i, c in enumerate(reversed(digits))]
    return sum(x // 10 + x % 10 for x in twice) % 10 == 0


def plain_base(text):
    out = []
    for rank, (kind, pattern) in enumerate(BASE.items()):
        for m in re.finditer(pattern, text or ""):
            digits = re.sub("[^0-9]", "", m[0])
            good = {
                "email": lambda m=m: True,
                "ip": lambda m=m: all(int(p) <= 255 for p in m[0].split(".")),
                "card": lambda d=digits: 14 <= len(d) <= 19 and plain_luhn(d),
                "phone": lambda d=digits: 10 <= len(d) <= 15,
            }[kind]()
            if good:
                out.append((m.start(), rank, kind, m.end()))
    return [(kind, a, b) for a, _, kind, b in sorted(out)]


def test_base_spans_against_the_patterns():
    rng = random.Random(1)
    pieces = ["a", "1", "25", ".", ".", "@", "-", " ", "+", "(", ")", "é", "at", "dot", "4485 4190 6118 7462", "1.2.3.4", "300", "x@y.com", "_"]
    for _ in range(20_000):
        text = "".join(rng.choice(pieces) for _ in range(rng.randint(0, 25)))
        got = sorted((c.start, c.kind, c.stop) for c in personal.exact_matches(text) if c.base)
        assert [(personal.KINDS[k], a, b) for a, k, b in got] == plain_base(text), text


def test_personal_data_query_against_the_patterns(spark, texts):
    rows = {r.doc_id: r for r in queries.op13_personal_data(spark, "/root/testdata/sf0.001").collect()}
    assert set(rows) == set(texts)
    for i, t in texts.items():
        base = plain_base(t)
        joined = ",".join(f"{k}:{a}:{b}" for k, a, b in base)
        assert rows[i].base_sha256 == hashlib.sha256(joined.encode()).hexdigest()
        assert [rows[i][f"n_{k}"] for k in BASE] == [sum(x[0] == k for x in base) for k in BASE]
        assert set(filter(None, joined.split(","))) <= set(filter(None, rows[i].spans.split(",")))


HIDDEN = {
    "jane.doe [at] mail [dot] example [dot] com": "email", "jane.doe(at)mail3.example.com": "email",
    "jane at mail dot example dot com": "email", "(136) 555-7479": "phone", "136-555-7479": "phone",
    "+1 (136) 555-7479 36985214": "phone",
    "120 . 121 . 90 . 252": "ip", "120[.]121[.]90[.]252": "ip", "4485.4190.6118.7462": "card",
}
PLAIN = ["300.1.2.3", "4485.4190.6118.7469", "Version 2.0.", "look at the dot com", "10.000.000", "pages 100-200-3000", "9777946427004852"]


def test_hidden_forms_are_added_and_plain_ones_left_alone(spark, texts):
    rows = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text").collect()
    learned = [(r.doc_id, r.text) for r in rows]
    planted = [(-1 - k, f"the of and {s} than her") for k, s in enumerate([*HIDDEN, *PLAIN])]
    frame = spark.createDataFrame(learned + planted, "doc_id long, text string")
    found = {r.doc_id: r.spans for r in personal.find(frame).collect()}
    assert len(found) == len(learned) + len(planted)
    for k, (s, kind) in enumerate(HIDDEN.items()):
        wanted = s.removesuffix(" 36985214")  # the exact pattern takes both numbers and fails
        assert [(x.kind, x.text, x.base) for x in found[-1 - k]] == [(kind, wanted, False)], s
    for k, s in enumerate(PLAIN, len(HIDDEN)):
        assert found[-1 - k] == [], s
    added = sum(not x.base for i in found if i >= 0 for x in found[i])
    assert added <= 0.02 * sum(len(found[i]) for i in found if i >= 0)


def test_reliabilities_recover_drawn_labelers():
    rng = np.random.default_rng(4)
    truth = rng.random(20_000) < 0.3
    right = np.array([0.95, 0.9, 0.85, 0.8, 0.6, 0.75])
    votes = np.where(rng.random((len(truth), 6)) < right, truth[:, None], ~truth[:, None]) * 2
    votes[rng.random(votes.shape) < 0.2] = 1
    patterns, counts = np.unique(votes @ 3 ** np.arange(5, -1, -1), return_counts=True)
    p, found = personal.reliabilities(np.zeros(len(patterns), int), patterns, counts.astype(float))
    assert np.allclose(found[0], right, atol=0.03)
    at = np.searchsorted(patterns, votes @ 3 ** np.arange(5, -1, -1))
    assert np.mean((p[at] > 0.5) == truth) > 0.95


def test_personal_data_of_odd_rows(spark, odd, empty):
    rows = personal.find(odd).collect()
    assert len(rows) == odd.count() and all(r.spans == [] for r in rows)
    assert personal.find(empty).count() == 0
    few = spark.createDataFrame([(1, "a@b.com"), (1, "a@b.com"), (None, "1.2.3.4 and a@b.com"), (2, None)], "doc_id long, text string")
    got = sorted(((r.doc_id or 0), [(x.kind, x.start, x.stop, x.base) for x in r.spans]) for r in personal.find(few).collect())
    mail = [("email", 0, 7, True)]
    assert got == [(0, [("ip", 0, 7, True), ("email", 12, 19, True)]), (1, mail), (1, mail), (2, [])]
    text = few.select(personal.listed(F.lit(None).cast(personal.SPANS)).alias("x")).first().x
    assert text is None


@pytest.mark.parametrize("text", ["1" * 200_000, "+1" + " " * 200_000, "a" * 200_000 + "@", "@a" * 100_000, "1 " * 100_000, "(at)a" * 40_000])
def test_long_texts_take_linear_time(text):
    assert len(personal.candidates(text)) <= 1
