"""The operators over training text against brute force, exact round trips and held-out rows."""

import functools
import hashlib
import itertools
import random
import time
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
import xxhash
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from clickloom.llm import (
    chat,
    codes,
    components,
    exact_dedup,
    html_text,
    language,
    minhash,
    mixing,
    packing,
    pages,
    quality,
    queries,
    samples,
    simhash,
    toxicity,
)

DOCS = "doc_id long, text string, lang string, source string, n_chars long, score double, size string, rank int"
ODD = [None, "", " \t", "One", "one", "Two words", "two  words\n", "x" * 5_000, "ab " * 5_000, "naïve ßtraße end"]


def lower(text):
    return (text or "").translate({i: i + 32 for i in range(65, 91)})


@pytest.fixture(scope="module")
def odd(spark):
    """Nulls in any column, empty and long texts, ties, repeated rows, clashing column names."""
    rows = [(i, t, "en" if i % 2 else None, f"s{i % 3}" if i % 4 else None, 1, 0.5, "big", 1) for i, t in enumerate(ODD)]
    rows += [rows[5], rows[5], (3, "Other", "en", "s0", 2, None, None, None), (None, "One", None, None, None, None, None, None)]
    return spark.createDataFrame(rows, DOCS)


@pytest.fixture(scope="module")
def empty(odd):
    return odd.limit(0)


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet("/root/testdata/sf0.001/documents.parquet")


@pytest.fixture(scope="module")
def larger(spark):
    return "/root/testdata/sf0.01"


def test_folds_follow_the_checksum_of_the_id(spark):
    found = spark.range(50).select("id", samples.in_fold(F.col("id"), 4, 2).alias("f")).collect()
    assert all(r.f == (zlib.crc32(str(r.id).encode()) % 4 == 2) for r in found)


# 1 language


def test_language_on_held_out_rows(spark, larger):
    found = queries.op1_language_id(spark, larger)
    truth = spark.read.parquet(f"{larger}/documents.parquet").select("doc_id", "lang")
    rows = found.join(truth, "doc_id").where("held_out").collect()
    assert np.mean([r.lang_pred == r.lang for r in rows]) > 0.97
    assert all(0 <= r.score <= 1 for r in rows)


def test_language_of_odd_rows(odd, empty):
    model = language.train(["the cat of the house", "le chat de la maison"] * 5, ["en", "fr"] * 5)
    rows = language.identify(odd, model).collect()
    assert len(rows) == odd.count()
    for r in rows:
        none = not any(c.isalpha() for c in r.text or "")
        assert (r.lang_pred == "und") == none
        assert r.lang_pred in ("und", "en", "fr") and (not none or r.rejected)
    assert language.identify(empty, model).count() == 0
    assert language.predict(language.train([], []), ["word"])["lang_pred"].tolist() == ["und"]


def test_language_rejects_what_it_does_not_know(docs):
    rows = docs.select("text", "lang").collect()
    model = language.train([r.text for r in rows], [r.lang for r in rows])
    found = language.predict(model, [r.text for r in rows])
    assert found["rejected"].mean() < 0.1
    assert language.predict(model, ["кот и дом на горе"])["rejected"][0] or found["score"].median() > 0.99


def test_character_ngrams_against_slices():
    texts = ["ab cab", "", "b a"]
    stream = codes.Stream(texts)
    blank = ~codes.letters()[stream.codes]
    got = Counter()
    for n, (at, bucket) in zip((2, 3), codes.character_ngrams(stream.codes, blank, (2, 3), 20), strict=True):
        got.update(zip(stream.text_of(at + 1).tolist(), itertools.repeat(n), bucket.tolist()))
    expected = defaultdict(int)
    for i, t in enumerate(texts):
        for word in t.split():
            padded = f" {word} "
            for n in (2, 3):
                for k in range(len(padded) - n + 1):
                    expected[i, n, padded[k : k + n]] += 1
    assert sorted(Counter(got.values()).items()) == sorted(Counter(expected.values()).items())
    assert sum(got.values()) == sum(expected.values())


def test_long_texts_go_in_pieces_and_count_whole():
    text = "word " * 1000
    parts = list(codes.pieces([text, None, "x" * 300], limit=100))
    assert "".join(t for rows, ts in parts for r, t in zip(rows, ts, strict=True) if r == 0) == text
    assert "".join(t for rows, ts in parts for r, t in zip(rows, ts, strict=True) if r == 2) == "x" * 300


# 2 near duplicates


def plain_fingerprint(text, words=3):
    parts = lower(text).encode().split()
    if not parts:
        return 0
    size = min(words, len(parts))
    h = [xxhash.xxh64_intdigest(b" ".join(parts[i : i + size]), 42) for i in range(len(parts) - size + 1)]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def plain_components(pairs, bits=3):
    """pairs of (id, fingerprint) -> smallest id reachable, by comparing all."""
    found = {i: i for i, _ in pairs}

    def root(x):
        while found[x] != x:
            x = found[x]
        return x

    for (a, x), (b, y) in itertools.combinations(pairs, 2):
        if (x ^ y).bit_count() <= bits:
            ra, rb = root(a), root(b)
            found[max(ra, rb)] = min(ra, rb)
    return {i: root(i) for i, _ in pairs}


def test_fingerprint_against_one_hash_at_a_time(spark):
    for text in [*ODD, "A b c d", "A b c D e f g a b c"]:
        assert simhash.fingerprint(text) == plain_fingerprint(text)
    native = spark.range(1).select(F.xxhash64(F.lit("a b ñ"))).first()[0]
    assert native % (1 << 64) == xxhash.xxh64_intdigest("a b ñ".encode(), 42)


def test_near_duplicates_against_all_pairs(spark, larger):
    docs = spark.read.parquet(f"{larger}/documents.parquet").select("doc_id", "text").collect()
    pairs = [(r.doc_id, plain_fingerprint(r.text)) for r in docs]
    expected = plain_components(pairs)
    got = queries.op2_simhash_near_dedup(spark, larger).collect()
    assert {r.doc_id: int(r.fingerprint, 16) for r in got} == dict(pairs)
    assert {r.doc_id: r.component_id for r in got} == expected


@pytest.mark.parametrize("block", [4, 2048])
def test_links_in_crowded_cells(spark, block):
    rng = np.random.default_rng(3)
    centre = rng.integers(0, 1 << 63, 6)
    fps = set()
    for c in centre.tolist():
        for _ in range(60):
            x = c
            for bit in rng.integers(0, 63, rng.integers(0, 7)).tolist():
                x ^= 1 << bit
            fps.add(x)
    fps = sorted(fps | {0, 1, 7, 15, -1 & ((1 << 63) - 1)})
    frame = spark.createDataFrame([(x,) for x in fps], "fp long")
    edges = simhash.links(frame, 3, block)
    assert all(((r.u ^ r.v) % (1 << 64)).bit_count() <= 3 for r in edges.collect())
    roots = {r.node: r.root for r in components.components(edges).collect()}
    assert {x: roots.get(x, x) for x in fps} == plain_components([(x, x) for x in fps])


def test_components_of_a_long_chain(spark):
    edges = [(i, i + 1) for i in range(0, 300)] + [(1000, 1001), (7, 7)]
    found = components.components(spark.createDataFrame(edges, "u long, v long")).collect()
    assert {r.node: r.root for r in found} == {i: 0 for i in range(301)} | {1000: 1000, 1001: 1000}
    assert components.components(spark.createDataFrame([], "u long, v long")).count() == 0


def test_near_duplicates_of_odd_rows(odd, empty):
    rows = simhash.near_duplicates(odd).collect()
    assert len(rows) == odd.count()
    zero = {r.id for r in rows if r.simhash == 0}
    assert {0, 1, 2} <= zero and {r.component_id for r in rows if r.id in (0, 1, 2)} == {0}
    kept = simhash.keep_one(odd)
    assert kept.columns == odd.columns
    of = components_of_rows(odd.collect())
    assert sorted(of[r.text] for r in kept.collect()) == sorted(set(of.values()))
    assert simhash.near_duplicates(empty).count() == 0 and simhash.keep_one(empty).count() == 0


def components_of_rows(rows):
    """{text: component} by all pairs of fingerprints."""
    prints = {r.text: plain_fingerprint(r.text) for r in rows}
    roots = plain_components([(f, f) for f in set(prints.values())])
    return {t: roots[f] for t, f in prints.items()}


def test_each_component_keeps_one_row_where_ids_repeat(spark, odd):
    rows = odd.collect()
    of = components_of_rows(rows)
    kept = simhash.keep_one(odd).collect()
    assert Counter(of[r.text] for r in kept) == Counter(set(of.values()))
    assert {(r.doc_id, r.text) for r in kept if r.doc_id == 3} == {(3, "One"), (3, "Other")}
    # Id 5 is the smallest of one component alone; its other row is no survivor in place of it.
    plain = [(3, "m n o p"), (5, "M n o p"), (5, "z y x w"), (5, "z  y x W"), (None, "z y x w"), (7, "z y x w")]
    frame = spark.createDataFrame(plain, "doc_id long, text string")
    got = sorted(map(tuple, simhash.keep_one(frame).collect()))
    assert got == [(3, "m n o p"), (5, "z  y x W")]


def test_a_component_without_ids_keeps_one_row(spark):
    lone = [(None, "a b c"), (None, "a b c"), (None, "A  b c"), (4, "d e f g"), (None, "d e f g"), (None, None)]
    frame = spark.createDataFrame(lone, "doc_id long, text string")
    kept = sorted((r.doc_id, r.text or "") for r in simhash.keep_one(frame).collect() if r.doc_id)
    rest = sorted(r.text or "" for r in simhash.keep_one(frame).collect() if r.doc_id is None)
    assert kept == [(4, "d e f g")] and rest == ["", "A  b c"]


# 3 quality, 6 toxicity


@pytest.mark.parametrize("name, label, at, parts, fold", [("op3_quality", "quality", 0.7, 4, 2), ("op6_toxicity", "toxic", 0.5, 5, 0)])
def test_classifiers_on_held_out_rows(spark, larger, name, label, at, parts, fold):
    rows = queries.queries()[name](spark, larger)
    labels = spark.read.parquet(f"{larger}/labels.parquet")
    found = rows.join(labels, "doc_id").where("held_out").collect()
    assert all(zlib.crc32(str(r.doc_id).encode()) % parts == fold for r in found)
    assert all(r.predicted == int(r.score >= at) and 0 <= r.score <= 1 for r in found)
    assert np.mean([r.predicted == r[label] for r in found]) > 0.93


def test_classifiers_on_odd_rows(odd, empty):
    good, bad = ["a plain line of text here", "some other words stand there"], ["BUY!! NOW!! BUY!!", "x%% y%% z%%"]
    model = quality.train(good * 6 + bad * 6, [1] * 12 + [0] * 12)
    rows = quality.score(odd, model).collect()
    assert len(rows) == odd.count() and all(0 <= r.score <= 1 for r in rows)
    assert len({r.score for r in rows if not (r.text or "").strip()}) == 1
    assert (quality.predict(model, good) > 0.7).all() and (quality.predict(model, bad) < 0.5).all()
    assert quality.score(empty, model).count() == 0
    assert quality.predict(quality.train([], []), ["word"])[0] == 0.5
    toxic = toxicity.train(["you idiot there", "calm words here"] * 12, [1, 0] * 12)
    assert toxicity.predict(toxic, [None, "", " "]).tolist() == [0, 0, 0]
    assert toxicity.score(odd, toxic).count() == odd.count() and toxicity.score(empty, toxic).count() == 0


def test_one_insult_and_a_misspelling_are_found_in_a_long_text(spark, larger):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{larger}/documents.parquet").collect()}
    labels = spark.read.parquet(f"{larger}/labels.parquet").collect()
    clean = [docs[r.doc_id] for r in labels if not r.toxic]
    rng = np.random.default_rng(5)
    apart, learned = clean[:50], clean[50:]
    toxic = []
    for t in learned:
        words = t.split(" ")
        words.insert(int(rng.integers(0, len(words))), ["idiot", "blockhead"][len(toxic) % 2])
        toxic.append(" ".join(words))
    model = toxicity.train(learned + toxic, [0] * len(learned) + [1] * len(toxic))
    assert (toxicity.predict(model, apart) > 0.5).mean() <= 0.04
    bent = {
        "plain": ["blockhead", "idiot"], "replaced": ["bl0ckhead", "blo*khead", "blockh3ad"],
        "dropped": ["blckhead", "blockhed", "bockhead"], "doubled": ["bloockhead", "blockkhead", "blockheaad"],
        "spaced": [" ".join("blockhead"), " ".join("idiot")],
    }
    found = {
        kind: (toxicity.predict(model, [f"{t} {w} {apart[-1]}" for t in apart[:20] for w in words]) > 0.5).mean()
        for kind, words in bent.items()
    }
    assert min(found.values()) >= 0.9, found
    very_long = " ".join(learned * 9)[:500_000]
    assert len(very_long) > 262_144 and toxicity.predict(model, [very_long])[0] < 0.5
    assert toxicity.predict(model, ["blockhead " + very_long])[0] > 0.5


def test_toxicity_is_the_softmax_of_one_weighted_bag():
    """Scores against sums in plain Python, whole texts cut into pieces or not."""
    model = toxicity.train(["you idiot there", "calm words here"] * 12, [1, 0] * 12)
    texts = ["calm idiot words", "you you there", "i d i o t here", "x", "calm\tIDIOT  here\n"]
    scores = toxicity.predict(model, texts)
    for text, score in zip(texts, scores):
        logits, weights = [], []
        for word in text.lower().replace("i d i o t", "idiot").split():
            stream, starts, grams = toxicity._words([word], model.settings)
            buckets = np.concatenate([b for _, b in grams])
            assert len(starts) == 1
            logits.append(model.toxic[buckets].astype(float).mean())
            weights.append(np.exp(model.weight[buckets].astype(float).mean()))
        logit = np.dot(logits, weights) / np.sum(weights) + model.bias
        assert score == pytest.approx(1 / (1 + np.exp(-logit)), abs=1e-6)
    long = "calm words here " * 40_000
    short = toxicity.predict(model, ["calm words here " * 4])[0]
    assert toxicity.predict(model, [long])[0] == pytest.approx(short, abs=1e-6)


# 4 mixing


def check_mix(rows):
    total = sum(r.size for r in rows)
    by = defaultdict(list)
    for r in rows:
        by[r.source].append(r)
    names = sorted((s for s in by if s is not None), key=lambda s: [ord(c) for c in s]) + [None] * (None in by)
    weight = {s: i % 3 + 1 for i, s in enumerate(names)}
    cap = {s: 3 * sum(r.size for r in by[s]) for s in names}
    capped = set()
    while True:
        free = [s for s in names if s not in capped]
        left = total - sum(cap[s] for s in capped)
        share = {s: left * weight[s] / sum(weight[f] for f in free) for s in free}
        over = {s for s in free if share[s] > cap[s]}
        if not over:
            break
        capped |= over
    for s in names:
        target = share.get(s, cap[s])
        assert {r.source_size for r in by[s]} == {cap[s] // 3}
        assert all(abs(r.target - target) < 1e-6 * max(1, target) for r in by[s])
        taken = sum(r.copies * r.size for r in by[s])
        assert abs(taken - target) <= max(r.size for r in by[s])
        if cap[s]:
            p = target / (cap[s] / 3)
            assert all(r.copies in (int(p), int(p) + 1) or abs(p - round(p)) < 1e-9 for r in by[s] if r.size)
    assert all(0 <= r.copies <= 3 for r in rows)


def test_mix_meets_its_targets(spark, larger):
    docs = spark.read.parquet(f"{larger}/documents.parquet")
    first = mixing.mix(docs)
    rows = first.collect()
    assert len(rows) == 1000
    check_mix(rows)
    again = mixing.mix(docs.repartition(5)).collect()
    assert sorted(map(tuple, rows)) == sorted(map(tuple, again))
    kept = mixing.apply_mix(docs, first)
    assert kept.columns == docs.columns
    expected = {r.doc_id: r.copies for r in rows if r.copies}
    assert {r.doc_id: r["count"] for r in kept.groupBy("doc_id").count().collect()} == expected


def test_fractions_decide_on_average(spark):
    rows = [(i, "s", " ".join(["w"] * (i % 7 + 1))) for i in range(40)] + [(99, "t", "w " * 400)]
    docs = spark.createDataFrame(rows, "doc_id long, source string, text string").coalesce(2)
    tally = Counter()
    for seed in range(12):
        for r in mixing.mix(docs, seed=seed).collect():
            tally[r.source] += r.copies * r.size
    target = {r.source: r.target for r in mixing.mix(docs).collect()}
    assert abs(tally["s"] / 12 - target["s"]) <= 7 and abs(tally["t"] / 12 - target["t"]) <= 250


def test_mix_of_odd_rows(odd, empty):
    rows = mixing.mix(odd).collect()
    assert len(rows) == odd.count()
    check_mix(rows)
    assert mixing.mix(empty).count() == 0 and mixing.apply_mix(empty, mixing.mix(empty)).count() == 0
    assert mixing.apply_mix(odd, mixing.mix(odd)).count() == sum(r.copies for r in rows)


# 5 pages


@functools.lru_cache(maxsize=1)
def field_model():
    return html_text.default_model()


def test_main_text_of_unseen_layouts():
    model = field_model()
    right = every = 0
    for page, main in pages.labelled_pages(60, seed=11):
        chain = html_text.blocks(page)
        labels = model.viterbi(html_text.features(chain)) if chain else []
        right += sum(label == (b.text in main) for b, label in zip(chain, labels, strict=True))
        every += len(chain)
    assert right / every > 0.98


def test_main_text_is_whole_and_decoded(spark):
    page = (
        "<html><head><title>T</title><style>p{}</style></head><body><nav><a href='/'>Home</a></nav>"
        "<div class='cookie-banner'>We use cookies</div><article><h1>A  title</h1><p>First &amp; best\n line <b>bold</b>er"
        "<p>Caf&eacute; &#65;&lt;b&gt;<br>next<script>var t='</p>';</script></p><form><label>Mail</label></form>"
        "<div class='comments'><p>I like it</p></div></article><footer>&copy; me</footer>"
    )
    expected = "A title\nFirst & best line bolder\nCafé A<b> next"
    rows = [(1, page, "x"), (2, None, None), (3, "", ""), (4, "<script>x", None), (1, page, "x"), (5, "<p", None)]
    frame = spark.createDataFrame(rows, "page_id long, html string, text string")
    model = field_model()
    found = html_text.extract(frame, model)
    assert found.columns == frame.columns
    assert [r.text for r in found.orderBy("page_id").collect()] == [expected, expected, "", "", "", ""]
    assert html_text.extract(frame.limit(0), model).count() == 0
    long = html_text.main_text("<article>" + "".join(f"<p>Line {i} of it.</p>" for i in range(20_000)), model)
    assert long.count("\n") == 19_999


@pytest.mark.parametrize("opening", [
    'div aria-hidden="false"', 'article title="A hidden valley"', 'section data-src="/hidden/x.png"',
    "article data-style='display:none'", 'p title="style=display:none"', 'div style="--no-display:none"', "div hidden=until-found",
])
def test_only_attributes_that_hide_hide(opening):
    assert [b.text for b in html_text.blocks(f"<{opening}>Seen text.")] == ["Seen text."]


def test_hints_are_read_attribute_by_attribute():
    for hiding in ("hidden", "HIDDEN=''", 'id=x hidden="hidden"', 'style="color:red; display : none"', "style=visibility:hidden"):
        unseen, seen = html_text.blocks(f"<div {hiding}>Unseen.</div><p>Seen.")
        assert unseen.text == "Unseen." and html_text.HIDING in unseen.path[-1][1]
        assert seen == html_text.Block((("p", frozenset()),), "Seen.")
    tag = """<a data-id="nav" href="/x?class=ad&id=menu" class = 'Post  body' ID=main class="late" title="role='banner'">"""
    assert html_text._hints(tag) == {"post", "body", "main", "=post", "=body", "=main"}
    assert html_text._hints('<div class="ad-free">') == {"ad", "free", "=ad-free"}


def test_a_slash_closes_no_element_of_html():
    page = '<p>a b.</p><script src="a.js"/>alert(1)</script><style />p{}</style ><div/>c<svg/><b/>d<math><mi/>e</math>'
    assert [b.text for b in html_text.blocks(page)] == ["a b.", "c de"]
    assert html_text.blocks("<p>x<script/>y</p>") == [html_text.Block((("p", frozenset()),), "x")]
    assert html_text.blocks("<div/>c")[0].path == (("div", frozenset()),)


@pytest.mark.parametrize("page", [
    "<font>x<hr>" * 90_000, "<div><font size=1>x" * 50_000, "<b><div>" + "<font>" * 100_000 + "</b>" * 100_000,
    "<p>x<li>" * 100_000, "".join(f"<div class=c{i}>x" for i in range(20_000)),
])
def test_a_page_of_unclosed_elements_takes_linear_time(page):
    begun = time.process_time()
    html_text.features(html_text.blocks(page))
    assert time.process_time() - begun < 10


def plain_layouts():
    """Pages of a second grammar, with the main text of each: no word of it is one the field has learned."""
    rng = random.Random(21)
    nouns = "river stone market window letter garden engine morning silver bridge".split()

    def line(least=5, most=25):
        words = [rng.choice(nouns) for _ in range(rng.randint(least, most))]
        return " ".join(words).capitalize() + rng.choice([".", ".", "?", ", she said."])

    def menu():
        return " ".join(f'<a href="/{n}">{n.title()}</a>' for n in rng.sample(nouns, rng.randint(2, 6)))

    for _ in range(200):
        text = [line() for _ in range(rng.choice([1, 2, 2, 3, 4, 8]))]
        paragraphs = "".join(f"<p>{t}</p>" for t in text)
        box = rng.choice(["div", "div id=x1", 'div class="c12"', 'div class="ad-free"', 'div class="story-content"', 'section id="k9"', "body"])
        page = f"<{box}>{paragraphs}</{box.split()[0]}>"
        kind = rng.random()
        if kind < 0.3:
            page = f"<nav>{menu()}</nav>{page}"
        elif kind < 0.5:
            page = f"<table><tr><td>{menu()}</td><td>{page}</td></tr></table>"
        elif kind < 0.6:
            page = f"<ul><li>{menu()}</li></ul>{page}"
        if rng.random() < 0.4:
            page += rng.choice([f"<footer>{line(2, 5)}</footer>", f'<div class="comments"><p>{line()}</p></div>', f"<form><label>{line(1, 3)}</label></form>"])
        if rng.random() < 0.3:
            page = f'<script src="/x.js"/>var a = "{line()}";</script>{page}<style/>p{{}}</style>'
        yield page, text


def test_main_text_of_a_second_grammar():
    model, worst, total = field_model(), 1.0, 0.0
    pages_ = list(plain_layouts())
    for page, text in pages_:
        got, wanted = html_text.main_text(page, model).split(), " ".join(text).split()
        assert got, page
        both = sum((Counter(got) & Counter(wanted)).values())
        f1 = 2 * both / (len(got) + len(wanted))
        worst, total = min(worst, f1), total + f1
    assert total / len(pages_) >= 0.98 and worst >= 0.95, (total / len(pages_), worst)


@pytest.mark.parametrize(("page", "text"), [
    ("<div id=x1><p>First para of text here.</p><p>Second para, with more.</p></div>", "First para of text here.\nSecond para, with more."),
    ("<html><body><p>Plain text only.</p></body></html>", "Plain text only."),
    ('<div class="story-content"><p>One para here.</p><div class="ad-free"><p>Two para here.</p></div></div>', "One para here.\nTwo para here."),
    ('<table><tr><td><a href="/">Home</a></td><td><p>Article text stands here, in a cell.</p></td></tr></table>', "Article text stands here, in a cell."),
    ("<article><p>Lead text.</p><div style='display:none'><p>More text, opened on a click.</p></div></article>", "Lead text.\nMore text, opened on a click."),
])
def test_main_text_of_plain_layouts(page, text):
    assert html_text.main_text(page, field_model()) == text


@pytest.mark.parametrize("tag", ["object", "canvas", "svg", "math", "noscript", "template"])
def test_an_unclosed_element_loses_nothing_behind_it(tag):
    for page in (f"<article><{tag}><p>Line one.</p><p>Line two.</p></article>", f"<p>Line one.<{tag}></p><p>Line two.<{tag}></{tag}>"):
        assert [b.text for b in html_text.blocks(page)] == ["Line one.", "Line two."]


def test_formulas_and_fallback_texts_are_blocks():
    page = (
        "<p>So <math><mi>x</mi><mo>=</mo><mn>2</mn></math>.</p><canvas><p>A chart.</p></canvas><p>a<object>b</object>c"
        "<div><noscript>Plain.</noscript></div><p>Seen <svg><svg></svg><text>no</text></svg><template><p>no</template>end."
    )
    assert [b.text for b in html_text.blocks(page)] == ["So x=2.", "A chart.", "a b c", "Plain.", "Seen end."]
    assert html_text.blocks("<iframe><p>no") == html_text.blocks("<title>no<p>no") == []


def test_viterbi_against_all_labellings():
    rng = np.random.default_rng(2)
    model = html_text.Field(rng.normal(size=(1 << html_text.BITS, 2)), rng.normal(size=(2, 2)), rng.normal(size=2))
    chain = [rng.integers(0, 1 << html_text.BITS, 3).tolist() for _ in range(7)]
    scores = model.scores(chain)

    def value(ls):
        return model.begin[ls[0]] + sum(scores[i, y] for i, y in enumerate(ls)) + sum(
            model.step[a, b] for a, b in itertools.pairwise(ls))

    assert tuple(model.viterbi(chain)) == max(itertools.product((0, 1), repeat=7), key=value)


# 7 packing


def check_pack(rows, texts, capacity=2048):
    """texts: (doc_id, text) pairs, repeated rows included."""
    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    expected = Counter()
    for doc, text in texts:
        ids = [*tokenizer.encode(text or "", add_special_tokens=False).ids, 0]
        first = len(ids) % capacity or capacity
        cuts = [0, *range(first, len(ids), capacity), len(ids)]
        for piece, (a, b) in enumerate(itertools.pairwise(cuts)):
            held = np.array(ids[a:b], "<u4").tobytes()
            expected[doc, piece, a, b - a, zlib.crc32(held)] += 1
            assert b - a == capacity or piece == 0
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in rows) == expected
    sequences = defaultdict(list)
    for r in rows:
        sequences[r.sequence_id].append((r.offset, r.length))
    for spans in sequences.values():
        spans.sort()
        assert spans[0][0] == 0 and sum(n for _, n in spans) <= capacity
        assert all(a + n == b for (a, n), (b, _) in itertools.pairwise(spans))
    return len(sequences), -(-sum(r.length for r in rows) // capacity)


def test_pack_is_whole_and_tight(spark, larger):
    docs = spark.read.parquet(f"{larger}/documents.parquet")
    used, least = check_pack(packing.pack(docs).collect(), [(r.doc_id, r.text) for r in docs.collect()])
    assert used <= least * 1.02 + 1


def test_pack_of_odd_rows(odd, empty):
    rows = packing.pack(odd).collect()
    check_pack(rows, [(r.doc_id, r.text) for r in odd.collect()])
    assert packing.pack(empty).count() == 0
    assert all(zlib.crc32(r.ids) == r.ids_crc32 and len(r.ids) == 4 * r.length for r in rows)


@pytest.mark.parametrize("seed", range(8))
def test_plan_places_every_piece(seed):
    rng = np.random.default_rng(seed)
    counts = {int(n): int(rng.integers(1, 40)) for n in rng.integers(1, 33, 12)}
    table = packing.plan(counts, 32)
    used = defaultdict(list)
    for length, n in counts.items():
        mine = table[table[:, 0] == length]
        for i in range(n):
            row = mine[np.searchsorted(mine[:, 1], i, "right") - 1]
            used[row[2] + i - row[1]].append((row[3], length))
    for spans in used.values():
        spans.sort()
        assert spans[0][0] == 0 and all(a + n == b for (a, n), (b, _) in itertools.pairwise(spans))
        assert sum(n for _, n in spans) <= 32 and sum(3 * n > 32 for _, n in spans) <= 2


def test_added_tokens_as_a_plain_call_gives_them(spark):
    texts = ["a <|endoftext|> b", "<|endoftext|>", "x<|endoftext|>\n y", "<|endoftext"]
    rows = packing.pack(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()
    check_pack(rows, list(enumerate(texts)))
    assert np.frombuffer(next(r.ids for r in rows if r.doc_id == 0), "<u4").tolist() == [64, 220, 50256, 275, 0]


def test_ids_of_drawn_texts_against_an_untouched_tokenizer():
    path = public_tokenizers.path("byte_bpe_50k.json")
    plain, coder, rng = Tokenizer.from_file(path), packing.Encoder(path), random.Random(3)
    parts = ["the", " ", "  ", "\n", "\t", "a", "'s", "'ll", "don't", "<|endoftext|>", "<|end", "1", "23", "é", "ß", "Å", "×", "÷",
             "ñ", "漢", "😀", ".", ",", "!!", "\r\n", "\x0b", "\xa0", "\x85", "ª", "µ", "²", "'", '"', "-", "İ", " ", "\x1c"]
    assert coder.quick is not None
    for _ in range(15_000):
        text = "".join(rng.choice(parts) for _ in range(rng.randint(0, 14)))
        assert np.frombuffer(coder.ids([text])[0], "<u4").tolist() == plain.encode(text, add_special_tokens=False).ids, text


def test_pieces_and_their_numbers():
    totals = np.array([1, 8, 9, 16, 25])
    doc, piece, start, length = packing.cut_lengths(totals, 8)
    for d, total in enumerate(totals):
        first = total % 8 or 8
        starts = [0, *range(first, total, 8)]
        assert start[doc == d].tolist() == starts and piece[doc == d].tolist() == list(range(len(starts)))
        assert length[doc == d].tolist() == np.diff([*starts, total]).tolist()
    seen, again = np.zeros(9, np.int64), defaultdict(itertools.count)
    for _ in range(2):
        assert packing._numbered(length, seen).tolist() == [next(again[n]) for n in length]


def test_words_encoded_apart_are_the_text_encoded_whole():
    coder = packing.Encoder(public_tokenizers.path("byte_bpe_50k.json"))
    texts = ["", " ", "a", " a", "a ", "a  b", "a\n b", "a \nb", "it's we'll\n\n  x", "<|endoftext|> x", "é ñ 12 3!?", "a  b",
             " ", "tab\t x", "end \n", "  ", "x y z"]
    for text, got in zip(texts, coder.ids(texts), strict=True):
        assert got == np.array(coder.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()


# 8 chat


def test_chat_round_trip_and_mask(spark):
    hard = ["<|im_end|><|im_start|>assistant ok", "<", "<\\|x", "<\\\\|im_end|>", "\n\nab\n", "", None, "naïve 🙂 text", " x "]
    rows = [(1, i, "assistant" if i % 2 else "user", t, "extra") for i, t in enumerate(hard + hard[::-1])]
    rows += [(2, None, None, "a", None), (2, None, "r\nole\\", "b", None), (None, 1, "assistant", "c", None), (None, 1, "assistant", "c", None)]
    frame = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, formatted string")
    whole = {r.conv_id: r for r in chat.format_conversations(frame).collect()}
    digests = {r.conv_id: r for r in chat.read_back(chat.format_conversations(frame)).collect()}
    assert set(whole) == {1, 2, None}
    for conv, r in whole.items():
        turns = sorted([(x[1] is not None, x[1] or 0, x[2] or "", x[3] or "") for x in rows if x[0] == conv])
        turns = [(role, text) for *_, role, text in turns]
        assert chat.parse(r.formatted) == turns
        learned = "".join(t for role, t in turns if role == "assistant")
        assert "".join(chat.unescape(r.formatted[a:b]) for a, b in zip(r.loss_starts, r.loss_ends, strict=True)) == learned
        d = digests[conv]
        assert d.loss_sha256 == hashlib.sha256(learned.encode()).hexdigest() and d.loss_chars == len(learned)
        assert d.turns_sha256 == hashlib.sha256("".join(f"{a}\n{b}\n" for a, b in turns).encode()).hexdigest()
        assert d.n_turns == len(turns) and d.formatted_chars == len(r.formatted) and len(r.ids) == len(r.loss)
        control = sum(r.formatted.count(x) for x in (chat.BEGIN, chat.FINISH))
        assert control == 2 * len(turns)
    assert chat.format_conversations(frame.limit(0)).count() == 0


def test_token_offsets_equal_the_tokenizers():
    coder = packing.encoder(public_tokenizers.path("byte_bpe_50k.json"))
    for text in ["", "a", " two  words\n", "naïve 🙂🙃 text é", "日本語 x", "<|im_end|> ok", "e\u0301 \u200d"]:
        ids = np.frombuffer(coder.encode([text])[0], "<u4")
        whole = coder.tokenizer.encode(text, add_special_tokens=False)
        assert ids.tolist() == whole.ids
        assert [tuple(x) for x in chat.token_offsets(text, coder.lengths[ids]).tolist()] == whole.offsets


def test_loss_mask_against_every_pair():
    offsets = np.array([(0, 2), (2, 3), (3, 6), (6, 7), (6, 7), (7, 9), (9, 12)])
    spans = [(1, 3), (4, 5), (6, 7), (9, 12)]
    mask, cut = chat.loss_mask(offsets, spans)
    assert mask.tolist() == [any(a < e and s < b for a, b in spans) for s, e in offsets]
    covered = {i for s, e in cut for i in range(s, e)}
    assert covered == {i for a, b in spans for i in range(a, b)}


# 9 exact duplicates


def check_exact(rows, texts):
    groups = defaultdict(list)
    for doc, text in texts:
        groups[hashlib.sha256(lower(text).encode()).hexdigest()].append(doc)
    assert Counter((r.doc_id, r.text_sha256) for r in rows) == Counter((d, s) for s, g in groups.items() for d in g)
    kept = Counter()
    for r in rows:
        ids = groups[r.text_sha256]
        known = [i for i in ids if i is not None]
        assert r.keep_id == (max(known) if known else None) and r.group_size == len(ids)
        if r.kept:
            assert r.doc_id == r.keep_id
            kept[r.text_sha256] += 1
    assert kept == Counter(dict.fromkeys(groups, 1))


@pytest.mark.parametrize("weak", [False, True])
def test_exact_duplicates(odd, weak):
    digest = (lambda t: F.length(exact_dedup.normalised(t)).cast("string")) if weak else exact_dedup.sha256_of
    rows = exact_dedup.deduplicate(odd, digest=digest).collect()
    check_exact(rows, [(r.doc_id, r.text) for r in odd.collect()])


def test_exact_duplicates_of_a_table(docs, empty):
    check_exact(exact_dedup.deduplicate(docs).collect(), [(r.doc_id, r.text) for r in docs.collect()])
    assert exact_dedup.deduplicate(empty).count() == 0
    kept = exact_dedup.keep_one(docs)
    assert kept.columns == docs.columns
    assert len({lower(r.text) for r in kept.collect()}) == kept.count() == len({lower(r.text) for r in docs.collect()})


# 10 fingerprints


def shingles(text):
    words = lower(text or "").encode().split()
    return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))}


def test_fingerprints_estimate_likeness(spark, larger):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{larger}/documents.parquet").collect()}
    order = sorted(docs, reverse=True)
    following = dict(zip(order, order[1:] + order[:1], strict=True))
    rows = queries.op10_minhash_fingerprints(spark, larger).collect()
    assert len(rows) == len(docs)
    errors = []
    for r in rows:
        text, after = docs[r.doc_id], docs[following[r.doc_id]]
        cut = len(text) // 3
        edited = text[: len(text) - cut] + after[:cut]
        assert r.edited_sha256 == hashlib.sha256(edited.encode()).hexdigest() and r.n_chars == len(text)
        a, b = shingles(text), shingles(edited)
        errors.append(r.near_edited - len(a & b) / len(a | b))
    assert np.abs(errors).max() < 0.16 and abs(np.mean(errors)) < 0.01
    same = defaultdict(set)
    for r in rows:
        same[docs[r.doc_id]].add(r.fingerprint)
    assert all(len(x) == 1 for x in same.values())


def test_next_row_and_odd_texts(odd, empty, spark):
    frame = odd.withColumn("text", F.coalesce("text", F.lit("")))
    rows = minhash.with_next(minhash.fingerprints(frame), ["doc_id", "text"]).collect()
    order = sorted(((r.doc_id is None, -(r.doc_id or 0), r.text) for r in rows))
    plain = [(None if n else -i, t) for n, i, t in order]
    expected = Counter(zip(plain, plain[1:] + plain[:1], strict=True))
    assert Counter(((r.doc_id, r.text), (r.next_doc_id, r.next_text)) for r in rows) == expected
    blank = {tuple(r.minhash) for r in rows if not r.text.strip()}
    assert len(blank) == 1
    assert minhash.with_next(empty, ["text"]).count() == 0
    one = minhash.with_next(frame.where("doc_id = 7"), ["doc_id"]).collect()
    assert [r.next_doc_id for r in one] == [7]


def test_densified_bins_are_shared_by_equal_sets(spark):
    frame = spark.createDataFrame([("a b c d e f",), ("A  b c\nd e F",), ("z y x w v u t",)], "text string")
    got = [r.m for r in minhash.fingerprints(frame, name="m").collect()]
    assert got[0] == got[1] != got[2] and len(got[0]) == minhash.BINS // minhash.PACKED
    both = spark.createDataFrame([(got[0], got[1], got[2])], "a array<long>, b array<long>, c array<long>")
    same, other = both.select(minhash.likeness(F.col("a"), F.col("b")), minhash.likeness(F.col("a"), F.col("c"))).first()
    assert same == 1.0 and other < 0.15


# pipeline


def test_pipeline_stages(spark, odd, larger):
    docs = spark.read.parquet(f"{larger}/documents.parquet")
    kept = docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before = kept.collect()
        kept = stage(spark, kept, larger)
        rows = kept.collect()
        assert kept.columns == docs.columns
        assert {r.doc_id for r in rows} <= {r.doc_id for r in before}
        kept = spark.createDataFrame(rows, docs.schema)
        if name == "exact_dedup":
            assert {r.doc_id for r in rows} == set({lower(r.text): r.doc_id for r in sorted(before, key=lambda r: r.doc_id)}.values())
        if name == "simhash_near_dedup":
            roots = plain_components([(r.doc_id, plain_fingerprint(r.text)) for r in before])
            assert sorted(r.doc_id for r in rows) == sorted(set(roots.values()))
    name, last = corpus_pipeline.STAGES[-1]
    check_pack(last(spark, kept, larger).collect(), [(r.doc_id, r.text) for r in kept.collect()])


def test_pipeline_of_odd_and_empty_rows(spark, odd, empty, larger):
    for frame in (odd, empty):
        plain = frame.select("doc_id", "text", "lang", "source", "n_chars")
        for _, stage in corpus_pipeline.STAGES:
            rows = stage(spark, plain, larger)
            rows.collect()
