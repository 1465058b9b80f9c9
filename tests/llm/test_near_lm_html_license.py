import itertools
import math
import os
import random
import time
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from edispark.llm import html_text, licenses, lm, neardup, sampling, shingles
from edispark.llm.html_blocks import blocks

from .data import empty_documents, odd_documents


def shingle_counts(text):
    w = [x.lower() for x in (text or "").encode().split()]
    return Counter(tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))) if w else Counter()


def test_shingles_equal_brute_force():
    r = random.Random(1)
    texts = [None, "", " \n", "One", "a b c d", "a b c d e", "a a a a a a a a", "É É É é x y z"] + [" ".join(r.choice("abC") for _ in range(r.randint(0, 40))) for _ in range(200)]
    found = {}
    for a, b, data, at in shingles.parts(pa.array(texts, pa.string())):
        hashes, times, row_at = shingles.shingles(data, at)
        for k in range(a, b):
            own = dict(zip(hashes[row_at[k - a] : row_at[k - a + 1]].tolist(), times[row_at[k - a] : row_at[k - a + 1]].tolist(), strict=True))
            want = shingle_counts(texts[k])
            assert sorted(own.values()) == sorted(want.values())
            found[k] = set(own)
    for i, j in itertools.combinations(range(len(texts)), 2):
        assert len(found[i] & found[j]) == len(set(shingle_counts(texts[i])) & set(shingle_counts(texts[j])))


def test_samples_agree_like_weighted_jaccard():
    r = np.random.default_rng(0)
    a = r.integers(1, 2**63, 300).astype(np.uint64)
    b = a.copy()
    b[:60] = r.integers(1, 2**63, 60).astype(np.uint64)
    wa = r.uniform(0.5, 3, 300)
    wb = wa.copy()
    wb[100:130] *= 1.5
    low = np.minimum(wa[60:], wb[60:]).sum()
    exact = low / (wa.sum() + wb.sum() - low)
    one, two = (sampling.samples(h, w, np.array([0, 300]), 2000) for h, w in ((a, wa), (b, wb)))
    assert abs((one == two).mean() - exact) < 0.04


def classes_by_brute_force(rows, weights, threshold):
    texts = sorted({t or "" for _, t in rows})
    up = {t: t for t in texts}

    def root(t):
        while up[t] != t:
            t = up[t]
        return t

    pairs = list(itertools.combinations(range(len(texts)), 2))
    for (i, j), s in zip(pairs, neardup.similarities(texts, pairs, weights), strict=True):
        if s >= threshold:
            up[root(texts[i])] = root(texts[j])
    least = {}
    for i, t in rows:
        k = root(t or "")
        least[k] = min((x for x in (least.get(k), i) if x is not None), default=None)
    return Counter((i, least[root(t or "")]) for i, t in rows)


def test_classes_equal_brute_force(spark):
    docs = odd_documents(spark)
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    how = neardup.Near()
    counts, n = neardup.frequencies(docs, "text", how)
    assert n == len(rows)
    df = Counter(x for _, t in rows for x in shingle_counts(t))
    assert sorted(counts.values()) == sorted(c for c in df.values() if c >= 2)
    got = Counter(tuple(x) for x in neardup.classes(docs).collect())
    assert got == classes_by_brute_force(rows, neardup.Weights(counts, n, how), how.threshold)
    kept = neardup.representatives(docs)
    assert kept.columns == docs.columns and kept.count() == len({c if c is not None else (c, i) for (i, c) in got} | set()) + 1  # two null ids, two classes
    assert neardup.classes(empty_documents(spark)).count() == 0


def test_filter_before_verification_loses_less_than_banding(spark):
    how = neardup.Near()
    lost = sum(math.comb(how.count, k) * how.threshold**k * (1 - how.threshold) ** (how.count - k) for k in range(how.agree))
    apart = (1 - how.threshold**how.rows) ** how.bands
    assert lost < 1e-7 and lost + apart < 2.2e-4
    one = np.arange(64, dtype=np.uint32)
    sketch = spark.createDataFrame([(n, bytearray(np.where(one < n, one, one + 100 * n).astype(np.uint32).tobytes())) for n in (64, 38, 32, 31)], "node long, samples binary")
    pairs = spark.createDataFrame([(64, 38), (64, 32), (64, 31)], "a long, b long")
    assert sorted(r.b for r in neardup._agreeing(pairs, sketch, how).collect()) == [32, 38]


def test_blocks_of_large_buckets_lose_no_link(spark, monkeypatch):
    r = random.Random(4)
    base = [f"w{r.randint(0, 9999)}" for _ in range(150)]
    rows = []
    for i in range(60):
        w = list(base)
        for _ in range(r.choice([1, 2, 3, 4, 5, 6])):
            w[r.randrange(150)] = f"x{r.randint(0, 10**6)}"
        rows.append((i, " ".join(w)))
    monkeypatch.setattr(neardup, "SMALL", 2)
    monkeypatch.setattr(neardup, "PIVOTS", 1)
    monkeypatch.setattr(neardup, "BLOCK", 7)
    monkeypatch.setattr(neardup, "frequencies", lambda *a: ({}, 60))
    got = Counter(tuple(x) for x in neardup.classes(spark.createDataFrame(rows, "doc_id long, text string")).collect())
    assert got == classes_by_brute_force(rows, neardup.Weights({}, 60, neardup.Near()), 0.8)


def tokens_of(text):
    return [*(text or "").encode().translate(bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))).split(), None]


def in_training(doc_id):
    return zlib.crc32(("" if doc_id is None else str(doc_id)).encode()) % 10 != 0


def test_tokens_equal_brute_force():
    texts = ["Ab ab\tABC  é\n", None, "", "x", "xyz wxyz xyz", " a\x1cb ", "\x0b" * 3, "long " * 9]
    own = [(r, a) for a, _, r in lm.reads(pa.array(texts, pa.string()))]
    assert len(own) == 1
    r = own[0][0]
    words = [w for t in texts for w in tokens_of(t)]
    assert list(np.diff(r.at)) == [len(tokens_of(t)) for t in texts]
    assert len(set(r.hashes.tolist())) == len(set(words)) and len(set(zip(words, r.hashes.tolist()))) == len(set(words))
    assert all(h == lm.END for w, h in zip(words, r.hashes.tolist()) if w is None)
    ends = {(w[-3:] if w else None, x) for w, x in zip(words, r.last.tolist())}
    assert len(ends) == len({e for e, _ in ends})


def test_lm_probabilities_and_base_by_brute_force(spark, monkeypatch):
    """Scores from counts in plain Python and the net's own vectors; all probabilities after a context add up to 1."""
    for name, value in (("SHORTLIST", 40), ("STEPS", 10)):
        monkeypatch.setattr(lm, name, value)
    docs = odd_documents(spark, 120)
    rows = docs.collect()
    train = [tokens_of(r.text) for r in rows if in_training(r.doc_id)]
    c = Counter(t for x in train for t in x)
    n, v = sum(c.values()), len(c)
    want = sorted((len(t), sum(c[w] > 0 for w in t), round(sum(math.log10((c[w] + 0.1) / (n + 0.1 * (v + 1))) for w in t), 6)) for t in (tokens_of(r.text) for r in rows))
    got = lm.scored(docs).collect()
    assert sorted((r.n_tokens, r.n_known, round(r.base_score, 6)) for r in got) == want and {r.train_tokens for r in got} == {n}
    held = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")) % 10 == 0
    units, net, rest, rarer, table, n2, v2 = lm.fit(docs.where(~held).select("text"))
    assert (n2, v2) == (n, v)

    def read(text):
        return next(r for *_, r in lm.reads(pa.array([text], pa.string())))

    pairs, seen = Counter(), Counter()
    for r in rows:
        if in_training(r.doc_id):
            g = lm.memory_of(read(r.text), units.memory).tolist()
            seen.update(g)
            pairs.update(zip(g, tokens_of(r.text), strict=True))
    words = list(c)
    (_, _, all_words), = lm.reads(pa.array([w.decode() if w else "" for w in words], pa.string()))
    _, spots, buckets = (x[all_words.at[:-1]] for x in units.of(all_words))
    short = {w for w, spot in zip(words, spots, strict=True) if spot >= 0}
    bucket_of = dict(zip(words, buckets.tolist(), strict=True))
    assert 20 < len(short) <= 60 and None in short
    first = {(g, w): (k - 1) / seen[g] for (g, w), k in pairs.items() if k > 1 and w not in short}
    left = Counter(dict.fromkeys(seen, 1.0))
    left.subtract(Counter({}))
    for (g, _), p in first.items():
        left[g] -= p
    assert {(g, round(10 ** rest[g], 9)) for g in seen} == {(g, round(left[g], 9)) for g in seen}
    assert sorted(r.c for r in rarer.collect()) == sorted(k for w, k in c.items() if w not in short)
    assert sorted(round(x, 9) for r in table.collect() for x in r.before.values()) == sorted(round(x, 9) for x in first.values())

    def p_net(r):
        u, spot, bucket = units.of(r)
        return u, spot, bucket, np.exp(net.log_probabilities(lm.contexts_of(u, r.at, len(units.mass)), u).astype(float))

    scores = Counter()
    for r in got:
        scores[r.n_tokens, round(r.base_score, 6), round(r.score, 2)] += 1
    for r in rows:
        t, own = tokens_of(r.text), read(r.text)
        g = lm.memory_of(own, units.memory).tolist()
        _, spot, bucket, p = p_net(own)
        total = 0.0
        for k, w in enumerate(t):
            d, size = units.discount, max(units.totals[bucket[k]], 1)
            share = 1.0 if spot[k] >= 0 else (c[w] - d) / size if c[w] else d * units.types[bucket[k]] / size if units.totals[bucket[k]] else 1.0
            total += math.log10(first.get((g[k], w), 0.0) + left.get(g[k], 1.0) * p[k] * share)
        key = (len(t), round(sum(math.log10((c[w] + 0.1) / (n + 0.1 * (v + 1))) for w in t), 6))
        near = [x for x in scores if x[:2] == key and abs(x[2] - total) < 0.02 + 1e-4 * abs(total)]
        assert near
    # all units after a context, then each bucket's words and its unknown word
    contexts = np.array([[0, 1, 2, 3], [len(units.mass)] * 4, [5, 5, 9, 1]])
    every = np.exp(np.array([net.log_probabilities(np.repeat(x[None], len(units.mass), axis=0), np.arange(len(units.mass))) for x in contexts]).astype(float))
    assert np.allclose(every.sum(axis=1), 1, atol=1e-4)
    for b in range(len(units.bucket)):
        own = [k for w, k in c.items() if w not in short and bucket_of[w] == b]
        if own:
            assert abs(sum(k - units.discount for k in own) / units.totals[b] + units.discount * units.types[b] / units.totals[b] - 1) < 1e-9
    assert lm.scored(empty_documents(spark)).count() == 0
    nothing = lm.scored(docs.where(held)).collect()
    assert {r.train_tokens for r in nothing} == {0} and all(r.base_score == 0 and r.score < 0 for r in nothing)


def test_training_learns_what_follows():
    r = np.random.default_rng(1)
    units = lm.units_of(np.arange(100, 140, dtype=np.uint64), np.full(40, 1000), np.zeros(16, int), np.zeros(16, int), 0.5, 64)
    trainer = lm.Trainer(lm.new_net(units), units, 3)
    for _ in range(400):
        u = r.integers(0, 40, 512)
        trainer.step(np.stack([u, *r.integers(0, 40, (3, 512))], axis=1), (u + 1) % 40, np.ones(512, np.float32))
    u = np.arange(40)
    contexts = np.stack([u, *r.integers(0, 40, (3, 40))], axis=1)
    p = np.exp([trainer.net.log_probabilities(contexts, np.full(40, w)) for w in range(40)])
    assert np.mean(p.argmax(axis=0) == (u + 1) % 40) > 0.9


@pytest.mark.skipif(not os.path.isdir("/root/testdata/sf0.01"), reason="no driver tables here")
def test_held_out_texts_score_above_the_unigram_and_near_the_bigram(spark):
    """Bits a token on texts that training has not seen, against counts in plain Python with the contract's events."""
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text")
    got = lm.scored(docs).where("held_out").agg(F.sum("score"), F.sum("base_score"), F.sum("n_tokens")).first()
    ours, base = (-got[k] / got[2] / math.log10(2) for k in (0, 1))
    rows = [(in_training(r.doc_id), tokens_of(r.text)) for r in docs.collect()]
    c, pairs, before, kinds = Counter(), Counter(), Counter(), Counter()
    for own, t in rows:
        if own:
            c.update(t)
            pairs.update(zip([b"", *t], t))
    for (a, _), k in pairs.items():
        before[a] += k
        kinds[a] += 1
    n, v = sum(c.values()), len(c)
    bits = tokens = 0
    for own, t in rows:
        if not own:
            for a, b in zip([b"", *t], t):
                p = (c[b] + 0.1) / (n + 0.1 * (v + 1))
                p = max(pairs[a, b] - 0.75, 0) / before[a] + 0.75 * kinds[a] / before[a] * p if before[a] else p
                bits, tokens = bits - math.log2(p), tokens + 1
    assert tokens == got[2] and ours < base - 2 and ours < bits / tokens + 1.3


@pytest.fixture(scope="module")
def crf():
    return html_text.default_model()


def test_held_out_pages(crf):
    pages = html_text.labelled_pages(200, seed=977)
    right = sum(a == b for page, labels in pages for a, b in zip(crf.decode(page), labels, strict=True))
    assert right / sum(len(p) for p, _ in pages) > 0.995


def test_viterbi_finds_the_best_labels(crf):
    for page, _ in html_text.labelled_pages(40, seed=5):
        page = page[:8]
        scores = [crf.score(b, k == 0) for k, b in enumerate(page)]

        def value(labels, scores=scores):
            return sum(s for s, y in zip(scores, labels, strict=True) if y) + sum(crf.pairs[a][b] for a, b in zip(labels, labels[1:], strict=False))

        assert value(crf.decode(page)) == pytest.approx(max(value(x) for x in itertools.product([0, 1], repeat=len(page))))


def test_pages(crf):
    page = '<html><head><title>T</title><style>p{}</style><script>var t="</p>";</script></head><body><nav><ul><li><a href=/a>Home</a></li></ul></nav><div class="ad">Buy this now.</div><article><h1>Title &amp; more</h1><p><b>One<br><p>Two \n words &am</p><div class="comments"><p>Nice text, thanks.</p></div></article><footer>&copy; me</footer></body></html>'
    assert html_text.main_text(page, crf) == "Title & more\nOne\nTwo words &am"
    assert html_text.main_text(None, crf) == html_text.main_text("", crf) == html_text.main_text("<p></p><!-- x", crf) == ""
    assert html_text.main_text("<script>no text", crf) == ""


@pytest.mark.parametrize(
    "html,want",
    [
        ("<p>a<p>b", ["a", "b"]),
        ("<ul><li>a<li>b<ul><li>c</ul></ul>d", ["a", "b", "c", "d"]),
        ("a<b>b</b>c <i>d", ["abc d"]),
        ("<div>a<div>b</div>c</div>", ["a", "b", "c"]),
        ("<table><tr><td>a<td>b<tr><th>c</table>", ["a", "b", "c"]),
        ("<p title='>'>a</p><textarea>no</textarea><select><option>no</select>b", ["a", "b"]),
        ("x < y and z > w", ["x < y and z > w"]),
        ("<p>&lt;b&gt; &#233; &eacute;&nbsp;x</p>", ["<b> é é x"]),
        ("<a href=x>l<a href=y>m</a> n", ["lm n"]),
    ],
)
def test_blocks(html, want):
    assert [b.text for b in blocks(html)] == want


def test_extracted_rows(spark, crf):
    rows = [(1, "u", "<article><p>Some text of an article here.</p></article>"), (2, None, None), (None, "x", ""), (1, "u", "<article><p>Some text of an article here.</p></article>")]
    got = html_text.extracted(spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("text", F.lit(1)), crf).collect()
    assert sorted((str(r.page_id), r.text, r.n_chars) for r in got) == [("1", "Some text of an article here.", 29)] * 2 + [("2", "", 0), ("None", "", 0)]


def test_licenses(spark):
    mit = licenses.TEMPLATES["MIT-text"]
    wrapped = "\n".join(" ".join(mit.split()[k : k + 9]) for k in range(0, len(mit.split()), 9))
    texts = {
        1: "some words\nLicensed under CC BY-NC 4.0.\nmore words",
        2: f"Copyright me\n\n{wrapped.replace('Software', 'Program', 1)}\n\ncode follows",
        3: "he has a driving license and that is all there is to say about it",
        4: "This work is licensed under the GNU General Public License, version 3. Licensed under the Apache License, Version 2.0.",
        5: None,
        6: "",
    }
    df = spark.createDataFrame(list(texts.items()), "doc_id long, text string").withColumn("license", F.lit("x"))
    rows = licenses.scanned(df).collect()
    good = {(r.doc_id, r.license): r for r in rows if r.confirmed}
    assert set(good) == {(1, "CC-BY-NC-4.0"), (2, "MIT-text"), (4, "GPL-3.0"), (4, "Apache-2.0")}
    assert texts[1][good[1, "CC-BY-NC-4.0"].start : good[1, "CC-BY-NC-4.0"].stop] == "Licensed under CC BY-NC 4.0."
    assert set(good[2, "MIT-text"].differences) == {"-software", "+program"} and all(r.bytes_given < r.bytes_alone for r in good.values())
    assert [r.confirmed for r in rows if r.doc_id == 3] == [False]
    assert licenses.scanned(df.where("false")).count() == 0


def test_short_notices_are_confirmed_in_any_surroundings():
    """A notice of a few words saves few bytes, so its rank depends on the words around it; it is found all the same."""
    scanner = licenses.Scanner()
    short = {n: t for n, t in licenses.TEMPLATES.items() if len(t.split()) <= 12}
    rng = np.random.default_rng(3)
    syllables = "er th ha st on ing ed tion ea wh ble nt".split()
    for k in range(120):
        around = [" ".join("".join(rng.choice(syllables, rng.integers(1, 5))) for _ in range(20)) for _ in range(2)]
        name = list(short)[k % len(short)]
        text = f"{around[0]}\n{short[name]}\n{around[1]}"
        found = list(scanner.scan(text))
        assert [(r["license"], r["confirmed"], text[r["start"] : r["stop"]]) for r in found] == [(name, True, short[name])]


def test_notices_without_an_unbroken_term(spark):
    texts = {}
    for k, (name, cut) in enumerate([("MIT-text", "is hereby"), ("BSD-text", "Redistribution and"), ("ISC-text", "Permission to"), ("Unlicense-text", "unencumbered software")]):
        a, b = cut.split()
        texts[k] = (name, "x = 1\n# " + licenses.TEMPLATES[name].replace(cut, f"{a}\n# {b}", 1) + "\ny = 2")
    texts[9] = ("MIT-text", licenses.TEMPLATES["MIT-text"].replace("hereby", "herewith", 1))
    df = spark.createDataFrame([(k, t) for k, (_, t) in texts.items()], "doc_id long, text string")
    assert {(r.doc_id, r.license) for r in licenses.scanned(df).collect() if r.confirmed} == {(k, n) for k, (n, _) in texts.items()}


def test_notices_with_no_break_spaces_and_many_open_terms():
    scanner = licenses.Scanner()
    mit = licenses.TEMPLATES["MIT-text"]
    text = "a b c " + mit.replace(" ", "\u00a0") + " d e f"
    assert [(r["license"], r["confirmed"], text[r["start"] : r["stop"]]) for r in scanner.scan(text)] == [("MIT-text", True, mit.replace(" ", "\u00a0"))]
    began = time.time()
    many = "license fee " * 4000
    rows = list(scanner.scan(many))
    assert time.time() - began < 5 and [r["confirmed"] for r in rows] == [False] and rows[0]["stop"] >= len(many.rstrip()) - 200
    both = list(scanner.scan("license fee " * 50 + mit + " license fee" * 50))
    assert [r["confirmed"] for r in both] == [False, True, False] and both[0]["stop"] <= both[1]["start"] and both[1]["stop"] <= both[2]["start"]


def test_license_rows_of_odd_tables(spark):
    mit = licenses.TEMPLATES["CC-BY-4.0"]
    rows = [(None, mit), (1, mit), (1, mit), (2, "word " * 200_000 + mit), (3, None), (4, "")]
    df = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 AS start", "2 AS license")
    got = licenses.scanned(df).collect()
    assert sorted((str(r.doc_id), r.license, r.confirmed, r.stop - r.start) for r in got) == sorted((str(k), "CC-BY-4.0", True, len(mit)) for k in (None, 1, 1, 2))
    none = licenses.scanned(df.where("doc_id > 2"))
    assert none.count() == 0 and none.columns == [c.split()[0] for c in licenses.COLUMNS.split(", ")]


def test_notices_of_the_table_equal_a_plain_search():
    """Whole wordings of short templates in the driver's texts, found by looking for them, are all confirmed."""
    import duckdb

    texts = [t for (t,) in duckdb.sql("select text from '/root/testdata/sf0.01/documents.parquet' where text is not null").fetchall()]
    scanner, plain = licenses.Scanner(), {n: " ".join(w for w in map(licenses.normal, t.split()) if w) for n, t in licenses.TEMPLATES.items() if len(t.split()) <= 16}
    seen = 0
    for text in texts:
        words = " ".join(w for w in map(licenses.normal, text.split()) if w)
        there = {n for n, t in plain.items() if f" {t} " in f" {words} "}
        if there:
            seen += 1
            assert there <= {r["license"] for r in scanner.scan(text) if r["confirmed"]}
    assert seen > 5


#: Pages written by hand, with the text a reader would take for the article.
HAND = [
    ("<body><header><a href=/>Site</a></header><main><h1>River news</h1><p>The water <em>rose</em> again, said <a href=x>a witness</a>.</p><script>ad()</script><p>It fell<sup>2</sup> later.</p></main><aside>Read more</aside></body>", "River news\nThe water rose again, said a witness.\nIt fell2 later."),
    ("<div id=menu><ul><li><a href=a>One</a><li><a href=b>Two</a></ul></div><div class=article><h2>Energy</h2><p>Energy <math><mi>E</mi><mo>=</mo><mi>m</mi></math> holds for all bodies.</p></div><div class=footer>Copyright 2020</div>", "Energy\nEnergy E=m holds for all bodies."),
    ("<article><p>Hello <script>x()</script>world and <svg><title>icon</title></svg> all the others here.</p><p>Second paragraph <!-- note --> goes on.</p></article><section class=comments><p>First!</p></section>", "Hello world and all the others here.\nSecond paragraph goes on."),
    ("<div class=cookie-notice>We use cookies. <button>Accept</button></div><div class=post><p>A long enough paragraph of plain text stands here for the reader.</p><blockquote>Quoted words belong to it.</blockquote><ul><li>first point of the list<li>second point of the list</ul></div>", "A long enough paragraph of plain text stands here for the reader.\nQuoted words belong to it.\nfirst point of the list\nsecond point of the list"),
    ("<nav>Home</nav><article><p>Tom &amp; Jerry&nbsp;run&#33;</p><form><label>Name</label><input></form><pre>a  b\n c</pre></article>", "Tom & Jerry run!\na b c"),
]


@pytest.mark.parametrize("html,want", HAND)
def test_pages_written_by_hand(crf, html, want):
    assert html_text.main_text(html, crf) == want


@pytest.mark.parametrize(
    "html,want",
    [
        ("<p>Hello <script>x()</script>world and <svg/> icon</p>", ["Hello world and icon"]),
        ("<p>a <style>p{}</style>b<template><p>no</p></template> c<select><option>o</select> d</p>", ["a b c d"]),
        ("<p>Energy <math><mi>E</mi></math> holds.</p>", ["Energy E holds."]),
        ("<p>a <object>inner</object> <video>old browser</video> b</p>", ["a inner old browser b"]),
        ("<div>x<svg></div>y", ["x", "y"]),
        ("<b><i>one</b> two</i> three", ["one two three"]),
        ("<my-box>a</my-box>b<blink>c</blink>d", ["a", "bcd"]),
        ("<noscript><p>no</p></noscript>yes", ["yes"]),
    ],
)
def test_silent_and_inline_elements(html, want):
    assert [b.text for b in blocks(html)] == want


@pytest.mark.parametrize("html", ["<div>x" * 50_000, "<b>x" * 50_000, "<p>x" * 50_000, "<ul><li>x" * 25_000, "<div>" * 25_000 + "<li>x</li></q>" * 25_000, "<b>" * 20_000 + "<i>" * 20_000 + "x</b>" * 20_000])
def test_deep_pages_take_linear_time(crf, html):
    began = time.time()
    text = html_text.main_text(html, crf)
    assert time.time() - began < 6 and set(text) <= {"x", "\n", " "}


def test_pages_long_and_none(spark, crf):
    long = "<article>" + "<p>Some words of a paragraph that goes on for a while.</p>" * 20_000 + "</article>"
    assert html_text.main_text(long, crf).count("\n") == 19_999
    df = spark.createDataFrame([], "page_id long, url string, html string")
    assert html_text.extracted(df, crf).count() == 0


def test_recall_of_near_copies(spark):
    """Copies with edits against all pairs by brute force: each pair of similarity 0.8 or more is in one class, and no text without one is in any."""
    r = random.Random(8)
    rows = []
    for k in range(40):
        base = [f"w{r.randint(0, 3000)}" for _ in range(r.choice([40, 120, 400]))]
        rows.append((len(rows), " ".join(base)))
        for _ in range(3):
            own = list(base)
            for _ in range(max(1, int(len(own) * r.choice([0.005, 0.01, 0.02, 0.04])))):
                own[r.randrange(len(own))] = f"x{r.randint(0, 10**6)}"
            rows.append((len(rows), " ".join(own)))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    how = neardup.Near()
    counts, n = neardup.frequencies(docs, "text", how)
    weights, own = neardup.Weights(counts, n, how), dict(neardup.classes(docs).collect())
    pairs = list(itertools.combinations(range(len(rows)), 2))
    close = [p for p, x in zip(pairs, neardup.similarities([t for _, t in rows], pairs, weights), strict=True) if x >= how.threshold]
    assert len(close) > 60 and all(own[a] == own[b] for a, b in close)
    assert Counter((i, c) for i, c in own.items()) == classes_by_brute_force(rows, weights, how.threshold)


def test_units_are_found_by_slots(monkeypatch):
    import numpy as np

    from edispark.llm import lm

    rng = np.random.default_rng(2)
    hashes = rng.integers(0, 2**63, 300).astype(np.uint64)
    tokens = lm.Read(np.concatenate([hashes, rng.integers(0, 2**63, 500).astype(np.uint64)]), rng.integers(0, 65536, 800), np.array([0, 800]))
    for slots in (16, 256, 1 << 18):
        monkeypatch.setattr(lm, "_SLOTS", slots)
        units = lm.units_of(hashes, np.arange(300, 0, -1), np.full(16, 5), np.full(16, 3), 0.5, 64)
        table, shared = units._slots
        assert len(table) == slots and shared == bool((table < 0).any())
        unit, spot, _ = units.of(tokens)
        assert (units.hashes[spot[:300]] == hashes).all() and (spot[300:] == -1).all() and (unit[:300] == units.unit[spot[:300]]).all()


def test_hashes_and_scores_are_worked_out_in_cached_pieces():
    """Neither holds more than one running sum of all bytes, or the vectors of all tokens twice."""
    import tracemalloc

    r = random.Random(4)
    text = " ".join("".join(r.choice("abcdeéXY") for _ in range(r.randint(1, 9))) for _ in range(60_000)).encode()
    data, at = np.frombuffer(text, np.uint8), np.array([0, len(text)])
    shingles.word_hashes(data, at)  # powers are made once
    tracemalloc.start()
    hashes, _ = shingles.word_hashes(data, at)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 16 * len(data)
    for k in (0, 1, 30_000, 59_999):
        own = np.frombuffer(text.split(b" ")[k], np.uint8)
        assert hashes[k] == shingles.word_hashes(own, np.array([0, len(own)]))[0][0]
    n = 50_000
    units = lm.units_of(np.arange(1, 101, dtype=np.uint64), np.arange(1, 101), np.ones(16, np.int64), np.ones(16, np.int64), 0.5, 64)
    net = lm.new_net(units)
    contexts, own = np.zeros((n, lm.CONTEXT), np.int32), np.arange(n) % len(units.mass)
    tracemalloc.start()
    net.log_probabilities(contexts, own)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 2 * 4 * n * (lm.WIDTH + 1)


def test_training_adds_the_sums_of_gradients_by_row():
    units = lm.units_of(np.arange(1, 101, dtype=np.uint64), np.arange(1, 101), np.ones(16, np.int64), np.ones(16, np.int64), 0.5, 64)
    trainer = lm.Trainer(lm.new_net(units), units, 1)
    rng = np.random.default_rng(2)
    rows, grads, before = rng.integers(0, 30, 200), rng.normal(size=(lm.WIDTH, 200)).astype(np.float32), trainer.net.context.copy()
    trainer._add(0, rows, grads)
    for k in range(len(before)):
        total = grads[:, rows == k].sum(axis=1)
        step = trainer.rate / np.sqrt(0.01 + (total**2).sum() / lm.WIDTH) * total
        np.testing.assert_allclose(trainer.net.context[k], before[k] + step, atol=1e-5)
