"""The pipeline's stages on odd rows, and its whole run against its stages in plain Python."""

from collections import Counter, defaultdict

import corpus_pipeline
from edispark.llm import neardup

from .data import empty_documents, odd_documents
from .test_near_lm_html_license import classes_by_brute_force
from .test_rules_and_mixing import brute


def test_stages(spark):
    docs = odd_documents(spark)
    shapes = []
    rows = docs
    for name, stage in corpus_pipeline.STAGES:
        rows = stage(spark, rows, "")
        shapes.append((name, rows))
    by = {n: [tuple(r) for r in d.collect()] for n, d in shapes}
    assert all(d.columns == docs.columns for _, d in shapes[:-1])
    # rules
    kept = [r for r in docs.collect() if not (lambda m: m[0] < 50 or 100 * m[4] > 50 * m[0] or 10 * m[2] > 3 * m[0] or m[1] < 2 * m[0] or m[1] > 20 * m[0])(brute(r.text))]
    assert Counter(by["quality_rules"]) == Counter(map(tuple, kept))
    # one of each class
    how = neardup.Near()
    counts, n = neardup.frequencies(shapes[0][1], "text", how)
    want = classes_by_brute_force([(r.doc_id, r.text) for r in kept], neardup.Weights(counts, n, how), how.threshold)
    named = {c for _, c in want}
    assert {r[0] for r in by["near_duplicates"]} == named
    # every document at least once and at most twice, and packed as often
    shown = Counter(by["source_mix"])
    assert set(shown) == set(by["near_duplicates"]) and max(shown.values()) <= 3
    bins = defaultdict(list)
    for r in shapes[-1][1].collect():
        bins[r.bin_id].append(r)
    assert sum(r.n_tokens for b in bins.values() for r in b) == sum(len((x[1] or "").split()) * k for x, k in shown.items())


def test_empty(spark):
    rows = empty_documents(spark)
    for _, stage in corpus_pipeline.STAGES:
        rows = stage(spark, rows, "")
        assert rows.count() == 0
