import math
import re
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from edispark.llm import mixing, packing, rules
from edispark.llm.common import word_count

from .data import empty_documents, odd_documents

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(text):
    text = text or ""
    w = WORD.findall(text)
    lines = [x for x in text.split("\n") if WORD.search(x)]
    windows = Counter(tuple(w[k : k + 3]) for k in range(len(w) - 2))
    covered = {p for k in range(len(w) - 2) if windows[tuple(w[k : k + 3])] > 1 for p in (k, k + 1, k + 2)}
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(covered)


def test_ledger_equals_brute_force(spark):
    docs = odd_documents(spark)
    book = rules.ledger(docs).collect()
    want = sorted(brute(r.text) for r in docs.collect())
    assert sorted((r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) for r in book) == want
    for r in book:
        assert bool(r.failed_bits & rules.BASE.mask) == (r.n_words < 50 or 100 * r.n_repeat_words > 50 * r.n_words)


def test_kept_documents_keep_their_columns(spark):
    docs = odd_documents(spark)
    kept = rules.kept_documents(docs)
    assert kept.columns == docs.columns
    good = rules.ledger(docs).where(rules.passes(rules.STANDARD)).count()
    assert kept.count() == good > 0 and rules.kept_documents(empty_documents(spark)).count() == 0


def test_kept_columns_may_clash(spark):
    docs = odd_documents(spark)
    book = rules.ledger(docs, keep=["n_words", "lang", "doc_id", "failed_bits"]) if "failed_bits" in docs.columns else rules.ledger(docs, keep=["n_words", "lang", "doc_id"])
    assert {"input_n_words", "lang", "input_doc_id", "n_words", "failed_bits"} <= set(book.columns)
    assert all(r.input_n_words == 1 and r.input_doc_id == r.doc_id for r in book.collect())


def test_ablation(spark):
    book = rules.ledger(odd_documents(spark))
    rows = book.collect()
    for a in rules.ablation(book, rules.STANDARD).collect():
        mask = rules.STANDARD.mask & ~(1 << a.bit)
        assert a.kept_without == sum(not r.failed_bits & mask for r in rows)
        assert a.fails == sum(bool(r.failed_bits >> a.bit & 1) for r in rows)
        assert a.fails_alone == sum(r.failed_bits & rules.STANDARD.mask == 1 << a.bit for r in rows)


def shares(rows):
    tokens = defaultdict(int)
    for r in rows:
        tokens[r._s] += r._n
    return tokens


@pytest.mark.parametrize("goal", [mixing.Goal(), mixing.Goal(entropy=0.95), mixing.Goal(entropy=0.98, budget=20000), mixing.Goal(repeats=2.0, budget="cover"), mixing.Goal(entropy=1.0, repeats=3.0, budget=120000)])
def test_mixing_meets_its_weights(spark, goal, monkeypatch):
    monkeypatch.setattr(mixing, "BLOCK_DOCS", 4)
    docs = odd_documents(spark)
    own = docs.select(F.col("source"), word_count(F.col("text")).alias("n")).collect()
    s = defaultdict(int)
    for r in own:
        s[r.source] += r.n
    total = sum(s.values())
    shown = mixing.mixed(docs, goal).collect()
    weights = {r._s: r._weight for r in shown}
    live = {k: v for k, v in s.items() if v}
    a = [math.log(weights[k] / weights["hot"]) / math.log(live[k] / live["hot"]) for k in live if k != "hot"]
    assert max(a) - min(a) < 1e-6 and -1e-9 <= a[0] <= 1 + 1e-9  # one exponent for all
    assert abs(sum(weights[k] for k in live) - 1) < 1e-9
    budget = total if goal.budget is None else goal.budget if isinstance(goal.budget, int) else max(live[k] / weights[k] for k in live)
    if goal.repeats:
        assert max(weights[k] * budget / live[k] for k in live) <= goal.repeats * (1 + 1e-6) or a[0] > 1 - 1e-9
    if goal.entropy and a[0] < 1 - 1e-6 and not goal.repeats:
        h = -sum(weights[k] * math.log(weights[k]) for k in live)
        assert abs(h - goal.entropy * math.log(len(live))) < 1e-4
    got = shares(shown)
    longest = {k: max(r.n for r in own if r.source == k) for k in s}
    for k in live:
        assert abs(got[k] - weights[k] * budget) <= longest[k] + 1
        passes = defaultdict(Counter)
        for r in shown:
            if r._s == k:
                passes[r._pass][(r._row.doc_id, r._row.text)] += 1
        whole = Counter((r.doc_id, r.text) for r in docs.collect() if r.source == k)
        last = max(passes)
        assert all(passes[p] == whole for p in range(last)) and all(n <= whole[d] for d, n in passes[last].items())
    assert all(0 <= r._mix_key < 1 for r in shown)
    if goal.budget == "cover":
        assert {(r._row.doc_id, r._row.text) for r in shown} == {(r.doc_id, r.text) for r in docs.collect()}


def test_part_pass_by_brute_force(spark, monkeypatch):
    """Which rows each pass shows, from every document's key: whole passes, then the prefix that meets the rest."""
    monkeypatch.setattr(mixing, "BLOCK_DOCS", 4)
    goal = mixing.Goal(entropy=0.98, budget=20000)
    docs = odd_documents(spark)
    shown = mixing.mixed(docs, goal).collect()
    plan = {r._s: r for r in mixing.plan(docs.select(F.col("source").alias("_s"), F.col("doc_id").alias("_id"), word_count(F.col("text")).alias("_n")), goal).collect()}
    sizes = docs.select(F.col("source").alias("_s"), F.col("doc_id").alias("_id"), word_count(F.col("text")).alias("_n"))
    got = Counter((r._s, r._row.doc_id, r._n, r._pass) for r in shown)
    want = Counter()
    for source, p in plan.items():
        own = sizes.where(F.col("_s").eqNullSafe(F.lit(source)))
        block = mixing.block_of(goal.seed, F.lit(p._blocks))
        rows = own.withColumn("b", block).withColumn("k", mixing._key(goal.seed, F.lit(p._full), F.lit(source), F.col("b"))).collect()
        for r in rows:
            want.update((source, r._id, r._n, k) for k in range(p._full))
        # blocks stay together in the permutation
        order = [r.b for r in sorted(rows, key=lambda r: r.k)]
        assert len([1 for a, b in zip([None, *order], order) if a != b]) == len(set(order))
        at = 0
        for k in sorted({r.k for r in rows}):
            tied = [r for r in rows if r.k == k]
            n = sum(r._n for r in tied)
            rest = p._allotted - p._full * p._tokens if p._tokens else 0
            if rest > 0 and 2 * at + n <= 2 * rest:
                want.update((source, r._id, r._n, p._full) for r in tied)
            at += n
    assert got == want
    # a document's block is the same in each pass
    assert all(len(bs) == 1 for bs in ({r._block for r in shown if (r._s, r._row.doc_id, r._n) == key} for key in {(r._s, r._row.doc_id, r._n) for r in shown}))


def test_mixing_of_nothing(spark):
    assert mixing.mixed(empty_documents(spark), mixing.Goal(entropy=0.9)).count() == 0
    none = odd_documents(spark).where("text is null or text = ''")
    assert mixing.mixed(none, mixing.Goal(entropy=0.9, repeats=2.0)).count() == 2


def brute_pack(pieces, capacity, quota):
    """The tightest compatible bin by looking at all of them; among equally tight ones the first opened."""
    bins, out = [], []
    for size, source, cluster in pieces:
        fit = [(capacity - sum(p[0] for p in b) - size, k) for k, b in enumerate(bins) if sum(p[0] for p in b) + size <= capacity and sum(p[1] == source for p in b) < quota and (cluster == -1 or all(p[2] != cluster for p in b))]
        k = min(fit)[1] if fit else len(bins)
        if not fit:
            bins.append([])
        bins[k].append((size, source, cluster))
        out.append(k)
    return out


@pytest.mark.parametrize("seed", range(5))
def test_packing_equals_brute_force(seed):
    import random

    r = random.Random(seed)
    pieces = [(r.randint(0, 50), r.randint(0, 5) if r.random() < 0.7 else 0, r.choice([-1, -1, 0, 1, 2])) for _ in range(300)]
    sizes, sources, clusters = zip(*pieces, strict=True)
    assert packing.pack(sizes, sources, clusters, 64, 2) == brute_pack(pieces, 64, 2)


def test_packing_rows(spark, monkeypatch):
    """Bins of a table, row for row, by brute force in each group; equal texts and equal rows are never together."""
    monkeypatch.setattr(packing, "GROUP_PIECES", 16)
    docs = odd_documents(spark)
    got = packing.packed(docs, capacity=256, source_quota=2).collect()
    again = packing.packed(docs.repartition(5), capacity=256, source_quota=2).collect()
    assert Counter(map(tuple, got)) == Counter(map(tuple, again))
    own = docs.select("doc_id", F.col("source"), word_count(F.col("text")).alias("size"), F.xxhash64(F.coalesce("text", F.lit(""))).alias("cluster"))
    full = [r.n // 256 for r in docs.select(word_count(F.col("text")).alias("n")).collect()]
    groups = -(-(len(full) + sum(full)) // 16)
    want, by_group = Counter(), defaultdict(list)
    for r in packing.pieces(own, groups).collect():
        want.update((r.doc_id, r.source, k, 256, (r.salt, k)) for k in range(r.size // 256))
        if r.size % 256 or not r.size:
            by_group[r.group].append((r.size % 256, r))
    for group, rows in by_group.items():
        rows.sort(key=lambda x: (-x[0], x[1].doc_id or 0, x[1].cluster, x[1].salt))
        sources, copies = {r.source: k for k, (_, r) in enumerate(rows)}, Counter(r.cluster for _, r in rows)
        bins = brute_pack([(n, sources[r.source], r.cluster if copies[r.cluster] > 1 else -1) for n, r in rows], 256, 2)
        want.update((r.doc_id, r.source, r.size // 256, n, f"{group}-{b}") for b, (n, r) in zip(bins, rows, strict=True))
    bins = {x[-1] for x in want}
    assert len({r.bin_id for r in got}) == len(bins)
    assert Counter(x[:4] if isinstance(x[4], tuple) else x for x in want.elements()) == Counter((r.doc_id, r.source, r.piece, r.n_tokens) if r.bin_id[0] == "f" else (r.doc_id, r.source, r.piece, r.n_tokens, r.bin_id) for r in got)
    assert packing.packed(empty_documents(spark)).count() == 0
