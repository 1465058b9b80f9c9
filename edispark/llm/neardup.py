"""Near-duplicate documents by consistent weighted sampling over TF-IDF shingles.

1. Document frequencies. A fixed table of counters over hashed shingles finds the few that can be
   frequent; these are then counted exactly over all documents. A shingle in at least a share
   ``frequent`` of the documents weighs less, down to ``least_idf`` for one that all hold; the others
   keep the full weight 1. Weight is term frequency times that factor.
2. Every text gets 64 weighted samples in 16 bands of 4. Equal texts become one node.
3. In a bucket (a band's value) with several nodes, all are first compared with the least node.
   Where a bucket still spans several groups of linked nodes, a small one is compared pair by pair
   and a large one with a few more pivots. Large ones that are still divided are dealt to blocks
   that meet two at a time, and a matrix product compares all their nodes of different groups; only
   links that join groups leave a task. No bucket is capped, and pairs already joined are not made.
4. A pair is verified by the weighted Jaccard similarity of its whole texts (0.8 or more); pairs whose
   samples agree in fewer than 32 of 64 places reach that with a chance below 1e-7 and are left out.
   A pair of similarity 0.8 shares no bucket with a chance of 2.18e-4, so banding and this filter
   together lose it with a chance below 2.2e-4; blocks of large buckets compare without the filter.
5. Linked nodes become classes by repeated least labels. A class is named by its least document id.

Defined cases: a null or empty text has no words and is in a class of its own kind only with texts
that equal it; texts of one to four words compare by all their words; rows with the same id and
different texts are separate nodes; a null id is treated as any other value and a class of null
ids alone has a null name; further columns pass through ``representatives`` unchanged.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from edispark.llm import shingles as S
from edispark.llm.sampling import samples
from edispark.shipping import dropped, ship, stored


#: Buckets of up to so many nodes are compared pair by pair; larger ones with pivots, then in blocks.
SMALL, PIVOTS, BLOCK = 32, 4, 512
#: Parts that a large group of linked nodes is dealt to, and the share of all rows from which a class is large.
SALTS, LARGE = 16, 2000


@dataclass(frozen=True)
class Near:
    threshold: float = 0.8
    bands: int = 16
    rows: int = 4
    agree: int = 32
    frequent: float = 0.002
    least_idf: float = 0.8

    @property
    def count(self) -> int:
        return self.bands * self.rows


#: Counters for hashed shingles; with shares of 0.002 a counter's own noise stays below the share
#: for documents of up to 2,000 shingles on average, whatever their number.
COUNTERS = 1 << 20
_SLICE = 1 << 12
_SHIFT = np.uint64(44)


def node_of(text: Column) -> Column:
    return F.xxhash64(F.coalesce(text, F.lit("")))


def frequencies(docs: DataFrame, text_col: str, how: Near) -> tuple[dict[int, int], int]:
    """(shingle, documents that hold it) of all frequent shingles, and the number of documents.

    At most (mean shingles of a document) / ``frequent`` shingles can be frequent, whatever the
    corpus's size; that bounds what comes to the driver and goes to every task.
    """
    spark = docs.sparkSession
    texts = docs.select(text_col)

    def counters(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table, rows = np.zeros(COUNTERS, np.int64), 0
        for batch in batches:
            rows += batch.num_rows
            for _, _, data, at in S.parts(batch.column(0)):
                hashes, _, _ = S.shingles(data, at)
                table += np.bincount((hashes >> _SHIFT).astype(np.int64), minlength=COUNTERS)
        if rows:
            n = COUNTERS // _SLICE
            cut = [table[k * _SLICE : (k + 1) * _SLICE].astype("<i4").tobytes() for k in range(n)]
            yield pa.RecordBatch.from_arrays([pa.array(range(n), pa.int32()), pa.array([rows] + [0] * (n - 1), pa.int64()), pa.array(cut, pa.binary())], ["slice", "docs", "counts"])

    def added(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Sums of the slices that meet in a partition, one array for each."""
        sums: dict[int, list] = {}
        for batch in batches:
            for k, n, raw in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                have = sums.setdefault(k, [0, np.zeros(_SLICE, np.int64)])
                have[0] += n
                have[1] += np.frombuffer(raw, "<i4" if len(raw) == 4 * _SLICE else "<i8")
        for k, (n, counts) in sums.items():
            yield pa.RecordBatch.from_arrays([pa.array([k], pa.int32()), pa.array([n], pa.int64()), pa.array([counts.astype("<i8").tobytes()], pa.binary())], ["slice", "docs", "counts"])

    shape = "slice int, docs long, counts binary"
    sliced = texts.mapInArrow(counters, shape).repartition("slice").mapInArrow(added, shape)
    sliced = stored(sliced, "near-counters")
    n = sliced.agg(F.sum("docs")).first()[0] or 0
    least = max(2, math.ceil(how.frequent * n))

    def suspects(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k, _, raw in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                found = np.flatnonzero(np.frombuffer(raw, "<i8") >= least) + k * _SLICE
                yield pa.RecordBatch.from_arrays([pa.array(found, pa.int64())], ["counter"])

    marked = np.zeros(COUNTERS, bool)
    marked[[r[0] for r in sliced.mapInArrow(suspects, "counter long").collect()]] = True
    bits = spark.sparkContext.broadcast(np.packbits(marked).tobytes())

    def exact(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        on = np.unpackbits(np.frombuffer(bits.value, np.uint8)).astype(bool)
        held: list[np.ndarray] = []
        size = 0

        def out() -> pa.RecordBatch:
            own, times = np.unique(np.concatenate(held), return_counts=True)
            return pa.RecordBatch.from_arrays([pa.array(own.view(np.int64), pa.int64()), pa.array(times, pa.int64())], ["shingle", "n"])

        for batch in batches:
            for _, _, data, at in S.parts(batch.column(0)):
                hashes, _, _ = S.shingles(data, at)
                held.append(hashes[on[(hashes >> _SHIFT).astype(np.int64)]])
                size += len(held[-1])
                if size > 2_000_000:
                    yield out()
                    held, size = [], 0
        if size:
            yield out()

    counted = texts.mapInArrow(exact, "shingle long, n long").groupBy("shingle").agg(F.sum("n").alias("n")).where(F.col("n") >= least)

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Sixteen bytes for each frequent shingle are all that reaches the driver."""
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([c.to_numpy().astype("<i8").tobytes()], pa.binary()) for c in batch.columns], ["shingle", "n"])

    rows = counted.mapInArrow(packed, "shingle binary, n binary").collect()
    keys, values = (np.frombuffer(b"".join(r[c] for r in rows), "<i8").tolist() for c in ("shingle", "n"))
    return dict(zip(keys, values, strict=True)), n


class Weights:
    """TF-IDF weights of shingles from the frequent ones' counts."""

    def __init__(self, counts: dict[int, int], n: int, how: Near):
        keys = np.array(sorted(counts), np.int64)
        df = np.array([counts[int(k)] for k in keys], float)
        least = max(2, math.ceil(how.frequent * n))
        span = math.log(max(n / least, math.e))
        idf = how.least_idf + (1 - how.least_idf) * np.clip(np.log(np.maximum(n, 1) / df) / span, 0, 1) if len(keys) else df
        order = np.argsort(keys.view(np.uint64)) if len(keys) else []
        self.keys, self.idf = keys.view(np.uint64)[order] if len(keys) else keys.view(np.uint64), idf[order] if len(keys) else idf

    def of(self, hashes: np.ndarray, times: np.ndarray) -> np.ndarray:
        w = times.astype(float)
        if len(self.keys):
            spot = np.minimum(np.searchsorted(self.keys, hashes), len(self.keys) - 1)
            hit = self.keys[spot] == hashes
            w[hit] *= self.idf[spot[hit]]
        return w


def sketches(docs: DataFrame, text_col: str, id_col: str, weights, how: Near) -> DataFrame:
    """``id, node, bands, samples`` of every row; rows without words have no bands."""

    def over(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = weights.value
        for batch in batches:
            for a, b, data, at in S.parts(batch.column(2)):
                hashes, times, row_at = S.shingles(data, at)
                got = samples(hashes, known.of(hashes, times), row_at, how.count)
                full = np.diff(row_at) > 0
                band = np.zeros((b - a, how.bands), np.uint64)
                for r in range(how.rows):
                    band = S.mix(band * np.uint64(31) + got[:, r :: how.rows][:, : how.bands].astype(np.uint64) + np.uint64(1))
                band = S.mix(band + np.arange(1, how.bands + 1, dtype=np.uint64)[None, :] * np.uint64(0x9E3779B97F4A7C15))
                ends = np.concatenate([[0], np.cumsum(np.where(full, how.bands, 0))]).astype(np.int32)
                lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(band[full].reshape(-1).view(np.int64), pa.int64()))
                raw = [x.tobytes() for x in got]
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(a, b - a), batch.column(1).slice(a, b - a), lists, pa.array(raw, pa.binary())], ["id", "node", "bands", "samples"])

    src = docs.select(F.col(id_col).cast("long").alias("id"), node_of(F.col(text_col)).alias("node"), F.col(text_col).alias("text"))
    return src.mapInArrow(over, "id long, node long, bands array<long>, samples binary")


def similarities(texts: list[str], pairs: list[tuple[int, int]], weights: Weights) -> list[float]:
    """Weighted Jaccard similarity of pairs of places in ``texts``; each text is cut into shingles once."""
    vectors = []
    for _, _, data, at in S.parts(pa.array(texts, pa.string())):
        hashes, times, row_at = S.shingles(data, at)
        w = weights.of(hashes, times)
        vectors += [(hashes[x:y], w[x:y], float(w[x:y].sum())) for x, y in zip(row_at, row_at[1:], strict=False)]
    out = []
    for i, j in pairs:
        (ha, wa, ta), (hb, wb, tb) = vectors[i], vectors[j]
        if not len(ha) or not len(hb):
            out.append(float(texts[i] == texts[j]))
            continue
        spot = np.minimum(np.searchsorted(ha, hb), len(ha) - 1)
        hit = ha[spot] == hb
        low = float(np.minimum(wa[spot[hit]], wb[hit]).sum())
        out.append(low / (ta + tb - low))
    return out


def similarity(one: str, two: str, weights: Weights) -> float:
    return similarities([one, two], [(0, 1)], weights)[0]


def _agreeing(pairs: DataFrame, sketch: DataFrame, how: Near) -> DataFrame:
    """Of (a, b), those whose samples agree often enough for the threshold."""
    left = sketch.select(F.col("node").alias("a"), F.col("samples").alias("sa"))
    right = sketch.select(F.col("node").alias("b"), F.col("samples").alias("sb"))

    def over(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x, y = (np.array([np.frombuffer(r, np.uint32) for r in batch.column(k).to_pylist()]).reshape(-1, how.count) for k in (2, 3))
            keep = pa.array((x == y).sum(axis=1) >= how.agree)
            yield pa.RecordBatch.from_arrays([batch.column(0).filter(keep), batch.column(1).filter(keep)], ["a", "b"])

    return pairs.join(left, "a").join(right, "b").select("a", "b", "sa", "sb").mapInArrow(over, "a long, b long")


def _verified(pairs: DataFrame, texts: DataFrame, weights, how: Near) -> DataFrame:
    def over(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = weights.value
        for batch in batches:
            for k in range(0, batch.num_rows, 2048):
                part = batch.slice(k, 2048)
                spots: dict[str, int] = {}
                places = [[spots.setdefault(t or "", len(spots)) for t in part.column(c).to_pylist()] for c in (2, 3)]
                found = similarities(list(spots), list(zip(*places, strict=True)), known)
                keep = pa.array([x >= how.threshold for x in found], pa.bool_())
                yield pa.RecordBatch.from_arrays([part.column(0).filter(keep), part.column(1).filter(keep)], ["a", "b"])

    one = texts.select(F.col("node").alias("a"), F.col("text").alias("ta"))
    two = texts.select(F.col("node").alias("b"), F.col("text").alias("tb"))
    return pairs.join(one, "a").join(two, "b").select("a", "b", "ta", "tb").mapInArrow(over, "a long, b long")


def components(edges: DataFrame) -> DataFrame:
    """``node, comp`` for every node of an edge: least labels over edges with pointer jumps, until nothing changes."""
    both = stored(edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), "near-edges")
    label = stored(both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("m")).select("node", F.least("node", "m").alias("comp")), "near-labels")
    while True:
        seen = both.join(label.select(F.col("node").alias("b"), F.col("comp").alias("c")), "b").groupBy("a").agg(F.min("c").alias("c"))
        new = label.join(seen, label["node"] == seen["a"]).select("node", F.col("comp").alias("old"), F.least("comp", "c").alias("comp"))
        # only groups whose head has a smaller label itself jump: few rows, repeated for each part of a large group
        heads = label.select(F.col("comp").alias("_head")).distinct().join(label.toDF(*[f"_{c}" for c in label.columns]), F.col("_head") == F.col("_node"))
        heads = heads.where("_comp <> _node").select(F.col("_node").alias("comp"), F.col("_comp").alias("up"))
        heads = heads.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
        salted = new.withColumn("_salt", F.pmod(F.xxhash64("node", F.lit(3)), F.lit(SALTS)).cast("int"))
        new = stored(salted.join(heads, ["comp", "_salt"], "left").select("node", "old", F.coalesce("up", "comp").alias("comp")), "near-labels")
        dropped(label)
        label = new
        if new.where("old <> comp").isEmpty():
            dropped(both)
            return new.select("node", "comp")


def _open(placed: DataFrame, comps: DataFrame) -> DataFrame:
    """Members of the buckets of three nodes or more that span several groups: ``key, node, n, comp``."""
    labelled = placed.where("n > 2").join(comps, "node", "left").select("key", "node", "n", F.coalesce("comp", "node").alias("comp"))
    mixed = labelled.groupBy("key").agg(F.min("comp").alias("x"), F.max("comp").alias("y")).where("x <> y").select("key")
    return labelled.join(mixed, "key")


def spanning_links(one: pd.DataFrame, two: pd.DataFrame, weights: Weights, threshold: float) -> list[tuple[int, int]]:
    """Links between rows (node, comp, text) of two blocks at or over the threshold that join different groups.

    All pairs are compared: a shingle that occurs k times counts as k elements of the same weight, so
    the common weight of all pairs is a matrix product over the elements that both blocks hold.
    """
    sides = []
    for block in (one, two):
        ids, rows, w, at = [], [], [], 0
        for _, _, data, offsets in S.parts(pa.array(block["text"].fillna(""), pa.string())):
            hashes, times, row_at = S.shingles(data, offsets)
            own = np.repeat(np.arange(at, at + len(row_at) - 1), np.diff(row_at))
            nth = np.arange(times.sum()) - np.repeat(np.cumsum(times) - times, times)
            ids.append(S.mix(np.repeat(hashes, times) + nth.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)))
            rows.append(np.repeat(own, times))
            w.append(np.repeat(weights.of(hashes, np.ones(len(hashes))), times))
            at += len(row_at) - 1
        sides.append((np.concatenate(ids), np.concatenate(rows), np.concatenate(w), at))
    (ia, ra, wa, na), (ib, rb, wb, nb) = sides
    both = np.intersect1d(ia, ib)
    common = np.zeros((na, nb))
    for k in range(0, len(both), 4096):
        part = both[k : k + 4096]
        grids = []
        for ids, rows, w, n in ((ia, ra, wa, na), (ib, rb, np.ones(len(ib)), nb)):
            spot = np.minimum(np.searchsorted(part, ids), len(part) - 1)
            hit = part[spot] == ids
            grid = np.zeros((n, len(part)), np.float32)
            grid[rows[hit], spot[hit]] = w[hit]
            grids.append(grid)
        common += grids[0] @ grids[1].T
    whole = np.bincount(ra, wa, na)[:, None] + np.bincount(rb, wb, nb)[None, :] - common
    ca, cb = one["comp"].to_numpy(), two["comp"].to_numpy()
    close = (common >= (threshold - 1e-6) * np.maximum(whole, 1e-12)) & (ca[:, None] != cb[None, :])
    up: dict[int, int] = {}

    def root(x: int) -> int:
        while up.get(x, x) != x:
            x = up[x]
        return x

    out = []
    for i, j in np.argwhere(close):
        x, y = root(int(ca[i])), root(int(cb[j]))
        if x != y:
            up[x] = y
            out.append((int(one["node"].iloc[i]), int(two["node"].iloc[j])))
    return out


def _block_links(still: DataFrame, texts: DataFrame, weights, how: Near) -> DataFrame:
    """Links of open buckets, from blocks of about ``BLOCK`` nodes. Blocks of a bucket's largest group do not meet each other."""
    sizes = still.groupBy("key", "comp").agg(F.count("*").alias("m"))
    largest = sizes.groupBy("key").agg(F.max_by("comp", F.struct("m", "comp")).alias("g"), F.max("m").alias("mg"), F.sum("m").alias("all"))
    df = still.select("key", "node", "comp").join(largest, "key").join(texts, "node")
    big = F.col("comp") == F.col("g")
    n_big, n_rest = F.ceil(F.col("mg") / BLOCK).cast("int"), F.ceil((F.col("all") - F.col("mg")) / BLOCK).cast("int")
    own = F.pmod(F.xxhash64("node", F.lit(9)), F.when(big, n_big).otherwise(n_rest)).cast("int")
    df = df.withColumn("own", F.when(big, -1 - own).otherwise(own))
    # a block of the rest meets the other blocks of the rest, itself, and every block of the largest group (negative)
    others = F.when(big, F.sequence(F.lit(0), n_rest - 1)).otherwise(F.concat(F.sequence(F.lit(0), n_rest - 1), F.sequence(-n_big, F.lit(-1))))
    met = df.select("key", "node", "comp", "text", "own", F.explode(others).alias("other"))
    met = met.withColumn("lo", F.least("own", "other")).withColumn("hi", F.greatest("own", "other"))

    def over(pdf: pd.DataFrame) -> pd.DataFrame:
        one = pdf[pdf["own"] == pdf["lo"]]
        two = pdf[pdf["own"] == pdf["hi"]]
        links = spanning_links(one, two, weights.value, how.threshold) if len(one) and len(two) else []
        return pd.DataFrame(links, columns=["a", "b"], dtype="int64")

    return met.groupBy("key", "lo", "hi").applyInPandas(over, "a long, b long").distinct()


def _joined(comps: DataFrame, links: DataFrame) -> DataFrame:
    """Components after further links: these join components, so only their graph is labelled anew."""
    own = links
    for side in ("a", "b"):
        known = comps.select(F.col("node").alias(side), F.col("comp").alias("_c"))
        own = own.join(known, side, "left").withColumn(f"c{side}", F.coalesce("_c", side)).drop("_c")
    heads = components(own.select(F.col("ca").alias("a"), F.col("cb").alias("b")).where("a <> b"))
    new = links.select(F.col("a").alias("node")).union(links.select(F.col("b").alias("node"))).distinct().join(comps, "node", "left_anti").select("node", F.col("node").alias("comp"))
    up = heads.select(F.col("node").alias("comp"), F.col("comp").alias("_up"))
    return stored(comps.union(new).join(up, "comp", "left").select("node", F.coalesce("_up", "comp").alias("comp")), "near-labels")


def near_classes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", how: Near | None = None) -> tuple[DataFrame, DataFrame]:
    """(``id, node, copies`` of every distinct id and text, ``node, comp`` of every node that has links)."""
    how = how or Near()
    spark: SparkSession = docs.sparkSession
    ship(spark)
    counts, n = frequencies(docs, text_col, how)
    weights = spark.sparkContext.broadcast(Weights(counts, n, how))
    rows = stored(sketches(docs, text_col, id_col, weights, how), "near-sketches")
    members = rows.groupBy("id", "node").agg(F.count("*").alias("copies"))
    nodes = stored(rows.groupBy("node").agg(F.min(F.struct("id", "bands", "samples")).alias("x")).select("node", F.col("x.id").alias("id"), "x.bands", "x.samples"), "near-nodes")
    placed = nodes.select("node", F.explode("bands").alias("key"))
    buckets = stored(placed.groupBy("key").agg(F.count("*").alias("n"), F.min("node").alias("pivot")).where("n > 1"), "near-buckets")
    placed = stored(placed.join(buckets, "key").select("key", "node", "n", "pivot"), "near-members")
    sketch = nodes.select("node", "samples")
    # texts of nodes that share a bucket with another, one row for each
    shared = placed.select("node").distinct().join(nodes.select("node", "id"), "node")
    one = docs.select(F.col(id_col).cast("long").alias("_id"), node_of(F.col(text_col)).alias("_node"), F.col(text_col).alias("text"))
    texts = one.join(shared, (F.col("_node") == F.col("node")) & F.col("_id").eqNullSafe(F.col("id"))).select("node", "text")
    texts = stored(texts, "near-texts")
    texts = texts.groupBy("node").agg(F.first("text").alias("text")) if members.where("copies > 1").limit(1).count() else texts

    star = placed.where("node <> pivot").select(F.col("pivot").alias("a"), F.col("node").alias("b")).distinct()
    tried = stored(star, "near-pairs")
    edges = stored(_verified(_agreeing(tried, sketch, how), texts, weights, how), "near-links")
    comps = components(edges)
    # buckets of a few nodes: all pairs that still lie in different groups; larger ones: a few more pivots
    still = _open(placed, comps)
    spot = F.shiftrightunsigned(F.xxhash64("node", F.lit(5)), 1) / F.lit(float(2**63))
    pivots = still.where((F.col("n") <= SMALL) | (spot * F.col("n") < PIVOTS)).select("key", F.col("node").alias("p"), F.col("comp").alias("pc"))
    pairs = pivots.join(still.select("key", "node", "n", "comp"), "key").where((F.col("pc") != F.col("comp")) & ((F.col("n") > SMALL) | (F.col("p") < F.col("node"))))
    pairs = pairs.select(F.least("p", "node").alias("a"), F.greatest("p", "node").alias("b")).distinct().join(tried, ["a", "b"], "left_anti")
    found = stored(_verified(_agreeing(pairs, sketch, how), texts, weights, how), "near-links")
    if not found.isEmpty():
        comps = _joined(comps, found)
    # larger buckets that still span several groups: block by block, all pairs of different groups
    still = stored(_open(placed, comps).where(F.col("n") > SMALL), "near-open")
    if not still.isEmpty():
        found = stored(_block_links(still, texts, weights, how), "near-links")
        if not found.isEmpty():
            comps = _joined(comps, found)
    return members, comps


def _named(members: DataFrame, comps: DataFrame) -> DataFrame:
    """Members with their group's name and its least id.

    Groups of more than 1/``LARGE`` of all members are fewer than ``LARGE``, so their rows are broadcast; the members of all others meet in a shuffle.
    """
    named = stored(members.join(comps, "node", "left").select("id", "node", "copies", F.coalesce("comp", "node").alias("comp")), "near-named")
    least = stored(named.groupBy("comp").agg(F.min("id").alias("class_id"), F.count("*").alias("n")), "near-least")
    total = least.agg(F.sum("n")).first()[0] or 0
    large = least.where(F.col("n") * LARGE > total).select("comp", F.struct("class_id").alias("_large"))
    some = named.join(F.broadcast(large), "comp", "left")
    rest = some.where("_large is null").drop("_large").join(least.drop("n"), "comp")
    return rest.select("id", "node", "copies", "comp", "class_id").union(some.where("_large is not null").select("id", "node", "copies", "comp", "_large.class_id"))


def classes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", how: Near | None = None) -> DataFrame:
    """One row for each row of ``docs``: its id and ``class_id``, the least id of its class."""
    members, comps = near_classes(docs, id_col, text_col, how)
    out = _named(members, comps).select(F.col("id").alias(id_col), "class_id", "copies")
    # many equal rows become one list for each few thousand of them
    out = out.withColumn("_k", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("copies") - 1) / 4096).cast("long"))))
    return out.withColumn("_c", F.explode(F.sequence(F.col("_k") * 4096 + 1, F.least(F.col("copies"), (F.col("_k") + 1) * 4096)))).select(id_col, "class_id")


def representatives(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", how: Near | None = None) -> DataFrame:
    """One row of each class, with all columns of ``docs``: the row of the least id."""
    members, comps = near_classes(docs, id_col, text_col, how)
    named = members.join(comps, "node", "left").select("id", "node", "copies", F.coalesce("comp", "node").alias("comp"))
    chosen = named.groupBy("comp").agg(F.min(F.struct(F.col("id").isNull().alias("none"), "id", "node", "copies")).alias("x")).select(F.col("x.id").alias("_cid"), F.col("x.node").alias("_cnode"), F.col("x.copies").alias("_copies"))
    cols = docs.columns
    whole = docs.select(F.struct(*[F.col(f"`{c}`") for c in cols]).alias("_row"), F.col(id_col).cast("long").alias("_rid"), node_of(F.col(text_col)).alias("_rnode"))
    kept = whole.join(chosen, (F.col("_rnode") == F.col("_cnode")) & F.col("_rid").eqNullSafe(F.col("_cid")))
    one = kept.where("_copies = 1").select("_row")
    # several rows of the same id and text: the one whose other columns come first as text
    many = kept.where("_copies > 1").groupBy("_rid", "_rnode").agg(F.min_by("_row", F.to_json("_row")).alias("_row")).select("_row")
    return one.unionByName(many).select(*[F.col("_row")[c].alias(c) for c in cols])
