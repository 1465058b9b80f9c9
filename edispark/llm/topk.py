"""Exact top-k by inner product with block-at-a-time pruning.

Components are the terms. Candidates are ordered by their largest components (which and of what sign), so that
blocks of consecutive rows hold vectors alike, and cut into blocks. A block has a forward index (its
component matrix) and, in a summary of two rows, the greatest and least value of every term. For a query, the
sum over terms of the larger of query * greatest and query * least bounds every score in the block.

1. Queries meet the summaries of blocks, a run of them at a time; each run names the block of the query's best
   bound, and of these the query's few best are scored: the k-th score found there is a floor under its true k-th.
2. Summaries again: blocks whose bound is under the query's floor are left out for good.
3. Only the (query, block) pairs that are left meet: a block's rows travel once for each group of queries that asks
   for it, blocks are taken in descending order of the bound and scored until the next bound is below the k-th score.
A last grouped top-k merges k rows for each query and run.

How much is left out depends on the vectors: in clustered tables most blocks are; for directions that are spread evenly
over many dimensions no bound by terms can be under a k-th score, and every block is scored (``BlockCounts`` tells).

Defined cases: vectors that are null, hold null or hold non-finite components take no part, nor do
empty ones and rows without an id; shorter vectors count as padded with zeros; equal scores go to the smaller id; the
query's own id is left out (all rows with that id); scores beyond a long saturate; a table
without vectors gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from edispark.shipping import ship, stored

#: Rows of a block, blocks of a run, summaries of a run, queries of a group, groups of a part, blocks scored for a query's floor.
BLOCK, RUN_BLOCKS, RUN_SUMMARIES, QUERY_GROUP, PART_GROUPS, SEEDS = 128, 128, 1024, 256, 16, 2
_SAFE = float(2**53)
_LONG = 2**63 - 1


def _packed(size: int):
    """Consecutive rows of a partition as one binary row each of up to ``size`` vectors: ids, width, components."""

    def over(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        ids: list[int] = []
        vecs: list[np.ndarray] = []

        def out() -> pd.DataFrame:
            width = max(len(v) for v in vecs)
            m = np.zeros((len(vecs), width))
            for k, v in enumerate(vecs):
                m[k, : len(v)] = v
            # as double: floor(256 * x) is a whole number that a double holds exactly
            return pd.DataFrame({"ids": [np.array(ids, "<i8").tobytes()], "width": [width], "values": [m.astype("<f8").tobytes()]})

        for pdf in batches:
            for i, v in zip(pdf["_id"], pdf["_v"], strict=True):
                ids.append(i)
                vecs.append(np.floor(256.0 * np.asarray(v, "f8")))
                if len(ids) == size:
                    yield out()
                    ids, vecs = [], []
        if ids:
            yield out()

    return over


def _exact(q: np.ndarray, m: np.ndarray, most: float) -> np.ndarray:
    """Integer inner products of a query with rows, in doubles where ``most`` shows them exact and in Python integers otherwise."""
    if most < _SAFE:
        return (m @ q).astype("i8")
    whole = [[int(x) for x in row] for row in m]
    one = [int(x) for x in q]
    return np.array([max(min(sum(a * b for a, b in zip(one, row, strict=True)), _LONG), -_LONG - 1) for row in whole], "i8")


def bounds_of(q: np.ndarray, top: np.ndarray, low: np.ndarray) -> np.ndarray:
    """The summed term maxima of blocks for queries; a double's rounding is covered by a relative margin."""
    bounds = np.maximum(q, 0) @ top.T + np.minimum(q, 0) @ low.T
    return bounds + (np.abs(q) @ np.maximum(np.abs(top), np.abs(low)).T) * 1e-12


def _wide(m: np.ndarray, width: int) -> np.ndarray:
    return np.pad(m, ((0, 0), (0, width - m.shape[1])))


def search_run(queries: tuple[np.ndarray, np.ndarray], blocks: list[tuple[np.ndarray, np.ndarray]], k: int, floors: np.ndarray | None = None) -> Iterator[tuple[int, int, int]]:
    """(query id, candidate id, score) of each query's best ``k`` in a run of blocks; nothing under a query's floor need be found."""
    q_ids, q = queries
    width = max([q.shape[1], *(m.shape[1] for _, m in blocks)])
    q = _wide(q, width)
    mats = [_wide(m, width) for _, m in blocks]
    bounds = bounds_of(q, np.array([m.max(axis=0) for m in mats]), np.array([m.min(axis=0) for m in mats]))
    most = np.abs(q).max(axis=1, initial=0)[:, None] * np.array([np.abs(m).max(initial=0) for m in mats]) * width
    floors = np.full(len(q), -np.inf) if floors is None else floors
    for row in range(len(q)):
        best_s, best_i = np.empty(0, "i8"), np.empty(0, "i8")
        for b in np.argsort(-bounds[row], kind="stable"):
            if bounds[row, b] < floors[row] or (len(best_s) == k and bounds[row, b] < best_s[-1]):
                break
            ids = blocks[b][0]
            s = _exact(q[row], mats[b], most[row, b])
            if len(best_s) == k and s.max() < best_s[-1]:
                continue
            own = ids != q_ids[row]
            s, i = np.concatenate([best_s, s[own]]), np.concatenate([best_i, ids[own]])
            if len(s) > 4 * k:
                # everything tied with the k-th stays for the order by id
                floor = np.partition(s, len(s) - k)[len(s) - k]
                s, i = s[s >= floor], i[s >= floor]
            order = np.lexsort((i, -s))[:k]
            best_s, best_i = s[order], i[order]
        for i, s in zip(best_i, best_s, strict=True):
            yield int(q_ids[row]), int(i), int(s)


def _summaries(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Blocks as runs of (numbers, greatest and least values), consecutive ones together."""
    held: list[tuple[int, str, np.ndarray, np.ndarray]] = []

    def out() -> pd.DataFrame:
        width = max(len(t) for *_, t, _ in held)
        tops, lows = (np.array([np.pad(x[k], (0, width - len(x[k]))) for x in held]) for k in (2, 3))
        # a shorter block's padding is 0, as its vectors' is
        row = {"srun": [held[0][0]], "bids": [np.array([x[0] for x in held], "<i8").tobytes()], "width": [width], "top": [tops.astype("<f8").tobytes()], "low": [lows.astype("<f8").tobytes()]}
        held.clear()
        return pd.DataFrame(row)

    for pdf in batches:
        for bid, run, width, values in zip(pdf["bid"], pdf["run"], pdf["width"], pdf["values"], strict=True):
            m = np.frombuffer(values, "<f8").reshape(-1, width)
            held.append((bid, run, m.max(axis=0), m.min(axis=0)))
            if len(held) == RUN_SUMMARIES:
                yield out()
    if held:
        yield out()


def _queries(rows: pd.DataFrame) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray | None]]:
    """(group, ids, vectors, floors) of packed queries."""
    for r in rows.itertuples(index=False):
        floors = np.frombuffer(r.floors, "<f8") if "floors" in rows.columns else None
        yield r.g, np.frombuffer(r.ids, "<i8"), np.frombuffer(r.values, "<f8").reshape(-1, r.width), floors


def _bounds(q: np.ndarray, row) -> tuple[np.ndarray, np.ndarray]:
    """Numbers of a run's blocks and the bounds of each query for them."""
    top, low = (np.frombuffer(x, "<f8").reshape(-1, row.width) for x in (row.top, row.low))
    width = max(q.shape[1], row.width)
    return np.frombuffer(row.bids, "<i8"), bounds_of(_wide(q, width), _wide(top, width), _wide(low, width))


def valid(vector: Column) -> Column:
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return vector.isNotNull() & (F.size(vector) > 0) & F.coalesce(finite, F.lit(False))


@dataclass
class BlockCounts:
    """(query, block) pairs in all and those that no bound left out before the search."""

    pairs: int = 0
    left: int = 0


def top_k(vectors: DataFrame, queries: Column, k: int = 5, id_col: str = "vec_id", vector_col: str = "embedding", counts: BlockCounts | None = None) -> DataFrame:
    """``query_id, rank, vec_id, score`` for the rows of ``vectors`` where ``queries`` holds, against all rows.

    ``counts``, if given, is filled in.
    """
    spark = vectors.sparkSession
    ship(spark)
    rows = vectors.where(valid(F.col(vector_col))).select(F.col(id_col).cast("long").alias("_id"), F.col(vector_col).cast("array<double>").alias("_v"), F.coalesce(queries, F.lit(False)).alias("_q"))
    rows = rows.where("_id is not null")
    # which components are largest, and their signs: vectors alike stand together
    rows = rows.withColumn("_size", F.transform("_v", lambda x: F.abs(x)))
    for name, order in (("_o1", 1), ("_o2", 2)):
        at = F.array_position("_size", F.element_at(F.sort_array("_size", asc=False), order) if order == 1 else F.coalesce(F.try_element_at(F.sort_array("_size", asc=False), F.lit(order)), F.lit(-1.0)))
        rows = rows.withColumn(name, F.when(at > 0, at * F.signum(F.element_at("_v", F.greatest(at, F.lit(1)).cast("int")))).otherwise(0))
    alike = ["_o1", "_o2", "_id"]
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    packed = "ids binary, width int, values binary"

    def numbered(df: DataFrame, number: str, together: str, size: int) -> DataFrame:
        low = F.col(number).bitwiseAND(F.lit(2**33 - 1))
        return df.withColumn(number, F.monotonically_increasing_id()).withColumn(together, F.concat_ws("-", F.shiftright(number, 33), F.floor(low / size)))

    blocks = rows.select("_v", *alike).repartitionByRange(n, *alike).sortWithinPartitions(*alike).mapInPandas(_packed(BLOCK), packed)
    blocks = stored(numbered(blocks, "bid", "run", RUN_BLOCKS), "topk-blocks")
    asked = rows.where("_q").select("_v", *alike).repartitionByRange(max(1, n // 4), *alike).sortWithinPartitions(*alike).mapInPandas(_packed(QUERY_GROUP), packed)
    asked = stored(numbered(asked, "g", "part", PART_GROUPS), "topk-queries")
    summaries = stored(blocks.mapInPandas(_summaries, "srun long, bids binary, width int, top binary, low binary"), "topk-summaries")

    def meet(left: DataFrame, right: DataFrame, by: str, over, shape: str) -> DataFrame:
        """Parts of queries with runs; only names of parts and runs are paired."""
        pairs = right.select("part", by).distinct() if "part" in right.columns else left.select("part").distinct().crossJoin(right.select(by).distinct())
        one = left.join(pairs, "part")
        two = right if "part" in right.columns else pairs.join(right, by)
        one = one.toDF(*one.columns)  # columns of its own, though both sides come from the pairs
        return one.groupBy("part", by).cogroup(two.groupBy("part", by)).applyInPandas(over, shape)

    def seeds(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        out = []
        for g, ids, q, _ in _queries(left):
            for row in right.itertuples(index=False):
                bids, bounds = _bounds(q, row)
                for spots in np.argsort(-bounds, axis=1, kind="stable")[:, :SEEDS].T:
                    out.append(pd.DataFrame({"part": left["part"].iloc[0], "g": g, "query_id": ids, "bid": bids[spots], "bound": bounds[np.arange(len(q)), spots]}))
        return pd.concat(out) if out else pd.DataFrame(columns=["part", "g", "query_id", "bid", "bound"])

    def search(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        some = [(np.frombuffer(r.ids, "<i8"), np.frombuffer(r.values, "<f8").reshape(-1, r.width)) for r in right[["ids", "width", "values"]].itertuples(index=False)]
        out = [(g, *x) for g, ids, q, floors in _queries(left) if some for x in search_run((ids, q), some, k, floors)]
        return pd.DataFrame(out, columns=["g", "query_id", "vec_id", "score"])

    def lower(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        """Each group of queries with its floors in the order of its ids."""
        known = dict(zip(right["query_id"], right["floor"], strict=True))
        return left.assign(floors=[np.array([known.get(i, -np.inf) for i in np.frombuffer(x, "<i8")], "<f8").tobytes() for x in left["ids"]])

    def asking(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        """Blocks that some query of the part may need, with how many do."""
        wanted: dict[int, int] = {}
        asked_in_all = 0
        for _, _, q, floors in _queries(left):
            for row in right.itertuples(index=False):
                bids, bounds = _bounds(q, row)
                asked_in_all += bounds.size
                for b, m in zip(bids.tolist(), (bounds >= floors[:, None]).sum(axis=0).tolist(), strict=True):
                    wanted[b] = wanted.get(b, 0) + m
        out = pd.DataFrame({"part": left["part"].iloc[0], "bid": list(wanted), "n": list(wanted.values())}) if len(left) else pd.DataFrame(columns=["part", "bid", "n"])
        return out.assign(pairs=[asked_in_all] + [0] * (len(out) - 1) if len(out) else [])

    found = "g long, query_id long, vec_id long, score long"
    first = meet(asked, summaries, "srun", seeds, "part string, g long, query_id long, bid long, bound double")
    leading = Window.partitionBy("g", "query_id").orderBy(F.col("bound").desc(), "bid")
    first = first.withColumn("_r", F.row_number().over(leading)).where(F.col("_r") <= SEEDS).select("part", "bid").distinct()
    tried = meet(asked, blocks.join(first, "bid"), "run", search, found)
    nth = Window.partitionBy("g", "query_id").orderBy(F.col("score").desc(), "vec_id")
    floors = tried.withColumn("_r", F.row_number().over(nth)).where(F.col("_r") == k).select("g", "query_id", F.col("score").cast("double").alias("floor"))
    asked = stored(asked.groupBy("g").cogroup(floors.groupBy("g")).applyInPandas(lower, asked.select("ids", "width", "values", "g", "part").schema.add("floors", "binary")), "topk-floors")
    left = stored(meet(asked, summaries, "srun", asking, "part string, bid long, n long, pairs long"), "topk-left")
    if counts is not None:
        got = left.agg(F.sum("pairs"), F.sum("n")).first()
        counts.pairs, counts.left = got[0] or 0, got[1] or 0
    near = meet(asked, blocks.join(left.where("n > 0").select("part", "bid"), "bid"), "run", search, found)
    best = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    return near.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k).select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
