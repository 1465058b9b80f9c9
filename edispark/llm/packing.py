"""Best-fit packing of documents into bins of a fixed number of tokens, under conflicts.

A bin may hold at most ``source_quota`` pieces of one source and no two pieces of one duplicate
cluster. Documents longer than a bin are cut into full pieces and a rest; nothing is dropped.

Rows are dealt by hash into groups of a bounded number of pieces, so a hot source or a large cluster
spreads over all groups. Equal rows are counted first and told apart by a number, so that groups and bins depend
on the rows alone: a repeated task or another partitioning gives the same bins. In a group pieces go from long to short. Bins are ordered by residual
tokens; each carries a bitmap of sources at their quota and one of the clusters it holds. The
successor search begins at the least residual that fits and goes on until a bin's bitmaps are
free of the piece's bits: the tightest compatible bin. If there is none, a bin is opened.

Defined cases: a null or empty text has length 0 and takes a place in some bin; a null source is a
source of its own; equal texts are one cluster if no cluster column is given; equal rows are
different pieces (of one cluster); ties in length go by id and text hash; an empty table gives
no rows; further columns are ignored.
"""

from __future__ import annotations

from bisect import insort

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from edispark.llm.common import word_count
from edispark.shipping import ship, stored

#: Pieces that a group holds on average.
GROUP_PIECES = 8192


class Bins:
    """Bins ordered by residual, found by the next set bit of a bitmap over residuals."""

    def __init__(self, capacity: int, source_quota: int):
        self.capacity, self.quota = capacity, source_quota
        self.at: list[list[int]] = [[] for _ in range(capacity + 1)]
        self.filled = 0
        self.sources: list[int] = []
        self.clusters: list[int] = []
        self.counts: list[dict[int, int]] = []

    def place(self, size: int, source: int, cluster: int) -> int:
        """The bin for a piece; ``source`` and ``cluster`` are bits, the latter 0 for a piece without copies."""
        rest = self.filled >> size
        residual = size
        while rest:
            step = (rest & -rest).bit_length() - 1
            residual += step
            for spot, b in enumerate(self.at[residual]):
                if not (self.sources[b] & source or self.clusters[b] & cluster):
                    del self.at[residual][spot]
                    if not self.at[residual]:
                        self.filled &= ~(1 << residual)
                    return self._put(b, residual - size, source, cluster)
            rest >>= step + 1
            residual += 1
        b = len(self.sources)
        self.sources.append(0)
        self.clusters.append(0)
        self.counts.append({})
        return self._put(b, self.capacity - size, source, cluster)

    def _put(self, b: int, residual: int, source: int, cluster: int) -> int:
        n = self.counts[b][source] = self.counts[b].get(source, 0) + 1
        if n >= self.quota:
            self.sources[b] |= source
        self.clusters[b] |= cluster
        insort(self.at[residual], b)
        self.filled |= 1 << residual
        return b


def pack(sizes: np.ndarray, sources: np.ndarray, clusters: np.ndarray, capacity: int, source_quota: int) -> list[int]:
    """Bin numbers of pieces in the given order; ``sources`` and ``clusters`` are small integers, -1 for no cluster."""
    bins = Bins(capacity, source_quota)
    return [bins.place(int(n), 1 << int(s), 0 if c < 0 else 1 << int(c)) for n, s, c in zip(sizes, sources, clusters, strict=True)]


def pieces(rows: DataFrame, groups: int) -> DataFrame:
    """``rows`` (doc_id, source, size, cluster) with ``salt``, a hash of the row and its number among equal ones, and its group."""
    same = rows.groupBy("doc_id", "source", "size", "cluster").agg(F.count("*").alias("_n"))
    # two steps, so that many equal rows never make one long list
    step = F.lit(4096)
    some = same.withColumn("_k", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("_n") - 1) / step).cast("long"))))
    one = some.withColumn("_copy", F.explode(F.sequence(F.col("_k") * step, F.least(F.col("_n"), (F.col("_k") + 1) * step) - 1)))
    salted = one.withColumn("salt", F.xxhash64("doc_id", "source", "size", "cluster", "_copy")).drop("_n", "_k", "_copy")
    return salted.withColumn("group", F.pmod(F.xxhash64("salt", F.lit(1)), F.lit(groups)).cast("long"))


def packed(docs: DataFrame, capacity: int = 2048, source_quota: int = 4, id_col: str = "doc_id", source_col: str = "source", text_col: str = "text", tokens: Column | None = None, cluster: Column | None = None) -> DataFrame:
    """``bin_id, doc_id, source, piece, n_tokens, bin_tokens`` for every piece of every row."""
    spark = docs.sparkSession
    ship(spark)
    n = word_count(F.col(text_col)) if tokens is None else tokens
    mark = F.xxhash64(F.coalesce(F.col(text_col), F.lit(""))) if cluster is None else cluster
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(source_col).cast("string").alias("source"), n.cast("long").alias("size"), mark.cast("long").alias("cluster"))
    # counting words is what costs: the few bytes of each row are written once
    rows = stored(rows, "packing-rows")
    sums = rows.agg(F.count("*").alias("n"), F.sum(F.floor(F.col("size") / capacity)).alias("full")).first()
    groups = max(1, -(-(sums["n"] + (sums["full"] or 0)) // GROUP_PIECES))
    salted = pieces(rows, groups)
    whole = F.floor(F.col("size") / capacity).cast("int")
    rest = F.col("size") - whole * capacity
    # full pieces fill a bin each, without a search; only rests meet others
    full = salted.where(whole > 0).select("group", "doc_id", "source", "size", "cluster", "salt", F.explode(F.sequence(F.lit(0), whole - 1)).alias("piece"))
    full = full.select(
        F.concat_ws("-", F.lit("f"), F.coalesce("doc_id", F.lit("")), F.hex("salt"), F.col("piece")).alias("bin_id"), "doc_id", "source", "piece", F.lit(capacity).cast("long").alias("n_tokens"), F.lit(capacity).cast("long").alias("bin_tokens")
    )
    # pandas would turn nullable integers to floats: a null id travels as a flag
    rests = salted.where((rest > 0) | (whole == 0)).select("group", F.coalesce("doc_id", F.lit(0)).alias("doc_id"), F.col("doc_id").isNull().alias("no_id"), "source", "cluster", "salt", whole.alias("piece"), rest.alias("n"))

    def over(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["n", "doc_id", "cluster", "salt"], ascending=[False, True, True, True], kind="stable")
        source = pd.factorize(pdf["source"], use_na_sentinel=False)[0]
        copies = pdf.groupby("cluster")["n"].transform("size").to_numpy()
        mark = np.full(len(pdf), -1)
        mark[copies > 1] = pd.factorize(pdf["cluster"][copies > 1])[0]
        bins = pack(pdf["n"].to_numpy(), source, mark, capacity, source_quota)
        filled = np.bincount(bins, weights=pdf["n"].to_numpy()).astype("i8")
        return pd.DataFrame(
            {"bin_id": [f"{pdf['group'].iloc[0]}-{b}" for b in bins], "doc_id": pdf["doc_id"].to_numpy(), "no_id": pdf["no_id"].to_numpy(), "source": pdf["source"].to_numpy(), "piece": pdf["piece"].to_numpy(), "n_tokens": pdf["n"].to_numpy(), "bin_tokens": filled[bins]}
        )

    best = rests.groupBy("group").applyInPandas(over, "bin_id string, doc_id long, no_id boolean, source string, piece int, n_tokens long, bin_tokens long")
    best = best.withColumn("doc_id", F.when(~F.col("no_id"), F.col("doc_id"))).drop("no_id")
    return best.unionByName(full)
