"""Temperature mixing of sources under a token budget, with DataFrame functions only.

Source *i* holds S_i tokens. Its weight is w_i = S_i^a / sum_j S_j^a, where the exponent *a* in
[0, 1] is bisected: 1 keeps the shares of the corpus, 0 gives every source the same. A budget of
B tokens allots B * w_i tokens to source *i*: whole passes over the source and a part of one more.
A document's block is fixed, by a hash of the seed and the document. Each pass permutes the blocks of a source, by a hash
of the pass and the block, and the documents in each block; the part pass is a prefix of its permutation.

Nothing is gathered on the driver but one row of sums for each candidate exponent. The part
pass is cut in three steps: by runs of blocks that follow one another, by the blocks of one run, and by the documents of
one block, so no window ever holds more than the runs of a source, the blocks of a run or the documents of a block.

Defined cases: a null source is a source of its own; a null or empty text has no tokens and goes
with the documents around it in the permutation; sources without any token get one pass; equal
rows share a hash and move together; an empty table gives an empty result; input columns keep
their names, also where they clash with the working columns.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from edispark.llm.common import word_count
from edispark.shipping import stored

#: Interior points tried in one job: 63 points are six bisection steps.
POINTS, ROUNDS = 63, 5
BLOCK_DOCS = 4096


@dataclass(frozen=True)
class Goal:
    """What the exponent must meet; with both given, the larger exponent of the two holds.

    ``entropy`` is a share of the largest possible entropy, the logarithm of the number of sources.
    ``repeats`` limits the passes over any source. ``budget`` is in tokens; None is the corpus's own
    number of tokens, and "cover" the least budget that shows every document once.
    """

    entropy: float | None = None
    repeats: float | None = None
    budget: int | str | None = None
    seed: int = 7


def _sums(totals: DataFrame, points: list[float], top: float) -> list:
    """For each exponent: sums for the entropy of the weights, and the logs of the largest and least weight to share ratio."""
    each = totals.select("_lns", F.explode(F.array(*[F.lit(p) for p in points])).alias("a"))
    x = (F.col("_lns") - F.lit(top)) * F.col("a")
    # w_i / share_i = S_i^(a - 1) * T / Z, here without T and with Z scaled by the largest source
    ratio = (F.col("a") - 1) * F.col("_lns") - F.col("a") * F.lit(top)
    got = each.groupBy("a").agg(F.sum(F.exp(x)).alias("z"), F.sum(F.exp(x) * x).alias("zx"), F.max(ratio).alias("most"), F.min(ratio).alias("least"))
    return sorted(got.collect(), key=lambda r: r["a"])


def exponent(totals: DataFrame, goal: Goal) -> tuple[float, float, float]:
    """(exponent, log of the sum of powers, budget in tokens) for ``totals`` with ``_lns``, the log of each source's tokens."""

    whole = totals.agg(F.max("_lns").alias("top"), F.log(F.sum(F.exp("_lns"))).alias("lnt"), F.count("*").alias("n")).first()
    if not whole["n"]:
        return 1.0, 0.0, 0.0
    lnt = whole["lnt"]

    def budget_log(r) -> float:
        if goal.budget == "cover":
            return math.log(r["z"]) - r["least"]
        return lnt if goal.budget is None else math.log(max(goal.budget, 1))

    def few_repeats(r) -> bool:
        return r["most"] - math.log(r["z"]) + budget_log(r) <= math.log(goal.repeats) + 1e-12

    def uneven(r) -> bool:
        return math.log(r["z"]) - r["zx"] / r["z"] < goal.entropy * math.log(whole["n"]) - 1e-12

    def bisect(low: float, high: float, wanted) -> float:
        """The border in [low, high] above which ``wanted`` holds."""
        for _ in range(ROUNDS):
            rows = _sums(totals, [low + (high - low) * k / (POINTS + 1) for k in range(POINTS + 2)], whole["top"])
            k = next((k for k, r in enumerate(rows) if wanted(r)), len(rows) - 1)
            low, high = rows[max(k - 1, 0)]["a"], rows[k]["a"]
        return high

    found = []
    if goal.entropy is not None:
        found.append(bisect(0.0, 1.0, uneven))
    if goal.repeats is not None:
        found.append(bisect(0.0, 1.0, few_repeats))
    a = max(found, default=1.0)
    r = _sums(totals, [a], whole["top"])[0]
    return a, a * whole["top"] + math.log(r["z"]), math.exp(budget_log(r))


def block_of(seed: int, blocks: Column) -> Column:
    """The block of a document, the same in every pass."""
    spot = F.shiftrightunsigned(F.xxhash64(F.lit(seed), F.lit("block"), F.col("_id"), F.col("_n")), 1) / F.lit(float(2**63))
    return F.least(F.floor(spot * blocks).cast("long"), blocks - 1)


#: Bits of a permutation key: of a block's place, of which the first name its run, then of a document's in it.
BLOCK_BITS, DOC_BITS, RUN_SHIFT = 40, 23, 28


def _key(seed: int, turn: Column, source: Column, block: Column) -> Column:
    """The permutation key of a document in a pass, 63 bits: the block's place, then the document's in the block."""
    place = F.shiftrightunsigned(F.xxhash64(F.lit(seed), turn.cast("long"), source.cast("string"), block), 64 - BLOCK_BITS)
    own = F.shiftrightunsigned(F.xxhash64(F.lit(seed), turn.cast("long"), F.col("_id"), F.col("_n")), 64 - DOC_BITS)
    return F.shiftleft(place, DOC_BITS).bitwiseOR(own)


def _border(rows: DataFrame, key: Column) -> DataFrame:
    """``_s, _at, _before``: of each source the key at which its rest ends, and the tokens before that."""
    sums = rows.withColumn("_at", key).groupBy("_s", "_at").agg(F.sum("_n").alias("_sum"), F.max("_rest").alias("_rest"), F.max("_base").alias("_base"))
    so_far = Window.partitionBy("_s").orderBy("_at").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.withColumn("_before", F.col("_base") + F.coalesce(F.sum("_sum").over(so_far), F.lit(0)))
    return stored(sums.where("_before < _rest and _before + _sum >= _rest").select("_s", "_at", "_before"), "mix-borders")


def _within(rows: DataFrame, border: DataFrame, key: Column) -> DataFrame:
    """The rows at the border, with the tokens before it as ``_base``; at most one key for each source."""
    met = rows["_s"].eqNullSafe(border["_s"]) & (key == border["_at"])
    return rows.join(border, met).select(border["_s"], "_n", "_rest", "_k", F.col("_before").alias("_base"))


def plan(sizes: DataFrame, goal: Goal) -> DataFrame:
    """One row for each source: ``_s, _tokens, _docs, _weight, _allotted, _full, _cut, _blocks``.

    ``sizes`` has ``_s`` (source), ``_id`` and ``_n`` (tokens). ``_full`` whole passes come first; in
    pass ``_full`` the documents whose key is at most ``_cut`` follow (-1: none).
    """
    totals = stored(sizes.groupBy("_s").agg(F.sum("_n").alias("_tokens"), F.count("*").alias("_docs")), "mix-sources")
    a, lnz, budget = exponent(totals.where("_tokens > 0").select(F.log("_tokens").alias("_lns")), goal)
    some = F.col("_tokens") > 0
    weight = F.when(some, F.exp(F.lit(a) * F.log("_tokens") - F.lit(lnz))).otherwise(0.0)
    totals = totals.withColumn("_weight", weight).withColumn("_allotted", F.when(some, F.round(F.col("_weight") * F.lit(budget)).cast("long")).otherwise(0))
    full = F.floor(F.col("_allotted") / F.col("_tokens"))
    # the budget that covers the corpus shows each document once at least, whatever the last bits of its sums
    full = F.greatest(full, F.lit(1)) if goal.budget == "cover" else full
    totals = totals.withColumn("_full", F.when(some, full).otherwise(1).cast("long"))
    totals = totals.withColumn("_rest", F.when(some, F.greatest(F.col("_allotted") - F.col("_full") * F.col("_tokens"), F.lit(0))).otherwise(0))
    totals = stored(totals.withColumn("_blocks", F.ceil(F.col("_docs") / F.lit(BLOCK_DOCS)).cast("long")), "mix-allotments")
    # the part pass: run, block and document at which each source's rest ends
    own = sizes.join(totals.where("_rest > 0"), sizes["_s"].eqNullSafe(totals["_s"])).select(totals["_s"], "_id", "_n", "_rest", "_full", "_blocks")
    keyed = own.withColumn("_k", _key(goal.seed, F.col("_full"), F.col("_s"), block_of(goal.seed, F.col("_blocks")))).select("_s", "_n", "_rest", "_k")
    place, run = F.shiftright("_k", DOC_BITS), F.shiftright("_k", DOC_BITS + RUN_SHIFT)
    first = _border(keyed.withColumn("_base", F.lit(0).cast("long")), run)
    second = _border(_within(keyed, first, run), place)
    inside = _within(keyed, second, place)
    # equal keys go together; a document belongs to the part pass if at least half of it lies within the rest
    per_key = inside.groupBy("_s", "_k").agg(F.sum("_n").alias("_n"), F.max("_rest").alias("_rest"), F.max("_base").alias("_base"))
    in_block = Window.partitionBy("_s").orderBy("_k").rowsBetween(Window.unboundedPreceding, -1)
    per_key = per_key.withColumn("_at", F.col("_base") + F.coalesce(F.sum("_n").over(in_block), F.lit(0)))
    cuts = per_key.groupBy("_s").agg(
        F.max(F.when(F.col("_at") * 2 + F.col("_n") <= F.col("_rest") * 2, F.col("_k"))).alias("_in"), F.min("_k").alias("_first")
    )
    cuts = cuts.select("_s", F.coalesce("_in", F.col("_first") - 1).alias("_cut"))
    out = totals.join(cuts, totals["_s"].eqNullSafe(cuts["_s"]), "left").select(*[totals[c] for c in totals.columns], F.coalesce("_cut", F.lit(-1)).alias("_cut"))
    return stored(out, "mix-plan")


def mixed(docs: DataFrame, goal: Goal, id_col: str = "doc_id", source_col: str = "source", text_col: str = "text", tokens: Column | None = None) -> DataFrame:
    """A row ``(_row, _s, _n, _pass, _block, _weight, _mix_key)`` for each document and pass that shows it.

    ``_row`` is the input row as a struct. Sorting by ``_mix_key``, in [0, 1), interleaves the sources
    in proportion to their weights, pass by pass and block by block.
    """
    cols = [F.col(f"`{c}`") for c in docs.columns]
    n = word_count(F.col(text_col)) if tokens is None else tokens
    wide = docs.select(F.struct(*cols).alias("_row"), F.col(source_col).alias("_s"), F.col(id_col).alias("_id"), n.alias("_n"))
    sizes = stored(wide.select("_s", "_id", "_n"), "mix-sizes")
    sources = plan(sizes, goal)
    df = wide.join(sources.withColumnRenamed("_s", "_ps"), F.col("_s").eqNullSafe(F.col("_ps")))
    df = df.withColumn("_block", block_of(goal.seed, F.col("_blocks")))
    passes = F.col("_full") + (_key(goal.seed, F.col("_full"), F.col("_s"), F.col("_block")) <= F.col("_cut")).cast("long")
    df = df.withColumn("_passes", passes).where("_passes > 0").withColumn("_pass", F.explode(F.sequence(F.lit(0).cast("long"), F.col("_passes") - 1)))
    key = _key(goal.seed, F.col("_pass"), F.col("_s"), F.col("_block"))
    shown = F.greatest(F.col("_allotted") / F.greatest(F.col("_tokens"), F.lit(1)), F.col("_full"), F.lit(1e-9))
    spot = (F.col("_pass") + key / F.lit(float(2**63))) / shown
    return df.select("_row", "_s", "_n", "_pass", "_block", "_weight", F.least(spot, F.lit(1 - 2.0**-53)).alias("_mix_key"))
