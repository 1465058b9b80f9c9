"""Quality rules as a bitmask ledger, with DataFrame functions only.

Every rule is evaluated once for each document. The ledger holds the measurements and one
``long`` whose bit *i* is set where rule *i* fails. A policy is a named, versioned mask over
these bits; applying another policy, or leaving a rule out of one, never reads a text again.

Defined cases: a null or empty text has no words, so it fails ``few_words``; repeated rows get
a row each; other columns of the input stay out, as the ledger only carries ``id_col`` and what ``keep`` names;
a kept column named like one of the ledger's own gets ``input_`` before its name.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from edispark.llm.common import words_of


SYMBOLS = "#*$%&|<>"


@dataclass(frozen=True)
class Rule:
    """A document fails where ``fails`` (SQL over the measurements) is true."""

    name: str
    fails: str


#: Position in this list is the bit. Append only: stored ledgers keep their meaning.
RULES = (
    Rule("few_words", "n_words < 50"),
    Rule("repeated_windows", "100 * n_repeat_words > 50 * n_words"),
    Rule("symbols", "10 * n_symbols > 3 * n_words"),
    Rule("repeated_lines", "n_lines >= 4 and 100 * n_dup_lines > 30 * n_lines"),
    Rule("short_words", "word_chars < 2 * n_words"),
    Rule("long_words", "word_chars > 20 * n_words"),
)


@dataclass(frozen=True)
class Policy:
    name: str
    version: int
    rules: tuple[str, ...]

    @property
    def mask(self) -> int:
        names = [r.name for r in RULES]
        return sum(1 << names.index(r) for r in self.rules)


BASE = Policy("base", 1, ("few_words", "repeated_windows"))
STANDARD = Policy("standard", 1, tuple(r.name for r in RULES))


def measured(docs: DataFrame, text_col: str = "text", id_col: str = "doc_id", keep: Sequence[str] = ()) -> DataFrame:
    """Measurements of each text; ``keep`` names further input columns to carry."""
    text = F.coalesce(F.col("_text"), F.lit(""))
    df = docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text"), F.struct(F.lit(0).alias("_"), *[F.col(f"`{c}`").alias(f"_{k}") for k, c in enumerate(keep)]).alias("_keep"))
    own = {id_col, "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "failed_bits"}
    df = df.withColumn("_words", words_of(F.col("_text")))
    # three-word windows by a 64-bit hash that chains their words
    df = df.withColumn("_n", F.size("_words").cast("long")).withColumn(
        "_windows",
        F.expr("transform(slice(_words, 1, greatest(size(_words) - 2, 0)), (w, i) -> xxhash64(w, get(_words, i + 1), get(_words, i + 2)))"),
    )
    df = df.withColumn("_repeats", F.size(F.array_distinct("_windows")) < F.size("_windows"))
    # only texts with a repeated window are sorted: equal neighbours are the repeated windows, and each covers its three words
    df = df.withColumn("_starts", F.when(F.col("_repeats"), _repeated_starts()))
    covered = F.expr("aggregate(transform(_starts, (s, k) -> least(3, coalesce(get(_starts, k + 1), s + 3) - s)), 0L, (a, x) -> a + x)")
    lines = F.filter(F.split(text, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    df = df.withColumn("_lines", lines)
    # one row from one: the generator keeps a later filter from being pushed below, where it would repeat all of this
    measures = F.struct(
        F.col("_id").alias(id_col),
        F.col("_n").alias("n_words"),
        F.length(F.array_join("_words", "")).cast("long").alias("word_chars"),
        # byte scans tell the many texts without a symbol from those worth counting in
        F.when(reduce(or_, [F.contains(text, F.lit(c)) for c in SYMBOLS]), F.length(text) - F.length(F.translate(text, SYMBOLS, ""))).otherwise(0).cast("long").alias("n_symbols"),
        (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long").alias("n_dup_lines"),
        F.coalesce(covered, F.lit(0)).cast("long").alias("n_repeat_words"),
        F.size("_lines").cast("long").alias("n_lines"),
        *[F.col("_keep")[f"_{k}"].alias(f"input_{c}" if c in own else c) for k, c in enumerate(keep)],
    )
    return df.select(F.explode_outer(F.array(measures)).alias("_m")).select("_m.*")


def _repeated_starts() -> Column:
    ordered = "sort_array(transform(_windows, (h, i) -> struct(h as h, i as i)))"
    return F.expr(
        f"""sort_array(transform(aggregate(array({ordered}), cast(array() as array<struct<h:bigint,i:int>>),
            (a, s) -> filter(s, (x, k) -> x.h = get(s, k - 1).h or x.h = get(s, k + 1).h)), x -> x.i))"""
    )


def ledger(docs: DataFrame, **how) -> DataFrame:
    """``measured`` plus ``failed_bits``, each rule evaluated once."""
    df = measured(docs, **how)
    bits = F.lit(0).cast("long")
    for i, rule in enumerate(RULES):
        bits = bits.bitwiseOR(F.when(F.expr(rule.fails), F.lit(1 << i).cast("long")).otherwise(F.lit(0).cast("long")))
    return df.withColumn("failed_bits", bits)


def passes(policy: Policy) -> Column:
    """Over a ledger: true where no rule of the policy fails."""
    return F.col("failed_bits").bitwiseAND(F.lit(policy.mask).cast("long")) == 0


def ablation(book: DataFrame, policy: Policy) -> DataFrame:
    """For each rule of a policy: documents it fails, those it alone fails, and what the policy keeps without it.

    The ledger shrinks first to its distinct masks with counts, at most 2 to the number of rules.
    """
    masks = book.groupBy(F.col("failed_bits").bitwiseAND(F.lit(policy.mask).cast("long")).alias("bits")).agg(F.count("*").alias("n"))
    rows = [(i, r.name, 1 << i) for i, r in enumerate(RULES) if r.name in policy.rules]
    one = F.explode(F.array(*[F.struct(F.lit(i).alias("bit"), F.lit(n).alias("rule"), F.lit(m).cast("long").alias("m")) for i, n, m in rows])).alias("r")
    each = masks.select("bits", "n", one)
    hit = F.col("bits").bitwiseAND(F.col("r.m")) != 0
    alone = F.col("bits") == F.col("r.m")
    return each.groupBy(F.col("r.bit").alias("bit"), F.col("r.rule").alias("rule")).agg(
        F.sum(F.when(hit, F.col("n")).otherwise(0)).alias("fails"),
        F.sum(F.when(alone, F.col("n")).otherwise(0)).alias("fails_alone"),
        F.sum(F.when(alone | (F.col("bits") == 0), F.col("n")).otherwise(0)).alias("kept_without"),
    )


def kept_documents(docs: DataFrame, policy: Policy = STANDARD, text_col: str = "text") -> DataFrame:
    """The input rows, with all their columns, that pass the policy."""
    cols = docs.columns
    whole = docs.select(F.struct(*[F.col(f"`{c}`") for c in cols]).alias("_row"), F.col(text_col).alias("_t"))
    book = ledger(whole, text_col="_t", id_col="_row")
    return book.where(passes(policy)).select(*[F.col("_row")[c].alias(c) for c in cols])
