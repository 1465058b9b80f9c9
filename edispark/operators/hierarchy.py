"""Segment numbers and parents from order and level."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def renumber(segments: DataFrame, document: list[str], order: str | list[str] = "ord", level: str = "hlevel", counted: Column | None = None) -> DataFrame:
    """Adds ``segnum`` (1, 2, ... in a document) and ``psgnum`` (the latest segment one level up; 0 if there is none).

    The rows of a document are dealt to the pairs of levels (k, k + 1) they belong to; in a pair one
    running maximum over the upper level's numbers finds each child's parent. Every segment belongs to two
    pairs, so levels have no limit and a document of any depth costs the same. A segment without a level has no parent.
    Only one of a segment's two rows carries its other columns. Rows that ``counted`` leaves out do not raise the number.
    """
    w = Window.partitionBy(*document).orderBy(*([order] if isinstance(order, str) else order))
    number = F.row_number().over(w) if counted is None else F.sum(counted.cast("long")).over(w.rowsBetween(Window.unboundedPreceding, 0))
    rest = [c for c in segments.columns if c not in document]
    df = segments.withColumn("segnum", number.cast("long")).withColumn("_level", F.col(level).cast("long"))
    df = df.select(*document, "segnum", "_level", F.struct(*rest).alias("_row"), F.explode(F.array_distinct(F.array(F.col("_level"), F.col("_level") - 1))).alias("_pair"))
    own = F.col("_pair").eqNullSafe(F.col("_level") - 1)
    paired = df.select(*document, "segnum", "_level", F.when(own, F.col("_row")).alias("_row"), "_pair")
    before = Window.partitionBy(*document, "_pair").orderBy("segnum").rowsBetween(Window.unboundedPreceding, -1)
    parent = F.max(F.when(F.col("_pair") == F.col("_level"), F.col("segnum"))).over(before)
    found = paired.withColumn("psgnum", F.coalesce(parent, F.lit(0)).cast("long"))
    return found.where(own).select(*[c if c in document else F.col("_row")[c].alias(c) for c in segments.columns], "segnum", "psgnum")
