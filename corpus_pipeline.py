"""The corpus pipeline: quality rules, near duplicates, source mixing, packing.

Each stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame; ``run`` writes every stage's
result to the shared folder as Parquet and hands the next stage what it reads back.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from edispark.llm import mixing, neardup, packing, rules
from edispark.shipping import stored


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the standard policy keeps."""
    return rules.kept_documents(docs, rules.STANDARD)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class: the least id's."""
    return neardup.representatives(docs)


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document once at least; smaller sources more often, up to twice and to nine tenths of the largest entropy."""
    shown = mixing.mixed(docs, mixing.Goal(entropy=0.9, repeats=2.0, budget="cover"))
    return shown.select("_row.*")


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Bins of 2,048 words; passes of one document are copies and so lie in different bins."""
    return packing.packed(docs, capacity=2048, source_quota=4)


STAGES = [
    ("quality_rules", quality),
    ("near_duplicates", near_duplicates),
    ("source_mix", source_mix),
    ("best_fit_packing", best_fit_packing),
]

#: SQL cannot express the sketches of the second stage; tests compare with a brute-force run.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name)
    return docs
