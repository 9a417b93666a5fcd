"""Corpus pipeline: quality rules, near duplicates, decontamination, personal data, packing.

Each stage reads what its predecessor kept, written as Parquet and read again, and all but the last return the
columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from uttera.llm.contamination import stage_decontamination
from uttera.llm.jaccard import stage_jaccard
from uttera.llm.packing import stage_packing
from uttera.llm.privacy import stage_pii
from uttera.llm.quality import stage_quality
from uttera.llm.scratch import Scratch

STAGES = [
    ("quality rules", stage_quality),
    ("n-gram Jaccard join", stage_jaccard),
    ("benchmark decontamination", stage_decontamination),
    ("personal data", stage_pii),
    ("packing", stage_packing),
]

#: A trained model, graph components and token ids are not expressible in SQL; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The packed pieces of the documents that every stage kept."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    scratch = Scratch(spark, "pipeline")
    for k, (_, stage) in enumerate(STAGES):
        docs = scratch.save(stage(spark, docs, sf_dir), f"stage{k}")
        scratch.keep(f"stage{k}")  # the next stage reads this one alone
    return docs
