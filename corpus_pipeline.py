"""A corpus pipeline of five stages, each applying one operator of ``tunedata.llm``.

Every stage takes (spark, docs, sf_dir), works on all rows of its predecessor and returns a
DataFrame that is written as Parquet and reread as the next one's docs.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tunedata.llm import stages
from tunedata.llm.common import materialize, table

STAGES = [
    ("language_id", stages.language_stage),
    ("ngram_jaccard_join", stages.near_duplicate_stage),
    ("benchmark_decontamination", stages.decontamination_stage),
    ("mixing", stages.mixing_stage),
    ("token_files", stages.token_stage),
]

# Compressed sizes, n-gram sets and token ids are beyond SQL; tests/llm compares with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs, _ = materialize(stage(spark, docs, sf_dir), name)
    return docs
