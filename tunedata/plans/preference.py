"""Loading of preference pairs."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tunedata.operators.pairs import informative_pairs
from tunedata.sources.jsonl import PREFERENCE_RECORD, read_jsonl


def load_preference_pairs(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Strict scan, no identical pairs; a row without one of the three fields fails the job."""
    return informative_pairs(read_jsonl(spark, path, PREFERENCE_RECORD, PREFERENCE_RECORD.names))
