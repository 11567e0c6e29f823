"""Syntax checks of Python blocks, row by row.

Python's own parser is the one thing here that Spark has no expression for. Blocks are extracted by
Spark, parsed in Arrow batches where their row lies, and only counts go on: no block is shuffled.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tunedata.functions.fences import python_blocks
from tunedata.functions.syntax import parsed_count

Extractor = Callable[[Column | str], Column]


def python_validity(
    rows: DataFrame, key: Sequence[str], text: str = "response", extract: Extractor = python_blocks
) -> DataFrame:
    """``key, python_valid``: at least one block, and all blocks parse."""
    counted = rows.select(*key, extract(text).alias("_blocks")).select(
        *key, F.size("_blocks").alias("_found"), parsed_count(F.col("_blocks")).alias("_parsed")
    )
    valid = (F.col("_found") > 0) & (F.col("_found") == F.col("_parsed"))
    return counted.select(*key, F.coalesce(valid, F.lit(False)).alias("python_valid"))
