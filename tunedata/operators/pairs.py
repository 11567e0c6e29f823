"""Preference pairs: required columns, identical pairs and their count."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

PAIR_COLUMNS = ("prompt", "chosen", "rejected")


def require_columns(rows: DataFrame, required: Iterable[str] = PAIR_COLUMNS) -> DataFrame:
    """Raise unless all columns exist. Looks at the schema only, so no job runs."""
    missing = sorted(set(required) - set(rows.columns))
    if missing:
        raise ValueError(f"columns {missing} are missing; found {rows.columns}")
    return rows


def informative_pairs(pairs: DataFrame) -> DataFrame:
    """Drop pairs whose two sides are the same: they carry no preference."""
    return require_columns(pairs).filter(~F.col("chosen").eqNullSafe(F.col("rejected")))


def pair_report(pairs: DataFrame) -> DataFrame:
    """One row ``before, after, identical`` from one scan."""
    identical = F.col("chosen").eqNullSafe(F.col("rejected"))
    return require_columns(pairs).agg(
        F.count(F.lit(1)).alias("before"),
        F.count_if(~identical).alias("after"),
        F.count_if(identical).alias("identical"),
    )
