"""Attach per-key values to rows when some keys may hold a large share of the rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SPREAD = 256


def attach_by_key(
    rows: DataFrame,
    lookup: DataFrame,
    key: str,
    spread_by: Sequence[str],
    spread: int = SPREAD,
) -> DataFrame:
    """Left join ``rows`` with ``lookup`` (one row per key) on ``key``, nulls matching nulls.

    A plain join sends all rows of a key to one task. Here a row also carries a salt, a hash of
    ``spread_by``, and joins on both, so that a hot key is split ``spread`` ways. The lookup row
    is copied only to the (key, salt) pairs that occur, not to all of them. ``spread_by`` must
    tell the rows of one key apart; it is hashed, not drawn, so a recomputed task agrees.
    """
    salt = F.pmod(F.xxhash64(*spread_by), F.lit(spread)).cast("int")
    salted = rows.withColumn("_salt", salt)
    placed = (
        salted.select(F.col(key).alias("_key"), F.col("_salt").alias("_slot"))
        .distinct()
        .join(lookup.withColumnRenamed(key, "_lookup"), F.col("_key").eqNullSafe(F.col("_lookup")))
        .drop("_lookup")
    )
    return salted.join(
        placed, F.col(key).eqNullSafe(F.col("_key")) & (F.col("_salt") == F.col("_slot")), "left"
    ).drop("_salt", "_key", "_slot")
