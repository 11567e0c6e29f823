"""Keyed hashes in place of a sequential random generator.

A row's pick depends on its key and the seed alone: not on row order, partitioning, retries of a
lost executor or on which other rows exist.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tunedata.constants import SEED
from tunedata.functions.text import as_column

_HASH_RANGE = 2**32


def key_hash(key: Column | str, salt: str) -> Column:
    """First 32 bits of ``md5(salt:key)`` as bigint."""
    text = F.coalesce(as_column(key).cast("string"), F.lit(""))
    digest = F.md5(F.concat(F.lit(f"{salt}:"), text))
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("bigint")


def in_sample(key: Column | str, ratio: float, seed: int = SEED) -> Column:
    """True for the share ``ratio`` of keys."""
    return key_hash(key, str(seed)) < F.lit(ratio * _HASH_RANGE)


def pick(key: Column | str, choices: int, seed: int = SEED) -> Column:
    """A number in ``[0, choices)``, independent of :func:`in_sample`."""
    return F.pmod(key_hash(key, f"{seed}:pick"), F.lit(choices))
