"""First n rows in key order."""

from __future__ import annotations

from collections.abc import Sequence
from typing import Any, NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

_LITERAL = (
    T.StringType, T.BinaryType, T.BooleanType, T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType,
    T.DoubleType, T.DecimalType, T.DateType, T.TimestampType, T.TimestampNTZType,
)


class Threshold(NamedTuple):
    """Where the first n rows end: conditions on rows up to, below and at the n-th key.

    ``upto`` is the part of the condition that reaches a scan. ``wanted`` rows at the key belong to
    the first n; ``surplus`` tells whether there are more.
    """

    upto: Column
    below: Column
    at: Column
    wanted: int
    surplus: bool


def _readable(column: Column, kind: T.DataType) -> Column:
    """The key in a form that the driver reads without loss."""
    if isinstance(kind, T.TimestampType):
        return F.unix_micros(column)
    if isinstance(kind, T.TimestampNTZType):
        return column.cast("string")
    return column


def _literal(value: Any, kind: T.DataType) -> Column:
    if isinstance(kind, T.TimestampType) and value is not None:
        return F.timestamp_micros(F.lit(value))
    if isinstance(kind, T.DateType) and value is not None:
        return F.lit(value.isoformat()).cast(kind)
    return F.lit(value).cast(kind)


def threshold(rows: DataFrame, n: int, keys: Sequence[Column], kinds: Sequence[T.DataType]) -> Threshold | None:
    """Where the first ``n`` rows by ``keys`` end; None if there are not more than ``n`` rows.

    Runs at once. Only the keys are read: every task keeps its first n + 1, one task the first of
    all, and the driver sees the n-th key and the next one. If these are equal, a further pass over
    the keys that do not exceed them counts the rows below; its condition reaches the scan.
    """
    names = [f"k{i}" for i in range(len(keys))]
    first = rows.select(*(k.alias(name) for k, name in zip(keys, names, strict=True))).orderBy(*names)
    shown = F.struct(*(_readable(F.col(name), kind).alias(name) for name, kind in zip(names, kinds)))
    last = first.limit(n + 1).offset(n - 1).agg(F.sort_array(F.collect_list(shown)).alias("last")).first()["last"]
    if len(last) < 2:
        return None
    nth = tuple(last[0])
    below, at = F.lit(False), F.lit(True)
    for column, value, kind in reversed(list(zip(keys, nth, kinds))):
        if value is None:  # null keys come first
            below, at = column.isNull() & below, column.isNull() & at
        else:
            bound = _literal(value, kind)
            below = column.isNull() | (column < bound) | ((column == bound) & below)
            at = (column == bound) & at
    upto = keys[0].isNull()
    if nth[0] is not None:
        upto = upto | (keys[0] <= _literal(nth[0], kinds[0]))
    # NaN equals itself as a key.
    if not all(a == b or (a != a and b != b) for a, b in zip(last[0], last[1])):
        return Threshold(upto, below, at, n, False)
    return Threshold(upto, below, at, n - rows.filter(upto & below).count(), True)


def first_n(rows: DataFrame, n: int, order: str | Sequence[str]) -> DataFrame:
    """The ``n`` smallest rows by ``order``, or all rows if there are fewer.

    Null keys come first. Rows with equal keys are ordered by a hash of all their columns, so the
    choice does not depend on the partitioning; equal rows are interchangeable. ``order`` names
    columns of atomic types.

    The n-th key is found at once, from the keys alone; the result is a plain filter by that key,
    which prunes the scan and neither shuffles, sorts nor broadcasts rows. Only where more rows than
    fit are equal in the n-th key are their hashes computed, and the n-th hash is found likewise.
    """
    order = [order] if isinstance(order, str) else list(order)
    kinds = [rows.schema[c].dataType for c in order]
    if not all(isinstance(kind, _LITERAL) for kind in kinds):
        raise ValueError("first_n orders by columns of atomic types")
    if n <= 0:
        return rows.limit(0)
    end = threshold(rows, n, [F.col(f"`{c}`") for c in order], kinds)
    if end is None:
        return rows
    if not end.surplus:
        return rows.filter(end.upto & (end.below | end.at))
    return _with_ties(rows, end)


def _with_ties(rows: DataFrame, end: Threshold) -> DataFrame:
    every = [F.col(f"`{c}`") for c in rows.columns]
    hashes = [F.xxhash64(*every), F.xxhash64(F.lit(1), *every)]
    tied = rows.filter(end.upto & end.at)
    hashed = threshold(tied, end.wanted, hashes, [T.LongType(), T.LongType()])
    if hashed is None:
        return rows.filter(end.upto & (end.below | end.at))
    if not hashed.surplus:
        return rows.filter(end.upto & (end.below | (end.at & (hashed.below | hashed.at))))
    # Copies of one row: one of them is read, and repeated as often as needed.
    copies = F.explode(F.array_repeat(F.lit(True), hashed.wanted))
    longer = "_" * max(len(c) for c in rows.columns) + "_copy"  # longer than any name: no clash
    repeated = tied.filter(hashed.at).limit(1).select(*every, copies.alias(longer)).drop(longer)
    return rows.filter(end.upto & (end.below | (end.at & hashed.below))).unionByName(repeated)
