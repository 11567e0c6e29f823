"""Numbering and running sums of keyed rows when a key may hold any share of them."""

from __future__ import annotations

import sys
from collections.abc import Iterable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark import TaskContext, cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tunedata.llm.common import materialize

cloudpickle.register_pickle_by_value(sys.modules[__name__])


def _scan(key: str, sums: Sequence[str]):
    """Per task: number the rows of each key as they come and add up; one row of a task is its tail."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        last_key, count = None, 0
        totals = [0] * len(sums)
        held: list[pa.Array] | None = None
        names: list[str] = []

        def block(tail: bool) -> pa.RecordBatch:
            rows = len(held[0])
            flags = np.zeros(rows, bool)
            flags[-1] = tail
            columns = [*held, pa.array(np.full(rows, part, np.int32)), pa.array(flags)]
            return pa.RecordBatch.from_arrays(columns, names=[*names, "_part", "_tail"])

        for batch in batches:
            if not batch.num_rows:
                continue
            if held is not None:
                yield block(False)
            keys = np.asarray(batch.column(key).to_numpy(zero_copy_only=False), np.int64)
            starts = np.flatnonzero(np.concatenate([[keys[0] != last_key], keys[1:] != keys[:-1]]))
            goes_on = not len(starts) or starts[0] != 0  # the first rows continue the last batch's key
            begins = np.concatenate([[0], starts]) if goes_on else starts
            lengths = np.diff(np.append(begins, len(keys)))
            base = np.repeat(begins, lengths)
            place = np.arange(1, len(keys) + 1) - base
            first = lengths[0]
            if goes_on:
                place[:first] += count
            columns = []
            for at, name in enumerate(sums):
                running = np.cumsum(np.asarray(batch.column(name).to_numpy(zero_copy_only=False), np.int64))
                before = np.concatenate([[0], running])[base]
                own = running - before
                if goes_on:
                    own[:first] += totals[at]
                totals[at] = int(own[-1])
                columns.append(pa.array(own))
            last_key, count = int(keys[-1]), int(place[-1])
            names = [*batch.schema.names, "_place", *(f"_sum_{s}" for s in sums)]
            held = [*batch.columns, pa.array(place), *columns]
        if held is not None:
            yield block(True)

    return run


def numbered(
    rows: DataFrame,
    key: str,
    order: Sequence[str],
    name: str,
    sums: Sequence[str] = (),
    place: str = "place",
) -> DataFrame:
    """``rows`` with the place of each row (from 1) in its ``key`` by ``order``, and the running
    sums of the columns ``sums`` as ``run_<column>``. ``key`` is an integer without nulls; rows that
    ``order`` leaves equal are numbered in either way. Sums must fit 64 bits.

    A window would pull a key into one task. Here rows are range-sorted by (key, order), counted
    where they lie and written; the driver gets one row per partition, the totals of the key that
    may go on in the next one, and its offsets go back with a join of that size.
    """
    spark = rows.sparkSession
    width = int(spark.conf.get("spark.sql.shuffle.partitions"))
    by = [F.col(key), *(F.col(c) for c in order)]
    extra = "".join(f", _sum_{s} bigint" for s in sums)
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields)
    counted, _ = materialize(
        rows.repartitionByRange(width, *by)
        .sortWithinPartitions(*by)
        .mapInArrow(_scan(key, sums), f"{fields}, _place bigint{extra}, _part int, _tail boolean"),
        name,
    )
    totals = [f"_sum_{s}" for s in sums]
    tails = counted.filter("_tail").select("_part", key, "_place", *totals).collect()
    offsets, carried, current = [], [0] * (1 + len(sums)), None
    tails.sort()
    for tail, following in zip(tails, tails[1:]):
        # A tail's own numbers begin with its partition; what lies before is carried.
        carried = [(0 if tail[1] != current else c) + v for c, v in zip(carried, tail[2:])]
        current = tail[1]
        offsets.append((following[0], current, *carried))
    schema = f"_to int, _of bigint, _by bigint{''.join(f', _by_{s} bigint' for s in sums)}"
    found = counted.join(
        F.broadcast(spark.createDataFrame(offsets, schema)),
        (F.col("_part") == F.col("_to")) & (F.col(key) == F.col("_of")),
        "left",
    )
    return found.select(
        *rows.columns,
        (F.col("_place") + F.coalesce("_by", F.lit(0))).alias(place),
        *((F.col(f"_sum_{s}") + F.coalesce(f"_by_{s}", F.lit(0))).alias(f"run_{s}") for s in sums),
    )
