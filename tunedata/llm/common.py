"""Shared by the operators: scratch tables in the cluster's shared folder, files seen by all tasks."""

from __future__ import annotations

import contextlib
import ctypes
import sys
import tempfile
import uuid
import zlib
from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Workers receive these functions by value: the package need not be installed on the executors.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

WORD = r"[^\x20\x09-\x0D]+"


def shared_folder(spark: SparkSession) -> str:
    """The folder that driver and executors share: ``spark.checkpoint.dir``.

    Where it is unset, as in tests, a local session gets one temporary folder; any other session is
    refused, since its executors would not see each other's files.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local["):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    return _local_folder(spark.sparkContext.applicationId)


@lru_cache(maxsize=1)
def _local_folder(application: str) -> str:
    return "file://" + tempfile.mkdtemp(prefix=f"tunedata-{application}-")


def scratch(spark: SparkSession, name: str) -> str:
    """A path of its own below the shared folder."""
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


def materialize(rows: DataFrame, name: str) -> tuple[DataFrame, str]:
    """Write ``rows`` to a scratch table and read it back; the path goes with it, for ``discard``.

    Cuts the lineage: later stages and lost executors cost no second run of what lies before.
    """
    spark = rows.sparkSession
    path = scratch(spark, name)
    rows.write.option("compression", "zstd").parquet(path)
    spark._jvm.System.gc()  # Spark drops the shuffle files of finished jobs as their plans are collected
    return spark.read.schema(rows.schema).parquet(path), path


def discard(spark: SparkSession, *paths: str) -> None:
    """Delete scratch tables that nothing reads any more."""
    for path in paths:
        where = spark._jvm.org.apache.hadoop.fs.Path(path)
        where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)


def open_shared(path: str) -> tuple[fs.FileSystem, str]:
    """File system and inner path of a URI, inside a task."""
    return fs.FileSystem.from_uri(path)


def release_memory() -> None:
    """Return what the allocators of a Python worker hold but do not use."""
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):  # other C libraries have no such call
        ctypes.CDLL(None).malloc_trim(0)


def tidied(run):
    """``run`` for mapInArrow, which gives memory back when a task ends: Spark keeps Python workers, and
    what allocators hold would add up over the stages of a job. So would an encoder that another
    operator has left (``token_files``)."""

    def tidy(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from run(batches)
        finally:
            sys.modules.pop("_tunedata_encoders", None)
            release_memory()

    return tidy


def id_remainder(divisor: int, column: str = "doc_id") -> Column:
    """crc32 of the id as text, modulo ``divisor``; a null id counts as the empty text."""
    return F.crc32(F.coalesce(F.col(column).cast("string"), F.lit(""))) % divisor


def internal(rows: DataFrame, *names: str) -> list[str]:
    """Names for helper columns that do not clash with those of ``rows``, whatever their case."""
    taken = {c.lower() for c in rows.columns}
    found = []
    for name in names:
        while name.lower() in taken:
            name = "_" + name
        taken.add(name.lower())
        found.append(name)
    return found


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


BROADCAST_ROWS = 200_000


def broadcast_if_small(rows: DataFrame, limit: int = BROADCAST_ROWS) -> DataFrame:
    """A hint to broadcast a narrow scratch table, if counting it shows at most ``limit`` rows.

    A larger one is joined by an ordinary shuffle; the result is the same.
    """
    return F.broadcast(rows) if rows.limit(limit + 1).count() <= limit else rows


def add_up(parts: DataFrame, key: str, value: str, dtype: str) -> DataFrame:
    """Sum arrays, given as binary, by an integer key: (key, value), one row per key.

    Parts of a key stream through one task in a fixed order, one at a time, so that neither memory
    nor the rounding of the sum depends on how many there are or how they arrive.
    """
    rows = parts.select(F.col(key).cast("int").alias("key"), F.col(value).alias("value"))
    ordered = rows.repartition("key").sortWithinPartitions("key", F.xxhash64("value"))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, total = None, None
        for batch in batches:
            values = batch.column(1)
            for at, own in enumerate(batch.column(0).to_pylist()):
                part = np.frombuffer(zlib.decompress(values[at].as_py()), dtype)
                if own != current:
                    if current is not None:
                        yield pack_arrays([current], [total])
                    current, total = own, part.copy()
                else:
                    total += part
        if current is not None:
            yield pack_arrays([current], [total])

    return ordered.mapInArrow(run, "key int, value binary")


def pack_arrays(keys: Iterable[int], arrays: Iterable[np.ndarray]) -> pa.RecordBatch:
    """Rows of (key, value) with compressed arrays."""
    values = [zlib.compress(np.ascontiguousarray(x).tobytes(), 1) for x in arrays]
    return pa.RecordBatch.from_arrays(
        [pa.array(list(keys), pa.int32()), pa.array(values, pa.binary())], names=["key", "value"]
    )


def unpack_array(value: bytes, dtype: str) -> np.ndarray:
    return np.frombuffer(zlib.decompress(value), dtype)
