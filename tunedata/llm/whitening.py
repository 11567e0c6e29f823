"""Whitening of embeddings by shifted CholeskyQR.

The centred rows A are never formed as a whole. A pass over the rows adds up the Gram matrix of
A R1^-1 R2^-1 ..., each task solving the triangular systems for its own blocks of rows; the driver
factors that small matrix. The first factor is shifted, so that it exists for any condition
number; the following passes repair what the shift left. The composed factor R then has the
singular values and right singular vectors of A, without the loss of squaring the condition.
"""

from __future__ import annotations

import sys
from collections.abc import Callable, Iterable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark import TaskContext, cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, IntegerType, LongType, StructField, StructType

from tunedata.llm.common import add_up, materialize, pack_arrays, unpack_array

cloudpickle.register_pickle_by_value(sys.modules[__name__])

SCALE, OFFSET = 64, 1_000_000
COMPONENTS = 32
PASSES = 6
BUCKETS = 32
BLOCK = 4096
_LONG = (1 << 63) - 1


def fixed_point(rows: DataFrame, key: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """(key, x): vectors without null or non-finite entries as whole numbers floor(64 c) + 1000000."""
    entry = F.col("v")
    values = rows.select(F.col(key), F.col(vector).cast("array<double>").alias("v")).filter(
        entry.isNotNull()
        & ~F.exists(entry, lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf")))
    )
    return values.select(
        key, F.transform("v", lambda c: F.floor(c * SCALE).cast("long") + OFFSET).alias("x")
    )


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, width)


def right_solve(rows: np.ndarray, r: np.ndarray) -> np.ndarray:
    """rows r^-1 for an upper triangular r, column by column."""
    out = np.array(rows, np.float64, order="F")
    for j in range(r.shape[0]):
        if j:
            out[:, j] -= out[:, :j] @ r[:j, j]
        out[:, j] /= r[j, j]
    return out


def _partial(width: int, combine: Callable[[np.ndarray], np.ndarray], dtype: str):
    """One row per task: the sum of ``combine`` over its blocks of rows."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            x = _matrix(batch.column(0), width)
            for at in range(0, len(x), BLOCK):
                part = combine(x[at : at + BLOCK]).astype(dtype, copy=False)
                total = part if total is None else total + part
        if total is not None:
            yield pack_arrays([TaskContext.get().partitionId() % BUCKETS], [total.ravel()])

    return run


def _reduce(
    vectors: DataFrame, width: int, combine: Callable[[np.ndarray], np.ndarray], dtype: str = "float64"
) -> np.ndarray:
    """Add up over all rows in two levels: tasks into 32 buckets, buckets into one array."""
    parts = vectors.select("x").mapInArrow(_partial(width, combine, dtype), "key int, value binary")
    buckets = add_up(parts, "key", "value", dtype)
    whole = add_up(buckets.select(F.lit(0).alias("key"), "value"), "key", "value", dtype)
    return unpack_array(whole.first()["value"], dtype)


def _centred(sums: Sequence[int], n: int) -> Callable[[np.ndarray], np.ndarray]:
    """x - S/n, the whole part of S/n taken off exactly."""
    whole = np.array([s // n for s in sums], np.int64)
    rest = np.array([(s % n) / n for s in sums])
    return lambda x: (x - whole) - rest


def _orthogonalise(vectors: DataFrame, width: int, n: int, centre) -> tuple[np.ndarray, float]:
    """R with A'A = R'R for the centred rows A, and the trace of A'A."""
    eps = np.finfo(np.float64).eps
    factors: list[np.ndarray] = []
    composed, trace = np.eye(width), 0.0
    for step in range(PASSES):

        def gram(x: np.ndarray, held: tuple[np.ndarray, ...] = tuple(factors)) -> np.ndarray:
            q = centre(x)
            for r in held:
                q = right_solve(q, r)
            return q.T @ q

        g = _reduce(vectors, width, gram).reshape(width, width)
        g = (g + g.T) / 2
        if step == 0:
            trace = float(np.trace(g))
            if trace == 0:
                return np.zeros((width, width)), 0.0
        else:
            values, basis = np.linalg.eigh(g)
            settled = np.max(np.minimum(np.abs(values), np.abs(values - 1))) < 1e-12 * width
            if settled or step == PASSES - 1:
                # What is left of the last factor, also where A lacks columns of full rank.
                root = (basis * np.sqrt(np.maximum(values, 0))) @ basis.T
                return root @ composed, trace
        shift = 11 * (n * width + width * (width + 1)) * eps * float(np.trace(g))
        try:
            r = np.linalg.cholesky(g + (shift * np.eye(width) if step == 0 else 0)).T
        except np.linalg.LinAlgError:
            r = np.linalg.cholesky(g + shift * np.eye(width)).T
        factors.append(r)
        composed = r @ composed
    raise AssertionError("the last pass returns")


def whiten(
    rows: DataFrame, key: str = "vec_id", vector: str = "embedding", components: int = COMPONENTS
) -> DataFrame:
    """Whitened components of the vectors, one row per vector and component.

    Rows whose vector is null or holds a null or non-finite entry are left out. All others take part
    with their fixed-point values x (``fixed_point``): repeated rows, null and repeated keys
    included. Vectors must share one length; where they do not, those of the commonest length (of
    equally common ones the longest) stay and the others are left out. Components are numbered from
    1 by falling eigenvalue of the covariance of x; directions without variance (relative singular
    value below rounding) have no component, so one row, equal rows or an empty table give no rows.
    Of tied eigenvalues any orthonormal basis comes out. Other columns are not read.

    Columns: key, component, n, deviation (the sum over dimensions of (n x - S)^2; null where that
    exceeds a long), whitened, explained (eigenvalue / trace), identity_error (the largest entry of
    the covariance of ``whitened`` minus the identity). Memory is a few blocks of rows and matrices
    of the vector's length squared; the driver sees such matrices only.
    """
    spark = rows.sparkSession
    kind = rows.schema[key].dataType
    schema = StructType(
        [
            StructField(key, kind),
            StructField("component", IntegerType()),
            StructField("n", LongType()),
            StructField("deviation", LongType()),
            StructField("whitened", DoubleType()),
            StructField("explained", DoubleType()),
            StructField("identity_error", DoubleType()),
        ]
    )
    vectors, _ = materialize(fixed_point(rows, key, vector), "vectors")
    widths = vectors.groupBy(F.size("x").alias("width")).count().orderBy(F.desc("count"), F.desc("width")).first()
    width = widths["width"] if widths else 0
    if not width:
        return spark.createDataFrame([], schema)
    n = int(widths["count"])
    vectors = vectors.filter(F.size("x") == width)
    sums = _reduce(vectors, width, lambda x: x.sum(axis=0), "int64").tolist()
    centre = _centred(sums, n)
    r, trace = _orthogonalise(vectors, width, n, centre)
    _, sizes, right = np.linalg.svd(r)
    sound = int(np.sum(sizes > sizes[0] * width * 8 * np.finfo(np.float64).eps)) if trace else 0
    keep = min(components, sound)
    if not keep:
        return spark.createDataFrame([], schema)
    eigenvalues = sizes[:keep] ** 2 / n
    project = right[:keep].T * (np.sqrt(n) / sizes[:keep])

    def covariance(x: np.ndarray) -> np.ndarray:
        own = centre(x) @ project  # its mean is zero, as that of the centred rows
        return own.T @ own

    error = float(np.max(np.abs(_reduce(vectors, width, covariance).reshape(keep, keep) / n - np.eye(keep))))
    explained = eigenvalues * n / trace
    names = [f.name for f in schema.fields]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.array(sums, np.int64)
        whole = total // n
        rest = total - whole * n
        for batch in batches:
            for at in range(0, batch.num_rows, BLOCK):
                block = batch.slice(at, BLOCK)
                x = _matrix(block.column(1), width)
                apart = x - whole
                if int(np.abs(apart).max() + 1) ** 2 * n * n * width <= _LONG:
                    deviations = ((n * apart - rest) ** 2).sum(axis=1).tolist()
                else:
                    exact = [sum((n * v - t) ** 2 for v, t in zip(row, rest.tolist())) for row in apart.tolist()]
                    deviations = [d if d <= _LONG else None for d in exact]
                own = centre(x) @ project
                again = np.repeat(np.arange(len(x)), keep)
                yield pa.RecordBatch.from_arrays(
                    [
                        block.column(0).take(pa.array(again)),
                        pa.array(np.tile(np.arange(1, keep + 1, dtype=np.int32), len(x))),
                        pa.array(np.full(len(again), n, np.int64)),
                        pa.array(deviations, pa.int64()).take(pa.array(again)),
                        pa.array(own.ravel()),
                        pa.array(np.tile(explained, len(x))),
                        pa.array(np.full(len(again), error)),
                    ],
                    names=names,
                )

    return vectors.select(key, "x").mapInArrow(run, schema)
