"""Quality classifier: random Fourier features, ridge regression, isotonic calibration.

A document becomes a fixed vector of statistics of its text. Random Fourier features of the
standardised vector approximate a Gaussian kernel; ridge scores come from normal equations that are
summed over partitions; isotonic regression turns scores into probabilities.
"""

from __future__ import annotations

import sys
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema

from tunedata.llm.common import add_up, internal, pack_arrays, unpack_array

cloudpickle.register_pickle_by_value(sys.modules[__name__])

FOURIER = 384
RIDGE = 1e-3
BANDWIDTH = 1.0  # kernel width in units of the square root of the number of statistics
SEED = 20
BINS = 2000
STATISTICS = (
    "log_bytes", "log_words", "word_bytes", "upper", "digit", "space", "newline", "high", "marks",
    "odd_marks", "pipes", "exclaim", "word_repeats", "top_word", "distinct", "distinct_bytes",
    "long_words", "short_words", "line_repeats", "stops", "capital_words", "marked_words",
)


def _byte_classes() -> np.ndarray:
    """For each byte, a bit per class."""
    found = np.zeros(256, dtype=np.uint16)
    classes = (
        range(ord("A"), ord("Z") + 1), range(ord("0"), ord("9") + 1), (32, 9, 11, 12, 13), (10,),
        range(128, 256), b"!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~", b"#$%&*@^~+=<>\\{}[]_", b"|", b"!", b".?",
    )
    for bit, members in enumerate(classes):
        for byte in members:
            found[byte] |= 1 << bit
    return found


def statistics(text: str | None) -> np.ndarray:
    """The statistics of one whole text; an empty or null text gives zeros."""
    data = (text or "").encode("utf-8", "replace")
    words = data.split()
    if not words:
        return np.zeros(len(STATISTICS))
    n, size = len(words), len(data)
    raw = np.bincount(np.frombuffer(data, np.uint8), minlength=256)
    classes = _byte_classes()
    upper, digit, space, newline, high, marks, odd, pipes, exclaim, stops = (
        raw[(classes >> bit & 1).astype(bool)].sum() for bit in range(10)
    )
    lengths = np.fromiter(map(len, words), np.int64, n)
    counts: dict[bytes, int] = {}
    same = marked = capital = 0
    before = b""
    for word in words:
        counts[word] = counts.get(word, 0) + 1
        same += word == before
        before = word
        marked += word[-1] in b"!#$%&*"
        capital += word[:1].isupper()
    lines = data.split(b"\n")
    return np.array(
        [
            np.log1p(size), np.log1p(n), min(lengths.mean(), 40.0), upper / size, digit / size, space / size,
            newline / n, high / size, marks / n, odd / n, pipes / n, exclaim / n, same / n,
            max(counts.values()) / n, len(counts) / n, np.log1p(sum(map(len, counts))) / np.log1p(size),
            (lengths > 12).mean(), (lengths < 3).mean(), 1 - len(set(lines)) / len(lines), stops / n,
            capital / n, marked / n,
        ]
    )


def with_statistics(docs: DataFrame, text: str = "text", name: str = "statistics") -> DataFrame:
    """Replace the text column by the vector of statistics; rows stay where they are."""
    if internal(docs, name) != [name]:
        raise ValueError("the added name clashes with a column of the table")
    schema = docs.drop(text).withColumn(name, F.lit(None).cast("array<double>")).schema

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = batch.schema.get_field_index(text)
            column = batch.column(at)
            found = [statistics(column[i].as_py()) for i in range(batch.num_rows)]
            flat = np.concatenate(found) if found else np.zeros(0)
            lists = pa.ListArray.from_arrays(
                np.arange(0, len(flat) + 1, len(STATISTICS), dtype=np.int32), pa.array(flat)
            )
            arrays = [batch.column(i) for i in range(batch.num_columns) if i != at]
            names = [c for i, c in enumerate(batch.schema.names) if i != at]
            yield pa.RecordBatch.from_arrays([*arrays, lists], names=[*names, name])

    return docs.mapInArrow(run, schema)


@dataclass(frozen=True)
class QualityModel:
    """Everything a score needs; its size depends on the parameters only."""

    mean: np.ndarray
    deviation: np.ndarray
    directions: np.ndarray
    phases: np.ndarray
    weights: np.ndarray
    knots: np.ndarray
    levels: np.ndarray

    def features(self, vectors: np.ndarray) -> np.ndarray:
        scaled = np.clip((vectors - self.mean) / self.deviation, -6, 6)
        waves = np.cos(scaled @ self.directions + self.phases) * np.sqrt(2 / len(self.phases))
        return np.hstack([waves, scaled / 6, np.ones((len(vectors), 1))])

    def ridge_scores(self, vectors: np.ndarray) -> np.ndarray:
        return self.features(vectors) @ self.weights

    def calibrated(self, scores: np.ndarray) -> np.ndarray:
        return np.clip(np.interp(scores, self.knots, self.levels), 0, 1)


def _matrix(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), len(STATISTICS))


def isotonic(scores: np.ndarray, labels: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pool adjacent violators over bins sorted by score: block centres and their levels."""
    blocks: list[list[float]] = []  # weight, sum of labels, sum of scores
    for s, y, c in zip(scores, labels, counts, strict=True):
        blocks.append([c, y, s * c])
        while len(blocks) > 1 and blocks[-2][1] * blocks[-1][0] >= blocks[-1][1] * blocks[-2][0]:
            last = blocks.pop()
            blocks[-1] = [a + b for a, b in zip(blocks[-1], last, strict=True)]
    found = np.array(blocks)
    return found[:, 2] / found[:, 0], found[:, 1] / found[:, 0]


def fit(labelled: DataFrame, vector: str = "statistics", label: str = "label", fold: str = "fold") -> QualityModel | None:
    """Fit on all rows of ``labelled``: vector, label (0 to 1) and fold (true: calibration only).

    Partitions sum their normal equations; matrix rows are added up by row number, so the driver
    receives one matrix of fixed size. The calibration rows are counted in ``BINS`` bins of the
    score. Without any labelled row there is no model.
    """
    size = len(STATISTICS)
    moments = labelled.select(
        *[F.avg(F.col(vector)[i]).alias(f"m{i}") for i in range(size)],
        *[F.stddev_pop(F.col(vector)[i]).alias(f"d{i}") for i in range(size)],
        F.count(F.lit(1)).alias("rows"),
    ).first()
    if not moments["rows"]:
        return None
    random = np.random.default_rng(SEED)
    mean = np.array([moments[f"m{i}"] for i in range(size)])
    deviation = np.array([moments[f"d{i}"] for i in range(size)])
    model = QualityModel(
        mean,
        np.where(deviation > 1e-9, deviation, 1.0),
        random.normal(size=(size, FOURIER)) / (BANDWIDTH * np.sqrt(size)),
        random.uniform(0, 2 * np.pi, FOURIER),
        np.zeros(0),
        np.zeros(1),
        np.zeros(1),
    )
    fitting = labelled.filter(~F.col(fold)).select(vector, label)

    def equations(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            if batch.num_rows:
                x = model.features(_matrix(batch.column(0)))
                y = batch.column(1).to_numpy(zero_copy_only=False)
                part = x.T @ np.hstack([x, y[:, None]])
                total = part if total is None else total + part
        if total is not None:
            yield pack_arrays(range(len(total)), total)

    parts = fitting.mapInArrow(equations, "key int, value binary")
    summed = add_up(parts, "key", "value", "<f8").collect()
    if summed:
        matrix = np.array([unpack_array(row["value"], "<f8") for row in sorted(summed, key=lambda row: row["key"])])
        normal, right = matrix[:, :-1], matrix[:, -1]
        penalty = RIDGE * normal[-1, -1] * np.eye(len(normal))
        penalty[-1, -1] = 0
        weights = np.linalg.solve(normal + penalty / len(normal), right)
    else:
        weights = np.zeros(FOURIER + size + 1)
    model = QualityModel(**{**model.__dict__, "weights": weights})

    scored = with_scores(labelled.filter(F.col(fold)).select(vector, label), model, vector, "raw", False)
    place = F.floor((F.greatest(F.least(F.col("raw"), F.lit(2.0)), F.lit(-1.0)) + 1) / 3 * BINS)
    bins = (
        scored.groupBy(place.alias("place"))
        .agg(F.avg("raw").alias("raw"), F.sum(label).alias("label"), F.count(F.lit(1)).alias("rows"))
        .orderBy("place")
        .collect()
    )
    if bins:
        knots, levels = isotonic(*(np.array([b[c] for b in bins], float) for c in ("raw", "label", "rows")))
    else:
        knots, levels = np.array([0.0, 1.0]), np.array([0.0, 1.0])
    return QualityModel(**{**model.__dict__, "knots": knots, "levels": levels})


def with_scores(rows: DataFrame, model: QualityModel | None, vector: str, name: str, calibrated: bool = True) -> DataFrame:
    """Replace the vector by a score: calibrated to 0..1, or the ridge score. No model: 0.5."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = batch.schema.get_field_index(vector)
            if model is None:
                scores = np.full(batch.num_rows, 0.5)
            elif batch.num_rows:
                scores = model.ridge_scores(_matrix(batch.column(at)))
                scores = model.calibrated(scores) if calibrated else scores
            else:
                scores = np.zeros(0)
            arrays = [batch.column(i) for i in range(batch.num_columns) if i != at]
            names = [c for i, c in enumerate(batch.schema.names) if i != at]
            yield pa.RecordBatch.from_arrays([*arrays, pa.array(scores)], names=[*names, name])

    schema = rows.drop(vector).withColumn(name, F.lit(None).cast("double")).schema
    to_arrow_schema(schema)  # fails early on kinds that Arrow cannot carry
    return rows.mapInArrow(run, schema)
