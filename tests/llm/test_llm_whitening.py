import math

import numpy as np
import pytest
from llm_cases import FOLDER

from tunedata.llm.queries import llm_queries
from tunedata.llm.whitening import right_solve, whiten

SCHEMA = "vec_id long, embedding array<float>, n string, x string, key string"


def frame(spark, vectors, parts=4):
    rows = [(i, v, "a", "b", "c") for i, v in vectors]
    return spark.createDataFrame(rows, SCHEMA).repartition(parts)


def fixed(vectors):
    return np.floor(64 * np.array(vectors, np.float32).astype(np.float64)).astype(np.int64) + 1_000_000


def compare(found, ids, vectors, components=32):
    """Against an eigendecomposition of the covariance, up to signs; eigenvalues must be apart."""
    x = fixed(vectors)
    n, total = len(x), x.sum(axis=0)
    centred = (x * n - total) / n
    values, basis = np.linalg.eigh(centred.T @ centred / n)
    values, basis = values[::-1], basis[:, ::-1]
    keep = min(components, int((values > values[0] * 1e-12).sum()))
    whole = (centred @ basis[:, :keep]) / np.sqrt(values[:keep])
    deviations = [sum((n * int(v) - int(t)) ** 2 for v, t in zip(row, total)) for row in x]
    assert len(found) == n * keep
    own = np.full((n, keep), np.nan)
    place = {i: at for at, i in enumerate(ids)}
    for r in found:
        own[place[r["vec_id"]], r["component"] - 1] = r["whitened"]
        assert r["n"] == n and r["deviation"] == deviations[place[r["vec_id"]]]
        assert abs(r["explained"] - values[r["component"] - 1] / values.sum()) < 1e-9
    signs = np.sign((own * whole).sum(axis=0))
    assert np.abs(own * signs - whole).max() < 1e-6
    covariance = own.T @ own / n
    assert {r["identity_error"] for r in found} == {found[0]["identity_error"]}
    assert found[0]["identity_error"] < 1e-9 and np.abs(covariance - np.eye(keep)).max() < 1e-9


def test_registered_query(spark):
    rows = sorted(spark.read.parquet(f"{FOLDER}/embeddings.parquet").select("vec_id", "embedding").collect())
    compare(llm_queries()["op13_whitening"](spark, FOLDER).collect(), [r[0] for r in rows], [r[1] for r in rows])


@pytest.mark.parametrize("scale", [1.0, 20.0])
def test_ill_conditioned_and_deficient(spark, scale):
    """Directions of very different size, one constant dimension and one that repeats another."""
    draw = np.random.default_rng(2)
    v = draw.normal(size=(200, 6)) * np.array([1000, 100, 10, 3, 1, 0.5]) * scale
    v = np.column_stack([v, np.full(200, 2.5), v[:, 1]])
    vectors = v.astype(np.float32).tolist()
    found = whiten(frame(spark, list(enumerate(vectors)))).collect()
    assert max(r["component"] for r in found) == 6
    compare(found, range(200), vectors)


def test_rows_left_out(spark):
    draw = np.random.default_rng(4)
    sound = [(i, row) for i, row in enumerate(draw.normal(size=(50, 5)).tolist())]
    bad = [(100, None), (101, [1.0, None, 1.0, 1.0, 1.0]), (102, [math.nan] * 5), (103, [math.inf, 1.0, 1.0, 1.0, 1.0])]
    bad += [(104, [-math.inf] * 5), (105, []), (106, [1.0, 2.0])]
    found = whiten(frame(spark, sound + bad), components=3).collect()
    compare(found, range(50), [v for _, v in sound], 3)


def test_repeated_rows_and_null_ids(spark):
    draw = np.random.default_rng(6)
    sound = draw.normal(size=(30, 3)).tolist()
    rows = [(None, sound[0]), (1, sound[1]), (1, sound[1])] + [(i + 2, v) for i, v in enumerate(sound[2:])]
    found = whiten(frame(spark, rows)).collect()
    assert len(found) == 31 * 3 and found[0]["n"] == 31
    assert sum(r["vec_id"] == 1 for r in found) == 6 and sum(r["vec_id"] is None for r in found) == 3
    assert found[0]["identity_error"] < 1e-9


def test_tied_eigenvalues(spark):
    vectors = [[s if k == at else 0.0 for k in range(4)] for at in range(4) for s in (1.0, -1.0)]
    found = whiten(frame(spark, list(enumerate(vectors)))).collect()
    assert len(found) == 8 * 4 and found[0]["identity_error"] < 1e-9
    assert all(abs(r["explained"] - 0.25) < 1e-9 for r in found)


def test_without_variance(spark):
    for vectors in ([], [(1, [1.0, 2.0])], [(i, [1.0, 2.0]) for i in range(5)], [(1, []), (2, None)]):
        found = whiten(frame(spark, vectors))
        assert found.collect() == [] and found.columns[0] == "vec_id"


def test_deviations_beyond_a_long_are_null(spark):
    vectors = [(i, [float(i * 2**40), float(i % 3)]) for i in range(6)]
    found = whiten(frame(spark, vectors)).collect()
    assert {r["deviation"] for r in found if r["vec_id"] == 0} == {None}


def test_triangular_solve():
    draw = np.random.default_rng(1)
    r = np.triu(draw.normal(size=(9, 9))) + 5 * np.eye(9)
    a = draw.normal(size=(40, 9))
    assert np.allclose(right_solve(a, r) @ r, a)
