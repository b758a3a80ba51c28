"""The qd solver against numpy's decompositions, whitening against the covariance itself."""

import numpy as np
import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from hourglass.llm import bidiagonal, whitening
from hourglass.llm.queries import QUERIES

ROWS = "vec_id long, embedding array<double>, x int"
NAMES = ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]


def turned(values, seed=0):
    r = np.random.default_rng(seed)
    n = len(values)
    q, _ = np.linalg.qr(r.normal(size=(n, n)))
    p, _ = np.linalg.qr(r.normal(size=(n, n)))
    return q @ np.diag(values) @ p.T


MATRICES = {
    "one": np.array([[3.0]]),
    "two": np.array([[1.0, 2.0], [0.0, 1e-3]]),
    "random": np.triu(np.random.default_rng(0).normal(size=(40, 40))),
    "identity": np.eye(20),
    "near identity": np.eye(30) + 1e-9 * np.random.default_rng(1).normal(size=(30, 30)),
    "repeated": turned([5.0] * 10 + [3.0] * 9 + [1.0] * 11),
    "graded": turned(np.geomspace(1e3, 1e-12, 32)),
    "low rank": turned([7.0, 7.0, 6.0, 5.0] + [0.0] * 20),
    "zero columns": np.random.default_rng(2).normal(size=(24, 24)) * (np.arange(24) % 5 > 0),
    "huge": 1e150 * np.triu(np.random.default_rng(3).normal(size=(9, 9))),
    "tiny": 1e-150 * np.triu(np.random.default_rng(3).normal(size=(9, 9))),
}


@pytest.mark.parametrize("name", MATRICES)
def test_right_singular_vectors(name):
    a = MATRICES[name]
    values, v = bidiagonal.right_singular(a, len(a))
    want = np.linalg.svd(a, compute_uv=False)
    assert np.abs(values - want).max() <= 1e-13 * want[0]
    assert v.shape[1] >= (want > 1e-12 * want[0]).sum()
    assert np.abs(v.T @ v - np.eye(v.shape[1])).max() < 1e-10
    b = a / want[0]
    assert np.abs(b.T @ (b @ v) - v * (values[: v.shape[1]] / want[0]) ** 2).max() < 1e-11
    assert bidiagonal.right_singular(np.zeros((4, 4)), 4)[1].shape == (4, 0)


def test_bidiagonal_form_keeps_the_matrix():
    r = MATRICES["random"]
    diag, sup, right = bidiagonal.bidiagonal(r)
    b = np.diag(diag) + np.diag(sup, 1)
    assert np.abs(right @ (b.T @ b) @ right.T - r.T @ r).max() < 1e-12


def test_small_singular_values_are_accurate():
    """dqds keeps relative accuracy where the values span 200 orders (a closed form: 2 x 2)."""
    a, b, c = 1.0, 1.0, 1e-100
    low = a * c / np.sqrt(a * a + b * b)  # to first order in c
    values = bidiagonal.singular_values(np.array([a, c]), np.array([b]))
    assert abs(values[1] / low - 1) < 1e-14


def check(spark, rows, dims, components=4, scale=1024, add=100_000, parts=5):
    df = spark.createDataFrame([(i, v, 0) for i, v in rows], ROWS).repartition(parts)
    out = whitening.whiten(df, components, scale, add)
    assert out.columns == NAMES
    got = out.toPandas()
    kept = [(i, [int(np.floor(scale * c)) + add for c in v]) for i, v in rows if v and len(v) == dims and all(c is not None and np.isfinite(c) for c in v)]
    x = np.array([v for _, v in kept], dtype=object)
    n, s = len(x), x.sum(0)
    exact = np.array([[n * a - b for a, b in zip(row, s)] for row in x], dtype=object)
    centred = exact.astype(float) / n
    e, v = np.linalg.eigh(centred.T @ centred / n)
    e, v = e[::-1], v[:, ::-1]
    size = got["component"].max()
    assert (got["n"] == n).all() and len(got) == n * size
    assert sorted(map(str, got[got.component == 1]["vec_id"])) == sorted(str(float(i) if got["vec_id"].dtype == float and i is not None else "nan" if i is None else i) for i, _ in kept)
    assert sorted(got[got.component == 1]["deviation"]) == sorted(int(sum(c * c for c in row)) for row in exact)
    assert (got["identity_error"] < 1e-8).all() and got["identity_error"].nunique() == 1
    for j in range(size):
        one = got[got.component == j + 1].sort_values(["deviation", "vec_id"])
        assert np.allclose(one["explained"], e[j] / e.sum(), rtol=1e-9)
        w = np.sort(one["whitened"].to_numpy())
        want = centred @ v[:, j] / np.sqrt(e[j])
        assert min(np.abs(w - np.sort(want)).max(), np.abs(w - np.sort(-want)).max()) < 1e-6
    return got


def test_whitening_equals_the_eigenvectors_of_the_covariance(spark):
    r = np.random.default_rng(4)
    x = r.normal(size=(400, 12)) * np.geomspace(4, 0.3, 12) @ np.linalg.qr(r.normal(size=(12, 12)))[0]
    rows = [(i, v.tolist()) for i, v in enumerate(x)]
    rows += [(7, rows[7][1])] * 180 + [(None, rows[3][1])]  # a third are copies
    rows += [(900, None), (901, []), (902, [1.0, 2.0]), (903, [None] * 12), (904, [float("nan")] * 12), (905, [float("-inf")] * 12)]
    check(spark, rows, 12)
    check(spark, rows, 12, parts=40)  # more triangles than one merge takes


def test_few_rows_have_few_components(spark):
    got = check(spark, [(1, [1.0, 0.0, 2.0]), (2, [0.0, 1.5, 0.0]), (3, [0.25, 0.0, 0.0])], 3)
    assert got["component"].max() == 2


def test_rows_without_variance_and_empty_tables(spark):
    for rows in ([], [(1, None)], [(1, [1.0, 2.0])], [(i, [0.1, 0.2, 0.3]) for i in range(50)]):
        out = whitening.whiten(spark.createDataFrame([(i, v, 0) for i, v in rows], ROWS), 8, 1024, 100_000)
        assert out.columns == NAMES and out.count() == 0


def test_deviation_beyond_a_long_is_null_and_large_ones_are_exact(spark):
    rows = [(1, [2.0**34, 0.0]), (2, [0.0, 1.0]), (3, [0.0, 0.0]), (4, [-(2.0**20), 5.0])]
    out = whitening.whiten(spark.createDataFrame([(i, v, 0) for i, v in rows], ROWS), 1, 1024, 0).toPandas().set_index("vec_id")["deviation"]
    x = np.array([[int(1024 * c) for c in v] for _, v in rows], dtype=object)
    s = x.sum(0)
    for (i, _), row in zip(rows, x):
        want = int(sum((4 * a - b) ** 2 for a, b in zip(row, s)))
        assert (int(out[i]) == want) if want < 2**63 else np.isnan(float(out[i]))
    with pytest.raises(PySparkException, match="is beyond"):
        whitening.whiten(spark.createDataFrame([(1, [1e300], 0)], ROWS), 1, 1024, 0).collect()


def test_clashing_columns_and_the_query(spark):
    names = ["id", "v", "w", "n", "deviation", "component", "i", "size", "whitened"]
    df = spark.createDataFrame([(i, [float(i % 3), float(i)], i) for i in range(9)], ROWS).select("vec_id", "embedding", *[F.col("x").alias(n) for n in names])
    assert whitening.whiten(df, 8, 1024, 0).count() == 18
    got = QUERIES["op12_whitening"](spark, "/root/testdata/sf0.001").toPandas()
    assert set(got["component"]) == set(range(1, 9)) and (got["identity_error"] < 1e-9).all()
    assert np.allclose(got.groupby("component")["whitened"].apply(lambda w: (w**2).mean()), 1)
