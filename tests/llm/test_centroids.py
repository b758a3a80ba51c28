"""Nearest centroids against all distances, whole clusterings against plain rounds."""

import hashlib

import numpy as np
import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from hourglass.llm import centroids

ROWS = "vec_id long, embedding array<double>, x int"


def plain_nearest(x, c):
    d = ((x[:, None, :] - c[None, :, :]) ** 2).sum(2)
    return d.argmin(1), d.min(1)


def plain_cluster(rows, k, rounds, dims, scale):
    kept = [(i, [int(np.floor(scale * v)) for v in vec]) for i, vec in rows if vec is not None and len(vec) == dims and all(v is not None and np.isfinite(v) for v in vec)]
    if not kept:
        return []
    x = np.array([v for _, v in kept], dtype=np.int64)
    first = sorted((hashlib.sha256(f"1:{'' if i is None else i}".encode()).hexdigest(), v) for i, v in kept)[:k]
    c = np.array([v for _, v in first], dtype=np.int64)
    for _ in range(rounds):
        who, _ = plain_nearest(x, c)
        for j in range(len(c)):
            if (who == j).any():
                c[j] = x[who == j].sum(0) // (who == j).sum()
    who, dist = plain_nearest(x, c)
    return sorted(((i, int(w), int(d), int(dist[who == w].sum()), int(dist.sum()), c[w].tolist()) for (i, _), w, d in zip(kept, who, dist)), key=str)


def run(spark, rows, **how):
    df = spark.createDataFrame([(i, v, 0) for i, v in rows], ROWS).repartition(3)
    out = centroids.cluster(df, **how)
    assert out.columns == ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid"]
    return sorted((tuple(r) for r in out.collect()), key=str)


@pytest.mark.parametrize("k,d,size", [(1, 5, 10), (16, 64, 40), (60, 3, 4), (200, 8, 2), (300, 16, 1_000_000)])
def test_search_equals_all_distances(k, d, size):
    r = np.random.default_rng(k)
    c = r.integers(-size, size + 1, (k, d))
    c[k // 2 :: 3] = c[0]  # equal centroids
    x = np.concatenate([r.integers(-size, size + 1, (700, d)), c])
    who, dist, measured = centroids.Search(c).nearest(x)
    want, least = plain_nearest(x, c)
    assert (who == want).all() and (dist == least).all()
    assert measured <= k * len(x)


def test_search_skips_most_of_spread_centroids():
    r = np.random.default_rng(1)
    c = r.integers(-20, 20, (500, 16)) + r.integers(-400, 400, (500, 1))
    x = c[r.integers(0, 500, 2000)] + r.integers(-5, 5, (2000, 16))
    who, _, measured = centroids.Search(c).nearest(x)
    assert (who == plain_nearest(x, c)[0]).all()
    assert measured < 0.05 * 500 * 2000


def test_largest_components_stay_exact():
    for d in (1, 64):
        top = centroids.largest_component(d)
        x, c = np.full((1, d), top), np.array([[-top] * d, [-top + 1] * d])
        who, dist, _ = centroids.Search(c).nearest(x)
        assert who[0] == 1 and int(dist[0]) == d * (2 * top - 1) ** 2


def test_clusters_equal_plain_rounds(spark):
    r = np.random.default_rng(3)
    hot = [0.25, -0.5, 0.125]
    rows = [(int(i), (r.normal(size=3) * 2).tolist()) for i in range(120)] + [(7, hot)] * 90 + [(None, hot), (None, [1.0, 2.0, 3.0])]
    rows += [(500, None), (501, []), (502, [1.0, 2.0]), (503, [1.0, None, 0.0]), (504, [1.0, float("nan"), 0.0]), (505, [1.0, float("inf"), 0.0]), (506, [1.0] * 4)]
    for k, rounds in ((6, 3), (1, 1), (4, 0)):
        assert run(spark, rows, k=k, rounds=rounds, dims=3, scale=16) == plain_cluster(rows, k, rounds, 3, 16)


def test_few_rows_and_none(spark):
    few = [(1, [0.5, 0.5]), (2, [-0.3, 0.0]), (2, [-0.3, 0.0])]
    assert run(spark, few, k=16, rounds=3, dims=2, scale=64) == plain_cluster(few, 16, 3, 2, 64)
    assert run(spark, [(1, None)], k=4, rounds=2, dims=2, scale=64) == []
    assert run(spark, [], k=4, rounds=2, dims=2, scale=64) == []


def test_clashing_columns_and_limits(spark):
    names = ["id", "x", "v", "cluster", "distance", "centroid", "n", "s", "i", "inertia", "h"]
    df = spark.createDataFrame([(1, [0.5, 0.5], 0), (2, [0.1, 0.2], 1)], ROWS).select("vec_id", "embedding", *[F.col("x").alias(n) for n in names])
    assert centroids.cluster(df, k=2, rounds=1, dims=2, scale=8).count() == 2
    with pytest.raises(ValueError, match="at most"):
        centroids.cluster(df, k=1 << 20, rounds=1, dims=64, scale=8)
    with pytest.raises(PySparkException, match="beyond the"):
        centroids.cluster(spark.createDataFrame([(1, [1e300, 0.0], 0)], ROWS), k=1, rounds=1, dims=2, scale=8).collect()
