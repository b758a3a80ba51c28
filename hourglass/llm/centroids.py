"""Centroid clustering with an equal-average equal-variance nearest-centroid search.

For vectors of d components with component means m and deviations s (the length of what
is left when the mean is taken off every component), the squared distance of x and c is at least
    d * (m(x) - m(c))**2 + (s(x) - s(c))**2.
Centroids are sorted by their mean.  A vector starts between its neighbours by mean and
scans outward, always to the side that is nearer in mean: once the first term alone exceeds
the best distance, nothing farther out can win and the scan ends (mean inequality); a centroid
whose whole bound exceeds it is passed over (deviation inequality); the others are measured in
integers.  Bounds are widened by rounding slack, so a skipped centroid is never the nearest
and ties go to the smaller number.  A batch of vectors takes each step of its scans together.

Vectors are integers (``floor(scale * x)``), so distances, sums and centroids are exact.  A round
assigns in tasks that hold the centroids (``MAX_CENTROID_VALUES`` numbers at most) and add up their
vectors by centroid before the shuffle; a cluster of any size sends one row a task.

Cases: vectors that are null, hold null, NaN or infinite components or have another length take no
part; repeated rows and null ids are vectors of their own; equal distances go to the smaller centroid;
with fewer vectors than centroids there are as many centroids as vectors; a centroid without vectors
stays where it is; an empty table gives an empty result; other columns are ignored.  Components so
large that a squared distance could pass 2**63 fail the job, by an error that names the limit.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hourglass.llm.common import saved
from hourglass.llm.topk import valid

#: Centroids times components that a task and the driver may hold (8 MB of long integers).
MAX_CENTROID_VALUES = 1 << 20
#: Vectors that are scanned together.
BATCH = 4096


def largest_component(dims: int) -> int:
    """The size of an integer component up to which squared distances stay below 2**63."""
    return int((2**62 / max(dims, 1)) ** 0.5) // 2


def integers(vec: Column, dims: int, scale: int) -> Column:
    """floor(scale * x) of each component; fails beyond ``largest_component``."""
    top = largest_component(dims)
    fail = F.raise_error(F.lit(f"a component is beyond the {top} that exact distances of {dims} components allow"))

    def one(x):
        y = F.floor(F.lit(float(scale)) * x.cast("double"))
        return F.when(F.abs(F.lit(float(scale)) * x.cast("double")) < F.lit(float(top)), y).otherwise(fail.cast("long"))

    return F.transform(vec, one)


class Search:
    """Nearest centroids of integer vectors.  ``centroids``: one row each, numbered from 0."""

    def __init__(self, centroids: np.ndarray):
        c = np.asarray(centroids, dtype=np.int64)
        self.number = np.argsort(c.sum(1), kind="stable")
        self.c = c[self.number]
        self.mean, self.dev, self.square = spread(self.c)

    def nearest(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
        """The number of the nearest centroid and the squared distance to it, by row, and
        how many distances were measured."""
        parts = [self._nearest(x[i : i + BATCH]) for i in range(0, len(x), BATCH)]
        if not parts:
            return np.zeros(0, np.int64), np.zeros(0, np.int64), 0
        return np.concatenate([p[0] for p in parts]), np.concatenate([p[1] for p in parts]), sum(p[2] for p in parts)

    def _nearest(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
        n, d = x.shape
        k = len(self.c)
        mean, dev, square = spread(x)
        slack = 1e-9 * (square + self.square.max(initial=0.0)) + 1e-9
        right = np.searchsorted(self.mean, mean)
        left = right - 1
        best = np.full(n, np.iinfo(np.int64).max)
        who = np.full(n, k, dtype=np.int64)
        live, measured = np.arange(n), 0
        while len(live):
            lo, hi = left[live], right[live]
            below = np.where(lo >= 0, mean[live] - self.mean[np.maximum(lo, 0)], np.inf)
            above = np.where(hi < k, self.mean[np.minimum(hi, k - 1)] - mean[live], np.inf)
            down = below <= above
            gap = d * np.where(down, below, above) ** 2 - slack[live]
            on = gap <= best[live]  # the mean inequality ends a scan
            live, down, gap, j = live[on], down[on], gap[on], np.where(down, lo, hi)[on]
            left[live[down]] -= 1
            right[live[~down]] += 1
            near = gap + (dev[live] - self.dev[j]) ** 2 <= best[live]  # the deviation inequality skips one centroid
            rows, j = live[near], j[near]
            diff = x[rows] - self.c[j]
            dist = np.einsum("ij,ij->i", diff, diff)
            measured += len(rows)
            num = self.number[j]
            wins = (dist < best[rows]) | ((dist == best[rows]) & (num < who[rows]))
            best[rows[wins]], who[rows[wins]] = dist[wins], num[wins]
        return who, best, measured


def spread(x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Mean of the components, deviation from it and squared length, by row."""
    y = x.astype(np.float64)
    if not y.shape[1]:
        return np.zeros(len(y)), np.zeros(len(y)), np.zeros(len(y))
    mean = y.mean(1)
    return mean, np.sqrt(((y - mean[:, None]) ** 2).sum(1)), (y**2).sum(1)


def matrix(column: pd.Series, dims: int) -> np.ndarray:
    return np.stack(column.to_numpy()).astype(np.int64) if len(column) else np.zeros((0, dims), np.int64)


def start(vectors: DataFrame, k: int, seed: int = 1) -> np.ndarray:
    """The ``k`` vectors (id, x) of least sha256 of ``seed:id``, in the order of the hash; of
    equal ids the lesser vector first; a null id is empty text."""
    h = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("id").cast("string"), F.lit(""))).cast("binary"), 256)
    rows = vectors.select(h.alias("h"), "x").orderBy("h", "x").limit(k).collect()  # k rows, bounded by MAX_CENTROID_VALUES
    return np.array([r["x"] for r in rows], dtype=np.int64)


def assign(vectors: DataFrame, centroids: np.ndarray) -> DataFrame:
    """id, cluster, distance (squared) of each of ``vectors`` (id, x)."""
    search = Search(centroids)

    def run(batches):
        for pdf in batches:
            who, best, _ = search.nearest(matrix(pdf["x"], centroids.shape[1]))
            yield pd.DataFrame({"id": pdf["id"], "cluster": who.astype(np.int32), "distance": best})

    kind = vectors.schema["id"].dataType.simpleString()
    return vectors.mapInPandas(run, f"id {kind}, cluster int, distance long")


def update(vectors: DataFrame, centroids: np.ndarray) -> np.ndarray:
    """The centroids after one round: floor(sum / count) by component; an empty one stays."""
    search = Search(centroids)
    k, d = centroids.shape

    def run(batches):
        sums, counts = np.zeros((k, d), np.int64), np.zeros(k, np.int64)
        for pdf in batches:
            x = matrix(pdf["x"], d)
            who, _, _ = search.nearest(x)
            order = np.argsort(who, kind="stable")
            there, at, n = np.unique(who[order], return_index=True, return_counts=True)
            sums[there] += np.add.reduceat(x[order], at, axis=0) if len(there) else 0
            counts[there] += n
        some = np.flatnonzero(counts)
        if len(some):
            yield pd.DataFrame({"cluster": some.astype(np.int32), "n": counts[some], "s": list(sums[some])})

    parts = vectors.select("x").mapInPandas(run, "cluster int, n long, s array<long>")
    whole = F.sum(F.col("s").cast("decimal(38,0)"))
    sums = parts.select("cluster", "n", F.posexplode("s").alias("i", "s")).groupBy("cluster", "i").agg(F.sum("n").alias("n"), whole.alias("s"))
    out = centroids.copy()
    for r in sums.collect():  # k * d rows, bounded by MAX_CENTROID_VALUES
        out[r["cluster"], r["i"]] = int(r["s"]) // r["n"]
    return out


def cluster(rows: DataFrame, k: int, rounds: int, dims: int, scale: int, id_col: str = "vec_id", vec_col: str = "embedding", seed: int = 1) -> DataFrame:
    """id_col, cluster, distance, cluster_inertia, inertia and centroid (its components) of every
    vector with exactly ``dims`` finite components, after ``rounds`` rounds and a last assignment."""
    if k < 1 or dims < 1 or k * dims > MAX_CENTROID_VALUES:
        raise ValueError(f"k and dims must be positive and k * dims at most {MAX_CENTROID_VALUES}")
    vec = F.col(vec_col)
    kept = rows.select(F.col(id_col).alias("id"), vec.alias("v")).filter(valid(F.col("v")) & (F.size("v") == dims))
    vectors = saved(kept.select("id", integers(F.col("v"), dims, scale).alias("x")))
    spark = rows.sparkSession
    centroids = start(vectors, k, seed)
    if not len(centroids):
        return vectors.select(F.col("id").alias(id_col), F.lit(0).alias("cluster"), *[F.lit(0).cast("long").alias(c) for c in ("distance", "cluster_inertia", "inertia")], F.col("x").alias("centroid"))
    for _ in range(rounds):
        centroids = update(vectors, centroids)
    out = saved(assign(vectors, centroids))
    inertia = {r["cluster"]: r["s"] for r in out.groupBy("cluster").agg(F.sum("distance").alias("s")).collect()}  # k rows
    every = sum(inertia.values())
    told = [(c, s, every, [int(v) for v in centroids[c]]) for c, s in sorted(inertia.items())]
    told = spark.createDataFrame(told, "cluster int, cluster_inertia long, inertia long, centroid array<long>")
    out = out.join(F.broadcast(told), "cluster")  # k rows, bounded by MAX_CENTROID_VALUES
    return out.select(F.col("id").alias(id_col), "cluster", "distance", "cluster_inertia", "inertia", "centroid")


def centroid_digest(centroid: Column) -> Column:
    """Lower-case hex sha256 of the components, as decimal integers joined by commas."""
    return F.sha2(F.array_join(F.transform(centroid, lambda x: x.cast("string")), ",").cast("binary"), 256)

