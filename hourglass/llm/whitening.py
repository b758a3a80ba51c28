"""Whitening of embeddings by blockwise QR and a bidiagonal qd solver.

1. Component sums and the row count are exact (integers and decimals).
2. Centred rows, x - S/n, are reduced to one triangular R by blockwise QR: a task folds its rows
   into an R block by block, and the tasks' R meet sixteen at a time in a tree.  R'R / n is the
   covariance V, without its ever being summed up.
3. The driver holds R alone (``dims`` squared numbers, ``MAX_DIMS`` at most): Householder reflectors
   bidiagonalise it, dqds finds its singular values, twisted factorisations its right singular vectors
   (``bidiagonal``).  With singular value s, e = s**2 / n is an eigenvalue of V.
4. A row's whitened value in a component is its centred row times the vector, over sqrt(e).

Rows are centred as (x - floor(S/n)) - (S mod n)/n, so no size of x or n takes digits from them.

Cases: vectors that are null or hold null, NaN or infinite entries take no part; the dimension is the
length that most of the others have (of equally many the longer one), and vectors of another length
take no part either; components whose eigenvalue is zero to rounding (fewer rows than components,
constant rows) have no whitened form and are left out, so equal rows give an empty result, as does an
empty table; repeated rows and null ids are rows of their own; equal eigenvalues get some orthonormal
vectors of their space; a deviation beyond a long integer is null; entries of 2**49 or more fail the
job, by an error that names the limit.  Other columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hourglass.llm.bidiagonal import right_singular
from hourglass.llm.common import saved
from hourglass.llm.topk import valid

MAX_DIMS = 1024
#: Entries stay below this, so that a block's sums are exact.
MAX_ENTRY = 1 << 49
FAN_IN = 16


@dataclass
class Whitening:
    """What whitens a row: count, sums of the components, directions (columns), eigenvalues, trace of V."""

    n: int
    sums: list[int]
    vectors: np.ndarray
    values: np.ndarray
    trace: float

    def centre(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """floor(S/n), S mod n and the latter over n."""
        whole = np.array([s // self.n for s in self.sums], dtype=np.int64)
        rest = np.array([s % self.n for s in self.sums], dtype=np.int64)
        return whole, rest, rest / self.n


def integers(vec: Column, scale: int, add: int) -> Column:
    """floor(scale * c) + add of each entry; fails from ``MAX_ENTRY`` on."""
    fail = F.raise_error(F.lit(f"an entry times {scale} is beyond {MAX_ENTRY}"))

    def one(c):
        y = F.lit(float(scale)) * c.cast("double")
        return F.when(F.abs(y) < F.lit(float(MAX_ENTRY - abs(add))), F.floor(y) + F.lit(add)).otherwise(fail.cast("long"))

    return F.transform(vec, one)


def _matrix(column: pd.Series) -> np.ndarray:
    return np.stack(column.to_numpy()).astype(np.int64)


def totals(vectors: DataFrame) -> tuple[int, list[int]]:
    """Rows and exact component sums of ``vectors`` (x)."""

    def run(batches):
        n, sums = 0, None
        for pdf in batches:
            if len(pdf):
                x = _matrix(pdf["x"])
                step = [int(v) for v in x.sum(0)]
                sums = step if sums is None else [a + b for a, b in zip(sums, step, strict=True)]
                n += len(x)
        if n:
            yield pd.DataFrame({"n": [n], "s": [[str(v) for v in sums]]})

    parts = vectors.select("x").mapInPandas(run, "n long, s array<string>")
    each = parts.select("n", F.posexplode("s").alias("i", "s")).groupBy("i").agg(F.sum("n").alias("n"), F.sum(F.col("s").cast("decimal(38,0)")).alias("s"))
    rows = sorted(each.collect(), key=lambda r: r["i"])  # one row a component
    return (int(rows[0]["n"]), [int(r["s"]) for r in rows]) if rows else (0, [])


def _fold(parts) -> np.ndarray | None:
    """The R of the rows of all ``parts``, block by block."""
    r = None
    for block in parts:
        both = block if r is None else np.vstack([r, block])
        r = np.linalg.qr(both, mode="r")
    return r


def triangle(vectors: DataFrame, centre: tuple[np.ndarray, np.ndarray, np.ndarray]) -> np.ndarray:
    """R (dims x dims) of the centred rows of ``vectors`` (x)."""
    whole, _, rest = centre
    d = len(whole)
    block = max(2048, 4 * d)

    def run(batches):
        def blocks():
            for pdf in batches:
                for i in range(0, len(pdf), block):
                    yield (_matrix(pdf["x"].iloc[i : i + block]) - whole) - rest

        r = _fold(blocks())
        if r is not None:
            yield pd.DataFrame({"node": [TaskContext.get().partitionId()], "r": [r.ravel()]})

    def merge(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("node")
        r = _fold(np.asarray(v).reshape(-1, d) for v in pdf["r"])
        return pd.DataFrame({"node": [int(pdf["up"].iloc[0])], "r": [r.ravel()]})

    level = saved(vectors.select("x").mapInPandas(run, "node long, r array<double>"))
    while level.count() > FAN_IN:
        up = level.withColumn("up", F.floor(F.col("node") / FAN_IN).cast("long"))
        level = saved(up.groupBy("up").applyInPandas(merge, "node long, r array<double>"))
    last = sorted(level.collect(), key=lambda r: r["node"])  # at most FAN_IN triangles
    r = _fold(np.asarray(v["r"]).reshape(-1, d) for v in last)
    out = np.zeros((d, d))
    out[: len(r)] = r
    return out


def fit(vectors: DataFrame, components: int) -> Whitening | None:
    """The whitening of ``vectors`` (x: integers of one length), with at most ``components``
    directions; None without rows."""
    n, sums = totals(vectors)
    if not n:
        return None
    fitted = Whitening(n, sums, np.zeros((len(sums), 0)), np.zeros(0), 0.0)
    r = triangle(vectors, fitted.centre())
    singular, v = right_singular(r, components)
    return Whitening(n, sums, v, singular[: v.shape[1]] ** 2 / n, float((singular**2).sum()) / n)


def project(vectors: DataFrame, w: Whitening) -> DataFrame:
    """id, deviation (sum over components of (n*x - S)**2) and w (whitened values) of ``vectors`` (id, x)."""
    whole, left, rest = w.centre()
    turn = w.vectors / np.sqrt(w.values)
    n = w.n

    def run(batches):
        for pdf in batches:
            if not len(pdf):
                continue
            off = _matrix(pdf["x"]) - whole
            rough = ((n * off.astype(np.float64) - left) ** 2).sum(1)
            fits = rough < 2.0**62
            exact = ((n * np.where(fits[:, None], off, 0) - left) ** 2).sum(1)
            for i in np.flatnonzero(~fits):
                big = sum((n * int(a) - int(b)) ** 2 for a, b in zip(off[i], left, strict=True))
                exact[i], fits[i] = (big, True) if big < 2**63 else (0, False)
            values = (off - rest) @ turn
            yield pd.DataFrame({"id": pdf["id"], "deviation": pd.array(exact, dtype="Int64").copy(), "fits": fits, "w": list(values)})

    kind = vectors.schema["id"].dataType.simpleString()
    out = vectors.select("id", "x").mapInPandas(run, f"id {kind}, deviation long, fits boolean, w array<double>")
    return out.select("id", F.when(F.col("fits"), F.col("deviation")).alias("deviation"), "w")


def identity_error(projected: DataFrame, size: int) -> float:
    """The largest absolute entry of the covariance of w (divisor n, centred first) minus the identity."""
    w = [F.element_at("w", i + 1) for i in range(size)]
    mean = projected.agg(*[F.avg(c).alias(f"m{i}") for i, c in enumerate(w)]).first()
    pairs = [(i, j) for i in range(size) for j in range(i + 1)]
    cov = projected.agg(*[F.avg((w[i] - F.lit(mean[i])) * (w[j] - F.lit(mean[j]))).alias(f"c{i}_{j}") for i, j in pairs]).first()
    return max(abs(c - (i == j)) for c, (i, j) in zip(cov, pairs, strict=True))


def whiten(rows: DataFrame, components: int, scale: int, add: int, id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """Per kept row and component (from 1, by falling eigenvalue): id_col, component, n, deviation,
    whitened, explained (e over the trace of V) and identity_error (one value)."""
    kept = rows.select(F.col(id_col).alias("id"), F.col(vec_col).alias("v")).filter(valid(F.col("v")) & (F.size("v") > 0))
    most = kept.groupBy(F.size("v").alias("size")).count().orderBy(F.desc("count"), F.desc("size")).first()
    if most and most["size"] > MAX_DIMS:
        raise ValueError(f"vectors have {most['size']} entries; at most {MAX_DIMS} are whitened")
    vectors = saved(kept.filter(F.size("v") == (most["size"] if most else 0)).select("id", integers(F.col("v"), scale, add).alias("x")))
    w = fit(vectors, components)
    if w is None or not w.vectors.shape[1]:
        doubles = [F.lit(0.0).alias(c) for c in ("whitened", "explained", "identity_error")]
        longs = [F.lit(0).cast("long").alias(c) for c in ("n", "deviation")]
        return vectors.filter(F.lit(False)).select(F.col("id").alias(id_col), F.lit(0).alias("component"), *longs, *doubles)
    out = saved(project(vectors, w))
    size = w.vectors.shape[1]
    error = identity_error(out, size)
    share = F.array(*[F.lit(float(e / w.trace)) for e in w.values])
    each = out.select("id", "deviation", F.posexplode("w").alias("i", "whitened"))
    return each.select(F.col("id").alias(id_col), (F.col("i") + 1).alias("component"), F.lit(w.n).cast("long").alias("n"), "deviation", "whitened",
                       F.element_at(share, F.col("i") + 1).alias("explained"), F.lit(float(error)).alias("identity_error"))
