"""Exact top-k inner-product search by dual cover trees.

1. Cells.  At most ``cells`` rows, by their hash, are centres; every row lies in the
   cell of its nearest centre, and a cell has a covering radius.  This is the shared top
   of all trees; rows whose length no centre has lie in a cell around the origin.
2. A first bound.  Every query meets one block of rows of the cell whose centre it scores
   highest with; its kth score there is a lower bound of its kth score.
3. A query goes to the cells whose centre and radius allow that bound, and to no other;
   a cell that no query asks for is not read on.  Rows and queries of a cell are dealt into blocks of
   ``block_rows``.  For each pair of blocks one task indexes both sides as cover trees and
   walks them together: a pair of nodes is dropped when the largest inner product that
   their centres and covering radii allow is below the worst kth score (or first bound) of
   the query node.  A pair of blocks returns at most k rows a query; a last window keeps the best k.
   Ties go to the smaller id.

So a query is sent once per block of the cells that can beat its bound, and a row once per
``block_rows`` queries that its cell's bound lets in.  Centres only decide the way: which rows
they are changes no result.

Vectors are integers here (``quantized``), so the scores are exact in doubles
while squared lengths stay below 2**53 (checked: longer vectors fail by name); the
bounds are widened by rounding slack, so pruning never loses a row.

Cases: vectors that are null or hold null, NaN or infinite components take no
part; vectors of other lengths than the query's are no candidates of it; an empty
vector scores 0; a repeated row is a candidate of its copies (a row is excluded
from its own candidates only, not its id); null ids come last in ties and are no
queries; an empty table gives an empty result.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from hourglass.llm.common import saved

LAST = np.iinfo(np.int64).max
LEAF = 48
SCORES = 1 << 20  # scores held at a time
EXACT = 2.0**53


def quantized(vec: Column, scale: int = 1024) -> Column:
    return F.transform(vec, lambda x: F.floor(F.lit(scale) * x.cast("double")))


def valid(vec: Column) -> Column:
    good = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")).cast("float"))
    return F.coalesce(vec.isNotNull() & F.forall(vec, good), F.lit(False))


class Node:
    __slots__ = ("center", "radius", "lo", "hi", "own", "children")

    def __init__(self, center, radius, lo, hi, own, children):
        self.center, self.radius, self.lo, self.hi, self.own, self.children = center, radius, lo, hi, own, children


class CoverTree:
    """A cover tree over rows of ``x``; ``order`` lists the rows so that each
    node holds the slice lo:hi of it, and ``own`` is the slice that lies in no child."""

    def __init__(self, x: np.ndarray, base: float = 1.5):
        self.x, self.base, self.order = x, base, np.empty(len(x), np.int64)
        self.filled = 0
        self.root = self._node(np.arange(len(x)), 0) if len(x) else None

    def _node(self, rows: np.ndarray, at: int) -> Node:
        center = self.x[rows[0]]
        d = np.sqrt(((self.x[rows] - center) ** 2).sum(1))
        radius = float(d.max())
        if len(rows) <= LEAF or radius == 0:
            self.order[at : at + len(rows)] = rows
            return Node(center, radius, at, at + len(rows), (at, at + len(rows)), [])
        rest, cover, groups, own = rows, radius / self.base, [], []
        near = d <= cover
        while len(rest):
            (groups if near.sum() > LEAF // 4 else own).append(rest[near])
            rest = rest[~near]
            if len(rest):
                near = ((self.x[rest] - self.x[rest[0]]) ** 2).sum(1) <= cover * cover
        mine = np.concatenate(own) if own else np.zeros(0, np.int64)
        end = at + len(mine)
        self.order[at:end] = mine
        children = []
        for g in groups:
            children.append(self._node(g, end))
            end += len(g)
        return Node(center, radius, at, end, (at, at + len(mine)), children)


def dual_search(queries: np.ndarray, q_rows: np.ndarray, data: np.ndarray, ids: np.ndarray, rows: np.ndarray, k: int, low: np.ndarray | None = None):
    """For each query the k best (score, id) among the data rows other than its own;
    score -inf where there are fewer.  Rows below a query's bound ``low`` may be left out."""
    qt, dt = CoverTree(queries), CoverTree(data)
    q, d = queries[qt.order], data[dt.order]
    qr, dr, di = q_rows[qt.order], rows[dt.order], ids[dt.order]
    score, best = np.full((len(q), k), -np.inf), np.full((len(q), k), LAST, np.int64)
    limit = np.full(len(q), -np.inf) if low is None else low[qt.order].astype(np.float64)

    def visit(a: int, z: int, b: slice) -> None:
        step = max(1, SCORES // (b.stop - b.start))
        for lo in range(a, z, step):
            s = q[lo : min(z, lo + step)] @ d[b].T
            s[qr[lo : lo + len(s)][:, None] == dr[b][None, :]] = -np.inf
            hit = lo + np.flatnonzero((s >= limit[lo : lo + len(s)][:, None]).any(1))
            if not len(hit):
                continue
            s = s[hit - lo]
            both = np.concatenate([score[hit], s], 1)
            name = np.concatenate([best[hit], np.broadcast_to(di[b], s.shape)], 1)
            pick = np.lexsort((name, -both), axis=-1)[:, :k]
            score[hit], best[hit] = np.take_along_axis(both, pick, 1), np.take_along_axis(name, pick, 1)
            limit[hit] = np.maximum(limit[hit], score[hit, -1])

    def bound(m: Node, n: Node) -> float:
        qn, pn = np.linalg.norm(m.center), np.linalg.norm(n.center)
        return float(m.center @ n.center) + qn * n.radius + pn * m.radius + m.radius * n.radius + 1e-9 * (1 + qn + m.radius) * (1 + pn + n.radius)

    stack = [(np.inf, qt.root, dt.root)] if len(q) and len(d) else []
    while stack:
        most, m, n = stack.pop()
        if most < limit[m.lo : m.hi].min():
            continue
        if m.children and (m.radius >= n.radius or not n.children):
            pairs = [(c, n) for c in m.children]
            if m.own[1] > m.own[0]:
                pairs.append((Node(m.center, m.radius, *m.own, m.own, []), n))
        else:
            if n.own[1] > n.own[0]:
                visit(m.lo, m.hi, slice(*n.own))
            pairs = [(m, c) for c in n.children]
        stack.extend(sorted(((bound(*p), *p) for p in pairs), key=lambda t: t[0]))
    found = np.empty_like(score), np.empty_like(best)
    found[0][qt.order], found[1][qt.order] = score, best
    return found


def _placed(rows: DataFrame, centers: dict) -> DataFrame:
    """Each row's cell (the nearest centre's; -1: around the origin), its distance from the
    centre, and the cell whose centre it scores highest with."""
    shared = rows.sparkSession.sparkContext.broadcast(centers)

    def run(batches):
        for pdf in batches:
            for dim, whole in pdf.groupby("dim"):
                for at in range(0, len(whole), 2048):
                    g = whole.iloc[at : at + 2048]
                    v = np.stack(g["v"].to_list()).astype(np.float64).reshape(len(g), dim)
                    near, best, far = -1, -1, np.sqrt((v * v).sum(1))
                    if dim in shared.value:
                        names, c = shared.value[dim]
                        dots = v @ c.T
                        at_c = ((c * c).sum(1) - 2 * dots).argmin(1)
                        near, best, far = names[at_c], names[dots.argmax(1)], np.sqrt(((v - c[at_c]) ** 2).sum(1))
                    yield g.assign(cell=near, best=best, far=far)

    return rows.mapInPandas(run, "id long, v array<double>, q boolean, row long, dim int, cell int, best int, far double")


def _asked(queries: DataFrame, centers: dict, radius: dict[int, float]) -> DataFrame:
    """Each query with the cells that may hold a score of at least its bound ``low``."""
    shared = queries.sparkSession.sparkContext.broadcast((centers, radius))

    def run(batches):
        centers, radius = shared.value
        for pdf in batches:
            for dim, whole in pdf.groupby("dim"):
                names, c = centers.get(dim, (np.full(1, -1), np.zeros((1, dim))))
                r = np.array([radius.get(int(x), -1.0) for x in names])
                for at in range(0, len(whole), 2048):
                    g = whole.iloc[at : at + 2048]
                    v = np.stack(g["v"].to_list()).astype(np.float64).reshape(len(g), dim)
                    size = np.sqrt((v * v).sum(1))[:, None]
                    most = v @ c.T + size * r + 1e-9 * (1 + size) * (1 + np.sqrt((c * c).sum(1)) + r)
                    may = (most >= g["low"].fillna(-np.inf).to_numpy()[:, None]) & (r >= 0)
                    yield pd.DataFrame({"id": g["id"], "v": g["v"], "row": g["row"], "dim": g["dim"], "low": g["low"], "cells": [names[m].tolist() for m in may]})

    return queries.mapInPandas(run, "id long, v array<double>, row long, dim int, low double, cells array<int>")


def _met(data: DataFrame, asks: DataFrame, sizes: list[tuple[int, int, int]], k: int) -> DataFrame:
    """query, query_id, vec_id, score of the k best rows for each query and block of rows.
    ``sizes``: cell, blocks of its rows, blocks of its queries (a row per asked cell)."""
    blocks = F.broadcast(data.sparkSession.createDataFrame(sizes, "cell int, chunks long, groups long"))
    place = F.xxhash64("row")
    cols = ["dim", "cell", "chunk", "of", "id", "v", "row"]
    one = data.join(blocks, "cell").withColumns({"chunk": F.pmod(place, "chunks"), "of": F.explode(F.expr("sequence(0L, groups - 1)"))}).select(*cols, F.lit(False).alias("asks"), F.lit(None).cast("double").alias("low"))
    two = asks.join(blocks, "cell").withColumns({"of": F.pmod(place, "groups"), "chunk": F.explode(F.expr("sequence(0L, chunks - 1)"))}).select(*cols, F.lit(True).alias("asks"), "low")

    def search(pdf: pd.DataFrame) -> pd.DataFrame:
        asked = pdf["asks"].to_numpy()
        ids = pdf["id"].astype("Int64").fillna(LAST).to_numpy(np.int64)
        where = pdf["row"].to_numpy(np.int64)
        if not asked.any() or asked.all():
            return pd.DataFrame({"query": [], "query_id": [], "vec_id": [], "score": []}).astype("int64")
        v = np.stack(pdf["v"].to_list()).astype(np.float64).reshape(len(pdf), -1)
        low = pdf["low"].fillna(-np.inf).to_numpy(np.float64)[asked]
        score, best = dual_search(v[asked], where[asked], v[~asked], ids[~asked], where[~asked], k, low)
        hit = np.isfinite(score) & (score >= low[:, None])
        each = hit.sum(1)
        return pd.DataFrame({"query": np.repeat(where[asked], each), "query_id": np.repeat(ids[asked], each), "vec_id": best[hit], "score": score[hit].astype(np.int64)})

    return one.unionByName(two).groupBy("dim", "cell", "chunk", "of").applyInPandas(search, "query long, query_id long, vec_id long, score long")


def top_k(vectors: DataFrame, is_query: Column, k: int = 10, id_col: str = "vec_id", vec_col: str = "embedding", block_rows: int = 4096, cells: int = 1024) -> DataFrame:
    """query_id, rank, vec_id, score of the k best rows for each query row.
    ``vec_col`` holds integer vectors (array<bigint>); at most ``cells`` rows reach the driver."""
    rows = saved(
        vectors.select(F.col(id_col).cast("long").alias("id"), F.col(vec_col).cast("array<double>").alias("v"), F.coalesce(is_query, F.lit(False)).alias("q"))
        .filter(F.col("v").isNotNull())
        .withColumns({"row": F.monotonically_increasing_id(), "dim": F.size("v")})
    )
    total, longest = rows.agg(F.count("*"), F.max(F.aggregate("v", F.lit(0.0), lambda a, x: a + x * x))).first()
    if longest is not None and longest >= EXACT:
        raise ValueError(f"a squared vector length of {longest:.4g} is too large for exact scores (limit 2**53)")
    blocks = lambda n: max(1, -(-int(n) // block_rows))
    picked = rows.filter("dim > 0").orderBy(F.xxhash64("row"), "row").limit(min(cells, blocks(total))).select("dim", "v").toPandas()
    centers = {int(dim): (g.index.to_numpy(), np.stack(g["v"].to_list()).astype(np.float64)) for dim, g in picked.groupby("dim")}
    placed = saved(_placed(rows, centers))
    stats = placed.groupBy("cell").agg(F.count("*"), F.max("far")).collect()  # at most cells + 1 rows
    chunks, radius = {r[0]: blocks(r[1]) for r in stats}, {r[0]: r[2] * (1 + 1e-12) for r in stats}
    queries = placed.filter("q")

    asks = queries.groupBy("best").count().collect()
    first = placed.join(F.broadcast(rows.sparkSession.createDataFrame(list(chunks.items()), "cell int, chunks long")), "cell").filter(F.pmod(F.xxhash64("row"), "chunks") == 0).drop("chunks")
    seen = _met(first, queries.select("id", "v", "row", "dim", F.col("best").alias("cell"), F.lit(None).cast("double").alias("low")), [(r[0], 1, blocks(r[1])) for r in asks], k)
    lows = seen.groupBy("query").agg(F.min("score").cast("double").alias("low"), F.count("*").alias("n")).filter(F.col("n") >= k).select(F.col("query").alias("row"), "low")
    asked = saved(_asked(queries.join(lows, "row", "left").select("id", "v", "row", "dim", "low"), centers, radius))

    each = asked.withColumn("cell", F.explode("cells")).drop("cells")
    counts = each.groupBy("cell").count().collect()
    found = _met(placed, each, [(r[0], chunks[r[0]], blocks(r[1])) for r in counts], k)
    w = W.partitionBy("query").orderBy(F.col("score").desc(), "vec_id")
    null_last = F.when(F.col("vec_id") != int(LAST), F.col("vec_id"))
    return found.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k).select("query_id", F.col("rank").cast("int"), null_last.alias("vec_id"), "score")
