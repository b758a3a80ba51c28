"""Boosted regression trees by gradient histograms (M4).

Second-order boosting of squared error: a row's gradient is prediction - target, its second
derivative 1.  A feature is cut into at most ``bins`` intervals at its quantiles, once.  A tree grows
level by level; each level is one aggregate over the binned rows: the gradients and row counts of
every (node, feature, interval), added up before the shuffle, then running sums along a feature's
intervals and the best cut.  What reaches the driver is one row an open node and feature.

* A split's gain is half of GL^2/(HL+l2) + GR^2/(HR+l2) - G^2/(H+l2); children hold at least
  ``min_child`` rows; ties go to the first feature, then to the lowest cut.
* A leaf adds -learning_rate * G / (H + l2).  The base is the target's mean.
* Features are drawn per tree, rows per tree by a hash of their ``id_cols`` (all features and the
  target by default: rows that agree in them are drawn together).
* Gradients are rounded to a binary fraction and added as integers, so a sum, and with it the
  model, does not depend on the order of the rows; the same seed gives the same trees.

Predictions so far are written to the shared folder every ``write_every`` trees; between those the new
trees are walked by array expressions.  Rows without a target are left out; a NULL feature fails the fit.
"""

from __future__ import annotations

import math
import random
from collections.abc import Sequence

import numpy as np
from pyspark.ml.feature import Bucketizer
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from hourglass.operators.guards import ContractError
from hourglass.plans.trees import TreeModel, from_rows, walk_sql
from hourglass.session import write_table

#: Rank error of a quantile is 1 / ACCURACY of the rows; cuts are exact up to as many rows.
ACCURACY = 10_000
MIN_GAIN = 1e-6


def cut_points(train: DataFrame, features: Sequence[str], bins: int = 256) -> list[list[float]]:
    """Rising cuts of each feature: a row lies in the interval whose number is the count of cuts at or below it."""
    probs = F.array(*[F.lit(i / bins) for i in range(1, bins)])
    out = []
    for at in range(0, len(features), 16):  # 16 sketches an aggregate
        part = features[at : at + 16]
        row = train.agg(*[F.percentile_approx(F.col(c).cast("double"), probs, F.lit(ACCURACY)).alias(f"q{i}") for i, c in enumerate(part)],
                        *[F.min(F.col(c).cast("double")).alias(f"m{i}") for i, c in enumerate(part)]).first()
        for i in range(len(part)):
            out.append([v for v in sorted(set(row[f"q{i}"] or [])) if v > row[f"m{i}"]])
    return out


def binned(train: DataFrame, features: Sequence[str], target: str, cuts: Sequence[Sequence[float]], id_cols: Sequence[str] | None) -> DataFrame:
    """_h (hash of a row's id), _y, _b (interval of each feature)."""
    cols = list(id_cols or [*features, target])
    x = train.filter(F.col(target).isNotNull()).select(
        F.xxhash64(*cols).alias("_h"), F.col(target).cast("double").alias("_y"), *[F.col(c).cast("double").alias(f"_x{i}") for i, c in enumerate(features)])
    some = [i for i, c in enumerate(cuts) if c]
    if some:
        x = Bucketizer(splitsArray=[[-math.inf, *cuts[i], math.inf] for i in some], inputCols=[f"_x{i}" for i in some],
                       outputCols=[f"_b{i}" for i in some], handleInvalid="error").transform(x)
    b = [F.col(f"_b{i}").cast("int") if c else F.lit(0) for i, c in enumerate(cuts)]
    return x.select("_h", "_y", F.array(*b).alias("_b"))


def _ints(values) -> str:
    return "array(" + ", ".join(str(int(v)) for v in values) + ")" if len(values) else "CAST(array() AS array<int>)"


class _Tree:
    """A growing tree: parallel lists by node."""

    def __init__(self):
        self.depth, self.feature, self.cut, self.left, self.right = [0], [-1], [0], [-1], [-1]
        self.sums, self.gain = [(0, 0)], [0.0]

    def split(self, node: int, feature: int, cut: int, gain: float, left: tuple, right: tuple) -> tuple[int, int]:
        a = len(self.depth)
        self.feature[node], self.cut[node], self.gain[node], self.left[node], self.right[node] = feature, cut, gain, a, a + 1
        for s in (left, right):
            for field, value in ((self.depth, self.depth[node] + 1), (self.feature, -1), (self.cut, 0), (self.left, -1), (self.right, -1), (self.sums, s), (self.gain, 0.0)):
                field.append(value)
        return a, a + 1

    def leaf_sql(self) -> str:
        """The leaf of a row by its intervals."""
        steps = _ints(range(max(self.depth)))
        return walk_sql("_b", "0", steps, _ints(self.feature), _ints(self.cut), _ints(self.left), _ints(self.right))


def _flags(count: int, which: Sequence[int]) -> str:
    on = set(which)
    return "array(" + ", ".join("true" if i in on else "false" for i in range(count)) + ")"


def _level(rows: DataFrame, tree: _Tree, open_nodes: Sequence[int], drawn: Sequence[int], count: int, l2: float, min_child: int, unit: float) -> dict:
    """By open node: its sums, and the best split's gain, feature, cut and left sums.  ``count``: all features."""
    placed = rows.selectExpr("_g", "_b", f"{tree.leaf_sql()} AS _n").filter(f"{_flags(len(tree.depth), open_nodes)}[_n]")
    each = placed.selectExpr("_n", "_g", "posexplode(_b) AS (f, b)").filter(f"{_flags(count, drawn)}[f]")
    hist = each.groupBy("_n", "f", "b").agg(F.sum("_g").alias("g"), F.count(F.lit(1)).alias("h"))
    along = Window.partitionBy("_n", "f").orderBy("b").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    whole = Window.partitionBy("_n", "f")
    run = hist.select("_n", "f", "b", F.sum("g").over(along).alias("gl"), F.sum("h").over(along).alias("hl"), F.sum("g").over(whole).alias("ga"), F.sum("h").over(whole).alias("ha"))
    term = lambda g, h: f"(({g} * {unit!r}D) * ({g} * {unit!r}D) / ({h} + {l2!r}D))"
    ok = f"hl >= {int(min_child)} AND ha - hl >= {int(min_child)}"
    gain = f"IF({ok}, 0.5D * ({term('gl', 'hl')} + {term('(ga - gl)', '(ha - hl)')} - {term('ga', 'ha')}), -1D)"
    best = run.selectExpr("_n", "f", "ga", "ha", f"named_struct('gain', {gain}, 'b', -b, 'gl', gl, 'hl', hl) AS s")
    out: dict = {}
    # one row an open node and drawn feature
    for r in sorted(best.groupBy("_n", "f").agg(F.max("s").alias("s"), F.first("ga").alias("ga"), F.first("ha").alias("ha")).collect(), key=lambda r: (r["_n"], r["f"])):
        if r["_n"] not in out or r["s"]["gain"] > out[r["_n"]]["s"]["gain"]:
            out[r["_n"]] = r
    return out


def _fitting_session(spark: SparkSession) -> SparkSession:
    """A sibling session for the levels' aggregates.  Their shuffles hold one row a node, feature and
    interval, a size that the model's parameters bound whatever the data, so their partitions are
    set by it and planning anew between stages (adaptive execution) would only take time."""
    s = spark.newSession()
    s.conf.set("spark.sql.session.timeZone", spark.conf.get("spark.sql.session.timeZone"))
    s.conf.set("spark.sql.adaptive.enabled", "false")
    return s


def _partitions(open_nodes: int, drawn: int, bins: int, rows: int) -> int:
    """Shuffle partitions for a level: one per 2^16 sums."""
    return min(64, max(1, -(-min(open_nodes * bins, rows) * drawn // (1 << 16))))


def drawn_features(count: int, share: float, seed: int, tree: int) -> list[int]:
    """The features that a tree may split on."""
    k = max(1, int(share * count))
    return sorted(random.Random(f"{seed}:{tree}").sample(range(count), k))


def drawn_rows(share: float, seed: int, tree: int) -> str:
    """The condition that a row (_h) is drawn for a tree."""
    return "true" if share >= 1 else f"pmod(xxhash64(_h, {int(seed)}, {int(tree)}), 1000000) < {int(share * 1_000_000)}"


def fit(train: DataFrame, features: Sequence[str], target: str = "target_aqi", rounds: int = 500, learning_rate: float = 0.05, max_depth: int = 6,
        min_child: int = 3, subsample: float = 0.8, colsample: float = 0.8, l2: float = 1.0, bins: int = 256, seed: int = 42, name: str = "boosted_trees",
        id_cols: Sequence[str] | None = None, write_every: int = 5) -> tuple[TreeModel, list[float]]:
    """The model, and the training error (mean squared) at the start and after each ``write_every`` trees."""
    features = list(features)
    holes = train.agg(*[F.count_if(F.col(c).isNull() | F.isnan(F.col(c).cast("double"))).alias(c) for c in features]).first().asDict()
    if any(holes.values()):
        raise ContractError(f"NULL features in the training rows: {[c for c, n in holes.items() if n]}")
    cuts = cut_points(train, features, bins)
    rows = write_table(binned(train, features, target, cuts, id_cols), _fitting_session(train.sparkSession))
    s = rows.agg(F.count(F.lit(1)).alias("n"), F.avg(F.col("_y").cast("decimal(38,12)")).alias("m"), F.min("_y").alias("lo"), F.max("_y").alias("hi")).first()
    if not s["n"]:
        raise ContractError("no training rows")
    base = float(s["m"])
    # Gradients as integers: as many bits as n of the largest leave below 2**62, 40 at most.
    reach = max(s["hi"] - s["lo"], 1e-300) * 4
    bits = min(40, 61 - math.ceil(math.log2(s["n"] + 1)))
    unit = 2.0 ** (math.ceil(math.log2(reach)) - bits)
    rows = write_table(rows.withColumn("_m", F.lit(base)))
    error = lambda t: float(t.agg(F.avg((F.col("_m") - F.col("_y")) ** 2)).first()[0])
    losses, out, pending, first = [error(rows)], [], [], 0
    for t in range(rounds):
        now = " + ".join(["_m", *[f"{values}[{leaf}]" for leaf, values in pending]])
        state = rows.filter(drawn_rows(subsample, seed, t)).selectExpr("_b", f"CAST(rint(({now} - _y) / {unit!r}D) AS BIGINT) AS _g")
        tree, open_nodes = _Tree(), [0]
        drawn = drawn_features(len(features), colsample, seed, t)
        for _ in range(max_depth):
            if not open_nodes:
                break
            rows.sparkSession.conf.set("spark.sql.shuffle.partitions", str(_partitions(len(open_nodes), len(drawn), bins, s["n"])))
            found, open_nodes = _level(state, tree, open_nodes, drawn, len(features), l2, min_child, unit), []
            for node, r in sorted(found.items()):
                b = r["s"]
                if node == 0:
                    tree.sums[0] = (r["ga"], r["ha"])
                if b["gain"] > MIN_GAIN:
                    left, right = (b["gl"], b["hl"]), (r["ga"] - b["gl"], r["ha"] - b["hl"])
                    open_nodes += tree.split(node, r["f"], -b["b"], b["gain"], left, right)
        values = [-learning_rate * (g * unit) / (h + l2) if f < 0 else 0.0 for (g, h), f in zip(tree.sums, tree.feature, strict=True)]
        for i, f in enumerate(tree.feature):
            inner = f >= 0
            # a row is at or below a cut's interval where it is less than the cut: at most the double before it
            threshold = float(np.nextafter(cuts[f][tree.cut[i]], -math.inf)) if inner else None
            out.append((t, first + i, tree.depth[i], f, threshold, first + tree.left[i] if inner else -1, first + tree.right[i] if inner else -1,
                        values[i], float(tree.sums[i][1]), tree.gain[i]))
        first += len(tree.depth)
        pending.append((tree.leaf_sql(), "array(" + ", ".join(f"{v!r}D" for v in values) + ")"))
        if len(pending) >= write_every or t == rounds - 1:
            now = " + ".join(["_m", *[f"{v}[{leaf}]" for leaf, v in pending]])
            rows, pending = write_table(rows.selectExpr("_h", "_y", "_b", f"{now} AS _m")), []
            losses.append(error(rows))
    return from_rows(train.sparkSession, out, features, base, name, target), losses
