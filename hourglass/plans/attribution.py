"""Feature attribution.

A linear model's exact additive attribution is ``beta_c * (x_c - mean_train_c)``: a columnar
expression computed for every row, unpivoted to a long table.

Trees get Shapley values of the game in which a coalition's features are known and the others
are averaged over the training rows along the tree (by cover).  A leaf's part of that game is a product:
for each feature on its path, 1 or 0 (known: the row meets all of the feature's conditions) or z (unknown:
the share of rows that pass them).  The Shapley value of feature j in such a product is

    value * (o_j - z_j) * integral over t in 0..1 of the product over the others k of (o_k * t + z_k * (1 - t)),

a polynomial of t, so Gauss points integrate it exactly: half as many as there are features on the path.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hourglass.operators.aggregates import attach_scalars
from hourglass.operators.ordering import top_k_per_group
from hourglass.plans.trees import TreeModel
from hourglass.session import write_table


def train_means(train: DataFrame, features: Sequence[str]) -> DataFrame:
    """One-row table of training means (``mu_<c>``)."""
    return train.agg(*[F.avg(F.col(c).cast("double")).alias(f"mu_{c}") for c in features])


def linear_attribution(rows: DataFrame, train: DataFrame, beta: dict, features: Sequence[str],
                       id_cols: Sequence[str]) -> DataFrame:
    """M9: long table (id_cols, feature, feature_value, contribution).  The
    contributions of a row sum to ``prediction - mean prediction on train``."""
    j = attach_scalars(rows.select(*id_cols, *features), train_means(train, features))
    items = [F.struct(F.lit(c).alias("feature"), F.col(c).cast("double").alias("feature_value"),
                      (F.lit(float(beta.get(c, 0.0))) * (F.col(c).cast("double") - F.col(f"mu_{c}"))).alias("contribution"))
             for c in features]
    return j.select(*id_cols, F.explode(F.array(*items)).alias("_a")).select(*id_cols, "_a.*")


def linear_importance(rows: DataFrame, train: DataFrame, beta: dict, features: Sequence[str]) -> DataFrame:
    """A17 of M9 without the long table: feature, mean_abs.  One aggregate a feature over the
    wide rows; only its one row is unpivoted."""
    j = attach_scalars(rows.select(*features), train_means(train, features))
    wide = j.agg(*[F.avg(F.abs(F.lit(float(beta.get(c, 0.0))) * (F.col(c).cast("double") - F.col(f"mu_{c}")))).alias(c) for c in features])
    items = [F.struct(F.lit(c).alias("feature"), F.col(c).alias("mean_abs")) for c in features]
    return wide.select(F.inline(F.array(*items)))


def local_explanation(row: DataFrame, train: DataFrame, beta: dict, features: Sequence[str],
                      keys: Sequence[str], ts: str, k: int = 15) -> DataFrame:
    """For the chosen row(s), value, contribution and its absolute value,
    the ``k`` largest by absolute contribution (ties by feature name)."""
    long = linear_attribution(row, train, beta, features, [*keys, ts])
    long = long.withColumn("abs_contribution", F.abs("contribution"))
    return top_k_per_group(long, list(keys), F.col("abs_contribution").desc(), k, ["feature"])


# --------------------------------------------------------------------------- M9 (trees)
def leaf_paths(model: TreeModel) -> DataFrame:
    """(tree, leaf, value, feature, lo, hi, z): the conditions lo < x <= hi that a path to a leaf sets
    on a feature, and the share z of a node's rows that pass them, multiplied along the path.
    One join of the node table to itself a level; a leaf that is its tree's root has no row."""
    nodes = model.nodes
    inner = nodes.filter("left >= 0").select("node", "feature", "threshold", F.col("cover").alias("whole"), F.explode(F.array(
        F.struct(F.col("left").alias("child"), F.lit(True).alias("goes_left")), F.struct(F.col("right").alias("child"), F.lit(False).alias("goes_left")))).alias("c"))
    lo = F.when(F.col("goes_left"), F.lit(float("-inf"))).otherwise(F.col("threshold"))
    hi = F.when(F.col("goes_left"), F.col("threshold")).otherwise(F.lit(float("inf")))
    below = nodes.select(F.col("node").alias("child"), F.col("cover").alias("part"), F.col("left").alias("next"), "value", "tree", "depth")
    steps = write_table(inner.select("node", "feature", "threshold", "whole", "c.*").join(below, "child").select(
        "tree", "depth", "node", "child", "next", "value", F.struct("feature", lo.alias("lo"), hi.alias("hi"), (F.col("part") / F.col("whole")).alias("z")).alias("s")))
    deepest = steps.agg(F.max("depth")).first()[0] or 0
    front = steps.filter("depth = 1").select("tree", "child", "next", "value", F.array("s").alias("path"))
    leaves = front.filter("next < 0")
    for d in range(2, deepest + 1):
        on = steps.filter(F.col("depth") == d).select("node", F.col("child").alias("to"), F.col("next").alias("after"), F.col("value").alias("v"), "s")
        front = front.filter("next >= 0").join(on, front["child"] == on["node"]).select("tree", F.col("to").alias("child"), F.col("after").alias("next"), F.col("v").alias("value"), F.concat("path", F.array("s")).alias("path"))
        front = write_table(front)
        leaves = leaves.unionByName(front.filter("next < 0"))
    each = leaves.select("tree", F.col("child").alias("leaf"), "value", F.explode("path").alias("s")).select("tree", "leaf", "value", "s.*")
    return each.groupBy("tree", "leaf", "value", "feature").agg(F.max("lo").alias("lo"), F.min("hi").alias("hi"), F.product("z").alias("z"))


def expected_value(model: TreeModel) -> float:
    """The mean prediction by cover: what the contributions of a row are added to."""
    paths = leaf_paths(model).groupBy("tree", "leaf", "value").agg(F.product("z").alias("p")).agg(F.sum(F.col("value") * F.col("p"))).first()[0]
    roots = model.nodes.filter("depth = 0 and left < 0").agg(F.sum("value")).first()[0]
    return model.base + (paths or 0.0) + (roots or 0.0)


def tree_attribution(rows: DataFrame, model: TreeModel, id_cols: Sequence[str]) -> DataFrame:
    """M9 for trees: long table (id_cols, feature, feature_value, contribution), a row for every feature.
    A row's contributions add up to its prediction less ``expected_value``; they are NULL where
    a feature is.  Rows that repeat id_cols add up, so those must tell rows apart.

    Every row meets every leaf as an expression over the broadcast paths (bounded like the model);
    contributions are added up by row and feature before they are shuffled."""
    paths = leaf_paths(model).groupBy("tree", "leaf", "value").agg(F.sort_array(F.collect_list(F.struct("feature", "lo", "hi", "z"))).alias("c"))
    paths = write_table(paths.select("value", "c"))
    longest = paths.agg(F.max(F.size("c"))).first()[0] or 1
    at, weight = np.polynomial.legendre.leggauss(-(-longest // 2))
    points = "array(" + ", ".join(f"named_struct('t', {(t + 1) / 2!r}D, 'w', {w / 2!r}D)" for t, w in zip(at.tolist(), weight.tolist(), strict=True)) + ")"
    x = "array(" + ", ".join(f"CAST(`{c}` AS DOUBLE)" for c in model.features) + ")"
    ids = [f"`{c}`" for c in id_cols]
    base = rows.selectExpr(*ids, f"{x} AS _x")
    whole = base.filter("NOT exists(_x, v -> v IS NULL)")
    met = attach_scalars(whole, paths.agg(F.collect_list(F.struct("value", "c")).alias("_p"))).selectExpr(*ids, "_x", "inline(_p) AS (v, c)")
    # o: 1 where the row meets the feature's conditions; a: the product at each Gauss point
    met = met.selectExpr(*ids, "v", "transform(c, k -> named_struct('f', k.feature, 'z', k.z, 'o', IF(_x[k.feature] > k.lo AND _x[k.feature] <= k.hi, 1D, 0D))) AS c")
    a = f"transform({points}, p -> named_struct('t', p.t, 'a', p.w * aggregate(c, 1D, (s, k) -> s * (k.o * p.t + k.z * (1D - p.t)))))"
    phi = "v * (k.o - k.z) * aggregate(a, 0D, (s, p) -> s + p.a / (k.o * p.t + k.z * (1D - p.t)))"
    each = met.selectExpr(*ids, "v", "c", f"{a} AS a").selectExpr(*ids, f"inline(transform(c, k -> named_struct('f', k.f, 'phi', {phi})))")
    sums = each.groupBy(*id_cols, "f").agg(F.sum("phi").alias("_phi"))
    names = F.array(*[F.lit(c) for c in model.features])
    long = base.select(*id_cols, F.posexplode("_x").alias("f", "feature_value"), F.exists("_x", lambda v: v.isNull()).alias("_null"))
    on = [F.col(f"l.`{c}`").eqNullSafe(F.col(f"s.`{c}`")) for c in [*id_cols, "f"]]
    contribution = F.when(~F.col("_null"), F.coalesce("_phi", F.lit(0.0)))
    return long.alias("l").join(sums.alias("s"), on, "left").select(
        *[F.col(f"l.`{c}`") for c in id_cols], F.element_at(names, F.col("l.f") + 1).alias("feature"), "feature_value", contribution.alias("contribution"))
