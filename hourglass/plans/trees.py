"""Fitted regression trees as a table of nodes, walked by array expressions.

One row a node: ``tree``, ``node`` (numbered over the whole model from 0), ``depth`` (0: a root),
``feature`` (its place among the model's features; -1 in a leaf), ``threshold`` (a row goes left
where its feature is at most this), ``left`` and ``right`` (nodes; -1 in a leaf), ``value`` (what a
leaf adds to the prediction, learning rate and tree weights included), ``cover`` (training rows in the node) and ``gain``.

To score rows the model becomes one row of arrays, broadcast and walked with ``aggregate()``: no
Python in the tasks, and a prediction may be a step of a larger expression (the recursive forecast).
That one row is bounded by ``MAX_NODES``; a larger model is refused.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from hourglass.operators.aggregates import attach_scalars
from hourglass.operators.guards import ContractError, check_feature_order, require_columns
from hourglass.session import checkpoint_dir, write_table

NODE_SCHEMA = ("tree int, node int, depth int, feature int, threshold double, left int, right int, "
               "value double, cover double, gain double")
_META = "name string, kind string, target string, features array<string>, base double, averaged boolean"
#: Nodes that one model may hold in the arrays of its one row (about 32 MB).
MAX_NODES = 1 << 20
#: The arrays of the one-row model, as columns.
PACKED = ["_t_feature", "_t_threshold", "_t_left", "_t_right", "_t_value", "_t_roots", "_t_steps"]


def walk_sql(x: str, root: str, steps: str = "_t_steps", feature: str = "_t_feature", threshold: str = "_t_threshold",
             left: str = "_t_left", right: str = "_t_right") -> str:
    """The leaf that a row with the feature array ``x`` reaches from node ``root``."""
    return (f"aggregate({steps}, {root}, (n, s) -> IF({left}[n] < 0, n, "
            f"IF({x}[{feature}[n]] <= {threshold}[n], {left}[n], {right}[n])))")


def sum_sql(x: str, base: float) -> str:
    """The prediction for the feature array ``x``; NULL where an entry is."""
    leaf = walk_sql(x, "r")
    return f"IF(exists({x}, v -> v IS NULL), NULL, aggregate(_t_roots, {base!r}D, (a, r) -> a + _t_value[{leaf}]))"


@dataclass
class TreeModel:
    """Trees with the ordered names of their features."""

    name: str
    features: list
    nodes: DataFrame
    base: float = 0.0
    target: str = "target_aqi"
    averaged: bool = False
    kind: str = "trees"

    def packed(self) -> DataFrame:
        """The model as one row of arrays, by node number."""
        s = self.nodes.agg(F.count(F.lit(1)).alias("n"), F.max("depth").alias("depth")).first()
        if (s["n"] or 0) > MAX_NODES:
            raise ContractError(f"the model has {s['n']} nodes; at most {MAX_NODES} are scored as one row")
        a = self.nodes.agg(F.sort_array(F.collect_list(F.struct("node", "feature", "threshold", "left", "right", "value", "depth"))).alias("a"))
        cols = [f"a.{c} AS _t_{c}" for c in ("feature", "threshold", "left", "right", "value")]
        return a.selectExpr(*cols, "transform(filter(a, x -> x.depth = 0), x -> x.node) AS _t_roots",
                            f"{'sequence(1, ' + str(s['depth']) + ')' if s['depth'] else 'array_repeat(1, 0)'} AS _t_steps")

    def predict(self, df: DataFrame, out: str = "prediction") -> DataFrame:
        """M5: score any frame carrying the feature columns (G1, G4 checked)."""
        require_columns(df, self.features, "model input")
        check_feature_order(self.features, [c for c in self.features if c in df.columns])
        x = "array(" + ", ".join(f"CAST(`{c}` AS DOUBLE)" for c in self.features) + ")"
        # The array is bound once a row (one-element transform), not built anew at each step of a walk.
        scored = f"transform(array({x}), x -> {sum_sql('x', self.base)})[0] AS `{out}`"
        return attach_scalars(df, self.packed()).selectExpr(*[f"`{c}`" for c in df.columns if c != out], scored)

    def importance(self) -> DataFrame:
        """M6: (feature, importance), shares of one.  Boosted trees: the mean gain of a feature's
        splits.  Averaged trees: the gain of its splits times their rows as a share of its tree's
        whole, averaged over the trees that split at all."""
        spark = self.nodes.sparkSession
        names = spark.createDataFrame(list(enumerate(self.features)), "_i int, name string")
        inner = self.nodes.filter("left >= 0")
        if self.averaged:
            by = inner.groupBy("tree", "feature").agg(F.sum(F.col("gain") * F.col("cover")).alias("_s"))
            share = F.try_divide(F.col("_s"), F.sum("_s").over(Window.partitionBy("tree")))
            gains = by.select("feature", share.alias("_s")).groupBy("feature").agg(F.sum("_s").alias("_g"))
        else:
            gains = inner.groupBy("feature").agg(F.avg("gain").alias("_g"))
        total = gains.agg(F.sum("_g").alias("_all"))
        each = attach_scalars(names.join(gains, names["_i"] == gains["feature"], "left").drop("feature"), total)
        return each.select(F.col("name").alias("feature"), F.coalesce(F.try_divide(F.col("_g"), F.col("_all")), F.lit(0.0)).alias("importance"))


def from_rows(spark: SparkSession, rows: Sequence[tuple], features: Sequence[str], base: float, name: str, target: str) -> TreeModel:
    return TreeModel(name, list(features), write_table(spark.createDataFrame(list(rows), NODE_SCHEMA)), float(base), target)


def from_ml(fitted, name: str | None = None) -> TreeModel:
    """The trees of a fitted Spark ML forest or boosted model, read from its saved form."""
    import uuid

    last = fitted.model.stages[-1]
    spark = SparkSession.getActiveSession()
    path = f"{checkpoint_dir(spark).rstrip('/')}/tables/{uuid.uuid4().hex}"
    last.write().save(path)
    # A forest averages its trees, a boosted model adds them by weight.
    weights = list(last.treeWeights)
    share = [w / sum(weights) if "RandomForest" in type(last).__name__ else w for w in weights]
    w = spark.createDataFrame(list(enumerate(float(v) for v in share)), "tree int, weight double")
    raw = spark.read.parquet(f"{path}/data").select(F.col("treeID").alias("tree"), "nodeData.*")
    sizes = raw.groupBy("tree").agg(F.count(F.lit(1)).alias("n"))  # one row a tree
    first = F.coalesce(F.sum("n").over(Window.orderBy("tree").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).cast("int")
    at = sizes.select("tree", first.alias("first"))
    up = raw.filter("leftChild >= 0").select("tree", F.col("id").alias("parent"), F.explode(F.array("leftChild", "rightChild")).alias("id"))
    inner = F.col("leftChild") >= 0
    child = lambda c: F.when(inner, F.col(c) + F.col("first")).otherwise(-1).cast("int")
    flat = raw.join(at, "tree").join(w, "tree").select(
        "tree", (F.col("id") + F.col("first")).cast("int").alias("node"), "id",
        F.when(inner, F.col("split.featureIndex")).otherwise(-1).cast("int").alias("feature"),
        F.when(inner, F.try_element_at("split.leftCategoriesOrThreshold", F.lit(1))).alias("threshold"),
        child("leftChild").alias("left"), child("rightChild").alias("right"),
        F.when(inner, 0.0).otherwise(F.col("prediction") * F.col("weight")).alias("value"),
        F.element_at("impurityStats", 1).cast("double").alias("cover"), F.when(inner, F.col("gain")).otherwise(0.0).alias("gain"))
    flat = write_table(flat)
    # Depths, one level of all trees a step; at most 31 levels.
    up = write_table(up)
    level = raw.filter("id = 0").select("tree", "id", F.lit(0).alias("depth"))
    done = level
    for d in range(1, max(_depth(t) for t in last.trees) + 1):
        level = write_table(level.select("tree", F.col("id").alias("parent")).join(up, ["tree", "parent"]).select("tree", "id", F.lit(d).alias("depth")))
        done = done.unionByName(level)
    cols = [c.split(" ")[0] for c in NODE_SCHEMA.split(", ")]
    nodes = write_table(flat.join(done, ["tree", "id"]).select(*cols))
    return TreeModel(name or fitted.name, list(fitted.features), nodes, 0.0, fitted.target, "RandomForest" in type(last).__name__)


def _depth(tree) -> int:
    return int(tree.depth)


def merge(models: Sequence[TreeModel], name: str) -> TreeModel:
    """One model that averages ``models`` (batches of one forest), each by its number of trees."""
    sizes = [m.nodes.agg(F.countDistinct("tree").alias("t"), F.count(F.lit(1)).alias("n")).first() for m in models]
    every = sum(s["t"] for s in sizes)
    out, trees, nodes, base = None, 0, 0, 0.0
    for m, s in zip(models, sizes, strict=True):
        move = lambda c: F.when(F.col(c) >= 0, F.col(c) + F.lit(nodes)).otherwise(F.col(c)).cast("int").alias(c)  # noqa: B023, E731
        part = m.nodes.select((F.col("tree") + F.lit(trees)).cast("int").alias("tree"), move("node"), "depth", "feature", "threshold", move("left"), move("right"),
                              (F.col("value") * F.lit(s["t"] / every)).alias("value"), "cover", "gain")
        out = part if out is None else out.unionByName(part)
        trees, nodes, base = trees + s["t"], nodes + s["n"], base + m.base * s["t"] / every
    return TreeModel(name, list(models[0].features), write_table(out), base, models[0].target, averaged=True)


# --------------------------------------------------------------------------- M18
def save_trees(m: TreeModel, path: str) -> None:
    """The nodes, then the description: a model without the latter was not wholly written."""
    spark = m.nodes.sparkSession
    m.nodes.write.mode("overwrite").parquet(f"{path}/nodes")
    meta = spark.createDataFrame([(m.name, m.kind, m.target, m.features, m.base, m.averaged)], _META)
    meta.coalesce(1).write.mode("overwrite").json(f"{path}/meta")


def saved_trees(spark: SparkSession, path: str) -> bool:
    """Whether a model was wholly written to ``path``."""
    done = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/meta/_SUCCESS")
    return bool(done.getFileSystem(spark._jsc.hadoopConfiguration()).exists(done))


def load_trees(spark: SparkSession, path: str) -> TreeModel:
    m = spark.read.schema(_META).json(f"{path}/meta").first()
    return TreeModel(m["name"], list(m["features"]), spark.read.schema(NODE_SCHEMA).parquet(f"{path}/nodes"), m["base"], m["target"], m["averaged"])
