"""Scaling, model fit, scoring, split evaluation and model comparison
(M1-M8, M18) on Spark ML.

Fitting is distributed by Spark ML (normal equations / tree aggregation over
executors); only fitted parameters (70 coefficients, tree structures) come to
the driver.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import LinearRegression, RandomForestRegressor
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hourglass.operators.aggregates import attach_scalars, regression_metrics
from hourglass.operators.guards import check_feature_order, require_columns
from hourglass.operators.windows import rank_min
from hourglass.plans import boosting
from hourglass.plans.trees import TreeModel, from_ml, load_trees, merge, save_trees, saved_trees
from hourglass.session import materialize

FEATURES_VEC = "features_vec"


# --------------------------------------------------------------------------- M1
def fit_scaler(train: DataFrame, cols: Sequence[str]) -> DataFrame:
    """M1: one-row table of training means and population standard deviations
    (``mu_<c>``, ``sd_<c>``).  ML ``StandardScaler`` uses the sample std, which
    the reference does not."""
    aggs = []
    for c in cols:
        aggs += [F.avg(c).alias(f"mu_{c}"), F.stddev_pop(c).alias(f"sd_{c}")]
    return train.agg(*aggs)


def scale(df: DataFrame, stats: DataFrame, cols: Sequence[str], suffix: str = "") -> DataFrame:
    """M1: ``(x - mu) / sd`` with ``sd = 0`` treated as 1; the one-row stats
    table is broadcast (a proven size bound)."""
    j = attach_scalars(df, stats)
    out = {}
    for c in cols:
        sd = F.when(F.col(f"sd_{c}") == 0, F.lit(1.0)).otherwise(F.col(f"sd_{c}"))
        out[c + suffix] = (F.col(c) - F.col(f"mu_{c}")) / sd
    return j.withColumns(out).drop(*[f"{p}_{c}" for c in cols for p in ("mu", "sd")])


# --------------------------------------------------------------------------- models
@dataclass
class FittedModel:
    """A fitted model with its ordered feature names (G4) and, for linear
    models, the scaler it was trained behind."""

    name: str
    features: list
    model: PipelineModel
    kind: str
    scaler: DataFrame | None = None
    target: str = "target_aqi"

    def predict(self, df: DataFrame, out: str = "prediction") -> DataFrame:
        """M5: score any frame carrying the feature columns (G1, G4 checked)."""
        require_columns(df, self.features, "model input")
        check_feature_order(self.features, [c for c in self.features if c in df.columns])
        x = scale(df, self.scaler, self.features, "__s") if self.scaler is not None else df
        res = self.model.transform(x)
        drop = [c for c in res.columns if c.endswith("__s") or c == FEATURES_VEC]
        return res.withColumnRenamed("prediction", out).drop(*drop)

    def linear_terms(self, spark: SparkSession) -> tuple[float, dict]:
        """Intercept and per-feature coefficients on the *unscaled* inputs:
        ``y = b0 + sum(beta_c * x_c)``.  Driver-side arithmetic on 70 numbers."""
        if self.kind != "linear":
            raise ValueError("linear_terms needs a linear model")
        lr = self.model.stages[-1]
        coefs = list(lr.coefficients)
        st = self.scaler.first().asDict()
        b0 = float(lr.intercept)
        beta = {}
        for c, w in zip(self.features, coefs):
            sd = st[f"sd_{c}"] or 1.0
            beta[c] = w / sd
            b0 -= w * st[f"mu_{c}"] / sd
        return b0, beta


def _label_stats(train: DataFrame, target: str) -> tuple[int, float]:
    r = train.agg(F.count(target).alias("n"), F.stddev_pop(target).alias("sd")).first()
    return int(r["n"]), float(r["sd"] or 0.0)


def fit_ridge(train: DataFrame, features: Sequence[str], target: str = "target_aqi", alpha: float = 1.0,
              name: str = "ridge") -> FittedModel:
    """M2: ridge regression on M1-scaled features, equal to the closed form
    ``min |y - Xw - b|^2 + alpha |w|^2`` (``regParam = alpha * sd_pop(y) / n``,
    because Spark's normal solver scales the label by its std)."""
    features = list(features)
    train = materialize(train.select(*features, target))
    stats = materialize(fit_scaler(train, features))
    xs = scale(train, stats, features, "__s")
    n, sd = _label_stats(train, target)
    reg = alpha * sd / n if n else 0.0
    pipe = Pipeline(stages=[
        VectorAssembler(inputCols=[c + "__s" for c in features], outputCol=FEATURES_VEC),
        LinearRegression(featuresCol=FEATURES_VEC, labelCol=target, solver="normal", elasticNetParam=0.0,
                         standardization=False, regParam=reg, fitIntercept=True),
    ])
    return FittedModel(name, features, pipe.fit(xs), "linear", stats, target)


def fit_forest(train: DataFrame, features: Sequence[str], target: str = "target_aqi", trees: int = 300,
               max_depth: int = 30, seed: int = 42, name: str = "random_forest") -> FittedModel:
    """M3: random forest, sqrt feature subsets per split.  Spark's trees have at
    most 30 levels; a larger ``max_depth`` is refused, not cut."""
    if int(max_depth) > 30:
        raise ValueError("max_depth must be at most 30")
    train = materialize(train.select(*features, target))
    pipe = Pipeline(stages=[
        VectorAssembler(inputCols=list(features), outputCol=FEATURES_VEC),
        RandomForestRegressor(featuresCol=FEATURES_VEC, labelCol=target, numTrees=trees,
                              featureSubsetStrategy="sqrt", maxDepth=int(max_depth),
                              minInstancesPerNode=1, seed=seed),
    ])
    return FittedModel(name, list(features), pipe.fit(train), "tree", None, target)


def fit_forest_batches(train: DataFrame, features: Sequence[str], path: str, target: str = "target_aqi", trees: int = 300,
                       max_depth: int = 30, seed: int = 42, batch: int = 50, name: str = "random_forest") -> TreeModel:
    """M3: the forest in batches of ``batch`` trees, each with a seed of its own and saved under
    ``path`` as soon as it is fitted; a driver that starts again reads the batches that are
    there and fits the rest.  The batches become one model that averages all trees."""
    if trees < 1 or batch < 1:
        raise ValueError("trees and batch must be positive")
    spark = train.sparkSession
    train = materialize(train.select(*features, target))
    parts = []
    for i, first in enumerate(range(0, trees, batch)):
        size = min(batch, trees - first)
        at = f"{path}/batch-{i:04d}-{size}-{max_depth}-{seed}"
        if not saved_trees(spark, at):
            save_trees(from_ml(fit_forest(train, features, target, size, max_depth, seed + 7919 * i, name)), at)
        parts.append(load_trees(spark, at))
    return merge(parts, name)


def fit_boosted(train: DataFrame, features: Sequence[str], target: str = "target_aqi", rounds: int = 500,
                learning_rate: float = 0.05, max_depth: int = 6, min_child: int = 3, subsample: float = 0.8,
                colsample: float = 0.8, seed: int = 42, name: str = "boosted_trees", id_cols: Sequence[str] | None = None) -> TreeModel:
    """M4: gradient-boosted trees by histograms (``boosting.fit``), with the reference's
    parameters: columns and rows drawn per tree, an L2 penalty of 1 on leaf weights."""
    return boosting.fit(train, features, target, rounds, learning_rate, max_depth, min_child, subsample, colsample, seed=seed, name=name, id_cols=id_cols)[0]


def model_importance(spark: SparkSession, fm: FittedModel | TreeModel) -> DataFrame:
    """M6: (feature, importance) for tree models, |coefficient| on scaled
    inputs for linear ones.  One row per feature (bounded by the model)."""
    if fm.kind == "trees":
        return fm.importance()
    last = fm.model.stages[-1]
    vals = list(last.featureImportances.toArray()) if fm.kind == "tree" else [abs(v) for v in last.coefficients]
    return spark.createDataFrame([(f, float(v)) for f, v in zip(fm.features, vals)], "feature string, importance double")


# --------------------------------------------------------------------------- M7, M8
def evaluate_splits(scored: DataFrame, actual: str = "target_aqi", pred: str = "prediction",
                    split: str = "split", keys: Sequence[str] = ()) -> DataFrame:
    """M7: A12 per split (score once, group by split)."""
    return regression_metrics(scored, actual, pred, [*keys, split])


def compare_models(metrics: DataFrame, by: str = "rmse") -> DataFrame:
    """M8: rank rows of a (model, mae, rmse, r2) table, lowest ``by`` first.
    The table has one row per model, so the unpartitioned rank is tiny."""
    return metrics.withColumn("rank", rank_min(by).cast("int"))


# --------------------------------------------------------------------------- M18
def save_model(fm: FittedModel | TreeModel, path: str) -> None:
    """Persist the pipeline (and scaler, for linear models) with Spark ML; trees as their table of nodes."""
    if fm.kind == "trees":
        save_trees(fm, path)
        return
    fm.model.write().overwrite().save(f"{path}/pipeline")
    if fm.scaler is not None:
        fm.scaler.write.mode("overwrite").parquet(f"{path}/scaler")
    spark = SparkSession.getActiveSession()
    spark.createDataFrame([(fm.name, fm.kind, fm.target, fm.features)],
                          "name string, kind string, target string, features array<string>") \
        .write.mode("overwrite").json(f"{path}/meta")


def load_model(spark: SparkSession, path: str) -> FittedModel | TreeModel:
    meta = spark.read.json(f"{path}/meta").first()
    if meta["kind"] == "trees":
        return load_trees(spark, path)
    scaler = spark.read.parquet(f"{path}/scaler") if meta["kind"] == "linear" else None
    return FittedModel(meta["name"], list(meta["features"]), PipelineModel.load(f"{path}/pipeline"), meta["kind"],
                       scaler, meta["target"])
