"""Model selection end to end (M2-M5, M7, M8, A19, M18, M19): fit every candidate, rank
them on held-out rows, save the winner, record the runs and the alias, and load the
winner by its alias."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hourglass.plans import ledger as L
from hourglass.plans import training as TR
from hourglass.plans.training import FittedModel


def candidates(features: Sequence[str], target: str = "target_aqi", trees: int = 300, rounds: int = 500,
               max_depth: int = 30) -> dict[str, Callable[[DataFrame], FittedModel]]:
    """The three model families at the reference's sizes (smaller ones on request)."""
    return {
        "ridge": lambda d: TR.fit_ridge(d, features, target),
        "random_forest": lambda d: TR.fit_forest(d, features, target, trees=trees, max_depth=max_depth),
        "boosted_trees": lambda d: TR.fit_boosted(d, features, target, rounds=rounds),
    }


def select_model(split: DataFrame, fits: dict[str, Callable[[DataFrame], FittedModel]], path: str, by: str = "rmse",
                 target: str = "target_aqi", alias: str = "champion", version: int = 1) -> DataFrame:
    """Test metrics of the candidates with their ranks (M8).  ``split`` is a written table
    with a ``split`` column.  Under ``path``: models/<name>, runs and aliases."""
    spark = split.sparkSession
    train = split.filter("split = 'train'")
    rows = None
    for name, fit in fits.items():
        fitted = fit(train)
        TR.save_model(fitted, f"{path}/models/{name}")
        m = TR.evaluate_splits(fitted.predict(split), target).filter("split = 'test'").withColumn("model", F.lit(name))
        rows = m if rows is None else rows.unionByName(m)
    ranked = TR.compare_models(rows.select("model", "n", "mae", "rmse", "r2"), by)
    runs = ranked.select(
        F.md5(F.concat_ws(":", "model", F.lit(version))).alias("run_id"), "model", F.lit(version).alias("version"),
        F.lit(None).cast("string").alias("alias"), F.create_map(F.lit("split"), F.lit("test")).alias("params"),
        F.create_map(F.lit("mae"), F.col("mae"), F.lit("rmse"), F.col("rmse"), F.lit("r2"), F.col("r2")).alias("metrics"),
        F.create_map(F.lit("path"), F.concat(F.lit(f"{path}/models/"), F.col("model"))).alias("tags"))
    L.append_runs(runs, f"{path}/runs")
    L.record_alias(L.read_ledger(spark, f"{path}/runs"), f"{path}/aliases", by, alias)
    return L.read_ledger(spark, f"{path}/runs").select(
        "model", F.col("metrics")["mae"].alias("mae"), F.col("metrics")["rmse"].alias("rmse"), F.col("metrics")["r2"].alias("r2")).transform(
        lambda d: TR.compare_models(d, by))


def load_selected(spark, path: str, alias: str = "champion") -> FittedModel:
    """The saved model that holds ``alias``."""
    run = L.resolve_alias(L.read_ledger(spark, f"{path}/runs"), L.read_aliases(spark, f"{path}/aliases"), alias).first()
    return TR.load_model(spark, run["tags"]["path"])
