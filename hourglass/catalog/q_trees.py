"""Trees in use (M3, M4, M6, M9): what can be stated of fitted trees without their values.

The models are fitted here on the training rows of the hourly features; the sizes are cut for these
entries (see the README's figures), the functions default to the full ones."""

from __future__ import annotations

from pyspark.sql import functions as F

from hourglass.catalog import register
from hourglass.catalog.common import KEYS, TS, rounded
from hourglass.catalog.q_files import _path
from hourglass.catalog.q_model import _SPLIT, FEATS, _split
from hourglass.operators import ordering as O
from hourglass.operators.aggregates import attach_scalars
from hourglass.plans import attribution as AT
from hourglass.plans import boosting
from hourglass.plans import training as TR

_ROUNDS = 10


@register("boosted_training", f"WITH {_SPLIT}\nSELECT CAST({_ROUNDS} AS BIGINT) AS trees, count(*) AS rows, true AS error_falls, true AS same_seed_same_trees, "
                              "true AS leaves_hold_all_drawn_rows, true AS children_hold_three_rows FROM spl WHERE split = 'train'")
def q_boosted_training(spark, sf):
    """M4: ten trees by gradient histograms.  The training error falls with every five trees; a second
    fit with the same seed gives the same first two trees; a tree's leaves hold the rows its root does."""
    train = _split(spark, sf).filter("split = 'train'")
    model, errors = boosting.fit(train, FEATS, rounds=_ROUNDS, id_cols=[*KEYS, TS])
    again, _ = boosting.fit(train, FEATS, rounds=2, id_cols=[*KEYS, TS])
    cols = ["node", "feature", "threshold", "left", "right", "value", "cover"]
    first = model.nodes.filter("tree < 2").select(cols)
    differ = first.exceptAll(again.nodes.select(cols)).unionByName(again.nodes.select(cols).exceptAll(first)).agg(F.count(F.lit(1)).alias("_differ"))
    sums = model.nodes.groupBy("tree").agg(F.sum(F.when(F.col("left") < 0, F.col("cover"))).alias("leaves"), F.max(F.when(F.col("depth") == 0, F.col("cover"))).alias("root"),
                                           F.min(F.when(F.col("depth") > 0, F.col("cover"))).alias("least"))
    out = sums.agg(F.count(F.lit(1)).alias("trees"), F.bool_and(F.col("leaves") == F.col("root")).alias("leaves_hold_all_drawn_rows"),
                   F.coalesce(F.min("least") >= 3, F.lit(True)).alias("children_hold_three_rows"))
    out = attach_scalars(attach_scalars(out, differ), train.agg(F.count("target_aqi").alias("rows")))
    falls = all(a > b for a, b in zip(errors[:-1], errors[1:], strict=True))
    return out.select("trees", "rows", F.lit(falls).alias("error_falls"), (F.col("_differ") == 0).alias("same_seed_same_trees"), "leaves_hold_all_drawn_rows", "children_hold_three_rows")


@register("tree_attribution", f"WITH {_SPLIT},\ns AS (SELECT location_id, timestamp FROM spl WHERE split = 'test' "
                              "ORDER BY md5(concat_ws(':', location_id, CAST(timestamp AS VARCHAR), '42')), location_id, timestamp LIMIT 500)\n"
                              f"SELECT location_id, timestamp, CAST({len(FEATS)} AS BIGINT) AS features, true AS adds_up FROM s")
def q_tree_attribution(spark, sf):
    """M9 for trees: Shapley values of boosted trees on the 500 test rows of O5's sample; every row's
    contributions and the expected value add up to its prediction."""
    split = _split(spark, sf)
    model = TR.fit_boosted(split.filter("split = 'train'"), FEATS, rounds=_ROUNDS, id_cols=[*KEYS, TS])
    rows = O.seeded_sample(split.filter("split = 'test'").select(*KEYS, TS, *FEATS), [*KEYS, TS], 500, 42)
    base = AT.expected_value(model)
    sums = AT.tree_attribution(rows, model, [*KEYS, TS]).groupBy(*KEYS, TS).agg(F.count("contribution").alias("features"), F.sum("contribution").alias("_s"))
    both = model.predict(rows, "_p").select(*KEYS, TS, "_p").join(sums, [*KEYS, TS])
    return both.select(*KEYS, TS, "features", (F.abs(F.col("_s") + F.lit(base) - F.col("_p")) < 1e-6).alias("adds_up"))


@register("tree_importance", None)
def q_tree_importance(spark, sf):
    """M9 + A17: the 20 features with the largest mean absolute contribution to boosted trees on O5's sample."""
    split = _split(spark, sf)
    model = TR.fit_boosted(split.filter("split = 'train'"), FEATS, rounds=_ROUNDS, id_cols=[*KEYS, TS])
    rows = O.seeded_sample(split.filter("split = 'test'").select(*KEYS, TS, *FEATS), [*KEYS, TS], 500, 42)
    long = AT.tree_attribution(rows, model, [*KEYS, TS]).groupBy("feature").agg(F.avg(F.abs("contribution")).alias("importance"))
    return rounded(O.top_k(long, "importance", 20, "feature"))


@register("forest_batches", f"SELECT CAST(12 AS BIGINT) AS trees, CAST(3 AS BIGINT) AS batches, CAST({len(FEATS)} AS BIGINT) AS features, true AS importance_is_the_batches_mean, "
                            "CAST(0 AS BIGINT) AS refitted, CAST(1 AS DOUBLE) AS importance")
def q_forest_batches(spark, sf):
    """M3 + M6: a forest in three saved batches of four trees.  Its importances are the mean of the
    batches'; a second run reads all batches back and fits none."""
    from hourglass.plans import trees as T
    from hourglass.sources.claims import names

    train = _split(spark, sf).filter("split = 'train'")
    path = _path(spark, "forest")
    fit = lambda: TR.fit_forest_batches(train, FEATS, path, trees=12, max_depth=12, batch=4)
    whole = fit()
    saved = {n: names(spark, f"{path}/{n}/nodes") for n in names(spark, path)}
    fit()
    refitted = sum(names(spark, f"{path}/{n}/nodes") != files for n, files in saved.items())
    parts = None
    for n in saved:
        one = T.load_trees(spark, f"{path}/{n}").importance().withColumnRenamed("importance", "_b")
        parts = one if parts is None else parts.unionByName(one)
    mean = parts.groupBy("feature").agg(F.avg("_b").alias("_b"))
    both = whole.importance().join(mean, "feature").agg(
        F.count(F.lit(1)).alias("features"), F.bool_and(F.abs(F.col("importance") - F.col("_b")) < 1e-9).alias("importance_is_the_batches_mean"), F.sum("importance").alias("importance"))
    out = attach_scalars(whole.nodes.agg(F.countDistinct("tree").alias("trees")), both)
    return rounded(out.select("trees", F.lit(len(saved)).cast("long").alias("batches"), "features", "importance_is_the_batches_mean", F.lit(refitted).cast("long").alias("refitted"), "importance"))
