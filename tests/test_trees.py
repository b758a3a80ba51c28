"""Trees as tables: boosting against a plain booster, scoring against Spark ML, the forecast fold
against hour-by-hour steps, attributions against all coalitions, forests in batches."""

import itertools
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from hourglass.operators.guards import ContractError
from hourglass.plans import attribution as AT
from hourglass.plans import boosting
from hourglass.plans import forecast as FC
from hourglass.plans import training as TR
from hourglass.plans import trees as T
from hourglass.plans.features import build_features
from hourglass.schema import DEFAULT_SPEC
from hourglass.sources.events import raw_hourly_from_dir
from table_dirs import SF0001

FEATURES = ["a", "b", "c", "d", "e"]


@pytest.fixture(scope="module")
def table(spark):
    r = np.random.default_rng(11)
    x = np.column_stack([r.normal(size=2000), r.integers(0, 6, 2000), r.uniform(size=2000).round(2), r.normal(size=2000), np.ones(2000)])
    y = 3 * np.sin(2 * x[:, 0]) + x[:, 1] * (x[:, 2] > 0.4) + 0.2 * r.normal(size=2000)
    rows = [(i, *map(float, v), float(t)) for i, (v, t) in enumerate(zip(x, y))]
    return spark.createDataFrame(rows, "id long, a double, b double, c double, d double, e double, y double"), x, y


def plain_booster(x, y, cuts, drawn_rows, drawn_cols, rounds, lr, depth, min_child, l2, unit):
    """The same boosting, row by row: predictions, and (feature, cut) of all splits in order."""
    m = np.full(len(y), y.mean())
    b = np.column_stack([np.searchsorted(np.array(c), x[:, j], side="right") for j, c in enumerate(cuts)])
    splits = []
    for t in range(rounds):
        g = np.rint((m - y) / unit)
        place, level = np.zeros(len(y), int), [0]
        nodes = {0: None}
        for _ in range(depth):
            nxt = []
            for n in level:
                rows = (place == n) & drawn_rows[t]
                G, H = g[rows].sum() * unit, rows.sum()
                best = (0.0, None)
                for f in drawn_cols[t]:
                    for cut in range(len(cuts[f])):
                        left = rows & (b[:, f] <= cut)
                        if not (left.sum() >= min_child and H - left.sum() >= min_child) or not (b[rows, f] == cut).any():
                            continue
                        gl, hl = g[left].sum() * unit, left.sum()
                        gain = 0.5 * (gl * gl / (hl + l2) + (G - gl) ** 2 / (H - hl + l2) - G * G / (H + l2))
                        if gain > best[0] + 1e-9:
                            best = (gain, (f, cut))
                if best[1] and best[0] > 1e-6:
                    f, cut = best[1]
                    k = len(nodes)
                    nodes[n], nodes[k], nodes[k + 1] = (f, cut, k, k + 1), None, None
                    splits.append((t, f, cut))
                    here = place == n
                    place[here & (b[:, f] <= cut)], place[here & (b[:, f] > cut)] = k, k + 1
                    nxt += [k, k + 1]
            level = nxt
        for n, s in nodes.items():
            if s is None:
                rows = (place == n) & drawn_rows[t]
                m[place == n] += -lr * (g[rows].sum() * unit) / (rows.sum() + l2)
    return m, splits


def test_boosting_equals_a_plain_booster(spark, table):
    df, x, y = table
    how = dict(rounds=4, learning_rate=0.3, max_depth=3, min_child=3, subsample=0.8, colsample=0.8, l2=1.0, bins=32, seed=7)
    model, losses = boosting.fit(df, FEATURES, "y", id_cols=["id"], write_every=2, **how)
    cuts = boosting.cut_points(df, FEATURES, 32)
    drawn = [boosting.drawn_rows(0.8, 7, t) for t in range(4)]
    flags = df.select("id", F.xxhash64("id").alias("_h")).selectExpr("id", *[f"{d} AS d{i}" for i, d in enumerate(drawn)]).orderBy("id").toPandas()
    rows = [flags[f"d{i}"].to_numpy() for i in range(4)]
    assert all(0.75 < r.mean() < 0.85 for r in rows)
    cols = [boosting.drawn_features(5, 0.8, 7, t) for t in range(4)]
    assert all(len(c) == 4 for c in cols)
    unit = 2.0 ** (math.ceil(math.log2((y.max() - y.min()) * 4)) - 40)
    want, splits = plain_booster(x, y, cuts, rows, cols, 4, 0.3, 3, 3, 1.0, unit)
    got = model.predict(df, "p").orderBy("id").toPandas()["p"].to_numpy()
    assert np.abs(got - want).max() < 1e-6
    assert model.nodes.filter("left >= 0").count() == len(splits)
    assert len(losses) == 3 and losses[0] > losses[1] > losses[2]
    assert losses[-1] == pytest.approx(((want - y) ** 2).mean(), rel=1e-9)
    gains = {r.feature: r.importance for r in model.importance().collect()}
    assert sum(gains.values()) == pytest.approx(1) and gains["e"] == 0 and gains["a"] > gains["d"]


def test_boosting_does_not_depend_on_the_order_of_rows(spark, table):
    df, _, _ = table
    how = dict(rounds=3, max_depth=4, bins=64, seed=3, id_cols=["id"], write_every=2)
    cols = ["tree", "node", "feature", "threshold", "left", "right", "value", "cover"]
    a = boosting.fit(df, FEATURES, "y", **how)[0].nodes.select(cols).orderBy("node").collect()
    b = boosting.fit(df.repartition(7, "c").orderBy(F.desc("d")), FEATURES, "y", **how)[0].nodes.select(cols).orderBy("node").collect()
    assert a == b
    c = boosting.fit(df, FEATURES, "y", **(how | {"seed": 4}))[0].nodes.select(cols).orderBy("node").collect()
    assert a != c


def test_boosting_cases(spark, table):
    df, _, _ = table
    flat = boosting.fit(df.withColumn("y", F.lit(2.5)), FEATURES, "y", rounds=2, max_depth=2)[0]
    assert flat.nodes.count() == 2 and {r.p for r in flat.predict(df, "p").select("p").distinct().collect()} == {2.5}
    few = boosting.fit(df.filter("id < 4"), FEATURES, "y", rounds=1, max_depth=3, min_child=3, subsample=1.0)[0]
    assert few.nodes.count() == 1  # no split leaves three rows on both sides
    with pytest.raises(ContractError, match="NULL features"):
        boosting.fit(df.withColumn("b", F.when(F.col("id") > 5, F.col("b"))), FEATURES, "y", rounds=1)
    with pytest.raises(ContractError, match="no training rows"):
        boosting.fit(df.filter("id < 0"), FEATURES, "y", rounds=1)
    some = boosting.fit(df.withColumn("y", F.when(F.col("id") % 3 > 0, F.col("y"))), FEATURES, "y", rounds=1, max_depth=2)[0]
    assert some.nodes.filter("depth = 0").first()["cover"] < 1400


def test_scoring_equals_spark_ml_and_batches_average(spark, table, tmp_path):
    df, _, _ = table
    forest = TR.fit_forest(df, FEATURES, "y", trees=6, max_depth=5, seed=1)
    m = T.from_ml(forest)
    both = m.predict(forest.predict(df, "ml"), "own")
    assert both.columns[-2:] == ["ml", "own"]
    assert both.agg(F.max(F.abs(F.col("ml") - F.col("own")))).first()[0] < 1e-9
    shares = dict(zip(FEATURES, forest.model.stages[-1].featureImportances.toArray()))
    for r in m.importance().collect():
        assert r.importance == pytest.approx(shares[r.feature], abs=1e-9)
    path = str(tmp_path / "forest")
    whole = TR.fit_forest_batches(df, FEATURES, path, "y", trees=5, max_depth=4, seed=9, batch=2)
    assert whole.nodes.agg(F.countDistinct("tree")).first()[0] == 5
    parts = [T.load_trees(spark, f"{path}/batch-{i:04d}-{n}-4-9") for i, n in enumerate([2, 2, 1])]
    scored = df
    for i, p in enumerate(parts):
        scored = p.predict(scored, f"p{i}")
    scored = whole.predict(scored, "all").withColumn("mean", (2 * F.col("p0") + 2 * F.col("p1") + F.col("p2")) / 5)
    assert scored.agg(F.max(F.abs(F.col("all") - F.col("mean")))).first()[0] < 1e-9
    # a driver that starts again reads what is there: the saved batches come back node by node
    files = sorted(p.stat().st_mtime_ns for p in (tmp_path / "forest").rglob("*.parquet"))
    again = TR.fit_forest_batches(df, FEATURES, path, "y", trees=5, max_depth=4, seed=9, batch=2)
    assert files == sorted(p.stat().st_mtime_ns for p in (tmp_path / "forest").rglob("*.parquet"))
    assert again.nodes.orderBy("node").collect() == whole.nodes.orderBy("node").collect()
    mean = {f: sum(n * p for n, p in zip([2, 2, 1], v)) / 5 for f, v in zip(FEATURES, zip(*[[r.importance for r in p.importance().collect()] for p in parts]))}
    got = {r.feature: r.importance for r in whole.importance().collect()}
    assert all(got[f] == pytest.approx(mean[f], abs=1e-9) for f in FEATURES)


def test_saved_trees_score_alike(spark, table, tmp_path):
    df, _, _ = table
    m = boosting.fit(df, FEATURES, "y", rounds=2, max_depth=3)[0]
    assert not T.saved_trees(spark, str(tmp_path / "m"))
    TR.save_model(m, str(tmp_path / "m"))
    back = TR.load_model(spark, str(tmp_path / "m"))
    assert T.saved_trees(spark, str(tmp_path / "m")) and (back.name, back.features, back.base, back.averaged) == (m.name, m.features, m.base, False)
    assert back.predict(m.predict(df, "p1"), "p2").filter("NOT p1 <=> p2").count() == 0
    holes = m.predict(df.withColumn("d", F.when(F.col("id") > 2, F.col("d"))), "p1")
    assert holes.filter("p1 IS NULL").count() == 3
    with pytest.raises(ContractError):
        m.predict(df.drop("d"))


def _value(nodes, x, known):
    """The mean prediction where only the features in ``known`` are known."""
    def at(n):
        r = nodes[n]
        if r.left < 0:
            return r.value
        if r.feature in known:
            return at(r.left if x[r.feature] <= r.threshold else r.right)
        return (nodes[r.left].cover * at(r.left) + nodes[r.right].cover * at(r.right)) / r.cover
    return sum(at(n) for n, r in nodes.items() if r.depth == 0)


def test_attributions_equal_all_coalitions(spark, table):
    df, _, _ = table
    m = boosting.fit(df, FEATURES, "y", rounds=3, learning_rate=0.5, max_depth=3, seed=2, subsample=1.0)[0]
    nodes = {r.node: r for r in m.nodes.collect()}
    rows = df.filter("id < 12")
    got = {}
    for r in AT.tree_attribution(rows, m, ["id"]).collect():
        got.setdefault(r.id, {})[r.feature] = r.contribution
    base = AT.expected_value(m)
    assert base == pytest.approx(m.base + _value(nodes, None, set()))
    for r in m.predict(rows, "p").collect():
        x = [r[c] for c in FEATURES]
        assert set(got[r.id]) == set(FEATURES)
        assert base + sum(got[r.id].values()) == pytest.approx(r.p, abs=1e-9)
        for j, f in enumerate(FEATURES):
            others = [i for i in range(5) if i != j]
            want = sum(math.factorial(k) * math.factorial(4 - k) / math.factorial(5) * (_value(nodes, x, {*s, j}) - _value(nodes, x, set(s)))
                       for k in range(5) for s in itertools.combinations(others, k))
            assert got[r.id][f] == pytest.approx(want, abs=1e-9)


def test_attributions_of_null_rows_and_of_forests(spark, table):
    df, _, _ = table
    m = T.from_ml(TR.fit_forest(df, FEATURES, "y", trees=3, max_depth=7, seed=1))
    rows = df.filter("id < 5").withColumn("c", F.when(F.col("id") > 0, F.col("c")))
    out = AT.tree_attribution(rows, m, ["id"])
    assert out.count() == 25 and out.filter("id = 0 AND contribution IS NULL").count() == 5
    sums = {r.id: r.s for r in out.groupBy("id").agg(F.sum("contribution").alias("s")).collect()}
    base = AT.expected_value(m)
    for r in m.predict(rows.filter("id > 0"), "p").collect():
        assert base + sums[r.id] == pytest.approx(r.p, abs=1e-8)


def _features(spark):
    return build_features(raw_hourly_from_dir(spark, SF0001), drop_incomplete=False)


@pytest.mark.parametrize("align", ["target", "reference"])
def test_forecast_fold_equals_steps(spark, align):
    cols = DEFAULT_SPEC.feature_columns()
    feats = build_features(raw_hourly_from_dir(spark, SF0001), drop_incomplete=False, align=align)
    train = feats.dropna(subset=[*cols, "target_aqi"])
    forest = TR.fit_forest(train, cols, trees=4, max_depth=6)
    fold = FC.recursive_forecast_trees(feats, T.from_ml(forest), horizon=6, align=align).toPandas()
    steps = FC.recursive_forecast_stepwise(feats, forest, horizon=6, align=align).toPandas()
    z = fold.merge(steps, on=["location_id", "timestamp", "step", "forecast_day"])
    assert len(z) == len(fold) == len(steps) > 0
    assert (z.predicted_aqi_x - z.predicted_aqi_y).abs().max() < 1e-9


def test_forecast_fold_names_or_keeps_short_series(spark):
    cols = DEFAULT_SPEC.feature_columns()
    feats = _features(spark)
    m = boosting.fit(feats.dropna(subset=[*cols, "target_aqi"]), cols, rounds=2, max_depth=2)[0]
    one = feats.select("location_id").orderBy("location_id").first()[0]
    newest = F.row_number().over(FC.Window.partitionBy("location_id").orderBy(F.desc("timestamp")))
    short = feats.withColumn("_r", newest).filter((F.col("location_id") != one) | (F.col("_r") <= 20)).drop("_r")
    with pytest.raises(Exception, match=f"series {one}.*aqi_lag"):
        FC.recursive_forecast_trees(short, m, horizon=6).collect()
    kept = FC.recursive_forecast_trees(short, m, horizon=6, on_null="keep").toPandas()
    assert kept[kept.location_id == one].predicted_aqi.isna().all() and kept[kept.location_id != one].predicted_aqi.notna().all()
    assert len(kept[kept.location_id == one]) == 6
