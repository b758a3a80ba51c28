import datetime as dt

import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from hourglass.operators import windows as Wn
from hourglass.plans.features import build_features, feature_sql
from hourglass.schema import DEFAULT_SPEC


def _series(spark, values, key="a"):
    t0 = dt.datetime(2024, 1, 1)
    rows = [(key, t0 + dt.timedelta(hours=i), v) for i, v in enumerate(values)]
    return spark.createDataFrame(rows, "k string, ts timestamp_ntz, x double")


def test_rolling_prior_and_trailing_match_pandas(spark):
    vals = [1.0, 2.0, None, 4.0, 5.0, 6.0, 7.0, None, 9.0, 10.0, 11.0, 12.0]
    df = _series(spark, vals)
    w = Wn.series_window(["k"], "ts")
    out = df.select("ts", Wn.rolling_mean_prior("x", 3, w).alias("p3"),
                    Wn.rolling_mean_trailing("x", 3, w).alias("t3"),
                    Wn.change("x", 2, w).alias("c2"), Wn.change_prior("x", 2, w).alias("cp2")).orderBy("ts").toPandas()
    s = pd.Series(vals, dtype=float)
    np.testing.assert_allclose(out["p3"], s.shift(1).rolling(3).mean(), equal_nan=True)
    np.testing.assert_allclose(out["t3"], s.rolling(3, min_periods=1).mean(), equal_nan=True)
    np.testing.assert_allclose(out["c2"], s - s.shift(2), equal_nan=True)
    np.testing.assert_allclose(out["cp2"], s.shift(1) - s.shift(3), equal_nan=True)


def test_sql_and_column_forms_agree(spark):
    from hourglass.plans.features import feature_columns_expr

    rng = np.random.default_rng(1)
    t0 = dt.datetime(2024, 1, 1)
    rows = [("a", t0 + dt.timedelta(hours=i), *rng.uniform(0, 100, 13).tolist()) for i in range(120)]
    cols = ", ".join(f"{c} double" for c in DEFAULT_SPEC.required_raw())
    df = spark.createDataFrame(rows, f"location_id string, timestamp timestamp_ntz, {cols}")
    for align in ("target", "reference"):
        a = df.withColumns(feature_columns_expr(DEFAULT_SPEC, ["location_id"], "timestamp", align))
        b = df.selectExpr("*", *[f"{e} AS {n}" for n, e in feature_sql(DEFAULT_SPEC, ["location_id"], "timestamp", align).items()])
        pa = a.orderBy("timestamp").toPandas()
        pb = b.orderBy("timestamp").toPandas()[pa.columns]
        pd.testing.assert_frame_equal(pa, pb)


def test_build_features_contract(spark):
    from hourglass.sources.events import raw_hourly_from_dir

    f = build_features(raw_hourly_from_dir(spark, "/root/testdata/sf0.01"))
    assert all(c in f.columns for c in DEFAULT_SPEC.feature_columns())
    nulls = f.select([F.count_if(F.col(c).isNull()).alias(c) for c in DEFAULT_SPEC.feature_columns() + ["target_aqi"]]).first()
    assert sum(nulls) == 0
    # 72 head rows and 1 tail row per complete series are dropped
    assert f.count() == 3385 - 5 * 73


def test_dedup_idempotent_and_tiebreak(spark):
    t = dt.datetime(2024, 1, 1)
    df = spark.createDataFrame([("a", t, 1, 10.0), ("a", t, 2, 20.0), ("a", t, 3, 30.0), ("b", t, 1, 5.0)],
                               "k string, ts timestamp_ntz, ingest int, v double")
    last = Wn.dedup_keep_last(df, ["k"], "ts", ["ingest"])
    first = Wn.dedup_keep_first(df, ["k"], "ts", ["ingest"])
    assert sorted(r.v for r in last.collect()) == [5.0, 30.0]
    assert sorted(r.v for r in first.collect()) == [5.0, 10.0]
    again = Wn.dedup_keep_last(last, ["k"], "ts", ["ingest"])
    assert sorted(map(tuple, again.collect())) == sorted(map(tuple, last.collect()))


def test_chrono_split_positions(spark):
    df = _series(spark, [float(i) for i in range(90)])
    s = Wn.chrono_split(df, ["k"], "ts").orderBy("ts").toPandas()
    # int(90 * 0.70) == 62 in doubles (62.99999...), int(90 * 0.85) == 76
    assert (s["split"] == "train").sum() == 62
    assert (s["split"] == "val").sum() == 14
    assert (s["split"] == "test").sum() == 14
    order = s["split"].map({"train": 0, "val": 1, "test": 2}).to_numpy()
    assert (np.diff(order) >= 0).all()


def test_block_number_and_lookback(spark):
    df = _series(spark, [float(i) for i in range(50)])
    b = df.select("ts", Wn.block_number(["k"], "ts", 24).alias("b")).orderBy("ts").toPandas()
    assert b["b"].tolist() == [1] * 24 + [2] * 24 + [3] * 2
    seq = Wn.lookback_sequences(df, ["k"], "ts", ["x"], 24).orderBy("ts").toPandas()
    assert len(seq) == 26
    assert [v[0] for v in seq["sequence"].iloc[0]] == [float(i) for i in range(24)]
    assert seq["x"].iloc[0] == 24.0
