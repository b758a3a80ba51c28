"""Values at the edges: large sums, ties, hot values, NULL predictions, short series."""

from datetime import datetime, timedelta

import numpy as np
import pytest
from pyspark.sql import functions as F

from hourglass.catalog.common import rounded
from hourglass.functions.numeric import quantize
from hourglass.operators import aggregates as A
from hourglass.operators.joins import attach_one_to_one
from hourglass.plans import forecast as FC
from hourglass.plans.features import build_features
from hourglass.plans.leakage import structural_leakage_report
from hourglass.plans.training import fit_forest
from hourglass.schema import DEFAULT_SPEC as S
from hourglass.sources.events import raw_hourly

T0 = datetime(2024, 1, 1)


@pytest.mark.parametrize("value", [5e10, 2e12, -3e13, 1e300, 1.25, -0.0])
def test_quantize_keeps_every_magnitude(spark, value):
    df = spark.createDataFrame([(value,)], "v double")
    got = df.select(quantize("v", 9).alias("v")).first().v
    assert got == pytest.approx(value, rel=1e-15) and str(got) != "-0.0"
    assert rounded(df).first().v == pytest.approx(value, rel=1e-15)


def test_hourly_sums_beyond_the_range_of_a_long(spark):
    rows = [(i, T0 + timedelta(minutes=i % 60), i % 7, "a", 1e9) for i in range(40)]
    ev = spark.createDataFrame(rows, "event_id long, ts timestamp, user_id long, event_type string, value double")
    r = raw_hourly(ev).first()
    assert r.carbon_monoxide == 4e10 and r.precipitation == 4e10


@pytest.mark.parametrize("conf", [{}, {"spark.sql.exchange.reuse": "false"}, {"spark.sql.exchange.reuse": "false", "spark.sql.adaptive.enabled": "false"}])
def test_quantiles_do_not_rest_on_the_optimizer(spark, conf):
    rng = np.random.default_rng(1)
    rows = [(g, 0.0 if rng.random() < 0.9 else float(x)) for g in ("a", "b", None) for x in rng.normal(size=3000)]
    df = spark.createDataFrame([*rows, ("a", None), ("b", float("nan"))], "g string, v double").repartition(5)
    old = {k: spark.conf.get(k) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        got = {(r.g, r.p): r.value for r in A.quantiles(df, ["v"], [0.0, 0.01, 0.5, 0.977, 1.0], ["g"]).collect()}
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
    want = {(g, p): np.quantile([x for h, x in rows if h == g], p) for g in ("a", "b", None) for p in (0.0, 0.01, 0.5, 0.977, 1.0)}
    assert got == {k: pytest.approx(v, abs=1e-12) for k, v in want.items()}


def test_equal_values_are_counted_before_the_sort(spark):
    df = spark.range(20_000).select(F.when(F.col("id") % 10 > 0, 0.0).otherwise(F.col("id").cast("double")).alias("v"))
    A.quantiles(df, ["v"], [0.5]).collect()
    counted = df.groupBy("v").count()
    assert counted.count() == 2000


def test_category_share_is_rounded_half_even(spark):
    df = spark.createDataFrame([("x",)] * 9 + [("y",)] * 791, "c string")
    got = {r.c: r.percent for r in A.category_distribution(df, "c").collect()}
    assert got["x"] == np.round(900 / 800, 2) == 1.12


def test_null_predictions_are_counted(spark):
    rows = [("s", 1, T0 + timedelta(hours=h), 10.0 + h, None if h < 6 else 11.0 + h) for h in range(24)]
    df = spark.createDataFrame(rows, "location_id string, forecast_day int, timestamp timestamp, a double, predicted_aqi double")
    m = A.regression_metrics(df, "a", "predicted_aqi", ["location_id"]).first()
    assert (m.n, m.skipped, m.mae) == (18, 6, 1.0)
    b = A.block_metrics(df, "a", "predicted_aqi", ["location_id"]).first()
    assert (b.hours, b.skipped, b.start) == (18, 6, T0 + timedelta(hours=6))
    assert A.block_actual_vs_pred(df, "a", "predicted_aqi", ["location_id"]).first().hours == 18
    c = A.block_completeness(df, ["location_id"], blocks=1).first()
    assert (c.total_hours, c.complete) == (18, False)


def test_block_means_are_rounded_before_their_errors(spark):
    df = spark.createDataFrame([("s", 1.005, 1.0149), ("s", 3.0, 2.0)], "k string, actual_mean double, predicted_mean double")
    a, p = np.round([1.005, 3.0], 2), np.round([1.0149, 2.0], 2)
    assert A.metrics_of_block_means(df, ["k"]).first().mae == pytest.approx(np.abs(a - p).mean(), abs=1e-12)


def test_one_to_one_join_fails_on_duplicates_in_the_same_plan(spark):
    left = spark.createDataFrame([(1, "a"), (2, "b")], "k long, v string")
    twice = spark.createDataFrame([(1, 1.0), (1, 2.0)], "k long, w double")
    assert attach_one_to_one(left, twice.limit(1), ["k"], ["w"], check="plan").count() == 2
    for a, b in ((left, twice), (twice, left)):
        with pytest.raises(Exception, match="duplicate join keys"):
            attach_one_to_one(a, b, ["k"], check="plan").collect()


def test_structural_report_sees_the_order_of_arrival(spark):
    hours = [5, 3, 9, 1]
    df = spark.createDataFrame([("s", T0 + timedelta(hours=h), 1.0, 2.0, i) for i, h in enumerate(hours)], "location_id string, timestamp timestamp, x_lag_1 double, target_aqi double, n int")
    bad = structural_leakage_report(df, ["location_id"], "timestamp", ["x_lag_1"], "target_aqi", ordinal="n").first()
    assert bad.order_violations == 2 and not bad.passed
    good = structural_leakage_report(df.withColumn("n", F.unix_timestamp("timestamp")), ["location_id"], "timestamp", ["x_lag_1"], "target_aqi", ordinal="n").first()
    assert good.order_violations == 0 and good.passed


def short_series(spark):
    rows = []
    for n in (60, 73, 90, 140, 200):
        for h in range(n):
            v = 50 + (h % 24)
            rows.append((f"s{n}", T0 + timedelta(hours=h), 20.0, 50, 1000.0, 0.0, 3.0, 90, float(v), 5.0, 9.0, 1.0, 2.0, 3.0, 4.0))
    cols = ["location_id", "timestamp", *S.weather, "us_aqi", *S.pollutants]
    return spark.createDataFrame(rows, cols)


def test_short_series_fail_by_name_or_stay_without_predictions(spark):
    raw = short_series(spark)
    feats = build_features(raw, ["location_id"], "timestamp", S, drop_incomplete=False)
    beta = {"aqi_lag_1": 0.5, "aqi_24h_mean": 0.4}
    with pytest.raises(Exception, match="series s(60|73|90).*aqi_24h_mean"):
        FC.recursive_forecast_linear(feats, 1.0, beta).collect()
    kept = FC.recursive_forecast_linear(feats, 1.0, beta, on_null="keep")
    got = {r.location_id: (r.n, r.p) for r in kept.groupBy("location_id").agg(F.count("*").alias("n"), F.count("predicted_aqi").alias("p")).collect()}
    assert set(got) == {"s60", "s73", "s90", "s140", "s200"}
    assert got["s140"] == (72, 72) and got["s200"] == (72, 72)
    assert all(got[s][1] == 0 for s in ("s60", "s73", "s90"))
    status = {r.location_id: r for r in FC.forecast_status(feats, used=list(beta)).collect()}
    assert {k: r.status for k, r in status.items()} == {"s60": "short", "s73": "short", "s90": "short", "s140": "ok", "s200": "ok"}
    assert status["s90"].missing_features == "aqi_24h_mean" and status["s73"].history == 1


def test_tree_forecast_keeps_short_series_too(spark):
    raw = short_series(spark)
    feats = build_features(raw, ["location_id"], "timestamp", S, drop_incomplete=False)
    train = build_features(raw, ["location_id"], "timestamp", S)
    model = fit_forest(train, S.feature_columns(), trees=2, max_depth=3)
    with pytest.raises(Exception, match="NULL features"):
        FC.recursive_forecast_stepwise(feats, model, horizon=4).collect()
    out = FC.recursive_forecast_stepwise(feats, model, horizon=4, on_null="keep").groupBy("location_id").agg(F.count("*").alias("n"), F.count("predicted_aqi").alias("p")).collect()
    assert {r.location_id: (r.n, r.p) for r in out} == {"s60": (4, 0), "s73": (4, 0 if max(FC.needed_hours().values()) > 69 else 4), "s90": (4, 4), "s140": (4, 4), "s200": (4, 4)}
    with pytest.raises(ValueError, match="max_depth"):
        fit_forest(train, S.feature_columns(), trees=2, max_depth=31)


def test_written_tables_are_released(spark):
    from hourglass.session import WRITTEN, release_tables, write_table

    release_tables(spark)
    df = write_table(spark.range(5).toDF("v"))
    assert df.count() == 5 and len(WRITTEN) == 1
    path = WRITTEN[0]
    assert release_tables(spark) == 1 and not WRITTEN
    with pytest.raises(Exception, match="PATH_NOT_FOUND|does not exist"):
        spark.read.parquet(path)


def test_halo_ordinals_keep_null_keys(spark):
    from hourglass.operators.halo import with_ordinal

    rows = [(k, T0 + timedelta(hours=h * 50)) for k in ("a", None) for h in range(9)] + [("a", None)]
    got = with_ordinal(spark.createDataFrame(rows, "k string, t timestamp_ntz"), ["k"], "t").collect()
    assert len(got) == len(rows)
    assert sorted(r._ordinal for r in got if r.k is None) == list(range(9))


def test_list_payloads(spark):
    from hourglass.sources.payloads import list_profile

    df = spark.createDataFrame([(1, '{"coord":{"lat":1.5,"lon":2.0},"list":[{"dt":3600,"x":1},{"dt":0,"x":null}]}'), (2, "{}"), (3, None)], "i long, p string")
    got = {r.i: r for r in list_profile(df, "p", ["x"], ["i"]).collect()}
    assert (got[1].records, got[1].first_ts, got[1].latitude) == (2, datetime(1970, 1, 1), 1.5)
    assert got[2].records == got[3].records == 0
