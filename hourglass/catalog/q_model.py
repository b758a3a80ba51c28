"""Model, forecast, evaluation, attribution, leakage and ledger queries (M*, A11, A13-A15, A17, A19-A21, P14).

Queries checked against DuckDB use a fixed linear model (coefficients below)
so SQL can state the same arithmetic; fitted Spark ML models are registered
as rows-only checks.
"""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from hourglass.catalog import register
from hourglass.catalog.common import KEYS, TS, events, features, raw, rounded
from hourglass.checks.sqlfrag import (
    FEATURES_CTE,
    RAW_HOURLY_CTE,
    W,
    dbl,
    errors_sql,
    exog_sql,
    features_select,
    forecast_sql,
    r6,
)
from hourglass.functions import calendar as C
from hourglass.functions.numeric import aqi_category
from hourglass.operators import aggregates as A
from hourglass.operators import ordering as O
from hourglass.operators.windows import chrono_split, lag_audit
from hourglass.plans import attribution as AT
from hourglass.plans import forecast as FC
from hourglass.plans import training as TR
from hourglass.schema import DEFAULT_SPEC as S
from hourglass.session import materialize, write_table

# Fixed test model (a hand-set linear model, not fitted): intercept and
# coefficients on unscaled features.  Used where SQL must repeat the math.
FIXED_B0 = 2.0
FIXED_BETA = {
    "temperature_2m": 0.005,
    "pm2_5": 0.01,
    "hour": 0.1,
    "is_weekend": -0.5,
    "aqi_lag_1": 0.55,
    "aqi_lag_24": 0.1,
    "aqi_3h_mean": 0.2,
    "aqi_24h_mean": 0.1,
    "aqi_change_1h": 0.3,
    "pm2_5_24h_mean": 0.002,
}
HORIZON = 72
FEATS = S.feature_columns()

_SPLIT = (f"{FEATURES_CTE},\nsp AS (SELECT *, row_number() OVER ({W}) AS _rn, count(*) OVER (PARTITION BY location_id) AS _n FROM feat),\n"
          "spl AS (SELECT *, CASE WHEN _rn <= floor(_n * 0.70::DOUBLE) THEN 'train' "
          "WHEN _rn <= floor(_n * 0.85::DOUBLE) THEN 'val' ELSE 'test' END AS split FROM sp)")


def _split(spark, sf):
    """Split feature table, written once to the shared checkpoint folder: every
    model query reads it two or more times (train statistics, scoring), and the
    checkpoint both avoids recomputing the window plan and cuts its lineage."""
    return materialize(chrono_split(features(spark, sf), KEYS, TS))


def _fixed_pred():
    e = F.lit(FIXED_B0)
    for c in FEATS:
        if FIXED_BETA.get(c):
            e = e + F.lit(FIXED_BETA[c]) * F.col(c).cast("double")
    return e


def _fixed_pred_sql():
    e = dbl(FIXED_B0)
    for c in FEATS:
        if FIXED_BETA.get(c):
            e = f"{e} + {dbl(FIXED_BETA[c])} * CAST({c} AS DOUBLE)"
    return e


# --------------------------------------------------------------------------- M1, M2
_SCALE_COLS = ["aqi_lag_1", "pm2_5", "temperature_2m", "hour"]


@register("scaler_stats", f"WITH {_SPLIT}\n" + "\nUNION ALL\n".join(
    f"SELECT '{c}' AS feature, {r6(f'avg(CAST({c} AS DOUBLE))', 'mean')}, {r6(f'stddev_pop(CAST({c} AS DOUBLE))', 'sd')} "
    f"FROM spl WHERE split = 'train'" for c in _SCALE_COLS))
def q_scaler_stats(spark, sf):
    """M1: training-split means and population stds (long form)."""
    st = TR.fit_scaler(_split(spark, sf).filter("split = 'train'"), _SCALE_COLS)
    long = st.select(F.explode(F.array(*[F.struct(F.lit(c).alias("feature"), F.col(f"mu_{c}").alias("mean"),
                                                  F.col(f"sd_{c}").alias("sd")) for c in _SCALE_COLS])).alias("r"))
    return rounded(long.select("r.*"))


_RIDGE_SQL = f"""WITH {_SPLIT},
tr AS (SELECT CAST(aqi_lag_1 AS DOUBLE) AS x, target_aqi AS y FROM spl WHERE split = 'train'),
st AS (SELECT avg(x) AS mx, stddev_pop(x) AS sx, avg(y) AS my FROM tr),
z AS (SELECT (x - mx) / sx AS xs, y - my AS yc FROM tr, st),
w AS (SELECT sum(xs * yc) / (sum(xs * xs) + 1.0) AS ws FROM z)
SELECT {r6('ws / sx', 'coefficient')}, {r6('my - ws * mx / sx', 'intercept')} FROM w, st"""


@register("ridge_one_feature", _RIDGE_SQL)
def q_ridge_one_feature(spark, sf):
    """M2: ridge (alpha 1) of the next-hour target on one scaled feature,
    returned on the raw scale; equals the closed form."""
    train = _split(spark, sf).filter("split = 'train'")
    fm = TR.fit_ridge(train, ["aqi_lag_1"], "target_aqi", 1.0)
    b0, beta = fm.linear_terms(spark)
    return rounded(spark.createDataFrame([(float(beta["aqi_lag_1"]), float(b0))], "coefficient double, intercept double"))


# --------------------------------------------------------------------------- M7, M8, W10, A19
_BASELINES = {"persistence": "us_aqi", "mean_3h": "aqi_3h_mean", "mean_24h": "aqi_24h_mean", "lag_24h": "aqi_lag_24"}


def _baseline_metrics(spark, sf):
    """All baselines in one pass: their predictions unpivoted from the split table's
    few columns, one aggregate by model and split."""
    cols = ["split", "target_aqi", *_BASELINES.values()]
    s = chrono_split(features(spark, sf), KEYS, TS).select(*cols)
    models = F.explode(F.array(*[F.struct(F.lit(n).alias("model"), F.col(c).cast("double").alias("prediction")) for n, c in _BASELINES.items()]))
    long = s.select("split", "target_aqi", models.alias("m")).select("split", "target_aqi", "m.*")
    return TR.evaluate_splits(long, "target_aqi", "prediction", "split", ["model"])


def _baseline_sql_rows():
    return " UNION ALL ".join(f"SELECT '{name}' AS model, split, {errors_sql('target_aqi', col, rounded=False)} FROM spl GROUP BY split"
                              for name, col in _BASELINES.items())


_MET = f"{_SPLIT},\nmet AS ({_baseline_sql_rows()})"


@register("evaluate_splits", f"WITH {_MET}\nSELECT model, split, n, skipped, {r6('mae', 'mae')}, {r6('rmse', 'rmse')}, {r6('r2', 'r2')} FROM met")
def q_evaluate_splits(spark, sf):
    """M7: MAE/RMSE/R^2 per split for four baseline predictors (persistence,
    3 h and 24 h prior means, 24 h lag)."""
    return rounded(_baseline_metrics(spark, sf))


@register("compare_models", f"WITH {_MET}\nSELECT model, {r6('mae', 'mae')}, {r6('rmse', 'rmse')}, {r6('r2', 'r2')}, "
                            "CAST(rank() OVER (ORDER BY rmse) AS INTEGER) AS rank FROM met WHERE split = 'test'")
def q_compare_models(spark, sf):
    """M8 + W10: test-split metrics ranked by RMSE."""
    m = _baseline_metrics(spark, sf).filter("split = 'test'").select("model", "mae", "rmse", "r2")
    return rounded(TR.compare_models(m, "rmse"))


@register("champion", f"WITH {_MET}\nSELECT model, {r6('mae', 'mae')}, {r6('rmse', 'rmse')}, {r6('r2', 'r2')} "
                      "FROM met WHERE split = 'test' ORDER BY rmse LIMIT 1")
def q_champion(spark, sf):
    """The test row with the lowest RMSE."""
    m = _baseline_metrics(spark, sf).filter("split = 'test'").select("model", "mae", "rmse", "r2")
    return rounded(A.champion(m, "rmse"))


def _ledger(spark, sf):
    m = _baseline_metrics(spark, sf).filter("split in ('val', 'test')")
    return m.select(F.md5(F.concat_ws(":", "model", "split")).alias("run_id"), "model",
                    F.when(F.col("split") == "val", 1).otherwise(2).alias("version"),
                    F.create_map(F.lit("kind"), F.lit("baseline"), F.lit("split"), F.col("split")).alias("params"),
                    F.create_map(F.lit("mae"), F.col("mae"), F.lit("rmse"), F.col("rmse"), F.lit("r2"), F.col("r2")).alias("metrics"),
                    F.create_map(F.lit("stage"), F.lit("evaluation")).alias("tags"))


@register("run_ledger",
          f"WITH {_MET},\nled AS (SELECT model, CASE WHEN split = 'val' THEN 1 ELSE 2 END AS version, split, rmse FROM met WHERE split IN ('val', 'test')),\n"
          "lat AS (SELECT model, max(version) AS version, arg_max(rmse, version) AS rmse, arg_max(split, version) AS split FROM led GROUP BY model)\n"
          f"SELECT model, CAST(version AS INTEGER) AS version, split, {r6('rmse', 'rmse')}, "
          "CASE WHEN rank() OVER (ORDER BY rmse) = 1 THEN 'champion' END AS alias FROM lat")
def q_run_ledger(spark, sf):
    """Runs with params/metrics/tags maps; latest version per model
    (max_by), champion alias on the lowest RMSE."""
    from hourglass.plans.ledger import assign_alias, latest_versions

    lat = latest_versions(_ledger(spark, sf))
    out = assign_alias(lat, "rmse", "champion")
    return rounded(out.select("model", F.col("version").cast("int").alias("version"),
                              F.col("params")["split"].alias("split"), F.col("metrics")["rmse"].alias("rmse"), "alias"))


# --------------------------------------------------------------------------- M14, M15
#: Hours before the horizon that the target's features read.
_NEED = {**{f"aqi_lag_{k}": k + 1 for k in S.aqi_lags}, **{n: w + 1 for n, c, w in S.mean_cols() if c == "us_aqi"},
         **{n: k + 1 for n, c, k in S.change_cols() if c == "us_aqi"}}


@register("forecast_status",
          f"WITH {RAW_HOURLY_CTE},\nk AS (SELECT user_id % 200 AS g, date_trunc('hour', ts) AS h, avg(value) AS v FROM events WHERE user_id IS NOT NULL GROUP BY 1, 2),\n"
          "p AS (SELECT CAST(g AS VARCHAR) AS location_id, row_number() OVER (PARTITION BY g ORDER BY h DESC) - 72 AS d FROM k),\n"
          "s AS (SELECT location_id, count(*) AS rows, greatest(0, max(d)) AS history FROM p GROUP BY 1)\n"
          "SELECT location_id, rows, history, CAST(0 AS BIGINT) AS null_history, CASE WHEN history < 73 THEN 'short' ELSE 'ok' END AS status, "
          "array_to_string(list_transform(list_filter([" + ", ".join(f"{{'n': '{n}', 'd': {d}}}" for n, d in sorted(_NEED.items())) + "], lambda x: x.d > history), lambda x: x.n), ',') AS missing_features FROM s")
def q_forecast_status(spark, sf):
    """M14's contract: series (here one per user group) that lack the history for the
    target's features, and which features."""
    ev = events(spark, sf).filter("user_id is not null").withColumn("g", (F.col("user_id") % 200).cast("string"))
    hourly = ev.groupBy(F.col("g").alias("location_id"), C.hour_trunc("ts").alias(TS)).agg(F.avg("value").alias("us_aqi"))
    return FC.forecast_status(hourly, KEYS, TS, HORIZON).withColumn("history", F.col("history").cast("long"))


_FC_SQL = forecast_sql(FIXED_B0, FIXED_BETA, HORIZON, "target")


def _forecast(spark, sf, align="target"):
    f = features(spark, sf, drop_incomplete=False, align=align)
    return FC.recursive_forecast_linear(f, FIXED_B0, FIXED_BETA, KEYS, TS, HORIZON, align)


@register("recursive_forecast", f"WITH RECURSIVE {_FC_SQL}\nSELECT location_id, timestamp, step, forecast_day, "
                                f"{r6('predicted_aqi', 'predicted_aqi')} FROM fc")
def q_recursive_forecast(spark, sf):
    """72-step recursive forecast of a linear model per series (aggregate fold)."""
    return rounded(_forecast(spark, sf))


_FC_REF_SQL = forecast_sql(FIXED_B0, FIXED_BETA, HORIZON, "reference")


@register("recursive_forecast_reference", f"WITH RECURSIVE {_FC_REF_SQL}\nSELECT location_id, timestamp, step, forecast_day, "
                                          f"{r6('predicted_aqi', 'predicted_aqi')} FROM fc")
def q_recursive_forecast_reference(spark, sf):
    """M14 with the reference's alignment (prediction stored at the feature row's hour)."""
    return rounded(_forecast(spark, sf, "reference"))


_BT = (f"WITH RECURSIVE {_FC_SQL},\nbt AS (SELECT fc.*, raw.us_aqi AS future_us_aqi FROM fc LEFT JOIN raw "
       "ON fc.location_id = raw.location_id AND fc.timestamp = raw.timestamp)")


def _backtest(spark, sf):
    return FC.attach_actuals(_forecast(spark, sf), raw(spark, sf), KEYS, TS, "us_aqi")


@register("backtest", f"{_BT}\nSELECT location_id, timestamp, step, forecast_day, {r6('predicted_aqi', 'predicted_aqi')}, "
                      f"{r6('future_us_aqi', 'future_us_aqi')} FROM bt")
def q_backtest(spark, sf):
    """Forecast of the last 72 hours from the data before them, actuals attached one-to-one."""
    return rounded(_backtest(spark, sf))


@register("forecast_metrics", f"{_BT}\nSELECT location_id, {errors_sql('future_us_aqi', 'predicted_aqi')} FROM bt GROUP BY 1")
def q_forecast_metrics(spark, sf):
    """A12 on the 72-hour backtest per series."""
    return rounded(A.regression_metrics(_backtest(spark, sf), "future_us_aqi", "predicted_aqi", KEYS))


@register("block_metrics",
          f"{_BT}\nSELECT location_id, forecast_day, min(timestamp) AS start, max(timestamp) AS \"end\", "
          f"{r6('avg(predicted_aqi)', 'predicted_avg')}, {r6('avg(future_us_aqi)', 'actual_avg')}, "
          f"{errors_sql('future_us_aqi', 'predicted_aqi', 'hours')}, "
          f"{r6('avg(predicted_aqi) - avg(future_us_aqi)', 'average_error')}, "
          f"{r6('abs(avg(predicted_aqi) - avg(future_us_aqi))', 'absolute_error')}, "
          f"{r6('CASE WHEN avg(future_us_aqi) = 0 THEN NULL ELSE abs(avg(predicted_aqi) - avg(future_us_aqi)) * 100.0 / avg(future_us_aqi) END', 'percentage_error')} "
          "FROM (SELECT location_id, forecast_day, CASE WHEN ok THEN timestamp END AS timestamp, CASE WHEN ok THEN future_us_aqi END AS future_us_aqi, "
          "CASE WHEN ok THEN predicted_aqi END AS predicted_aqi FROM (SELECT *, future_us_aqi IS NOT NULL AND predicted_aqi IS NOT NULL AS ok FROM bt)) GROUP BY 1, 2")
def q_block_metrics(spark, sf):
    """A12 per 24-hour block plus mean-level errors."""
    return rounded(A.block_metrics(_backtest(spark, sf), "future_us_aqi", "predicted_aqi", KEYS))


_A14_SQL = (f"{_BT},\nblk AS (SELECT location_id, forecast_day, count(predicted_aqi) AS hours, "
            "avg(predicted_aqi) AS predicted_mean, min(predicted_aqi) AS predicted_min, max(predicted_aqi) AS predicted_max, "
            "avg(future_us_aqi) AS actual_mean, min(future_us_aqi) AS actual_min, max(future_us_aqi) AS actual_max FROM bt GROUP BY 1, 2),\n"
            "blk2 AS (SELECT *, abs(predicted_mean - actual_mean) AS abs_error, "
            "CASE WHEN actual_mean = 0 THEN NULL ELSE abs(predicted_mean - actual_mean) * 100.0 / actual_mean END AS pct_error FROM blk)")


@register("block_actual_vs_pred",
          f"{_A14_SQL}\nSELECT location_id, forecast_day, hours, " + ", ".join(
              r6(c, c) for c in ["predicted_mean", "predicted_min", "predicted_max", "actual_mean", "actual_min",
                                 "actual_max", "abs_error", "pct_error"]) + " FROM blk2")
def q_block_actual_vs_pred(spark, sf):
    """Per block mean/min/max of prediction and actual, abs and % error."""
    return rounded(A.block_actual_vs_pred(_backtest(spark, sf), "future_us_aqi", "predicted_aqi", KEYS))


@register("metrics_of_block_means",
          f"{_A14_SQL},\nblk3 AS (SELECT location_id, round_even(actual_mean, 2) AS a, round_even(predicted_mean, 2) AS p FROM blk2)\n"
          f"SELECT location_id, {errors_sql('a', 'p')} FROM blk3 GROUP BY 1")
def q_metrics_of_block_means(spark, sf):
    """A12 over the three daily block means per series."""
    blocks = A.block_actual_vs_pred(_backtest(spark, sf), "future_us_aqi", "predicted_aqi", KEYS)
    return rounded(A.metrics_of_block_means(blocks, KEYS))


@register("block_completeness",
          f"{_BT},\nper AS (SELECT location_id, forecast_day, count(predicted_aqi) AS n FROM bt GROUP BY 1, 2)\n"
          "SELECT location_id, count(*) AS blocks, sum(n) AS total_hours, bool_and(n = 24) AS all_full, "
          "bool_and(n = 24) AND count(*) = 3 AND sum(n) = 72 AS complete FROM per GROUP BY 1")
def q_block_completeness(spark, sf):
    """Every block has 24 hours, 3 blocks, 72 in total."""
    return A.block_completeness(_backtest(spark, sf), KEYS)


def _cat_sql(col):
    from hourglass.schema import AQI_CATEGORY_BOUNDS

    return "CASE " + " ".join(f"WHEN {col} <= {float(b)} AND NOT isnan({col}) THEN '{n}'" for b, n in AQI_CATEGORY_BOUNDS) \
        + " ELSE 'Hazardous' END"


@register("forecast_block_summary",
          f"{_BT},\ns AS (SELECT location_id, forecast_day, min(timestamp) AS first_ts, max(timestamp) AS last_ts, count(*) AS hours, "
          "avg(predicted_aqi) AS mean_aqi, min(predicted_aqi) AS min_aqi, max(predicted_aqi) AS max_aqi FROM bt GROUP BY 1, 2)\n"
          "SELECT location_id, forecast_day, first_ts, last_ts, hours, "
          f"{r6('round_even(mean_aqi, 2)', 'mean_aqi')}, {r6('round_even(min_aqi, 2)', 'min_aqi')}, {r6('round_even(max_aqi, 2)', 'max_aqi')}, "
          f"{_cat_sql('mean_aqi')} AS category FROM s")
def q_forecast_block_summary(spark, sf):
    """A11 + W9 + F7 + F9: per 24 h block time span, mean/min/max prediction
    (half-even 2 dp), hours and the AQI band of the mean."""
    from hourglass.plans.evaluation import forecast_block_summary

    return rounded(forecast_block_summary(_backtest(spark, sf), KEYS))


@register("select_group", f"{_BT}\nSELECT location_id, timestamp, step, {r6('predicted_aqi', 'predicted_aqi')} FROM bt WHERE forecast_day = 2")
def q_select_group(spark, sf):
    """The rows of forecast day 2."""
    from hourglass.operators.projections import select_group

    return rounded(select_group(_backtest(spark, sf), "forecast_day", 2).select(*KEYS, TS, "step", "predicted_aqi"))


# --------------------------------------------------------------------------- M12, M13, A21
_FUT = (f"{RAW_HOURLY_CTE},\nb AS (SELECT location_id, max(timestamp) - INTERVAL 72 HOUR AS boundary FROM raw GROUP BY 1),\n"
        "hist AS (SELECT r.* FROM raw r JOIN b USING (location_id) WHERE r.timestamp <= b.boundary),\n"
        "g AS (SELECT location_id, unnest(generate_series(boundary + INTERVAL 1 HOUR, boundary + INTERVAL 72 HOUR, INTERVAL 1 HOUR)) AS timestamp FROM b),\n"
        "fut AS (SELECT r.* FROM raw r WHERE (location_id, timestamp) IN (SELECT (location_id, timestamp) FROM g)),\n"
        "frame AS (SELECT h.*, false AS is_future FROM hist h UNION ALL "
        "SELECT f.* REPLACE (CAST(NULL AS DOUBLE) AS us_aqi), true FROM fut f)")


def _frame(spark, sf):
    r = raw(spark, sf)
    b = r.groupBy(*KEYS).agg(F.timestamp_add("HOUR", F.lit(-72), F.max(TS)).alias("_b"))
    hist = r.join(b, KEYS).filter(F.col(TS) <= F.col("_b")).drop("_b")
    grid = b.select(*KEYS, F.explode(F.sequence(F.timestamp_add("HOUR", F.lit(1), "_b"),
                                                F.timestamp_add("HOUR", F.lit(72), "_b"),
                                                F.expr("INTERVAL 1 HOUR"))).alias(TS))
    from hourglass.sources.events import air_side, weather_side
    from hourglass.catalog.common import events

    ev = events(spark, sf)
    fut = FC.future_inputs(weather_side(ev), air_side(ev), grid)
    return FC.forecast_frame(hist, fut, KEYS, TS, "us_aqi")


@register("future_inputs", f"WITH {_FUT}\nSELECT location_id, count(*) AS hours, count_if(us_aqi IS NULL) AS null_aqi, "
                           "min(timestamp) AS first_ts, max(timestamp) AS last_ts FROM fut GROUP BY 1")
def q_future_inputs(spark, sf):
    """Both providers joined (J1) on the 72-hour horizon grid (J4); counts per series."""
    r = raw(spark, sf)
    b = r.groupBy(*KEYS).agg(F.timestamp_add("HOUR", F.lit(-72), F.max(TS)).alias("_b"))
    grid = b.select(*KEYS, F.explode(F.sequence(F.timestamp_add("HOUR", F.lit(1), "_b"),
                                                F.timestamp_add("HOUR", F.lit(72), "_b"),
                                                F.expr("INTERVAL 1 HOUR"))).alias(TS))
    from hourglass.catalog.common import events
    from hourglass.sources.events import air_side, weather_side

    ev = events(spark, sf)
    fut = FC.future_inputs(weather_side(ev), air_side(ev), grid)
    return fut.groupBy(*KEYS).agg(F.count(F.lit(1)).alias("hours"), F.count_if(F.col("us_aqi").isNull()).alias("null_aqi"),
                                  F.min(TS).alias("first_ts"), F.max(TS).alias("last_ts"))


@register("forecast_frame", f"WITH {_FUT}\nSELECT location_id, timestamp, is_future, {r6('us_aqi', 'us_aqi')}, "
                            f"{r6('pm2_5', 'pm2_5')}, {r6('temperature_2m', 'temperature_2m')} FROM frame")
def q_forecast_frame(spark, sf):
    """History UNION future inputs, later source wins, target NULL after the boundary."""
    return rounded(_frame(spark, sf).select(*KEYS, TS, "is_future", "us_aqi", "pm2_5", "temperature_2m"))


@register("coverage_report", f"WITH {_FUT}\nSELECT location_id, count_if(NOT is_future) AS history_rows, count_if(is_future) AS future_rows, "
                             "count_if(NOT is_future AND us_aqi IS NULL) AS history_null_us_aqi, count_if(is_future AND us_aqi IS NULL) AS future_null_us_aqi, "
                             "count_if(NOT is_future AND pm2_5 IS NULL) AS history_null_pm2_5, count_if(is_future AND pm2_5 IS NULL) AS future_null_pm2_5 "
                             "FROM frame GROUP BY 1")
def q_coverage_report(spark, sf):
    """history/future rows and NULL targets on each side."""
    return A.coverage_report(_frame(spark, sf), F.col("is_future"), ["us_aqi", "pm2_5"], KEYS)


# --------------------------------------------------------------------------- M9, M10, M11, A17
_ATTR_SQL = (f"{_SPLIT},\nmu AS (SELECT " + ", ".join(f"avg(CAST({c} AS DOUBLE)) AS mu_{c}" for c in FEATS) + " FROM spl WHERE split = 'train'),\n"
             "te AS (SELECT * FROM spl WHERE split = 'test'),\nlong AS (" + " UNION ALL ".join(
                 f"SELECT location_id, timestamp, '{c}' AS feature, CAST({c} AS DOUBLE) AS feature_value, "
                 f"{dbl(FIXED_BETA.get(c, 0.0))} * (CAST({c} AS DOUBLE) - mu_{c}) AS contribution FROM te, mu" for c in FEATS) + ")")


@register("attribution", f"WITH {_ATTR_SQL}\nSELECT location_id, timestamp, feature, {r6('feature_value', 'feature_value')}, "
                         f"{r6('contribution', 'contribution')} FROM long")
def q_attribution(spark, sf):
    """M9: exact additive attribution of the linear model on the test split:
    one row per (row, feature) with value and ``beta * (x - train mean)``."""
    s = _split(spark, sf)
    return rounded(AT.linear_attribution(s.filter("split = 'test'"), s.filter("split = 'train'"), FIXED_BETA, FEATS, [*KEYS, TS]))


@register("global_importance", f"WITH {_ATTR_SQL}\nSELECT feature, {r6('avg(abs(contribution))', 'mean_abs')} FROM long GROUP BY 1")
def q_global_importance(spark, sf):
    """Mean absolute attribution per feature."""
    s = _split(spark, sf)
    return rounded(AT.linear_importance(s.filter("split = 'test'"), s.filter("split = 'train'"), FIXED_BETA, FEATS))


@register("top_importance", f"WITH {_ATTR_SQL},\ng AS (SELECT feature, avg(abs(contribution)) AS mean_abs FROM long GROUP BY 1)\n"
                            f"SELECT feature, {r6('mean_abs', 'mean_abs')}, CAST(row_number() OVER (ORDER BY mean_abs DESC, feature) AS INTEGER) AS rank "
                            "FROM g QUALIFY rank <= 20")
def q_top_importance(spark, sf):
    """O2 on A17: the 20 most important features, numbered."""
    s = _split(spark, sf)
    means = AT.linear_importance(s.filter("split = 'test'"), s.filter("split = 'train'"), FIXED_BETA, FEATS)
    return rounded(O.top_k(means, "mean_abs", 20, "feature"))


_LOCAL_POS = 10


@register("local_explanation",
          f"WITH {_ATTR_SQL},\npick AS (SELECT location_id, timestamp FROM te QUALIFY row_number() OVER (PARTITION BY location_id ORDER BY timestamp) = {_LOCAL_POS + 1})\n"
          f"SELECT l.location_id, l.timestamp, l.feature, {r6('l.feature_value', 'feature_value')}, {r6('l.contribution', 'contribution')}, "
          f"{r6('abs(l.contribution)', 'abs_contribution')}, CAST(row_number() OVER (PARTITION BY l.location_id ORDER BY abs(l.contribution) DESC, l.feature) AS INTEGER) AS rank "
          "FROM long l JOIN pick p ON l.location_id = p.location_id AND l.timestamp = p.timestamp QUALIFY rank <= 15")
def q_local_explanation(spark, sf):
    """M10 + O6 + O3: the 15 largest contributions for the test row at position 10 of each series."""
    s = _split(spark, sf)
    row = O.row_at(s.filter("split = 'test'"), KEYS, TS, _LOCAL_POS)
    return rounded(AT.local_explanation(row, s.filter("split = 'train'"), FIXED_BETA, FEATS, KEYS, TS, 15))


@register("prediction_error",
          f"WITH {_SPLIT},\npick AS (SELECT * FROM spl WHERE split = 'test' QUALIFY row_number() OVER (PARTITION BY location_id ORDER BY timestamp) = {_LOCAL_POS + 1})\n"
          f"SELECT location_id, timestamp, {r6('target_aqi', 'actual')}, {r6(_fixed_pred_sql(), 'predicted')}, "
          f"{r6(f'abs(target_aqi - ({_fixed_pred_sql()}))', 'abs_error')} FROM pick")
def q_prediction_error(spark, sf):
    """Absolute error of one prediction per series."""
    s = _split(spark, sf)
    row = O.row_at(s.filter("split = 'test'"), KEYS, TS, _LOCAL_POS)
    p = row.select(*KEYS, TS, F.col("target_aqi").alias("actual"), _fixed_pred().alias("predicted"))
    return rounded(p.withColumn("abs_error", F.abs(F.col("actual") - F.col("predicted"))))


# --------------------------------------------------------------------------- M16, M17
_AUDIT = {**{f"aqi_lag_{k}": ("us_aqi", k) for k in S.aqi_lags}, **{f"{p}_lag_{k}": (p, k) for p in S.pollutants for k in S.pollutant_lags}, "target_aqi": ("us_aqi", -1)}


def _audit_sql():
    parts = []
    for col, (src, k) in _AUDIT.items():
        fn = f"lag({src}, {k})" if k > 0 else f"lead({src}, {-k})"
        parts.append(f"SELECT '{col}' AS column_name, {k} AS shift, {col} AS stored, {fn} OVER ({W}) AS expected FROM raw_feat")
    return " UNION ALL ".join(parts)


@register("temporal_leakage_report",
          f"WITH {RAW_HOURLY_CTE}, raw_feat AS ({features_select()}),\nc AS ({_audit_sql()}),\n"
          "g AS (SELECT column_name, CAST(shift AS INTEGER) AS shift, count_if(stored IS NOT NULL AND expected IS NOT NULL) AS compared, "
          "count_if(stored IS NOT NULL AND expected IS NOT NULL AND stored <> expected) AS mismatches FROM c GROUP BY 1, 2)\n"
          "SELECT column_name, shift, compared, mismatches, mismatches = 0 AS passed FROM g UNION ALL "
          "SELECT '__verdict__', CAST(0 AS INTEGER), CAST(sum(compared) AS BIGINT), CAST(sum(mismatches) AS BIGINT), bool_and(mismatches = 0) FROM g")
def q_temporal_leakage_report(spark, sf):
    """Every stored lag/lead recomputed and compared, plus a verdict
    row that includes every check."""
    from hourglass.plans.leakage import temporal_leakage_report

    return temporal_leakage_report(features(spark, sf, drop_incomplete=False), KEYS, TS, _AUDIT)


_M16_NULLS = " + ".join(f"count_if({c} IS NULL)" for c in FEATS)


@register("structural_leakage_report",
          f"WITH {FEATURES_CTE},\na AS (SELECT event_type AS location_id, date_trunc('hour', ts) AS timestamp, min(event_id) AS arrival FROM events GROUP BY 1, 2),\n"
          "o AS (SELECT count_if(timestamp < prev) AS bad FROM (SELECT f.timestamp, lag(f.timestamp) OVER (PARTITION BY f.location_id ORDER BY arrival) AS prev "
          "FROM feat f JOIN a ON f.location_id = a.location_id AND f.timestamp = a.timestamp))\n"
          f"SELECT {r6('min(target_aqi)', 'target_min')}, {r6('max(target_aqi)', 'target_max')}, {r6('avg(target_aqi)', 'target_mean')}, "
          f"CAST({_M16_NULLS} AS BIGINT) AS feature_nulls, count_if(target_aqi IS NULL) AS target_nulls, count(*) AS rows, "
          "(SELECT CAST(bad AS BIGINT) FROM o) AS order_violations, true AS current_value_excluded, true AS no_future_like_inputs, "
          f"CAST({sum('_lag_' in c for c in FEATS)} AS INTEGER) AS lag_features, CAST({sum('_mean' in c for c in FEATS)} AS INTEGER) AS mean_features, "
          f"CAST({sum('_change_' in c for c in FEATS)} AS INTEGER) AS change_features, (SELECT bad FROM o) = 0 AND {_M16_NULLS} = 0 AND count_if(target_aqi IS NULL) = 0 AS passed FROM feat")
def q_structural_leakage_report(spark, sf):
    """Arrival order (an hour arrives with its first event), target summary, null
    counts and name-family guards in one row."""
    from hourglass.plans.leakage import structural_leakage_report

    ev = events(spark, sf)
    first = ev.groupBy(F.col("event_type").alias("location_id"), C.hour_trunc("ts").alias(TS)).agg(F.min("event_id").alias("arrival"))
    f = write_table(features(spark, sf).select(*KEYS, TS, "target_aqi", *FEATS).join(first, [*KEYS, TS]))
    return rounded(structural_leakage_report(f, KEYS, TS, FEATS, "target_aqi", ordinal="arrival"))


# --------------------------------------------------------------------------- fitted models (rows-only)
def _fit_inputs(spark, sf):
    s = _split(spark, sf)
    return s, s.filter("split = 'train'")


@register("ridge_model", None)
def q_ridge_model(spark, sf):
    """M2 + M5 + M7 + M8: ridge on the 70 scaled features, metrics per split."""
    s, train = _fit_inputs(spark, sf)
    fm = TR.fit_ridge(train, FEATS)
    return rounded(TR.evaluate_splits(fm.predict(s)).withColumn("model", F.lit("ridge")))


@register("forest_model", None)
def q_forest_model(spark, sf):
    """M3 + M6: random forest (20 trees), metrics per split."""
    s, train = _fit_inputs(spark, sf)
    fm = TR.fit_forest(train, FEATS, trees=20, max_depth=12)
    return rounded(TR.evaluate_splits(fm.predict(s)).withColumn("model", F.lit("random_forest")))


@register("boosted_model", None)
def q_boosted_model(spark, sf):
    """M4: gradient-boosted trees (20 rounds), metrics per split."""
    s, train = _fit_inputs(spark, sf)
    fm = TR.fit_boosted(train, FEATS, rounds=20, id_cols=[*KEYS, TS])
    return rounded(TR.evaluate_splits(fm.predict(s)).withColumn("model", F.lit("boosted_trees")))


@register("model_importance", None)
def q_model_importance(spark, sf):
    """M6 + O2: top 20 features of a 20-tree forest by importance."""
    _, train = _fit_inputs(spark, sf)
    fm = TR.fit_forest(train, FEATS, trees=20, max_depth=12)
    return rounded(O.top_k(TR.model_importance(spark, fm), "importance", 20, "feature"))


@register("ridge_forecast", None)
def q_ridge_forecast(spark, sf):
    """M14 + M15 with the fitted ridge: its raw-scale coefficients drive the fold."""
    _, train = _fit_inputs(spark, sf)
    fm = TR.fit_ridge(train, FEATS)
    b0, beta = fm.linear_terms(spark)
    return rounded(FC.backtest_linear(raw(spark, sf), b0, beta, KEYS, TS, HORIZON))


@register("boosted_forecast", None)
def q_boosted_forecast(spark, sf):
    """M14 + M15 for the tree champion (20 rounds): one fold per series that walks the trees."""
    _, train = _fit_inputs(spark, sf)
    fm = TR.fit_boosted(train, FEATS, rounds=20, id_cols=[*KEYS, TS])
    return rounded(FC.backtest_trees(raw(spark, sf), fm, KEYS, TS, HORIZON))
