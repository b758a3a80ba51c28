"""File round trips, contracts, model persistence and the ledger in use (S1-S4, S6, S9,
P1, P17, P18, J5, M15, M18, M19).  Files go to the cluster's shared folder."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F
from pyspark.sql import types as T

from hourglass.catalog import register
from hourglass.catalog.common import KEYS, TS, events, features, raw, rounded
from hourglass.catalog.q_model import _SPLIT, FIXED_B0, FIXED_BETA, HORIZON, _ledger, _MET, _split
from hourglass.checks.sqlfrag import FEATURES_CTE, RAW_HOURLY_CTE, forecast_sql, r6, rounded_select
from hourglass.functions.calendar import format_date, parse_ts_utc
from hourglass.operators.aggregates import attach_scalars
from hourglass.operators.guards import write_checked
from hourglass.operators.joins import latest_features
from hourglass.plans import forecast as FC
from hourglass.plans import ledger as L
from hourglass.plans import training as TR
from hourglass.schema import DEFAULT_SPEC as S
from hourglass.schema import RAW_HOURLY_SCHEMA
from hourglass.session import checkpoint_dir, write_table
from hourglass.sources import files as FI
from hourglass.sources import payloads as PL
from hourglass.sources.events import air_side

_COLS = ["location_id", "timestamp", *S.weather, "us_aqi", *S.pollutants]
_INTS = ("relative_humidity_2m", "wind_direction_10m")
#: The raw hourly schema without the provider's sub-indices, in its order (CSV is read by position).
_SCHEMA = T.StructType([f for f in RAW_HOURLY_SCHEMA if f.name in _COLS])
_RAW_ROUNDED = f"WITH {RAW_HOURLY_CTE}\nSELECT " + ", ".join(
    c if c in ("location_id", "timestamp") or c in _INTS else r6(c, c) for c in _COLS) + " FROM raw"


def _path(spark, kind: str) -> str:
    return f"{checkpoint_dir(spark).rstrip('/')}/{kind}/{uuid.uuid4().hex}"


@register("csv_round_trip", _RAW_ROUNDED)
def q_csv_round_trip(spark, sf):
    """S3 then S1: the hourly table written as CSV and read back by its schema."""
    path = _path(spark, "csv")
    FI.write_csv(raw(spark, sf).select(*_SCHEMA.names), path)
    return rounded(FI.read_hourly_csv(spark, path, _SCHEMA).select(*_COLS))


@register("csv_to_parquet", _RAW_ROUNDED)
def q_csv_to_parquet(spark, sf):
    """CSV to Parquet clustered by series, and its scan."""
    src, dst = _path(spark, "csv"), _path(spark, "parquet")
    FI.write_csv(raw(spark, sf).select(*_SCHEMA.names), src)
    return rounded(FI.csv_to_parquet(spark, src, dst, _SCHEMA).select(*_COLS))


@register("features_round_trip", f"WITH {FEATURES_CTE}\nSELECT location_id, timestamp, hour, {r6('aqi_lag_24', 'aqi_lag_24')}, "
                                 f"{r6('pm2_5_24h_mean', 'pm2_5_24h_mean')} FROM feat WHERE hour >= 12")
def q_features_round_trip(spark, sf):
    """S4 then S2: the feature table written clustered by series; a pruned, filtered scan."""
    path = _path(spark, "features")
    FI.write_features(features(spark, sf), path)
    return rounded(FI.read_features(spark, path, [*KEYS, TS, "hour", "aqi_lag_24", "pm2_5_24h_mean"]).filter("hour >= 12"))


@register("guarded_features", f"WITH {FEATURES_CTE}\nSELECT location_id, timestamp, {r6('target_aqi', 'target_aqi')}, "
                              "strftime(timestamp, '%Y-%m-%d') AS day, date_trunc('day', timestamp) AS day_start FROM feat")
def q_guarded_features(spark, sf):
    """P17 and P18 hold on the cleaned feature table, counted while it is written; P1 parses the day's text back."""
    f = features(spark, sf).select(*KEYS, TS, "target_aqi")
    f = write_checked(f, _path(spark, "guarded"), not_null=[*KEYS, TS, "target_aqi"], cols=3).withColumn("day", format_date(TS))
    return rounded(f.withColumn("day_start", parse_ts_utc("day", "yyyy-MM-dd")))


_VIEW = S.feature_columns()
_INT_FEATS = {*S.calendar, *_INTS}


@register("latest_feature_view", f"WITH {FEATURES_CTE},\nlast AS (SELECT * FROM feat QUALIFY row_number() OVER (PARTITION BY location_id ORDER BY timestamp DESC) = 1)\n"
          + rounded_select({"location_id": "string", "timestamp": "timestamp", **{c: "int" if c in _INT_FEATS else "double" for c in _VIEW}}, "last"))
def q_latest_feature_view(spark, sf):
    """J5 over the real view: the newest 70 features of every series."""
    f = features(spark, sf).select(*KEYS, TS, *_VIEW)
    ids = raw(spark, sf).select(*KEYS).distinct()
    return rounded(latest_features(f, ids, KEYS, TS, _VIEW).filter(F.col(TS).isNotNull()))


@register("payload_list_profile", f"WITH {RAW_HOURLY_CTE}\nSELECT location_id, date_trunc('day', timestamp) AS period, "
                                  "CAST(count(*) AS INTEGER) AS records, min(timestamp) AS first_ts, max(timestamp) AS last_ts, "
                                  f"CAST(34.0 AS DOUBLE) AS latitude, CAST(71.5 AS DOUBLE) AS longitude FROM air GROUP BY 1, 2")
def q_payload_list_profile(spark, sf):
    """S6 for the second provider: payloads with a ``list`` of records."""
    p = PL.build_list_payloads(air_side(events(spark, sf)), KEYS, TS, ["us_aqi", "pm2_5"], F.lit(34.0), F.lit(71.5))
    return PL.list_profile(p, "payload", ["us_aqi", "pm2_5"], [*KEYS, "period"])


# --------------------------------------------------------------------------- M15, M18, M19
_ORIGINS = (0, 24, 48)
_ORIGIN_RAW = (RAW_HOURLY_CTE.replace("\nraw AS (", "\nraw_all AS (") + ",\nraw AS (SELECT location_id || '@' || o AS location_id, * EXCLUDE (location_id, o, rn) "
               "FROM (SELECT raw_all.*, o, row_number() OVER (PARTITION BY location_id, o ORDER BY timestamp DESC) AS rn FROM raw_all, "
               f"(VALUES {', '.join(f'({o})' for o in _ORIGINS)}) t(o)) WHERE rn > o)")


@register("backtest_origins", "WITH RECURSIVE " + forecast_sql(FIXED_B0, FIXED_BETA, HORIZON, "target").replace(RAW_HOURLY_CTE, _ORIGIN_RAW)
          + f"\nSELECT split_part(fc.location_id, '@', 1) AS location_id, CAST(split_part(fc.location_id, '@', 2) AS INTEGER) AS origin, fc.timestamp, step, "
            f"forecast_day, {r6('predicted_aqi', 'predicted_aqi')}, {r6('raw.us_aqi', 'future_us_aqi')} "
            "FROM fc LEFT JOIN raw ON fc.location_id = raw.location_id AND fc.timestamp = raw.timestamp")
def q_backtest_origins(spark, sf):
    """M15 from three origins (the end of each series, one and two days earlier)."""
    return rounded(FC.backtest_origins(raw(spark, sf), FIXED_B0, FIXED_BETA, _ORIGINS, KEYS, TS, HORIZON))


@register("model_reload", f"WITH {_SPLIT}\nSELECT split, count(*) AS rows, CAST(0 AS BIGINT) AS different FROM spl GROUP BY 1")
def q_model_reload(spark, sf):
    """A fitted ridge saved to the shared folder and loaded scores every row alike."""
    s = _split(spark, sf)
    fitted = TR.fit_ridge(s.filter("split = 'train'"), _VIEW)
    path = _path(spark, "model")
    TR.save_model(fitted, path)
    both = TR.load_model(spark, path).predict(fitted.predict(s, "a").select(*s.columns, "a"), "b")
    return both.groupBy("split").agg(F.count(F.lit(1)).alias("rows"), F.count_if(~F.col("a").eqNullSafe(F.col("b"))).alias("different"))


@register("ledger_alias", f"WITH {_MET}\nSELECT 'champion' AS alias, model, CAST(2 AS INTEGER) AS version, {r6('rmse', 'rmse')} "
                          "FROM met WHERE split = 'test' ORDER BY rmse LIMIT 1")
def q_ledger_alias(spark, sf):
    """M19 in use: runs appended in two writes, read back, the champion's alias recorded and looked up."""
    runs, aliases = _path(spark, "ledger"), _path(spark, "aliases")
    new = _ledger(spark, sf).withColumn("alias", F.lit(None).cast("string"))
    for version in (1, 2):
        L.append_runs(new.filter(F.col("version") == version), runs)
    L.record_alias(L.read_ledger(spark, runs), aliases, "rmse", "champion")
    found = L.resolve_alias(L.read_ledger(spark, runs), L.read_aliases(spark, aliases), "champion")
    return rounded(found.select("alias", "model", "version", F.col("metrics")["rmse"].alias("rmse")))


@register("model_selection", f"WITH {RAW_HOURLY_CTE}, n AS (SELECT count(DISTINCT location_id) * {HORIZON} AS hours FROM raw)\n"
                             "SELECT CAST(3 AS BIGINT) AS models, true AS saved_models_score_alike, true AS alias_is_rank_one, hours AS forecast_hours, hours AS predictions FROM n")
def q_model_selection(spark, sf, trees: int = 20, rounds: int = 20, max_depth: int = 12):
    """Fit ridge, forest and boosted trees, rank, save, record, load by alias, and forecast
    with the winner (sizes cut for this entry; the functions default to the full ones).  Every saved
    model is loaded again and scores the test rows as the ledger says, and the alias names the best of these scores."""
    from hourglass.plans import selection as SE
    from hourglass.plans import trees as T

    path = _path(spark, "selection")
    split = _split(spark, sf)
    ranked = SE.select_model(split, SE.candidates(_VIEW, trees=trees, rounds=rounds, max_depth=max_depth), path)
    best = SE.load_selected(spark, path)
    rows = None
    for name in ("ridge", "random_forest", "boosted_trees"):
        again = TR.load_model(spark, f"{path}/models/{name}").predict(split.filter("split = 'test'"))
        m = TR.evaluate_splits(again).select(F.lit(name).alias("model"), F.col("rmse").alias("_again"))
        rows = m if rows is None else rows.unionByName(m)
    table = ranked.join(rows, "model", "left").agg(
        F.count(F.lit(1)).alias("models"), F.bool_and(F.coalesce(F.abs(F.col("rmse") - F.col("_again")) <= 1e-9 * F.col("rmse"), F.lit(False))).alias("saved_models_score_alike"),
        (F.min_by("model", "_again") == F.lit(best.name)).alias("alias_is_rank_one"))
    hourly = raw(spark, sf)
    if best.kind == "linear":
        b0, beta = best.linear_terms(spark)
        fc = FC.backtest_linear(hourly, b0, beta, KEYS, TS, HORIZON)
    else:
        fc = FC.backtest_trees(hourly, best if best.kind == "trees" else T.from_ml(best), KEYS, TS, HORIZON)
    hours = fc.agg(F.count(F.lit(1)).alias("forecast_hours"), F.count("predicted_aqi").alias("predictions"))
    return attach_scalars(table, hours)


@register("leakage_flags", f"WITH {FEATURES_CTE},\na AS (SELECT event_type AS location_id, date_trunc('hour', ts) AS timestamp, min(event_id) AS arrival FROM events GROUP BY 1, 2),\n"
                           "o AS (SELECT count_if(timestamp < prev) = 0 AS ok FROM (SELECT f.timestamp, lag(f.timestamp) OVER (PARTITION BY f.location_id ORDER BY arrival) AS prev "
                           "FROM feat f JOIN a ON f.location_id = a.location_id AND f.timestamp = a.timestamp)),\n"
                           "b AS (SELECT count(*) < 2 AS ok FROM feat GROUP BY location_id)\n"
                           "SELECT 'inputs' AS inputs, false AS target_in_inputs, false AS current_in_inputs, '' AS suspicious_inputs, ok AS time_ordered, ok AS passed FROM o UNION ALL "
                           "SELECT 'inputs and leaks', true, true, 'target_aqi', ok, false FROM o UNION ALL "
                           "SELECT 'newest first', false, false, '', bool_and(ok), bool_and(ok) FROM b")
def q_leakage_flags(spark, sf):
    """M17's flags for the 70 inputs, for the same with the target and the current value added, and for
    rows that arrive newest first.  An hour arrives with its first event."""
    from hourglass.functions.calendar import hour_trunc
    from hourglass.plans.leakage import leakage_flags

    first = events(spark, sf).groupBy(F.col("event_type").alias("location_id"), hour_trunc("ts").alias(TS)).agg(F.min("event_id").alias("arrival"))
    f = write_table(features(spark, sf).select(*KEYS, TS).join(first, [*KEYS, TS]))
    rows = [("inputs", f, _VIEW), ("inputs and leaks", f, [*_VIEW, "us_aqi", "target_aqi"]),
            ("newest first", f.withColumn("arrival", -F.unix_micros(F.col(TS).cast("timestamp"))), _VIEW)]
    out = None
    for name, table, inputs in rows:
        one = leakage_flags(table, KEYS, TS, inputs).withColumn("inputs", F.lit(name))
        out = one if out is None else out.unionByName(one)
    return out
