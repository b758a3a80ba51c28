"""Feature build and window operators (E1, W1-W15, P-series on features)."""

from __future__ import annotations

from pyspark.sql import functions as F

from hourglass.catalog import register
from hourglass.catalog.common import KEYS, TS, events, features, raw, round_col, rounded
from hourglass.checks.sqlfrag import FEATURES_CTE, RAW_HOURLY_CTE, W, features_select, r6, trailing_mean
from hourglass.functions.calendar import hour_trunc
from hourglass.operators import windows as Wn
from hourglass.schema import DEFAULT_SPEC as S

FEATURE_COLS = S.feature_columns()
_DOUBLE_INT = {"hour", "day_of_week", "day_of_month", "month", "is_weekend", "relative_humidity_2m",
               "wind_direction_10m"}


def _sel(cols, src):
    return "SELECT " + ", ".join(c if c in _DOUBLE_INT or c in ("location_id", "timestamp", "split") else r6(c, c)
                                 for c in cols) + f" FROM {src}"


ALL_FEATURE_TABLE = ["location_id", "timestamp", *S.required_raw(), *FEATURE_COLS[12:], S.target]
ALL_FEATURE_TABLE = list(dict.fromkeys(["location_id", "timestamp", *S.weather, "us_aqi", *S.pollutants,
                                        *S.calendar, *S.aqi_lag_cols(), S.target, *S.pollutant_lag_cols(),
                                        *[c for c, _, _ in S.mean_cols()], *[c for c, _, _ in S.change_cols()]]))


@register("hourly_features", f"WITH {FEATURES_CTE}\n{_sel(ALL_FEATURE_TABLE, 'feat')}")
def q_hourly_features(spark, sf):
    """Raw hourly -> 70 features + target, incomplete rows dropped."""
    return rounded(features(spark, sf))


@register("hourly_features_chunked", f"WITH {FEATURES_CTE}\n{_sel(ALL_FEATURE_TABLE, 'feat')}")
def q_hourly_features_chunked(spark, sf):
    """E1 through halo chunks (96-row chunks, 72-row halo): the long-series
    plan, equal to ``hourly_features``."""
    from hourglass.plans.features import build_features_chunked

    return rounded(build_features_chunked(raw(spark, sf), chunk_rows=96).select(*ALL_FEATURE_TABLE))


@register("raw_hourly", f"WITH {RAW_HOURLY_CTE}\n{_sel(['location_id', 'timestamp', *S.weather, 'us_aqi', *S.pollutants], 'raw')}")
def q_raw_hourly(spark, sf):
    """J1 over the two hourly sides of events (E5 backfill join)."""
    return rounded(raw(spark, sf))


_LAG_COLS = ["location_id", "timestamp", *S.aqi_lag_cols(), *S.pollutant_lag_cols()]


@register("lags", f"WITH {RAW_HOURLY_CTE}, f AS ({features_select()})\n{_sel(_LAG_COLS, 'f')}")
def q_lags(spark, sf):
    """W1 + W2: AQI lags 1..72 and 24 pollutant lags, rows kept (NULL heads)."""
    return rounded(features(spark, sf, drop_incomplete=False).select(*_LAG_COLS))


@register("lead_target", f"WITH {RAW_HOURLY_CTE}\nSELECT location_id, timestamp, {r6('us_aqi', 'us_aqi')}, "
                         f"{r6(f'lead(us_aqi, 1) OVER ({W})', 'target_aqi')} FROM raw")
def q_lead_target(spark, sf):
    """W3."""
    r = raw(spark, sf)
    w = Wn.series_window(KEYS, TS)
    return rounded(r.select(*KEYS, TS, "us_aqi", Wn.lead_col("us_aqi", 1, w).alias("target_aqi")))


_MEAN_COLS = ["location_id", "timestamp", *[c for c, _, _ in S.mean_cols()]]


@register("rolling_prior", f"WITH {RAW_HOURLY_CTE}, f AS ({features_select()})\n{_sel(_MEAN_COLS, 'f')}")
def q_rolling_prior(spark, sf):
    """Strict prior-w means (NULL unless all w present), 14 columns."""
    return rounded(features(spark, sf, drop_incomplete=False).select(*_MEAN_COLS))


def _trailing_sql():
    cols = [f"{r6(trailing_mean(c, w), f'{c}_{w}h_trailing')}"
            for c, w in [("us_aqi", 3), ("us_aqi", 24), ("pm2_5", 6), ("ozone", 24)]]
    return f"WITH {RAW_HOURLY_CTE}\nSELECT location_id, timestamp, " + ", ".join(cols) + " FROM raw"


@register("rolling_trailing", _trailing_sql())
def q_rolling_trailing(spark, sf):
    """Trailing means ending at the current row, nulls skipped."""
    r = raw(spark, sf)
    w = Wn.series_window(KEYS, TS)
    return rounded(r.select(*KEYS, TS, *[Wn.rolling_mean_trailing(c, k, w).alias(f"{c}_{k}h_trailing")
                                         for c, k in [("us_aqi", 3), ("us_aqi", 24), ("pm2_5", 6), ("ozone", 24)]]))


_CHG_COLS = ["location_id", "timestamp", *[c for c, _, _ in S.change_cols()]]


@register("changes", f"WITH {RAW_HOURLY_CTE}, f AS ({features_select()})\n{_sel(_CHG_COLS, 'f')}")
def q_changes(spark, sf):
    """X - lag(x, k) for AQI 1/3/6/24 h and PM 1/24 h."""
    return rounded(features(spark, sf, drop_incomplete=False).select(*_CHG_COLS))


def _change_prior_sql():
    cols = [r6(f"lag(us_aqi, 1) OVER ({W}) - lag(us_aqi, {k + 1}) OVER ({W})", f"aqi_change_{k}h_prior")
            for k in S.aqi_changes]
    return f"WITH {RAW_HOURLY_CTE}\nSELECT location_id, timestamp, " + ", ".join(cols) + " FROM raw"


@register("change_prior", _change_prior_sql())
def q_change_prior(spark, sf):
    """Forecast-path AQI change lag1 - lag(k+1)."""
    r = raw(spark, sf)
    w = Wn.series_window(KEYS, TS)
    return rounded(r.select(*KEYS, TS, *[Wn.change_prior("us_aqi", k, w).alias(f"aqi_change_{k}h_prior")
                                         for k in S.aqi_changes]))


SPLIT_SQL = (f"WITH {FEATURES_CTE},\nsp AS (SELECT *, row_number() OVER ({W}) AS _rn, count(*) OVER (PARTITION BY location_id) AS _n FROM feat),\n"
             "spl AS (SELECT *, CASE WHEN _rn <= floor(_n * 0.70::DOUBLE) THEN 'train' "
             "WHEN _rn <= floor(_n * 0.85::DOUBLE) THEN 'val' ELSE 'test' END AS split FROM sp)")


@register("chrono_split", f"{SPLIT_SQL}\nSELECT location_id, timestamp, split FROM spl")
def q_chrono_split(spark, sf):
    """70/15/15 chronological split per series, cut = floor(n * f) in DOUBLE."""
    return Wn.chrono_split(features(spark, sf), KEYS, TS).select(*KEYS, TS, "split")


@register("split_extents", f"{SPLIT_SQL}\nSELECT location_id, split, count(*) AS rows, min(timestamp) AS first_ts, "
                           "max(timestamp) AS last_ts FROM spl GROUP BY 1, 2")
def q_split_extents(spark, sf):
    """Rows and first/last timestamp per split."""
    from hourglass.operators.aggregates import split_extents

    return split_extents(Wn.chrono_split(features(spark, sf), KEYS, TS), TS, "split", KEYS)


@register("block_of_24", f"WITH {RAW_HOURLY_CTE}\nSELECT location_id, timestamp, "
                         f"CAST(floor((row_number() OVER ({W}) - 1) / 24) + 1 AS INTEGER) AS block FROM raw")
def q_block_of_24(spark, sf):
    """(position // 24) + 1 per series."""
    return raw(spark, sf).select(*KEYS, TS, Wn.block_number(KEYS, TS, 24).alias("block"))


_DEDUP_BASE = ("SELECT event_id, ts, user_id, event_type, value, date_trunc('hour', ts) AS hour_ts, "
               "row_number() OVER (PARTITION BY user_id, date_trunc('hour', ts) ORDER BY ts {o}, event_id {o}) AS _rn "
               "FROM events WHERE user_id IS NOT NULL AND ts IS NOT NULL")


def _dedup_spark(spark, sf, keep):
    ev = events(spark, sf).filter(F.col("user_id").isNotNull() & F.col("ts").isNotNull()) \
        .select("user_id", hour_trunc("ts").alias("hour_ts"), "event_id", "ts", "event_type", "value")
    fn = Wn.dedup_keep_last if keep == "last" else Wn.dedup_keep_first
    return rounded(fn(ev, ["user_id"], "hour_ts", ["ts", "event_id"]))


@register("dedup_keep_last", f"SELECT user_id, hour_ts, event_id, ts, event_type, {r6('value', 'value')} "
                             f"FROM ({_DEDUP_BASE.format(o='DESC')}) WHERE _rn = 1")
def q_dedup_keep_last(spark, sf):
    """One event per (user, hour): the latest by (ts, event_id)."""
    return _dedup_spark(spark, sf, "last")


@register("dedup_keep_first", f"SELECT user_id, hour_ts, event_id, ts, event_type, {r6('value', 'value')} "
                              f"FROM ({_DEDUP_BASE.format(o='ASC')}) WHERE _rn = 1")
def q_dedup_keep_first(spark, sf):
    """One event per (user, hour): the earliest by (ts, event_id)."""
    return _dedup_spark(spark, sf, "first")


_SEQ_FEATS = ["us_aqi", "pm2_5", "nitrogen_dioxide"]


@register("lookback_sequences",
          f"WITH {FEATURES_CTE},\ns AS (SELECT location_id, timestamp, target_aqi, "
          f"list([{r6('us_aqi')}, {r6('pm2_5')}, {r6('nitrogen_dioxide')}]) "
          f"OVER ({W} ROWS BETWEEN 24 PRECEDING AND 1 PRECEDING) AS sequence FROM feat)\n"
          f"SELECT location_id, timestamp, {r6('target_aqi', 'target_aqi')}, sequence FROM s WHERE len(sequence) = 24")
def q_lookback_sequences(spark, sf):
    """Previous 24 rows of features as a matrix, target of the current row."""
    f = features(spark, sf).select(*KEYS, TS, "target_aqi", *[round_col(F.col(c)).alias(c) for c in _SEQ_FEATS])
    seq = Wn.lookback_sequences(f, KEYS, TS, _SEQ_FEATS, 24)
    return rounded(seq.select(*KEYS, TS, "target_aqi", "sequence"))


@register("first_last_rows",
          f"WITH {RAW_HOURLY_CTE}\nSELECT location_id, min(timestamp) AS first_ts, {r6('arg_min(us_aqi, timestamp)', 'first_aqi')}, "
          f"max(timestamp) AS last_ts, {r6('arg_max(us_aqi, timestamp)', 'last_aqi')} FROM raw GROUP BY 1")
def q_first_last_rows(spark, sf):
    """First and last row per series."""
    fl = Wn.first_last_rows(raw(spark, sf).select(*KEYS, TS, "us_aqi"), KEYS, TS)
    return rounded(fl.select(*KEYS, F.col("first_row.timestamp").alias("first_ts"),
                             F.col("first_row.us_aqi").alias("first_aqi"),
                             F.col("last_row.timestamp").alias("last_ts"), F.col("last_row.us_aqi").alias("last_aqi")))


_AUDIT = {**{f"aqi_lag_{k}": k for k in S.aqi_lags}, "target_aqi": -1}


def _audit_sql():
    parts = []
    for col, k in _AUDIT.items():
        fn = f"lag(us_aqi, {k})" if k > 0 else f"lead(us_aqi, {-k})"
        parts.append(f"SELECT '{col}' AS column_name, {k} AS shift, {col} AS stored, {fn} OVER ({W}) AS expected FROM feat")
    u = " UNION ALL ".join(parts)
    return (f"WITH {FEATURES_CTE},\nc AS ({u})\nSELECT column_name, CAST(shift AS INTEGER) AS shift, "
            "count_if(stored IS NOT NULL AND expected IS NOT NULL) AS compared, "
            "count_if(stored IS NOT NULL AND expected IS NOT NULL AND stored <> expected) AS mismatches, "
            "count_if(stored IS NOT NULL AND expected IS NOT NULL AND stored <> expected) = 0 AS passed "
            "FROM c GROUP BY 1, 2")


@register("lag_audit", _audit_sql())
def q_lag_audit(spark, sf):
    """W15/M17 core: recompute lags and lead on the cleaned table and compare."""
    return Wn.lag_audit(features(spark, sf), KEYS, TS, "us_aqi", _AUDIT)
