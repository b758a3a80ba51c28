"""Sort/top-k/sample (O1-O6), set operations (U1-U2), projections."""

from __future__ import annotations

from pyspark.sql import functions as F

from hourglass.catalog import register
from hourglass.catalog.common import KEYS, TS, features, raw, rounded
from hourglass.checks.sqlfrag import FEATURES_CTE, RAW_HOURLY_CTE, W, features_select, not_null_all, r6
from hourglass.operators import ordering as O
from hourglass.operators import projections as P
from hourglass.operators import setops as U
from hourglass.operators.windows import chrono_split
from hourglass.schema import DEFAULT_SPEC as S

RAW_COLS = ["location_id", "timestamp", *S.weather, "us_aqi", *S.pollutants]
_INTS = {"relative_humidity_2m", "wind_direction_10m", "hour", "day_of_week", "day_of_month", "month", "is_weekend"}


def _sel(cols, src, extra=""):
    return "SELECT " + ", ".join(c if (c in _INTS or c in ("location_id", "timestamp")) else r6(c, c) for c in cols) \
        + (", " + extra if extra else "") + f" FROM {src}"


@register("sort_by_time", f"WITH {RAW_HOURLY_CTE}\n{_sel(RAW_COLS, 'raw')} ORDER BY location_id, timestamp")
def q_sort_by_time(spark, sf):
    """O1: the raw hourly table in (series, time) order (sink-side sort)."""
    return rounded(O.sort_by_time(raw(spark, sf), KEYS, TS))


@register("top_k", f"WITH {RAW_HOURLY_CTE}\nSELECT location_id, timestamp, {r6('us_aqi', 'us_aqi')}, "
                   "CAST(row_number() OVER (ORDER BY us_aqi DESC, location_id, timestamp) AS INTEGER) AS rank "
                   "FROM raw QUALIFY rank <= 20")
def q_top_k(spark, sf):
    """O2: the 20 highest hourly AQI values, numbered."""
    r = raw(spark, sf).select(*KEYS, TS, "us_aqi")
    return rounded(O.top_k(r, "us_aqi", 20, ["location_id", "timestamp"]))


@register("top_k_abs", f"WITH {FEATURES_CTE}\nSELECT location_id, timestamp, {r6('aqi_change_1h', 'aqi_change_1h')}, "
                       "CAST(row_number() OVER (PARTITION BY location_id ORDER BY abs(aqi_change_1h) DESC, timestamp) AS INTEGER) AS rank "
                       "FROM feat QUALIFY rank <= 15")
def q_top_k_abs(spark, sf):
    """O3: per series, the 15 hours with the largest absolute 1 h AQI change."""
    f = features(spark, sf).select(*KEYS, TS, "aqi_change_1h")
    return rounded(O.top_k_abs(f, "aqi_change_1h", 15, TS, KEYS))


@register("head_tail", f"WITH {RAW_HOURLY_CTE}\n"
                       f"SELECT 'head' AS part, location_id, timestamp, {r6('us_aqi', 'us_aqi')} FROM raw "
                       "QUALIFY row_number() OVER (PARTITION BY location_id ORDER BY timestamp) <= 5 UNION ALL "
                       f"SELECT 'tail', location_id, timestamp, {r6('us_aqi', 'us_aqi')} FROM raw "
                       "QUALIFY row_number() OVER (PARTITION BY location_id ORDER BY timestamp DESC) <= 5")
def q_head_tail(spark, sf):
    """First and last 5 hours of each series."""
    r = raw(spark, sf).select(*KEYS, TS, "us_aqi")
    return rounded(O.head(r, KEYS, TS, 5).withColumn("part", F.lit("head"))
                   .unionByName(O.tail(r, KEYS, TS, 5).withColumn("part", F.lit("tail"))))


_SPLIT = (f"{FEATURES_CTE},\nsp AS (SELECT *, row_number() OVER ({W}) AS _rn, count(*) OVER (PARTITION BY location_id) AS _n FROM feat),\n"
          "spl AS (SELECT *, CASE WHEN _rn <= floor(_n * 0.70::DOUBLE) THEN 'train' "
          "WHEN _rn <= floor(_n * 0.85::DOUBLE) THEN 'val' ELSE 'test' END AS split FROM sp)")


@register("seeded_sample", f"WITH {_SPLIT}\nSELECT location_id, timestamp, {r6('us_aqi', 'us_aqi')}, {r6('target_aqi', 'target_aqi')} "
                           "FROM spl WHERE split = 'test' "
                           "ORDER BY md5(concat_ws(':', location_id, CAST(timestamp AS VARCHAR), '42')), location_id, timestamp LIMIT 500")
def q_seeded_sample(spark, sf):
    """500 test rows in a stable hash order (md5 of key, time and seed 42)."""
    f = chrono_split(features(spark, sf), KEYS, TS).filter("split = 'test'").select(*KEYS, TS, "us_aqi", "target_aqi")
    return rounded(O.seeded_sample(f, [*KEYS, TS], 500, 42))


@register("row_at", f"WITH {RAW_HOURLY_CTE}\n{_sel(RAW_COLS, 'raw')} "
                    "QUALIFY row_number() OVER (PARTITION BY location_id ORDER BY timestamp) = 101")
def q_row_at(spark, sf):
    """The row at 0-based position 100 of each series."""
    return rounded(O.row_at(raw(spark, sf), KEYS, TS, 100))


@register("row_range", f"WITH {RAW_HOURLY_CTE}\nSELECT location_id, timestamp, {r6('us_aqi', 'us_aqi')} FROM raw "
                       "QUALIFY row_number() OVER (PARTITION BY location_id ORDER BY timestamp) - 1 BETWEEN 100 AND 199")
def q_row_range(spark, sf):
    """Rows at positions [100, 200) of each series."""
    return rounded(P.row_range(raw(spark, sf).select(*KEYS, TS, "us_aqi"), KEYS, TS, 100, 200))


_BOUNDARY = "b AS (SELECT location_id, max(timestamp) AS boundary FROM raw GROUP BY 1)"


@register("append_future",
          f"WITH {RAW_HOURLY_CTE}, {_BOUNDARY}\n"
          f"SELECT r.location_id, r.timestamp, {r6('r.us_aqi', 'us_aqi')} FROM raw r JOIN b USING (location_id) "
          "WHERE r.timestamp <= b.boundary - INTERVAL 72 HOUR UNION ALL "
          f"SELECT r.location_id, r.timestamp, {r6('r.us_aqi', 'us_aqi')} FROM raw r JOIN b USING (location_id) "
          "WHERE r.timestamp > b.boundary - INTERVAL 72 HOUR")
def q_append_future(spark, sf):
    """U1 + P10: history (up to 72 h before each series' end) UNION ALL the last 72 h."""
    r = raw(spark, sf).select(*KEYS, TS, "us_aqi")
    b = P.series_boundary(r, KEYS, TS).withColumn("boundary", F.timestamp_add("HOUR", F.lit(-72), "boundary"))
    return rounded(U.append_future(P.history_mask(r, KEYS, TS, b), P.future_mask(r, KEYS, TS, b)))


def _revised_air_sql():
    return ("rev AS (SELECT event_type AS location_id, date_trunc('hour', ts) AS timestamp, max(value) AS us_aqi "
            "FROM events WHERE event_type IS NOT NULL AND ts IS NOT NULL GROUP BY 1, 2)")


@register("upsert_by_time",
          f"WITH {RAW_HOURLY_CTE}, {_BOUNDARY}, {_revised_air_sql()},\n"
          "upd AS (SELECT rev.* FROM rev JOIN b USING (location_id) WHERE rev.timestamp > b.boundary - INTERVAL 72 HOUR),\n"
          "u AS (SELECT location_id, timestamp, us_aqi, 0 AS _src FROM raw UNION ALL SELECT location_id, timestamp, us_aqi, 1 FROM upd)\n"
          f"SELECT location_id, timestamp, {r6('us_aqi', 'us_aqi')} FROM u "
          "QUALIFY row_number() OVER (PARTITION BY location_id, timestamp ORDER BY _src DESC) = 1")
def q_upsert_by_time(spark, sf):
    """History plus revised values for the last 72 h; the later source wins per hour."""
    from hourglass.catalog.common import events
    from hourglass.functions.calendar import hour_trunc

    r = raw(spark, sf).select(*KEYS, TS, "us_aqi")
    ev = events(spark, sf).filter(F.col("event_type").isNotNull() & F.col("ts").isNotNull())
    rev = ev.groupBy(F.col("event_type").alias("location_id"), hour_trunc("ts").alias("timestamp")) \
        .agg(F.max("value").alias("us_aqi"))
    b = P.series_boundary(r, KEYS, TS).withColumn("boundary", F.timestamp_add("HOUR", F.lit(-72), "boundary"))
    upd = P.future_mask(rev, KEYS, TS, b)
    return rounded(U.upsert_by_time(r, upd, KEYS, TS))


_PROJ = [*S.feature_columns()]


@register("projection_ops",
          f"WITH {FEATURES_CTE}\nSELECT location_id, timestamp, 'v1' AS model_version, {r6('us_aqi', 'aqi_now')}, "
          + ", ".join(c if c in _INTS else r6(c, c) for c in _PROJ) + " FROM feat")
def q_projection_ops(spark, sf):
    """Drop absent/unused columns, rename, exact model column order, constant column."""
    f = features(spark, sf)
    f = P.drop_columns(f, ["us_aqi_pm2_5", "us_aqi_pm10", S.target])  # absent names are ignored
    f = P.rename(f, {"us_aqi": "aqi_now"})
    f = P.with_constant(f, "model_version", "v1")
    return rounded(P.select_ordered(f, ["location_id", "timestamp", "model_version", "aqi_now", *_PROJ]))


@register("drop_incomplete_any",
          f"WITH {RAW_HOURLY_CTE}, f AS ({features_select()})\nSELECT count(*) AS rows FROM f WHERE "
          + not_null_all(["location_id", "timestamp", *S.weather, "us_aqi", *S.pollutants, *S.calendar,
                          *S.aqi_lag_cols(), S.target, *S.pollutant_lag_cols(), *[c for c, _, _ in S.mean_cols()],
                          *[c for c, _, _ in S.change_cols()]]))
def q_drop_incomplete_any(spark, sf):
    """Rows left after dropping any row with a NULL in any column."""
    return P.drop_incomplete_any(features(spark, sf, drop_incomplete=False)).agg(F.count(F.lit(1)).alias("rows"))


@register("time_range_filter",
          f"WITH {RAW_HOURLY_CTE}, {_BOUNDARY}\nSELECT r.location_id, r.timestamp, {r6('r.us_aqi', 'us_aqi')} "
          "FROM raw r JOIN b USING (location_id) WHERE r.timestamp >= b.boundary - INTERVAL 5 HOUR")
def q_time_range_filter(spark, sf):
    """Rows within 5 hours of each series' last timestamp."""
    r = raw(spark, sf).select(*KEYS, TS, "us_aqi")
    b = P.series_boundary(r, KEYS, TS)
    j = r.join(b, KEYS)
    return rounded(P.time_range_filter(j, TS, F.col("boundary"), 5).drop("boundary"))
