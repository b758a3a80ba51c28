"""Profiling and aggregate operators (A1-A12, A16, A18), scalar functions (F*)."""

from __future__ import annotations

from pyspark.sql import functions as F

from hourglass.catalog import register
from hourglass.catalog.common import KEYS, TS, events, features, raw, rounded
from hourglass.sources.events import read_table
from hourglass.checks.sqlfrag import FEATURES_CTE, RAW_HOURLY_CTE, W, errors_sql, features_select, r6
from hourglass.functions import calendar as C
from hourglass.functions.numeric import aqi_category, round_half_even, safe_div
from hourglass.operators import aggregates as A
from hourglass.operators.guards import all_true, monotonic_report
from hourglass.schema import AQI_CATEGORY_BOUNDS, DEFAULT_SPEC as S
from hourglass.session import write_table

RAW_COLS = ["location_id", "timestamp", *S.weather, "us_aqi", *S.pollutants]
NUM_RAW = [*S.weather, "us_aqi", *S.pollutants]


@register("extent", f"WITH {RAW_HOURLY_CTE}\nSELECT location_id, count(*) AS rows, CAST({len(RAW_COLS)} AS INTEGER) AS columns, "
                    "min(timestamp) AS first_ts, max(timestamp) AS last_ts FROM raw GROUP BY 1")
def q_extent(spark, sf):
    """A1: rows, columns, first/last timestamp per series."""
    return A.extent(raw(spark, sf), TS, KEYS)


_FEAT_ALL = [c for c in ["location_id", "timestamp", *NUM_RAW, *S.calendar, *S.aqi_lag_cols(), S.target,
                         *S.pollutant_lag_cols(), *[c for c, _, _ in S.mean_cols()],
                         *[c for c, _, _ in S.change_cols()]]]


def _null_sql():
    parts = [f"SELECT '{c}' AS column_name, count_if({c} IS NULL) AS nulls FROM f" for c in _FEAT_ALL]
    body = " UNION ALL ".join(parts)
    return (f"WITH {RAW_HOURLY_CTE}, f AS ({features_select()}), n AS ({body})\n"
            "SELECT column_name, nulls FROM n UNION ALL SELECT '__total__', CAST(sum(nulls) AS BIGINT) FROM n")


@register("null_counts", _null_sql())
def q_null_counts(spark, sf):
    """Per-column and total NULL counts of the feature table before P6."""
    f = features(spark, sf, drop_incomplete=False).select(*_FEAT_ALL)
    return A.null_counts(f)


_DUP_SQL = """
SELECT 'user_hour' AS scope, CAST(coalesce(sum(n - 1), 0) AS BIGINT) AS duplicates, count(*) AS distinct_values
  FROM (SELECT count(*) AS n FROM events GROUP BY user_id, date_trunc('hour', ts))
UNION ALL
SELECT 'timestamp', CAST(coalesce(sum(n - 1), 0) AS BIGINT), count(*) FROM (SELECT count(*) AS n FROM events GROUP BY ts)
UNION ALL
SELECT 'date', CAST(coalesce(sum(n - 1), 0) AS BIGINT), count(*) FROM (SELECT count(*) AS n FROM events GROUP BY CAST(ts AS DATE))
UNION ALL
SELECT 'whole_row', CAST(coalesce(sum(n - 1), 0) AS BIGINT), count(*)
  FROM (SELECT count(*) AS n FROM events GROUP BY event_id, ts, user_id, event_type, value, props)
"""


@register("duplicate_count", _DUP_SQL)
def q_duplicate_count(spark, sf):
    """A3: rows after the first occurrence, by (user, hour), timestamp, date, whole row."""
    ev = events(spark, sf)
    scopes = {
        "user_hour": ev.select("user_id", C.hour_trunc("ts").alias("h")),
        "timestamp": ev.select("ts"),
        "date": ev.select(C.date_of("ts").alias("d")),
        "whole_row": ev,
    }
    out = None
    for name, df in scopes.items():
        d = A.duplicate_count(df).select(F.lit(name).alias("scope"), "duplicates", "distinct_values")
        out = d if out is None else out.unionByName(d)
    return out


def _describe_sql():
    parts = []
    for c in NUM_RAW:
        v = f"CAST({c} AS DOUBLE)"
        parts.append(
            f"SELECT location_id, '{c}' AS column_name, count({v}) AS count, {r6(f'avg({v})', 'mean')}, "
            f"{r6(f'stddev_samp({v})', 'std')}, {r6(f'min({v})', 'min')}, "
            f"{r6(f'quantile_cont({v}, 0.25)', 'p25')}, {r6(f'quantile_cont({v}, 0.5)', 'p50')}, "
            f"{r6(f'quantile_cont({v}, 0.75)', 'p75')}, {r6(f'max({v})', 'max')} FROM raw GROUP BY location_id")
    return f"WITH {RAW_HOURLY_CTE}\n" + "\nUNION ALL\n".join(parts)


@register("describe", _describe_sql())
def q_describe(spark, sf):
    """A4: count, mean, std, min, exact quartiles, max per series and column.
    The hourly table feeds about fifteen branches (moments, the range sort, its
    per-partition counts, the picked order statistics), so it is written once
    to the shared checkpoint folder instead of being re-aggregated per branch."""
    return rounded(A.describe(write_table(raw(spark, sf)), NUM_RAW, KEYS))


@register("target_stats", f"WITH {FEATURES_CTE}\nSELECT location_id, {r6('avg(target_aqi)', 'mean')}, "
                          f"{r6('min(target_aqi)', 'min')}, {r6('max(target_aqi)', 'max')}, "
                          f"{r6('stddev_samp(target_aqi)', 'std')}, {r6('quantile_cont(target_aqi, 0.5)', 'median')} "
                          "FROM feat GROUP BY 1")
def q_target_stats(spark, sf):
    """A5: mean, median, min, max, std of the target per series."""
    return rounded(A.target_stats(write_table(features(spark, sf).select(*KEYS, "target_aqi")), "target_aqi", KEYS))


@register("hours_per_day", f"WITH {RAW_HOURLY_CTE}\nSELECT location_id, CAST(CAST(timestamp AS DATE) AS VARCHAR) AS date, count(*) AS hours "
                           "FROM raw GROUP BY 1, 2")
def q_hours_per_day(spark, sf):
    """Observations per calendar day per series."""
    return rounded(A.hours_per_day(raw(spark, sf), TS, KEYS))


@register("day_completeness",
          f"WITH {RAW_HOURLY_CTE}, d AS (SELECT location_id, CAST(timestamp AS DATE) AS date, count(*) AS hours FROM raw GROUP BY 1, 2)\n"
          "SELECT location_id, count(*) AS days, count_if(hours < 24) AS incomplete_days, count_if(hours = 24) AS complete_days, "
          f"min(hours) AS min_hours, max(hours) AS max_hours, {r6('avg(hours)', 'mean_hours')}, {r6('stddev_samp(hours)', 'std_hours')}, "
          f"{r6('quantile_cont(hours, 0.25)', 'p25_hours')}, {r6('quantile_cont(hours, 0.5)', 'p50_hours')}, "
          f"{r6('quantile_cont(hours, 0.75)', 'p75_hours')} FROM d GROUP BY 1")
def q_day_completeness(spark, sf):
    """Days, days with fewer than 24 hours, full days."""
    return rounded(A.day_completeness(raw(spark, sf), TS, KEYS))


_DAILY_MEANS = ["us_aqi", "pm2_5", "pm10", "carbon_monoxide", "nitrogen_dioxide", "sulphur_dioxide", "ozone",
                "temperature_2m", "relative_humidity_2m", "pressure_msl", "wind_speed_10m", "wind_direction_10m"]


def _daily_sql():
    cols = [r6(f"avg({c})", f"{c}_mean") for c in _DAILY_MEANS]
    cols += [r6("max(temperature_2m)", "temperature_2m_max"), r6("min(temperature_2m)", "temperature_2m_min"),
             r6("sum(precipitation)", "precipitation_sum")]
    return (f"WITH {RAW_HOURLY_CTE}\nSELECT location_id, CAST(CAST(timestamp AS DATE) AS VARCHAR) AS date, " + ", ".join(cols)
            + " FROM raw GROUP BY 1, 2")


@register("daily_summary", _daily_sql())
def q_daily_summary(spark, sf):
    """12 daily means, temperature max/min, precipitation sum."""
    return rounded(A.daily_summary(raw(spark, sf), TS, KEYS, _DAILY_MEANS))


def _category_sql(col="us_aqi"):
    case = "CASE " + " ".join(f"WHEN {col} <= {float(b)} AND NOT isnan({col}) THEN '{n}'" for b, n in AQI_CATEGORY_BOUNDS) \
        + " ELSE 'Hazardous' END"
    return case


@register("category_distribution",
          f"WITH {RAW_HOURLY_CTE}, c AS (SELECT location_id, {_category_sql()} AS aqi_category, count(*) AS count FROM raw GROUP BY 1, 2)\n"
          f"SELECT location_id, aqi_category, count, {r6('round_even(count * 100.0 / sum(count) OVER (PARTITION BY location_id), 2)', 'percent')} FROM c")
def q_category_distribution(spark, sf):
    """A9 + F7: AQI band counts and percent share per series."""
    r = raw(spark, sf).withColumn("aqi_category", aqi_category("us_aqi"))
    return rounded(A.category_distribution(r, "aqi_category", KEYS))


_HIST_SQL = f"""WITH {RAW_HOURLY_CTE},
mm AS (SELECT min(us_aqi) AS lo, max(us_aqi) AS hi FROM raw),
b AS (SELECT CAST(CASE WHEN hi = lo THEN 0 ELSE least(floor((us_aqi - lo) / ((hi - lo) / 30)), 29) END AS INTEGER) AS bin, count(*) AS n
      FROM raw, mm WHERE us_aqi IS NOT NULL GROUP BY 1),
g AS (SELECT CAST(range AS INTEGER) AS bin, lo, hi FROM range(30), mm)
SELECT g.bin, {r6('lo + (hi - lo) * g.bin / 30', 'bin_start')}, {r6('lo + (hi - lo) * (g.bin + 1) / 30', 'bin_end')},
       CAST(coalesce(b.n, 0) AS BIGINT) AS count
FROM g LEFT JOIN b ON g.bin = b.bin"""


@register("histogram", _HIST_SQL)
def q_histogram(spark, sf):
    """A10: 30 equal-width bins of hourly AQI, empty bins filled."""
    return rounded(A.histogram(raw(spark, sf), "us_aqi", 30))


_SPLIT_FEAT = (f"{FEATURES_CTE},\nsp AS (SELECT *, row_number() OVER ({W}) AS _rn, count(*) OVER (PARTITION BY location_id) AS _n FROM feat),\n"
               "spl AS (SELECT *, CASE WHEN _rn <= floor(_n * 0.70::DOUBLE) THEN 'train' "
               "WHEN _rn <= floor(_n * 0.85::DOUBLE) THEN 'val' ELSE 'test' END AS split FROM sp)")


@register("regression_metrics",
          f"WITH {_SPLIT_FEAT}\nSELECT location_id, split, {errors_sql('target_aqi', 'us_aqi')} FROM spl GROUP BY 1, 2")
def q_regression_metrics(spark, sf):
    """MAE, RMSE, R^2 of the persistence prediction (next hour = this hour)
    per series and split."""
    from hourglass.operators.windows import chrono_split

    f = chrono_split(features(spark, sf), KEYS, TS)
    return rounded(A.regression_metrics(f, "target_aqi", "us_aqi", [*KEYS, "split"]))


@register("distinct_values", "SELECT DISTINCT event_type FROM events")
def q_distinct_values(spark, sf):
    """A16."""
    return A.distinct_values(events(spark, sf), "event_type")


@register("all_true",
          f"WITH {FEATURES_CTE}\nSELECT bool_and(coalesce(target_aqi IS NOT NULL, false)) AS target_present, "
          "bool_and(coalesce(us_aqi >= 0, false)) AS aqi_nonnegative, "
          "bool_and(coalesce(hour BETWEEN 0 AND 23, false)) AS hour_in_range, "
          "bool_and(coalesce(aqi_lag_1 IS NOT NULL, false)) AS lags_present FROM feat")
def q_all_true(spark, sf):
    """bool_and reductions over the cleaned feature table."""
    return all_true(features(spark, sf), {
        "target_present": F.col("target_aqi").isNotNull(),
        "aqi_nonnegative": F.col("us_aqi") >= 0,
        "hour_in_range": F.col("hour").between(0, 23),
        "lags_present": F.col("aqi_lag_1").isNotNull(),
    })


@register("monotonic_check",
          "WITH p AS (SELECT user_id, ts, lag(ts) OVER (PARTITION BY user_id ORDER BY event_id) AS prev FROM events)\n"
          "SELECT user_id, count_if(ts < prev) AS out_of_order, count(*) AS rows, count_if(ts < prev) = 0 AS is_monotonic "
          "FROM p GROUP BY 1")
def q_monotonic_check(spark, sf):
    """Per user, events whose time is earlier than the previous event in
    arrival (event_id) order."""
    return monotonic_report(events(spark, sf), ["user_id"], "ts", "event_id")


@register("calendar_functions",
          f"WITH {RAW_HOURLY_CTE}\nSELECT location_id, timestamp, CAST(hour(timestamp) AS INTEGER) AS hour, "
          "CAST(isodow(timestamp) - 1 AS INTEGER) AS day_of_week, CAST(day(timestamp) AS INTEGER) AS day_of_month, "
          "CAST(month(timestamp) AS INTEGER) AS month, CAST(isodow(timestamp) >= 6 AS INTEGER) AS is_weekend, "
          "CAST(CAST(timestamp AS DATE) AS VARCHAR) AS date, strftime(timestamp, '%Y-%m-%d') AS date_text, "
          "CAST(epoch(timestamp) AS BIGINT) AS epoch_seconds, timestamp + INTERVAL 72 HOUR AS plus_72h, "
          "timestamp - INTERVAL 5 HOUR AS minus_5h FROM raw")
def q_calendar_functions(spark, sf):
    """F1-F6, F11, F12 on every hourly row."""
    r = raw(spark, sf).select(*KEYS, TS)
    return rounded(C.calendar_columns(r, TS).withColumns({
        "date": C.date_of(TS), "date_text": C.format_date(TS), "epoch_seconds": C.epoch_seconds(TS),
        "plus_72h": C.shift_hours(TS, 72), "minus_5h": C.shift_hours(TS, -5)}))


@register("aqi_category", f"WITH {RAW_HOURLY_CTE}\nSELECT location_id, timestamp, {r6('us_aqi', 'us_aqi')}, "
                          f"{_category_sql()} AS aqi_category FROM raw")
def q_aqi_category(spark, sf):
    """F7 on every hourly row."""
    return rounded(raw(spark, sf).select(*KEYS, TS, "us_aqi", aqi_category("us_aqi").alias("aqi_category")))


@register("numeric_functions",
          f"WITH {FEATURES_CTE}\nSELECT location_id, timestamp, {r6('abs(aqi_change_1h)', 'abs_change')}, "
          f"{r6('sqrt(us_aqi)', 'sqrt_aqi')}, {r6('CASE WHEN pm10 = 0 THEN NULL ELSE pm2_5 / pm10 END', 'pm_ratio')}, "
          f"{r6('round_even(us_aqi, 1)', 'aqi_1dp')}, {r6('greatest(0.0, aqi_change_24h)', 'rise_24h')} FROM feat")
def q_numeric_functions(spark, sf):
    """Abs, sqrt, guarded division, half-even rounding, clamp at 0."""
    from hourglass.functions.numeric import clamp_nonneg

    f = features(spark, sf)
    return rounded(f.select(*KEYS, TS, F.abs("aqi_change_1h").alias("abs_change"), F.sqrt("us_aqi").alias("sqrt_aqi"),
                            safe_div("pm2_5", "pm10").alias("pm_ratio"), round_half_even("us_aqi", 1).alias("aqi_1dp"),
                            clamp_nonneg("aqi_change_24h").alias("rise_24h")))


@register("lineitem_daily",
          "SELECT l_returnflag, CAST(CAST(l_shipdate AS DATE) AS VARCHAR) AS date, count(*) AS lines, "
          f"{r6('sum(l_quantity)', 'quantity')}, {r6('avg(l_extendedprice)', 'avg_price')}, "
          f"{r6('max(l_extendedprice)', 'max_price')} FROM lineitem GROUP BY 1, 2")
def q_lineitem_daily(spark, sf):
    """A8 on the second (daily) series: lineitem by ship date and return flag."""
    li = read_table(spark, sf, "lineitem")
    return rounded(li.groupBy("l_returnflag", C.date_of("l_shipdate").alias("date")).agg(
        F.count(F.lit(1)).alias("lines"), F.sum("l_quantity").alias("quantity"),
        F.avg("l_extendedprice").alias("avg_price"), F.max("l_extendedprice").alias("max_price")))
