"""Join operators (J2-J6) and the hour grid."""

from __future__ import annotations

from pyspark.sql import functions as F

from hourglass.catalog import register
from hourglass.catalog.common import KEYS, TS, events, raw, rounded
from hourglass.checks.sqlfrag import RAW_HOURLY_CTE, qz, r6
from hourglass.functions.calendar import date_of, hour_grid, hour_trunc
from hourglass.functions.numeric import quantize
from hourglass.operators import joins as J
from hourglass.operators import projections as P

_BOUNDARY = "b AS (SELECT location_id, max(timestamp) AS boundary FROM raw GROUP BY 1)"


@register("attach_daily",
          f"WITH {RAW_HOURLY_CTE}, d AS (SELECT location_id, CAST(timestamp AS DATE) AS date, avg(us_aqi) AS aqi_daily_mean "
          "FROM raw GROUP BY 1, 2)\n"
          f"SELECT r.location_id, r.timestamp, {r6('r.us_aqi', 'us_aqi')}, {r6('d.aqi_daily_mean', 'aqi_daily_mean')} "
          "FROM raw r LEFT JOIN d ON r.location_id = d.location_id AND CAST(r.timestamp AS DATE) = d.date")
def q_attach_daily(spark, sf):
    """Left outer join of each hour to its day's mean AQI."""
    r = raw(spark, sf).select(*KEYS, TS, "us_aqi").withColumn("date", date_of(TS))
    d = r.groupBy(*KEYS, "date").agg(F.avg("us_aqi").alias("aqi_daily_mean"))
    return rounded(J.attach(r, d, [*KEYS, "date"], ["aqi_daily_mean"]).drop("date"))


@register("attach_one_to_one",
          f"WITH {RAW_HOURLY_CTE}, nxt AS (SELECT location_id, timestamp - INTERVAL 1 HOUR AS timestamp, us_aqi AS actual FROM raw)\n"
          f"SELECT r.location_id, r.timestamp, {r6('r.us_aqi', 'predicted')}, {r6('n.actual', 'actual')} "
          "FROM raw r LEFT JOIN nxt n ON r.location_id = n.location_id AND r.timestamp = n.timestamp")
def q_attach_one_to_one(spark, sf):
    """Persistence prediction per hour, the observed value one hour later
    attached one-to-one (fails on duplicate keys on either side)."""
    r = raw(spark, sf).select(*KEYS, TS, F.col("us_aqi").alias("predicted"))
    nxt = raw(spark, sf).select(*KEYS, F.timestamp_add("HOUR", F.lit(-1), TS).alias(TS), F.col("us_aqi").alias("actual"))
    return rounded(J.attach_one_to_one(r, nxt, [*KEYS, TS], ["actual"]))


@register("hour_grid",
          f"WITH {RAW_HOURLY_CTE}, {_BOUNDARY}\nSELECT location_id, "
          "unnest(generate_series(boundary + INTERVAL 1 HOUR, boundary + INTERVAL 72 HOUR, INTERVAL 1 HOUR)) AS timestamp FROM b")
def q_hour_grid(spark, sf):
    """the next 72 hours after each series' last observation."""
    b = P.series_boundary(raw(spark, sf), KEYS, TS)
    return b.select(*KEYS, F.explode(hour_grid(F.timestamp_add("HOUR", F.lit(1), "boundary"), 72)).alias(TS))


@register("keep_hours",
          f"WITH {RAW_HOURLY_CTE}, {_BOUNDARY},\n"
          "g AS (SELECT location_id, unnest(generate_series(boundary - INTERVAL 71 HOUR, boundary, INTERVAL 1 HOUR)) AS timestamp FROM b)\n"
          f"SELECT location_id, timestamp, {r6('us_aqi', 'us_aqi')}, {r6('pm2_5', 'pm2_5')} FROM raw "
          "WHERE (location_id, timestamp) IN (SELECT (location_id, timestamp) FROM g)")
def q_keep_hours(spark, sf):
    """Keep rows whose (series, hour) lies on the last-72-hour grid."""
    r = raw(spark, sf).select(*KEYS, TS, "us_aqi", "pm2_5")
    b = P.series_boundary(r, KEYS, TS)
    grid = b.select(*KEYS, F.explode(hour_grid(F.timestamp_add("HOUR", F.lit(-71), "boundary"), 72)).alias(TS))
    return rounded(J.keep_hours(r, grid, [*KEYS, TS]))


_USER_VIEW = ("uv AS (SELECT user_id, date_trunc('hour', ts) AS timestamp, count(*) AS n_events, "
              f"{qz('avg(value)', 9)} AS avg_value FROM events WHERE user_id IS NOT NULL AND ts IS NOT NULL GROUP BY 1, 2)")


def _user_view(spark, sf):
    ev = events(spark, sf).filter(F.col("user_id").isNotNull() & F.col("ts").isNotNull())
    return ev.groupBy("user_id", hour_trunc("ts").alias(TS)).agg(
        F.count(F.lit(1)).alias("n_events"), quantize(F.avg("value"), 9).alias("avg_value"))


@register("latest_features",
          f"WITH {_USER_VIEW}, ent AS (SELECT DISTINCT user_id FROM events WHERE user_id IS NOT NULL)\n"
          f"SELECT e.user_id, l.timestamp, l.n_events, {r6('l.avg_value', 'avg_value')} FROM ent e LEFT JOIN "
          "(SELECT user_id, max(timestamp) AS timestamp, arg_max(n_events, timestamp) AS n_events, "
          "arg_max(avg_value, timestamp) AS avg_value FROM uv GROUP BY 1) l ON e.user_id = l.user_id")
def q_latest_features(spark, sf):
    """Newest hourly feature row per user, for every user entity."""
    ent = events(spark, sf).filter(F.col("user_id").isNotNull()).select("user_id").distinct()
    return rounded(J.latest_features(_user_view(spark, sf), ent, ["user_id"], TS, ["n_events", "avg_value"]))


_TTL_DAYS = 3


@register("point_in_time_join",
          "WITH p AS (SELECT event_id, user_id, ts AS as_of FROM events WHERE event_type = 'purchase'),\n"
          "v AS (SELECT user_id, ts, value FROM events WHERE event_type = 'view' AND user_id IS NOT NULL AND ts IS NOT NULL),\n"
          "j AS (SELECT p.event_id, p.user_id, p.as_of, v.ts AS view_ts, v.value AS view_value FROM p "
          "ASOF LEFT JOIN v ON p.user_id = v.user_id AND p.as_of >= v.ts)\n"
          "SELECT event_id, user_id, as_of, "
          f"CASE WHEN epoch_us(as_of) - epoch_us(view_ts) <= {_TTL_DAYS * 86400 * 1000000} THEN view_ts END AS view_ts, "
          f"{r6(f'CASE WHEN epoch_us(as_of) - epoch_us(view_ts) <= {_TTL_DAYS * 86400 * 1000000} THEN view_value END', 'view_value')} FROM j")
def q_point_in_time_join(spark, sf):
    """For each purchase, the user's newest 'view' event at or before it,
    within a 3-day TTL (as-of join without a range join)."""
    ev = events(spark, sf)
    ent = ev.filter(F.col("event_type") == "purchase").select("event_id", "user_id", F.col("ts").alias("as_of"))
    view = ev.filter(F.col("event_type") == "view").select("user_id", "ts", "value")
    out = J.point_in_time_join(ent, view, ["user_id"], "as_of", "ts", ["value"], ttl_seconds=_TTL_DAYS * 86400)
    return rounded(out.withColumnsRenamed({"ts": "view_ts", "value": "view_value"}))
