"""Mapping of the driver's ``events`` table onto the hourly data model.

No air-quality table exists in the test data, so ``events`` stands in for it.
The mapping is fixed and documented so the oracle SQL can state the same:

air side, per (series key, hour):
  us_aqi = avg(value), pm2_5 = max(value), pm10 = min(value),
  carbon_monoxide = sum(value), nitrogen_dioxide = count(*) (double),
  sulphur_dioxide = count(distinct user_id) (double), ozone = max(value) - min(value)
weather side, per hour over all events (one region):
  temperature_2m = avg(value), relative_humidity_2m = count(*) (bigint),
  pressure_msl = max(value), precipitation = sum(value),
  wind_speed_10m = min(value), wind_direction_10m = count(distinct user_id) (bigint)

Averages and sums are quantized to 1e-9 (``quantize``): a float sum depends
on the order rows arrive in, which differs between partitionings and engines;
quantized hourly values are reproducible bit for bit.

The hourly aggregates are partial (map-side) aggregations, so a hot key or
hot hour is combined on the map side before the shuffle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hourglass.functions.calendar import hour_trunc
from hourglass.functions.numeric import quantize

HOURLY_DIGITS = 9
EVENT_COLUMNS = ["event_id", "ts", "user_id", "event_type", "value"]


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def series_key(key: str = "event_type"):
    c = F.col(key)
    return (c if key == "event_type" else c.cast("string")).alias("location_id")


def air_side(events: DataFrame, key: str = "event_type") -> DataFrame:
    v = F.col("value")
    return (events.select(series_key(key), hour_trunc("ts").alias("timestamp"), "value", "user_id")
                  .filter(F.col("location_id").isNotNull() & F.col("timestamp").isNotNull())
                  .groupBy("location_id", "timestamp")
                  .agg(quantize(F.avg(v), HOURLY_DIGITS).alias("us_aqi"),
                       F.max(v).alias("pm2_5"),
                       F.min(v).alias("pm10"),
                       quantize(F.sum(v), HOURLY_DIGITS).alias("carbon_monoxide"),
                       F.count(F.lit(1)).cast("double").alias("nitrogen_dioxide"),
                       F.count_distinct("user_id").cast("double").alias("sulphur_dioxide"),
                       (F.max(v) - F.min(v)).alias("ozone")))


def weather_side(events: DataFrame) -> DataFrame:
    v = F.col("value")
    return (events.select(hour_trunc("ts").alias("timestamp"), "value", "user_id")
                  .filter(F.col("timestamp").isNotNull())
                  .groupBy("timestamp")
                  .agg(quantize(F.avg(v), HOURLY_DIGITS).alias("temperature_2m"),
                       F.count(F.lit(1)).alias("relative_humidity_2m"),
                       F.max(v).alias("pressure_msl"),
                       quantize(F.sum(v), HOURLY_DIGITS).alias("precipitation"),
                       F.min(v).alias("wind_speed_10m"),
                       F.count_distinct("user_id").alias("wind_direction_10m")))


def raw_hourly(events: DataFrame, key: str = "event_type") -> DataFrame:
    """J1 over the two sides: F1-shaped raw hourly table keyed by ``location_id``."""
    from hourglass.operators.joins import join_hourly

    return join_hourly(weather_side(events), air_side(events, key), on=["timestamp"])


def raw_hourly_from_dir(spark: SparkSession, sf_dir: str, key: str = "event_type") -> DataFrame:
    return raw_hourly(read_table(spark, sf_dir, "events"), key)
