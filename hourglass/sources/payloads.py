"""Provider payloads (S5-S8): a JSON object whose ``hourly`` member is a struct
of parallel arrays (``time`` plus one array per variable) and whose
``hourly_units`` maps variable to unit.

Each payload covers a bounded window (one request: one location, a range of
hours); flattening is ``from_json`` -> ``arrays_zip`` -> ``explode``, entirely
JVM-side and parallel across payloads.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

TIME_FORMAT = "yyyy-MM-dd'T'HH:mm"


def payload_schema(variables: Sequence[str]) -> T.StructType:
    hourly = T.StructType([T.StructField("time", T.ArrayType(T.StringType()))]
                          + [T.StructField(v, T.ArrayType(T.DoubleType())) for v in variables])
    return T.StructType([
        T.StructField("latitude", T.DoubleType()),
        T.StructField("longitude", T.DoubleType()),
        T.StructField("hourly_units", T.MapType(T.StringType(), T.StringType())),
        T.StructField("hourly", hourly),
    ])


def parse_payloads(df: DataFrame, col: str, variables: Sequence[str]) -> DataFrame:
    """``from_json`` with an explicit schema (no inference)."""
    return df.withColumn("_p", F.from_json(F.col(col), payload_schema(variables)))


def flatten_hourly(parsed: DataFrame, variables: Sequence[str], keep: Sequence[str] = (),
                   ts: str = "timestamp") -> DataFrame:
    """One row per hour: ``keep`` columns, timestamp (UTC, NTZ) and every
    variable.  Arrays of unequal length are padded with NULL by ``arrays_zip``."""
    z = F.arrays_zip(F.col("_p.hourly.time").alias("time"),
                     *[F.col(f"_p.hourly.{v}").alias(v) for v in variables])
    rows = parsed.select(*keep, F.explode(z).alias("_r"))
    return rows.select(*keep, F.to_timestamp_ntz(F.col("_r.time"), F.lit(TIME_FORMAT)).alias(ts),
                       *[F.col(f"_r.{v}").alias(v) for v in variables])


def payload_profile(parsed: DataFrame, variables: Sequence[str], keep: Sequence[str] = ()) -> DataFrame:
    """Per payload, number of variables present, records, coordinates."""
    present = sum((F.col(f"_p.hourly.{v}").isNotNull().cast("int") for v in variables), F.lit(0))
    return parsed.select(*keep, present.alias("variables"), F.size("_p.hourly.time").alias("records"),
                         F.col("_p.latitude").alias("latitude"), F.col("_p.longitude").alias("longitude"))


def payload_units(parsed: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """(variable, unit) rows from the units map."""
    return parsed.select(*keep, F.explode("_p.hourly_units").alias("variable", "unit"))


def payload_preview(parsed: DataFrame, variables: Sequence[str], keep: Sequence[str], n: int = 5,
                    ts: str = "timestamp") -> DataFrame:
    """The first ``n`` hours of each payload (arrays sliced before the
    explode, so only ``n`` rows per payload are ever produced)."""
    z = F.arrays_zip(F.slice("_p.hourly.time", 1, n).alias("time"),
                     *[F.slice(f"_p.hourly.{v}", 1, n).alias(v) for v in variables])
    rows = parsed.select(*keep, F.posexplode(z).alias("pos", "_r"))
    return rows.select(*keep, "pos", F.to_timestamp_ntz(F.col("_r.time"), F.lit(TIME_FORMAT)).alias(ts),
                       *[F.col(f"_r.{v}").alias(v) for v in variables])


def _field(name: str):
    return lambda r: r[name]


def build_payloads(hourly: DataFrame, keys: Sequence[str], ts: str, variables: Sequence[str], units: dict,
                   latitude: Column, longitude: Column, period: str = "day") -> DataFrame:
    """Inverse of S5 (used to derive payloads from a Spark table): one JSON
    payload per (keys, period), arrays in time order.  A payload holds at
    most one period of hours (24 for a day), so ``collect_list`` is bounded."""
    grp = [*keys, F.date_trunc(period, F.col(ts)).cast("timestamp_ntz").alias("period")]
    rec = F.struct(F.col(ts).alias("_t"), *[F.col(v).cast("double").alias(v) for v in variables])
    g = hourly.groupBy(*grp).agg(F.sort_array(F.collect_list(rec)).alias("_rows"))
    hourly_struct = F.struct(
        F.transform("_rows", lambda r: F.date_format(r["_t"], TIME_FORMAT)).alias("time"),
        *[F.transform("_rows", _field(v)).alias(v) for v in variables])
    unit_map = F.create_map(*[x for v in variables for x in (F.lit(v), F.lit(units.get(v, "")))])
    body = F.struct(latitude.alias("latitude"), longitude.alias("longitude"), unit_map.alias("hourly_units"),
                    hourly_struct.alias("hourly"))
    return g.select(*keys, "period", F.to_json(body).alias("payload"))


# --------------------------------------------------------------------------- second provider
def list_schema(variables: Sequence[str]) -> T.StructType:
    record = T.StructType([T.StructField("dt", T.LongType())] + [T.StructField(v, T.DoubleType()) for v in variables])
    coord = T.StructType([T.StructField("lat", T.DoubleType()), T.StructField("lon", T.DoubleType())])
    return T.StructType([T.StructField("coord", coord), T.StructField("list", T.ArrayType(record))])


def list_profile(df: DataFrame, col: str, variables: Sequence[str], keep: Sequence[str] = ()) -> DataFrame:
    """S6 for payloads whose ``list`` holds the records: their number (0 without a
    list), first and last time, coordinates."""
    p = df.withColumn("_p", F.from_json(F.col(col), list_schema(variables)))
    at = lambda f: F.timestamp_seconds(f(F.transform("_p.list", lambda r: r["dt"]))).cast("timestamp_ntz")
    return p.select(*keep, F.coalesce(F.size("_p.list"), F.lit(0)).alias("records"), at(F.array_min).alias("first_ts"),
                    at(F.array_max).alias("last_ts"), F.col("_p.coord.lat").alias("latitude"), F.col("_p.coord.lon").alias("longitude"))


def build_list_payloads(hourly: DataFrame, keys: Sequence[str], ts: str, variables: Sequence[str], latitude: Column,
                        longitude: Column, period: str = "day") -> DataFrame:
    """One ``list`` payload per (keys, period); at most a period of hours each."""
    grp = [*keys, F.date_trunc(period, F.col(ts)).cast("timestamp_ntz").alias("period")]
    rec = F.struct(F.unix_seconds(F.col(ts).cast("timestamp")).alias("dt"), *[F.col(v).cast("double").alias(v) for v in variables])
    g = hourly.groupBy(*grp).agg(F.sort_array(F.collect_list(rec)).alias("list"))
    return g.select(*keys, "period", F.to_json(F.struct(F.struct(latitude.alias("lat"), longitude.alias("lon")).alias("coord"), "list")).alias("payload"))
