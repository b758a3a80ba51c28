"""File sources and sinks (S1-S4, S9) and the synthetic test fixture."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hourglass.functions.calendar import calendar_columns
from hourglass.operators.guards import require_columns
from hourglass.schema import RAW_HOURLY_SCHEMA, DEFAULT_SPEC

# Timestamp text: written with an explicit offset; read with 'T' or space,
# optional seconds, fraction and offset (ISO and pandas forms both parse).
CSV_TS_WRITE = "yyyy-MM-dd HH:mm:ssxxx"
CSV_TS_READ = "yyyy-MM-dd['T'][' ']HH:mm[:ss][.SSS][XXX]"


def read_hourly_csv(spark: SparkSession, path: str, schema: T.StructType = RAW_HOURLY_SCHEMA,
                    required: Sequence[str] | None = None) -> DataFrame:
    """Header CSV scan with an explicit schema (no inference pass); G1 on
    the required names.  Timestamps are read as UTC wall clock."""
    df = (spark.read.schema(schema).option("header", True).option("mode", "FAILFAST")
               .option("timestampFormat", CSV_TS_READ).csv(path))
    return require_columns(df, required or ["timestamp", *DEFAULT_SPEC.required_raw()], "raw")


def read_features(spark: SparkSession, path: str, columns: Sequence[str] | None = None) -> DataFrame:
    """Parquet scan; selecting ``columns`` prunes the scan and filters on
    the result are pushed into it."""
    df = spark.read.parquet(path)
    return df.select(*columns) if columns else df


def write_csv(df: DataFrame, path: str) -> None:
    """S3: header CSV, overwrite; timestamps as ``2024-01-01 00:00:00+00:00``,
    which S1 reads back."""
    df.write.mode("overwrite").option("header", True).option("timestampFormat", CSV_TS_WRITE).csv(path)


def write_features(df: DataFrame, path: str, keys: Sequence[str] = ("location_id",), ts: str = "timestamp",
                   partition_cols: Sequence[str] = (), files_per_write: int | None = None) -> None:
    """Parquet sink clustered by series: hash-partitioned on the keys and
    sorted by (keys, ts) inside each file, so min/max statistics let later
    scans skip files by key or time.  Directory partitioning only on explicit
    low-cardinality ``partition_cols`` (never one folder per series)."""
    keys = list(keys)
    out = df.repartition(files_per_write, *keys) if files_per_write else df.repartition(*keys)
    w = out.sortWithinPartitions(*keys, ts).write.mode("overwrite")
    if partition_cols:
        w = w.partitionBy(*partition_cols)
    w.parquet(path)


def csv_to_parquet(spark: SparkSession, src: str, dst: str, schema: T.StructType = RAW_HOURLY_SCHEMA,
                   keys: Sequence[str] = ("location_id",)) -> DataFrame:
    """Read CSV with a schema, write Parquet clustered by series, return the
    Parquet scan."""
    write_features(read_hourly_csv(spark, src, schema), dst, keys)
    return read_features(spark, dst)


def hourly_fixture(spark: SparkSession, n: int = 100, seed: int = 42, start: str = "2026-01-01 00:00:00",
                   location: str = "fixture", spec=DEFAULT_SPEC) -> DataFrame:
    """``n`` hourly rows from ``start``: AQI and target uniform 20-200,
    every other feature uniform 0-100, calendar columns derived from time.
    For contract tests only (values are random, not lagged)."""
    base = spark.range(n).select(
        F.lit(location).alias("location_id"),
        F.timestamp_add("HOUR", F.col("id"), F.lit(start).cast("timestamp_ntz")).alias("timestamp"),
        F.col("id"))
    cols = {"us_aqi": F.lit(20.0) + F.rand(seed) * 180.0, spec.target: F.lit(20.0) + F.rand(seed + 1) * 180.0}
    cal = set(spec.calendar)
    for i, c in enumerate(spec.feature_columns()):
        if c not in cal:
            cols[c] = F.rand(seed + 2 + i) * 100.0
    return calendar_columns(base.withColumns(cols), "timestamp").drop("id")
