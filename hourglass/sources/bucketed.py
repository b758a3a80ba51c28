"""Hourly tables bucketed by series (S2, S4): written once so that windows, aggregates and joins on the
series key read them without an exchange.

A series lies in one bucket file, sorted by time.  Bucketing is known to Spark through a table's
definition, not through the files, so a table is opened by name and place in each session.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from hourglass.operators.guards import ContractError


def write_bucketed(df: DataFrame, table: str, path: str, buckets: int, keys: Sequence[str] = ("location_id",), ts: str = "timestamp") -> DataFrame:
    """Write ``df`` to ``path`` in ``buckets`` buckets of the series key and open it as ``table``.
    Rows meet in their bucket before the write, so each bucket is one file."""
    if buckets < 1:
        raise ContractError("buckets must be positive")
    spark = df.sparkSession
    spark.sql(f"DROP TABLE IF EXISTS {table}")
    keys = list(keys)
    placed = df.repartition(buckets, *keys)
    placed.write.mode("overwrite").format("parquet").option("path", path).bucketBy(buckets, keys[0], *keys[1:]).sortBy(*keys, ts).saveAsTable(table)
    return spark.table(table)


def open_bucketed(spark: SparkSession, table: str, path: str, buckets: int, keys: Sequence[str] = ("location_id",), ts: str = "timestamp") -> DataFrame:
    """The bucketed files under ``path`` as ``table``, in a session that has not written them."""
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in spark.read.parquet(path).schema.fields)
    by = ", ".join(f"`{k}`" for k in keys)
    spark.sql(f"DROP TABLE IF EXISTS {table}")
    place = path.replace("'", "\\'")
    spark.sql(f"CREATE TABLE {table} ({columns}) USING parquet CLUSTERED BY ({by}) SORTED BY ({by}, `{ts}`) INTO {int(buckets)} BUCKETS LOCATION '{place}'")
    return spark.table(table)
