"""Set operations."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hourglass.operators.windows import dedup_keep_last


def append_future(history: DataFrame, future: DataFrame, allow_missing: bool = False) -> DataFrame:
    """UNION ALL by column name."""
    return history.unionByName(future, allowMissingColumns=allow_missing)


def upsert_by_time(history: DataFrame, future: DataFrame, keys: Sequence[str], ts: str) -> DataFrame:
    """U1, then one row per (keys, ts) with the later source winning."""
    u = history.withColumn("_src", F.lit(0)).unionByName(future.withColumn("_src", F.lit(1)), allowMissingColumns=True)
    return dedup_keep_last(u, keys, ts, ["_src"]).drop("_src")
