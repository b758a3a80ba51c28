"""Projections and filters."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from hourglass.functions.numeric import clamp_nonneg


def drop_columns(df: DataFrame, cols: Sequence[str], missing_ok: bool = True) -> DataFrame:
    """Drop names; absent names are ignored unless ``missing_ok`` is False."""
    if not missing_ok:
        absent = [c for c in cols if c not in df.columns]
        if absent:
            raise ValueError(f"cannot drop absent columns {absent}")
    return df.drop(*cols)


def rename(df: DataFrame, mapping: dict[str, str]) -> DataFrame:
    """P3."""
    return df.withColumnsRenamed(mapping)


def select_ordered(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Exact column order (model input order)."""
    return df.select(*cols)


def with_constant(df: DataFrame, name: str, value) -> DataFrame:
    """P5."""
    return df.withColumn(name, F.lit(value))


def drop_incomplete(df: DataFrame, subset: Sequence[str]) -> DataFrame:
    """Drop rows with a NULL in any of ``subset``."""
    return df.na.drop(subset=list(subset))


def drop_incomplete_any(df: DataFrame) -> DataFrame:
    """Drop rows with a NULL in any column."""
    return df.na.drop("any")


def series_boundary(df: DataFrame, keys: Sequence[str], ts: str, name: str = "boundary") -> DataFrame:
    """Last timestamp of each series (aggregate, skew-safe)."""
    return df.groupBy(*keys).agg(F.max(ts).alias(name))


def history_mask(df: DataFrame, keys, ts, boundary: DataFrame, name: str = "boundary") -> DataFrame:
    """P10: rows at or before the boundary."""
    return df.join(boundary, list(keys), "inner").filter(F.col(ts) <= F.col(name)).drop(name)


def future_mask(df: DataFrame, keys, ts, boundary: DataFrame, name: str = "boundary") -> DataFrame:
    """P10: rows after the boundary."""
    return df.join(boundary, list(keys), "inner").filter(F.col(ts) > F.col(name)).drop(name)


def time_range_filter(df: DataFrame, ts: str, anchor, hours: int) -> DataFrame:
    """``ts >= anchor - hours``; ``anchor`` is a literal timestamp or a column."""
    a = anchor if not isinstance(anchor, str) else F.lit(anchor).cast(df.schema[ts].dataType)
    return df.filter(F.col(ts) >= F.timestamp_add("HOUR", F.lit(-int(hours)), a))


def row_range(df: DataFrame, keys: Sequence[str], ts: str, start: int, stop: int | None) -> DataFrame:
    """Rows at 0-based positions [start, stop) in time order per series."""
    rn = F.row_number().over(Window.partitionBy(*keys).orderBy(ts)) - 1
    pos = F.col("_pos")
    cond = pos >= start if stop is None else (pos >= start) & (pos < stop)
    return df.withColumn("_pos", rn).filter(cond).drop("_pos")


def select_group(df: DataFrame, col: str, value) -> DataFrame:
    """P14."""
    return df.filter(F.col(col) == F.lit(value))
