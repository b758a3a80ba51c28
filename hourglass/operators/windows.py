"""Series window operators.

Every window is ``partitionBy(keys).orderBy(ts)``: the exchange is a hash on
the series keys and all windows over the same spec fuse into one Window node
and one sort.  A series of hourly data is bounded by its time span, not by the
data volume; for very long positional series use ``hourglass.operators.halo``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F


def series_window(keys: Sequence[str], ts: str, tiebreak: Sequence[str] = ()) -> WindowSpec:
    return Window.partitionBy(*keys).orderBy(ts, *tiebreak)


def lag_col(col: str, k: int, w: WindowSpec) -> Column:
    """Positional lag."""
    return F.lag(col, k).over(w)


def lead_col(col: str, k: int, w: WindowSpec) -> Column:
    """W3."""
    return F.lead(col, k).over(w)


def rolling_mean_prior(col: str, width: int, w: WindowSpec) -> Column:
    """Mean of the ``width`` rows before the current one; NULL unless all
    ``width`` values are present (pandas ``shift(1).rolling(width).mean()``).

    A sliding ROWS frame: Spark sums the frame oldest to newest, so the
    result equals ``(lag w + ... + lag 1) / w`` in that order (the oracle SQL
    states it so)."""
    frame = w.rowsBetween(-width, -1)
    return F.when(F.count(col).over(frame) == width, F.avg(col).over(frame))


def rolling_mean_trailing(col: str, width: int, w: WindowSpec) -> Column:
    """Mean of the ``width`` rows ending at the current one, nulls skipped."""
    return F.avg(col).over(w.rowsBetween(-(width - 1), 0))


def change(col: str, k: int, w: WindowSpec) -> Column:
    """``x - lag(x, k)``."""
    return F.col(col) - F.lag(col, k).over(w)


def change_prior(col: str, k: int, w: WindowSpec) -> Column:
    """``lag(x, 1) - lag(x, k + 1)`` (forecast path form)."""
    return F.lag(col, 1).over(w) - F.lag(col, k + 1).over(w)


def chrono_split(df: DataFrame, keys: Sequence[str], ts: str, train: float = 0.70, val: float = 0.85,
                 name: str = "split") -> DataFrame:
    """train/val/test by position within each series; cut indices are
    ``floor(n * fraction)`` computed in DOUBLE, as ``int(n * 0.70)`` does."""
    w = series_window(keys, ts)
    rn = F.row_number().over(w)
    n = F.count(F.lit(1)).over(Window.partitionBy(*keys))
    return (df.withColumns({"_rn": rn, "_n": n})
              .withColumn(name, F.when(F.col("_rn") <= F.floor(F.col("_n") * F.lit(float(train))), "train")
                                 .when(F.col("_rn") <= F.floor(F.col("_n") * F.lit(float(val))), "val")
                                 .otherwise("test"))
              .drop("_rn", "_n"))


def block_number(keys: Sequence[str], ts: str, hours: int = 24) -> Column:
    """``(position // hours) + 1`` within each series."""
    return (F.floor((F.row_number().over(series_window(keys, ts)) - 1) / hours) + 1).cast("int")


def rank_min(metric: str, partition: Sequence[str] = (), ascending: bool = True) -> Column:
    """Competition rank (ties share the lowest rank).  Unpartitioned only
    for small metric tables."""
    o = F.col(metric).asc() if ascending else F.col(metric).desc()
    w = Window.partitionBy(*partition).orderBy(o) if partition else Window.orderBy(o)
    return F.rank().over(w)


def _dedup(df: DataFrame, keys: Sequence[str], ts: str, order: Sequence[str], keep: str) -> DataFrame:
    group = list(keys) + [ts]
    rest = [c for c in df.columns if c not in group]
    if not rest:
        return df.dropDuplicates(group)
    ordering = F.struct(*[F.col(c) for c in order]) if order else F.lit(0)
    payload = F.struct(*[F.col(c) for c in rest])
    pick = F.max_by(payload, ordering) if keep == "last" else F.min_by(payload, ordering)
    # An aggregate, not a row_number window: partial (map-side) aggregation
    # shrinks hot (key, ts) groups before the shuffle.
    return df.groupBy(*group).agg(pick.alias("_row")).select(*group, "_row.*").select(*df.columns)


def dedup_keep_last(df: DataFrame, keys: Sequence[str], ts: str, order: Sequence[str]) -> DataFrame:
    """One row per (keys, ts): the last by ``order`` (ingest order / id)."""
    return _dedup(df, keys, ts, order, "last")


def dedup_keep_first(df: DataFrame, keys: Sequence[str], ts: str, order: Sequence[str]) -> DataFrame:
    """One row per (keys, ts): the first by ``order``."""
    return _dedup(df, keys, ts, order, "first")


def lookback_sequences(df: DataFrame, keys: Sequence[str], ts: str, features: Sequence[str], length: int = 24,
                       include_current: bool = False, name: str = "sequence") -> DataFrame:
    """The previous ``length`` rows' feature vectors as an array of arrays;
    rows without a full history are dropped.  Windowing before splitting lets
    val/test rows borrow history from the split before them."""
    w = series_window(keys, ts)
    frame = w.rowsBetween(-(length - 1), 0) if include_current else w.rowsBetween(-length, -1)
    seq = F.collect_list(F.array(*[F.col(c).cast("double") for c in features])).over(frame)
    return df.withColumn(name, seq).filter(F.size(name) == length)


def first_last_rows(df: DataFrame, keys: Sequence[str], ts: str) -> DataFrame:
    """First and last row of each series as structs (aggregate, skew-safe)."""
    rest = [c for c in df.columns if c not in keys]
    row = F.struct(*[F.col(c) for c in rest])
    return df.groupBy(*keys).agg(F.min_by(row, F.col(ts)).alias("first_row"),
                                 F.max_by(row, F.col(ts)).alias("last_row"))


def lag_audit(df: DataFrame, keys: Sequence[str], ts: str, source: str, checks: dict[str, int]) -> DataFrame:
    """Recompute each stored shift of ``source`` (positive = lag, negative =
    lead) and compare where both sides are non-null.  Long form
    (column, shift, compared, mismatches, passed)."""
    w = series_window(keys, ts)
    exp = {f"_exp_{i}": (F.lag(source, k).over(w) if k > 0 else F.lead(source, -k).over(w))
           for i, k in enumerate(checks.values())}
    wide = df.select(*checks.keys(), *[e.alias(n) for n, e in exp.items()])
    cmp = wide.select(F.explode(F.array(*[
        F.struct(F.lit(col).alias("column_name"), F.lit(int(k)).alias("shift"),
                 F.col(col).alias("stored"), F.col(f"_exp_{i}").alias("expected"))
        for i, (col, k) in enumerate(checks.items())])).alias("c")).select("c.*")
    both = F.col("stored").isNotNull() & F.col("expected").isNotNull()
    return (cmp.groupBy("column_name", "shift")
               .agg(F.count_if(both).alias("compared"),
                    F.count_if(both & (F.col("stored") != F.col("expected"))).alias("mismatches"))
               .withColumn("passed", F.col("mismatches") == 0))
