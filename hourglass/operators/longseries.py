"""Positional operators on very long series (W8, W13, W15, P12, and the rows that M14 reads).

The plain forms number a series' rows with one window, so a series with a third of all rows lies in
one task.  Here a row's position comes from counts of time buckets (``with_ordinal``) and a series' length
from a plain aggregate, and windows that reach a bounded number of rows run over chunks with halo rows.
Results equal the plain forms'; ``ts`` is unique per series.  ``bucket_seconds`` bounds
the rows that one task numbers, ``chunk_rows`` those that one window holds.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hourglass.operators.halo import CHUNK, ORDINAL, drop_halo, halo_chunks, with_ordinal
from hourglass.operators.windows import lookback_sequences

WEEK = 7 * 86400


def with_length(df: DataFrame, keys: Sequence[str], ts: str, bucket_seconds: int = WEEK) -> DataFrame:
    """Rows with their 0-based position (``_ordinal``) and their series' length (``_n``).  Lengths are
    counted before the shuffle; the join back is on series and bucket-balanced rows, and
    adaptive execution splits or broadcasts it."""
    o = with_ordinal(df, keys, ts, bucket_seconds)
    n = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    on = [F.col(f"o.`{k}`").eqNullSafe(F.col(f"n.`{k}`")) for k in keys]
    return o.alias("o").join(n.alias("n"), on).select("o.*", "n._n")


def chrono_split_long(df: DataFrame, keys: Sequence[str], ts: str, train: float = 0.70, val: float = 0.85,
                      name: str = "split", bucket_seconds: int = WEEK) -> DataFrame:
    """W8 without a window over a whole series."""
    upto = lambda share: F.col(ORDINAL) < F.floor(F.col("_n") * F.lit(float(share)))
    split = F.when(upto(train), "train").when(upto(val), "val").otherwise("test")
    return with_length(df, keys, ts, bucket_seconds).withColumn(name, split).drop(ORDINAL, "_n")


def row_range_long(df: DataFrame, keys: Sequence[str], ts: str, start: int, stop: int | None, bucket_seconds: int = WEEK) -> DataFrame:
    """P12 without a window over a whole series."""
    at = F.col(ORDINAL)
    cond = at >= start if stop is None else (at >= start) & (at < stop)
    return with_ordinal(df, keys, ts, bucket_seconds).filter(cond).drop(ORDINAL)


def last_rows(df: DataFrame, keys: Sequence[str], ts: str, rows: int, bucket_seconds: int = WEEK) -> DataFrame:
    """The newest ``rows`` rows of each series: all that M14 reads are horizon + 73."""
    return with_length(df, keys, ts, bucket_seconds).filter(F.col(ORDINAL) >= F.col("_n") - rows).drop(ORDINAL, "_n")


def lookback_sequences_long(df: DataFrame, keys: Sequence[str], ts: str, features: Sequence[str], length: int = 24,
                            include_current: bool = False, name: str = "sequence", chunk_rows: int = 24 * 7 * 8, bucket_seconds: int = WEEK) -> DataFrame:
    """W13 by chunks with ``length`` rows of halo."""
    h = halo_chunks(df, keys, ts, chunk_rows, back=length, ahead=0, bucket_seconds=bucket_seconds)
    return drop_halo(lookback_sequences(h, [*keys, CHUNK], ts, features, length, include_current, name))


def lag_audit_long(df: DataFrame, keys: Sequence[str], ts: str, source: str, checks: dict[str, int], chunk_rows: int = 24 * 7 * 8,
                   bucket_seconds: int = WEEK) -> DataFrame:
    """W15 by chunks with as many halo rows as the largest lag and lead."""
    from pyspark.sql import Window

    back, ahead = max([0, *checks.values()]), max([0, *[-k for k in checks.values()]])
    h = halo_chunks(df.select(*dict.fromkeys([*keys, ts, source, *checks])), keys, ts, chunk_rows, back, ahead, bucket_seconds)
    w = Window.partitionBy(*keys, CHUNK).orderBy(ts)
    shifted = [(F.lag(source, k) if k > 0 else F.lead(source, -k)).over(w).alias(f"_e{i}") for i, k in enumerate(checks.values())]
    wide = drop_halo(h.select("*", *shifted))
    return _compared(wide, [(c, k, F.col(c), F.col(f"_e{i}")) for i, (c, k) in enumerate(checks.items())])


def _compared(wide: DataFrame, pairs: Sequence[tuple[str, int, Column, Column]]) -> DataFrame:
    """(column_name, shift, compared, mismatches, passed): counted wide in one pass, then a row a column."""
    both = lambda a, b: a.isNotNull() & b.isNotNull()
    sums = wide.agg(*[F.count_if(both(a, b)).alias(f"c{i}") for i, (_, _, a, b) in enumerate(pairs)],
                    *[F.count_if(both(a, b) & (a != b)).alias(f"m{i}") for i, (_, _, a, b) in enumerate(pairs)])
    rows = F.array(*[F.struct(F.lit(n).alias("column_name"), F.lit(int(k)).alias("shift"), F.col(f"c{i}").alias("compared"), F.col(f"m{i}").alias("mismatches"))
                     for i, (n, k, _, _) in enumerate(pairs)])
    return sums.select(F.explode(rows).alias("r")).select("r.*").withColumn("passed", F.col("mismatches") == 0)
