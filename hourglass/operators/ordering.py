"""Sort, top-k, head/tail, seeded sample, row at position.

Top-k and head/tail are ``orderBy().limit()`` (TakeOrderedAndProject: each
task keeps its k best, the driver merges k x tasks rows).  Per-series forms
use ``row_number`` within the series, which Spark 3.5+ pre-filters with a
partial WindowGroupLimit before the shuffle.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def sort_by_time(df: DataFrame, keys: Sequence[str], ts: str) -> DataFrame:
    """O1: only at the sink; windows sort by themselves."""
    return df.orderBy(*keys, ts)


def top_k(df: DataFrame, by: str, k: int, tiebreak: Sequence[str] | str | None = None, ascending: bool = False,
          rank_name: str = "rank") -> DataFrame:
    """O2: the ``k`` rows with the largest ``by`` (ties by ``tiebreak``),
    numbered 1..k."""
    o = [F.col(by).asc() if ascending else F.col(by).desc()]
    if tiebreak:
        o += [F.col(t).asc() for t in ([tiebreak] if isinstance(tiebreak, str) else tiebreak)]
    top = df.orderBy(*o).limit(k)
    return top.withColumn(rank_name, F.row_number().over(Window.orderBy(*o)))  # k rows only


def top_k_per_group(df: DataFrame, keys: Sequence[str], by, k: int, tiebreak: Sequence[str] = (),
                    rank_name: str = "rank") -> DataFrame:
    """O2/O3 per group: ``row_number <= k`` within each group."""
    o = [by] if not isinstance(by, (list, tuple)) else list(by)
    w = Window.partitionBy(*keys).orderBy(*o, *[F.col(t).asc() for t in tiebreak])
    return df.withColumn(rank_name, F.row_number().over(w)).filter(F.col(rank_name) <= k)


def top_k_abs(df: DataFrame, col: str, k: int, tiebreak: str | None = None, keys: Sequence[str] = ()) -> DataFrame:
    """O3: the ``k`` rows with the largest ``|col|``."""
    by = F.abs(F.col(col)).desc()
    if keys:
        return top_k_per_group(df, keys, by, k, [tiebreak] if tiebreak else [])
    o = [by] + ([F.col(tiebreak).asc()] if tiebreak else [])
    return df.orderBy(*o).limit(k)


def head(df: DataFrame, keys: Sequence[str], ts: str, n: int) -> DataFrame:
    """First ``n`` rows of each series in time order."""
    return top_k_per_group(df, keys, F.col(ts).asc(), n, rank_name="_r").drop("_r")


def tail(df: DataFrame, keys: Sequence[str], ts: str, n: int) -> DataFrame:
    """Last ``n`` rows of each series."""
    return top_k_per_group(df, keys, F.col(ts).desc(), n, rank_name="_r").drop("_r")


def sample_key(cols: Sequence[str], seed: int = 42):
    """Stable pseudo-random order: md5 of the key text and the seed (the same
    in DuckDB, unaffected by partitioning, unlike ``df.sample``)."""
    parts = [F.coalesce(F.col(c).cast("string"), F.lit("")) for c in cols]
    return F.md5(F.concat_ws(":", *parts, F.lit(str(seed))))


def seeded_sample(df: DataFrame, key_cols: Sequence[str], n: int, seed: int = 42) -> DataFrame:
    """``n`` rows by the stable hash order (a sampling operator: the limit
    is the feature)."""
    return df.withColumn("_h", sample_key(key_cols, seed)).orderBy("_h", *key_cols).limit(n).drop("_h")


def row_at(df: DataFrame, keys: Sequence[str], ts: str, position: int) -> DataFrame:
    """0-based ``position`` in time order per series."""
    w = Window.partitionBy(*keys).orderBy(ts)
    return df.withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") == position + 1).drop("_rn")
