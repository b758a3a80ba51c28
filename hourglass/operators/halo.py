"""Positional windows over very long series without a single-task window.

``partitionBy(keys).orderBy(ts)`` puts a whole series in one task.  For a
series too long for that (or a key holding a large share of the rows), rows
get an exact position (ordinal) within their series, are cut into chunks of
``chunk_rows`` consecutive rows, and each chunk receives copies of the
``back`` rows before it and the ``ahead`` rows after it (halo rows).  Window
operators then run over ``partitionBy(keys, chunk)``; halo rows are dropped
afterwards.  For any positional frame reaching at most ``back`` rows back and
``ahead`` rows forward the result equals the plain window exactly.

The ordinal itself is computed without a per-series window: rows are counted
per (keys, time bucket), the counts are prefix-summed on that small table,
and the position inside a bucket is a ``row_number`` bounded by the bucket.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

CHUNK = "_chunk"
HALO = "_halo"
ORDINAL = "_ordinal"
RANGE_CHUNK = "_rc"
CHUNK_ROWS = 2_000_000


def range_chunks(df: DataFrame, keys: Sequence[str], order: Sequence[str], chunks: int | None = None) -> DataFrame:
    """Rows tagged with ``_rc``: ``df`` range-partitioned on (keys, order) into
    ``chunks`` parts of about equal row count (by default as many as keep a chunk
    at ``CHUNK_ROWS`` rows, and at least ``spark.sql.shuffle.partitions``).  Each chunk holds a contiguous run of
    one or more series in ``order``; a key holding a third of all rows spans
    many chunks, so per-(key, chunk) work stays bounded by the chunk size.

    The range bounds are sampled on each execution: a plan that reads the
    tagged rows more than once must write them once first (``materialize``).
    """
    n = int(chunks or max(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-df.count() // CHUNK_ROWS)))
    return df.repartitionByRange(n, *keys, *order).withColumn(RANGE_CHUNK, F.spark_partition_id())


def with_ordinal(df: DataFrame, keys: Sequence[str], ts: str, bucket_seconds: int = 7 * 86400) -> DataFrame:
    """0-based position of each row in its series' time order (``ts`` unique
    per series)."""
    keys = list(keys)
    b = F.floor(F.unix_micros(F.col(ts).cast("timestamp")) / F.lit(int(bucket_seconds) * 1_000_000))
    x = df.withColumn("_b", b)
    counts = x.groupBy(*keys, "_b").agg(F.count(F.lit(1)).alias("_n"))
    wk = Window.partitionBy(*keys).orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select(*keys, "_b", F.coalesce(F.sum("_n").over(wk), F.lit(0)).alias("_start"))
    pos = F.row_number().over(Window.partitionBy(*keys, "_b").orderBy(ts)) - 1
    on = [F.col(f"x.{c}").eqNullSafe(F.col(f"s.{c}")) for c in [*keys, "_b"]]  # NULL keys and times are a bucket too
    return (x.withColumn("_p", pos).alias("x").join(starts.alias("s"), on)
             .select(*[f"x.{c}" for c in df.columns], (F.col("_start") + F.col("_p")).cast("long").alias(ORDINAL)))


def halo_chunks(df: DataFrame, keys: Sequence[str], ts: str, chunk_rows: int, back: int, ahead: int = 1,
                bucket_seconds: int = 7 * 86400) -> DataFrame:
    """Rows tagged with ``_chunk`` plus halo copies (``_halo = true``)."""
    if back > chunk_rows or ahead > chunk_rows:
        raise ValueError("chunk_rows must be at least the halo width")
    o = with_ordinal(df, keys, ts, bucket_seconds)
    c = F.floor(F.col(ORDINAL) / chunk_rows).cast("long")
    p = F.col(ORDINAL) % chunk_rows
    home = o.withColumns({CHUNK: c, HALO: F.lit(False)})
    nxt = o.filter(p >= chunk_rows - back).withColumns({CHUNK: c + 1, HALO: F.lit(True)})
    prv = o.filter(p < ahead).withColumns({CHUNK: c - 1, HALO: F.lit(True)})
    return home.unionByName(nxt).unionByName(prv).filter(F.col(CHUNK) >= 0).drop(ORDINAL)


def drop_halo(df: DataFrame) -> DataFrame:
    return df.filter(~F.col(HALO)).drop(HALO, CHUNK)
