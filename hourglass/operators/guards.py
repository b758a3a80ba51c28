"""Metadata guards (G1-G4) and row-level contracts.

G1-G4 only look at column names on the driver.  Row-level checks run as one
distributed aggregate and return a one-row DataFrame (or raise, when asked).
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hourglass.schema import NON_FEATURE_COLUMNS


class ContractError(ValueError):
    """A schema or data contract does not hold."""


def require_columns(df: DataFrame, required: Iterable[str], what: str = "input") -> DataFrame:
    """G1: fail listing every missing name."""
    missing = [c for c in required if c not in df.columns]
    if missing:
        raise ContractError(f"Missing required {what} columns: {missing}")
    return df


def feature_list(df: DataFrame, exclude: Sequence[str] = NON_FEATURE_COLUMNS) -> list[str]:
    """Every column except the exclusion list, in table order."""
    ex = set(exclude)
    return [c for c in df.columns if c not in ex]


def name_families(columns: Iterable[str]) -> dict[str, list[str]]:
    """Group names by case-folded substring family."""
    fam = {"lag": [], "mean": [], "change": [], "future_like": []}
    for c in columns:
        low = c.casefold()
        if "_lag_" in low:
            fam["lag"].append(c)
        if "_mean" in low:
            fam["mean"].append(c)
        if "_change_" in low:
            fam["change"].append(c)
        if any(tok in low for tok in ("future", "lead", "next", "target")):
            fam["future_like"].append(c)
    return fam


def check_feature_order(expected: Sequence[str], actual: Sequence[str]) -> None:
    """model's ordered feature names equal the table's."""
    if list(expected) != list(actual):
        missing = [c for c in expected if c not in actual]
        extra = [c for c in actual if c not in expected]
        raise ContractError(
            f"Feature order mismatch ({len(expected)} expected, {len(actual)} given); missing={missing} extra={extra}"
        )


def null_report(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """P17/A2 core: one-pass null count per column, long form (column_name, nulls)."""
    cols = list(cols or df.columns)
    wide = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in cols])
    return wide.select(F.explode(F.array(*[
        F.struct(F.lit(c).alias("column_name"), F.col(c).cast("long").alias("nulls")) for c in cols
    ])).alias("r")).select("r.*")


def assert_no_nulls(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Raise naming offending columns; returns ``df`` unchanged."""
    bad = [r["column_name"] for r in null_report(df, cols).filter("nulls > 0").collect()]
    if bad:
        raise ContractError(f"Null values in columns: {bad}")
    return df


def assert_shape(df: DataFrame, rows: int | None = None, cols: int | None = None) -> DataFrame:
    """Exact row and/or column count."""
    if cols is not None and len(df.columns) != cols:
        raise ContractError(f"Expected {cols} columns, found {len(df.columns)}")
    if rows is not None:
        n = df.count()
        if n != rows:
            raise ContractError(f"Expected {rows} rows, found {n}")
    return df


def write_checked(df: DataFrame, path: str, not_null: Sequence[str] = (), rows: int | None = None, cols: int | None = None) -> DataFrame:
    """P17 and P18 in the pass that writes ``df`` (Parquet) to ``path``, and the table read back.  Rows and
    nulls are counted as the rows are written, beside the final place; a table that fails
    the checks is removed and named in the error, so ``path`` only ever holds one that passed."""
    from pyspark.sql import Observation

    from hourglass.sources.claims import exists, move, remove

    spark = df.sparkSession
    assert_shape(df, cols=cols)
    if exists(spark, path):
        raise ContractError(f"{path} is there already")
    seen = Observation()
    counts = [F.count(F.lit(1)).alias("_rows"), *[F.count_if(F.col(c).isNull()).alias(f"_null_{i}") for i, c in enumerate(not_null)]]
    beside = f"{path}.unchecked"
    df.observe(seen, *counts).write.mode("overwrite").parquet(beside)
    got = seen.get
    bad = [c for i, c in enumerate(not_null) if got[f"_null_{i}"]]
    wrong = f"Null values in columns: {bad}" if bad else f"Expected {rows} rows, found {got['_rows']}" if rows is not None and got["_rows"] != rows else None
    if wrong:
        remove(spark, beside)
        raise ContractError(wrong)
    move(spark, beside, path)
    return spark.read.schema(df.schema).parquet(path)


def monotonic_report(df: DataFrame, keys: Sequence[str], ts: str, ordinal: str,
                     chunks: int | None = None) -> DataFrame:
    """Per series, count rows whose ``ts`` is earlier than the previous
    row in arrival order (``ordinal``).  A DataFrame has no row order, so the
    arrival ordinal must be a column.

    Skew-safe: rows are range-partitioned on (keys, ordinal) into balanced
    chunks; the previous row is found inside each (keys, chunk), and the first
    row of a chunk is compared with the last row of the key's preceding chunk
    on the small (keys x chunk) table.
    """
    from pyspark.sql import Window

    from hourglass.operators.halo import RANGE_CHUNK as C
    from hourglass.operators.halo import range_chunks

    keys = list(keys)
    t = range_chunks(df.select(*keys, ordinal, ts), keys, [ordinal], chunks)
    prev = F.lag(ts, 1).over(Window.partitionBy(*keys, C).orderBy(ordinal))
    per = (t.select(*keys, C, ordinal, ts, prev.alias("_prev"))
            .groupBy(*keys, C)
            .agg(F.count_if(F.col(ts) < F.col("_prev")).alias("_bad"), F.count(F.lit(1)).alias("_n"),
                 F.min_by(ts, ordinal).alias("_first"), F.max_by(ts, ordinal).alias("_last")))
    edge = F.col("_first") < F.lag("_last", 1).over(Window.partitionBy(*keys).orderBy(C))
    per = per.withColumn("_bad", F.col("_bad") + F.coalesce(edge.cast("long"), F.lit(0)))
    return (per.groupBy(*keys)
               .agg(F.sum("_bad").cast("long").alias("out_of_order"), F.sum("_n").cast("long").alias("rows"))
               .withColumn("is_monotonic", F.col("out_of_order") == 0))


def all_true(df: DataFrame, predicates: dict[str, object]) -> DataFrame:
    """``bool_and`` of each named predicate, one row."""
    return df.agg(*[F.bool_and(F.coalesce(p if not isinstance(p, str) else F.expr(p), F.lit(False))).alias(n)
                    for n, p in predicates.items()])
