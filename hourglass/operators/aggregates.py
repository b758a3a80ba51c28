"""Aggregation operators.

All are ``groupBy().agg()`` plans: Spark runs a partial aggregate before the
shuffle, so a hot group is combined map-side.  Quantiles use the exact,
sort-based ``quantiles`` below (no single-task collection of a column).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hourglass.functions.calendar import date_of
from hourglass.functions.numeric import round_half_even, safe_div
from hourglass.session import write_table


def attach_scalars(df: DataFrame, one_row: DataFrame) -> DataFrame:
    """Append the columns of a one-row aggregate to every row (broadcast of a
    single row: a proven size bound)."""
    return (df.withColumn("_one", F.lit(1))
              .join(F.broadcast(one_row.withColumn("_one", F.lit(1))), "_one", "left")
              .drop("_one"))


def extent(df: DataFrame, ts: str, keys: Sequence[str] = ()) -> DataFrame:
    """A1: rows, columns, first and last timestamp (per series if ``keys``)."""
    aggs = [F.count(F.lit(1)).alias("rows"), F.lit(len(df.columns)).alias("columns"),
            F.min(ts).alias("first_ts"), F.max(ts).alias("last_ts")]
    return df.groupBy(*keys).agg(*aggs) if keys else df.agg(*aggs)


def null_counts(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """A2: long table (column_name, nulls) plus a ``__total__`` row, one pass."""
    from hourglass.operators.guards import null_report

    rep = null_report(df, cols)
    total = rep.agg(F.lit("__total__").alias("column_name"), F.sum("nulls").cast("long").alias("nulls"))
    return rep.unionByName(total)


def duplicate_count(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """A3: rows after the first occurrence of each value of ``cols`` (whole row
    by default).  Two-level aggregation: count per value, then sum(n - 1)."""
    cols = list(cols or df.columns)
    per = df.groupBy(*cols).agg(F.count(F.lit(1)).alias("_n"))
    return per.agg(F.coalesce(F.sum(F.col("_n") - 1), F.lit(0)).cast("long").alias("duplicates"),
                   F.count(F.lit(1)).alias("distinct_values"))


def quantiles(df: DataFrame, cols: Sequence[str], probs: Sequence[float], keys: Sequence[str] = ()) -> DataFrame:
    """Exact quantiles with linear interpolation (pandas/DuckDB ``quantile_cont``).

    Equal values are counted before the shuffle, so a value that fills a group is
    one row.  The counts are range-sorted and written once (range bounds are
    sampled per execution; every branch must see the same pieces), given their
    first ordinal by a running sum per piece and a prefix sum over the pieces of a
    group, and only the values around each requested position are kept.
    Output: keys, column, p, value.
    """
    keys = list(keys)
    long = df.select(*keys, F.explode(F.array(*[
        F.struct(F.lit(c).alias("column_name"), F.col(c).cast("double").alias("v")) for c in cols])).alias("_x")) \
        .select(*keys, "_x.column_name", "_x.v").filter(F.col("v").isNotNull() & ~F.isnan("v"))
    grp = [*keys, "column_name"]
    counts = long.groupBy(*grp, "v").agg(F.count(F.lit(1)).alias("_c"))
    srt = write_table(counts.orderBy(*grp, "v").withColumn("_pid", F.spark_partition_id()))
    grp_w = Window.partitionBy(*grp)
    part = srt.groupBy(*grp, "_pid").agg(F.sum("_c").alias("_s"))
    part = part.withColumns({
        "_before": F.coalesce(F.sum("_s").over(grp_w.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)),
        "_n": F.sum("_s").over(grp_w)}).drop("_s")
    same = [F.col(f"srt.{c}").eqNullSafe(F.col(f"part.{c}")) for c in [*grp, "_pid"]]
    run = F.sum("_c").over(Window.partitionBy(*grp, "_pid").orderBy("v").rowsBetween(Window.unboundedPreceding, 0))
    ordered = (srt.withColumn("_run", run).alias("srt").join(part.alias("part"), same)
                  .select(*[f"srt.{c}" for c in grp], "v", "_c", "_n", (F.col("_before") + F.col("_run")).alias("_end")))
    h = F.col("p") * (F.col("_n") - 1)
    holds = lambda at: (F.col("_end") - F.col("_c") <= at) & (at < F.col("_end"))
    wanted = ordered.withColumn("p", F.explode(F.array(*[F.lit(float(x)) for x in probs])))
    picked = wanted.filter(holds(F.floor(h)) | holds(F.ceil(h)))
    lo, hi = (F.max(F.when(holds(f(h)), F.col("v"))) for f in (F.floor, F.ceil))
    out = picked.groupBy(*grp, "p").agg(lo.alias("_lo"), hi.alias("_hi"), F.first(h - F.floor(h)).alias("_frac"))
    return out.select(*grp, "p", (F.col("_lo") + (F.col("_hi") - F.col("_lo")) * F.col("_frac")).alias("value"))


def describe(df: DataFrame, cols: Sequence[str], keys: Sequence[str] = ()) -> DataFrame:
    """A4: count, mean, std (sample), min, 25/50/75 % (exact), max per column,
    long form (keys, column, count, mean, std, min, p25, p50, p75, max)."""
    keys = list(keys)
    long = df.select(*keys, F.explode(F.array(*[
        F.struct(F.lit(c).alias("column_name"), F.col(c).cast("double").alias("v")) for c in cols])).alias("_x")) \
        .select(*keys, "_x.column_name", "_x.v")
    moments = long.groupBy(*keys, "column_name").agg(
        F.count("v").alias("count"), F.avg("v").alias("mean"), F.stddev_samp("v").alias("std"),
        F.min("v").alias("min"), F.max("v").alias("max"))
    q = quantiles(df, cols, [0.25, 0.5, 0.75], keys)
    qw = q.groupBy(*keys, "column_name").pivot("p", [0.25, 0.5, 0.75]).agg(F.first("value"))
    qw = qw.withColumnsRenamed({"0.25": "p25", "0.5": "p50", "0.75": "p75"})
    return moments.join(qw, [*keys, "column_name"], "left").select(
        *keys, "column_name", "count", "mean", "std", "min", "p25", "p50", "p75", "max")


def target_stats(df: DataFrame, col: str, keys: Sequence[str] = ()) -> DataFrame:
    """A5: mean, median, min, max, std (sample) of one column."""
    keys = list(keys)
    m = df.groupBy(*keys).agg(F.avg(col).alias("mean"), F.min(col).alias("min"), F.max(col).alias("max"),
                              F.stddev_samp(col).alias("std"))
    med = quantiles(df, [col], [0.5], keys).select(*keys, F.col("value").alias("median"))
    if keys:
        return m.join(med, keys, "left")
    return attach_scalars(m, med)


def hours_per_day(df: DataFrame, ts: str, keys: Sequence[str] = ()) -> DataFrame:
    """Observations per calendar day."""
    return df.groupBy(*keys, date_of(ts).alias("date")).agg(F.count(F.lit(1)).alias("hours"))


def day_completeness(df: DataFrame, ts: str, keys: Sequence[str] = (), full: int = 24) -> DataFrame:
    """Number of days, days below ``full`` hours, days at ``full``, and the
    spread of the daily counts (sample standard deviation, exact quartiles)."""
    keys = list(keys)
    d = hours_per_day(df, ts, keys)
    q = quantiles(d, ["hours"], [0.25, 0.5, 0.75], keys).groupBy(*keys).pivot("p", [0.25, 0.5, 0.75]).agg(F.first("value"))
    q = q.withColumnsRenamed({"0.25": "p25_hours", "0.5": "p50_hours", "0.75": "p75_hours"})
    counts = d.groupBy(*keys).agg(F.stddev_samp("hours").alias("std_hours"), F.count(F.lit(1)).alias("days"),
                                F.count_if(F.col("hours") < full).alias("incomplete_days"),
                                F.count_if(F.col("hours") == full).alias("complete_days"),
                                F.min("hours").alias("min_hours"), F.max("hours").alias("max_hours"),
                                F.avg("hours").alias("mean_hours"))
    return counts.join(q, keys, "left") if keys else attach_scalars(counts, q)


def daily_summary(df: DataFrame, ts: str, keys: Sequence[str], means: Sequence[str],
                  temperature: str = "temperature_2m", precipitation: str = "precipitation") -> DataFrame:
    """Daily means plus temperature max/min and precipitation sum."""
    aggs = [F.avg(c).alias(f"{c}_mean") for c in means]
    aggs += [F.max(temperature).alias(f"{temperature}_max"), F.min(temperature).alias(f"{temperature}_min"),
             F.sum(precipitation).alias(f"{precipitation}_sum")]
    return df.groupBy(*keys, date_of(ts).alias("date")).agg(*aggs)


def category_distribution(df: DataFrame, cat: str, keys: Sequence[str] = (), digits: int = 2) -> DataFrame:
    """Count and percent share per category (share over the group total)."""
    keys = list(keys)
    c = df.groupBy(*keys, cat).agg(F.count(F.lit(1)).alias("count"))
    tot = F.sum("count").over(Window.partitionBy(*keys)) if keys else F.sum("count").over(Window.partitionBy())
    return c.withColumn("percent", round_half_even(F.col("count") * 100.0 / tot, digits))


def histogram(df: DataFrame, col: str, bins: int = 30) -> DataFrame:
    """A10: equal-width bins between min and max, last bin closed; empty bins
    are emitted with zero.  min/max is a one-row aggregate joined back."""
    rng = df.agg(F.min(col).alias("_lo"), F.max(col).alias("_hi"))
    x = attach_scalars(df.select(col).filter(F.col(col).isNotNull()), rng)
    width = (F.col("_hi") - F.col("_lo")) / bins
    b = F.when(F.col("_hi") == F.col("_lo"), F.lit(0)).otherwise(
        F.least(F.floor((F.col(col) - F.col("_lo")) / width), F.lit(bins - 1))).cast("int")
    counts = x.groupBy(b.alias("bin")).agg(F.count(F.lit(1)).alias("count"))
    grid = rng.select(F.explode(F.sequence(F.lit(0), F.lit(bins - 1))).alias("bin"), "_lo", "_hi")
    return (grid.join(counts, "bin", "left")
                .select("bin",
                        (F.col("_lo") + (F.col("_hi") - F.col("_lo")) * F.col("bin") / bins).alias("bin_start"),
                        (F.col("_lo") + (F.col("_hi") - F.col("_lo")) * (F.col("bin") + 1) / bins).alias("bin_end"),
                        F.coalesce("count", F.lit(0)).cast("long").alias("count")))


def _error_aggs(actual: str, pred: str) -> list[Column]:
    """Counts, error sums and the actuals' variance over the rows with both sides."""
    e = F.col(actual) - F.col(pred)  # NULL where a side is
    return [F.count(e).alias("n"), (F.count(F.lit(1)) - F.count(e)).alias("skipped"), F.avg(F.abs(e)).alias("mae"),
            F.sqrt(F.avg(e * e)).alias("rmse"), F.sum(e * e).alias("_sse"),
            F.var_pop(F.when(e.isNotNull(), F.col(actual))).alias("_var")]


def _r2(g: DataFrame) -> DataFrame:
    r2 = F.lit(1.0) - safe_div(F.col("_sse"), F.col("n") * F.col("_var"))
    return g.withColumn("r2", F.when(F.col("_var") > 0, r2)).drop("_sse", "_var")


def regression_metrics(df: DataFrame, actual: str, pred: str, keys: Sequence[str] = ()) -> DataFrame:
    """MAE, RMSE and R^2 (``1 - SSE / SST``; NULL when the actuals have no
    variance).  One aggregate; rows with a NULL on either side are counted in
    ``skipped``."""
    aggs = _error_aggs(actual, pred)
    return _r2(df.groupBy(*keys).agg(*aggs) if keys else df.agg(*aggs))


def block_metrics(df: DataFrame, actual: str, pred: str, keys: Sequence[str], block: str = "forecast_day",
                  ts: str = "timestamp") -> DataFrame:
    """A12 per block plus predicted/actual means, signed, absolute and
    percentage error of the means (``try_divide``: NULL for a zero mean).  Rows with
    a NULL on either side are counted in ``skipped`` only."""
    both = F.col(actual).isNotNull() & F.col(pred).isNotNull()
    of = lambda c: F.when(both, F.col(c))
    g = df.groupBy(*keys, block).agg(
        F.min(of(ts)).alias("start"), F.max(of(ts)).alias("end"),
        F.avg(of(pred)).alias("predicted_avg"), F.avg(of(actual)).alias("actual_avg"), *_error_aggs(actual, pred))
    g = _r2(g).withColumnRenamed("n", "hours")
    return (g.withColumn("average_error", F.col("predicted_avg") - F.col("actual_avg"))
             .withColumn("absolute_error", F.abs(F.col("average_error")))
             .withColumn("percentage_error", safe_div(F.col("absolute_error") * 100.0, F.col("actual_avg"))))


def block_actual_vs_pred(df: DataFrame, actual: str, pred: str, keys: Sequence[str], block: str = "forecast_day",
                         digits: int | None = None) -> DataFrame:
    """mean/min/max of both sides per block, hours (predictions that are not
    NULL), abs and pct error."""
    keys = list(keys)
    g = df.groupBy(*keys, block).agg(
        F.count(pred).alias("hours"),
        F.avg(pred).alias("predicted_mean"), F.min(pred).alias("predicted_min"), F.max(pred).alias("predicted_max"),
        F.avg(actual).alias("actual_mean"), F.min(actual).alias("actual_min"), F.max(actual).alias("actual_max"))
    g = g.withColumn("abs_error", F.abs(F.col("predicted_mean") - F.col("actual_mean"))) \
         .withColumn("pct_error", safe_div(F.col("abs_error") * 100.0, F.col("actual_mean")))
    if digits is not None:
        g = g.withColumns({c: round_half_even(c, digits) for c in g.columns
                           if c not in (*keys, block, "hours")})
    return g


def metrics_of_block_means(blocks: DataFrame, keys: Sequence[str] = (), digits: int = 2) -> DataFrame:
    """A12 over the per-block means produced by A14, rounded (half even) first."""
    means = {c: round_half_even(c, digits) for c in ("actual_mean", "predicted_mean")}
    return regression_metrics(blocks.withColumns(means), "actual_mean", "predicted_mean", keys)


def distinct_values(df: DataFrame, col: str) -> DataFrame:
    """A16."""
    return df.select(col).distinct()


def global_importance(attr: DataFrame, feature: str = "feature", value: str = "contribution") -> DataFrame:
    """Mean absolute attribution per feature."""
    return attr.groupBy(feature).agg(F.avg(F.abs(value)).alias("mean_abs"))


def champion(metrics: DataFrame, by: str = "rmse") -> DataFrame:
    """The row with the lowest ``by`` (``min_by`` over a struct)."""
    return metrics.agg(F.min_by(F.struct(*[F.col(c) for c in metrics.columns]), F.col(by)).alias("_c")).select("_c.*")


def block_completeness(df: DataFrame, keys: Sequence[str], block: str = "forecast_day", hours: int = 24,
                       blocks: int = 3, pred: str = "predicted_aqi") -> DataFrame:
    """Every block has ``hours`` predictions (NULLs do not count), ``blocks``
    blocks, total = product."""
    per = df.groupBy(*keys, block).agg(F.count(pred).alias("n"))
    return per.groupBy(*keys).agg(F.count(F.lit(1)).alias("blocks"), F.sum("n").alias("total_hours"),
                                  F.bool_and(F.col("n") == hours).alias("all_full")) \
              .withColumn("complete", F.col("all_full") & (F.col("blocks") == blocks)
                          & (F.col("total_hours") == hours * blocks))


def coverage_report(df: DataFrame, is_future: Column | str, cols: Sequence[str], keys: Sequence[str] = ()) -> DataFrame:
    """historical/future row counts and nulls of ``cols`` on each side."""
    fut = F.expr(is_future) if isinstance(is_future, str) else is_future
    aggs = [F.count_if(~fut).alias("history_rows"), F.count_if(fut).alias("future_rows")]
    for c in cols:
        aggs += [F.count_if(~fut & F.col(c).isNull()).alias(f"history_null_{c}"),
                 F.count_if(fut & F.col(c).isNull()).alias(f"future_null_{c}")]
    return df.groupBy(*keys).agg(*aggs) if keys else df.agg(*aggs)


def split_extents(df: DataFrame, ts: str, split: str = "split", keys: Sequence[str] = ()) -> DataFrame:
    """Rows and first/last timestamp per split."""
    return df.groupBy(*keys, split).agg(F.count(F.lit(1)).alias("rows"), F.min(ts).alias("first_ts"),
                                        F.max(ts).alias("last_ts"))
