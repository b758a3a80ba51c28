"""Leakage audits."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hourglass.operators.aggregates import attach_scalars
from hourglass.operators.guards import monotonic_report, name_families
from hourglass.operators.windows import series_window


def temporal_leakage_report(df: DataFrame, keys: Sequence[str], ts: str, checks: dict[str, tuple[str, int]]) -> DataFrame:
    """Recompute each stored shift ``{column: (source, k)}`` (k > 0 lag,
    k < 0 lead), compare where both are non-null, and add a verdict row that
    includes every check."""
    w = series_window(keys, ts)
    exp = {f"_e{i}": (F.lag(src, k).over(w) if k > 0 else F.lead(src, -k).over(w))
           for i, (src, k) in enumerate(checks.values())}
    wide = df.select(*checks.keys(), *[e.alias(n) for n, e in exp.items()])
    long = wide.select(F.explode(F.array(*[
        F.struct(F.lit(c).alias("column_name"), F.lit(int(k)).alias("shift"), F.col(c).alias("stored"),
                 F.col(f"_e{i}").alias("expected")) for i, (c, (_, k)) in enumerate(checks.items())])).alias("x")).select("x.*")
    both = F.col("stored").isNotNull() & F.col("expected").isNotNull()
    g = long.groupBy("column_name", "shift").agg(F.count_if(both).alias("compared"),
                                                  F.count_if(both & (F.col("stored") != F.col("expected"))).alias("mismatches"))
    g = g.withColumn("passed", F.col("mismatches") == 0)
    verdict = g.agg(F.lit("__verdict__").alias("column_name"), F.lit(0).alias("shift"),
                    F.sum("compared").cast("long").alias("compared"), F.sum("mismatches").cast("long").alias("mismatches"),
                    F.bool_and("passed").alias("passed"))
    return g.unionByName(verdict)


def leakage_flags(df: DataFrame, keys: Sequence[str], ts: str, features: Sequence[str], target: str = "target_aqi",
                  source: str = "us_aqi", ordinal: str = "arrival") -> DataFrame:
    """M17's verdict on the inputs: the target or the current value among them, their
    suspicious names (G3), and rows that arrive in time order (P16)."""
    odd = sorted(name_families(features)["future_like"])
    order = monotonic_report(df, keys, ts, ordinal).agg((F.coalesce(F.sum("out_of_order"), F.lit(0)) == 0).alias("time_ordered"))
    flags = order.select(F.lit(target in features).alias("target_in_inputs"), F.lit(source in features).alias("current_in_inputs"),
                         F.lit(",".join(odd)).alias("suspicious_inputs"), "time_ordered")
    return flags.withColumn("passed", ~F.col("target_in_inputs") & ~F.col("current_in_inputs")
                            & (F.col("suspicious_inputs") == "") & F.col("time_ordered"))


def structural_leakage_report(df: DataFrame, keys: Sequence[str], ts: str, features: Sequence[str],
                              target: str, source: str = "us_aqi", ordinal: str | None = None) -> DataFrame:
    """One row: rows of each series arrive in time order (P16; ``ordinal`` is the
    arrival order, without it the places of the rows as read), target min/max/mean, total NULLs in
    features and target, the current value excluded from inputs (G2), no future-like
    names among inputs (G3)."""
    fam = name_families(features)
    if ordinal is None:
        ordinal, df = "_arrival", df.withColumn("_arrival", F.monotonically_increasing_id())
    nulls = sum((F.col(c).isNull().cast("long") for c in features), F.lit(0))
    order = monotonic_report(df, keys, ts, ordinal).agg(F.coalesce(F.sum("out_of_order"), F.lit(0)).cast("long").alias("order_violations"))
    rep = df.agg(F.min(target).alias("target_min"), F.max(target).alias("target_max"), F.avg(target).alias("target_mean"),
                 F.coalesce(F.sum(nulls), F.lit(0)).cast("long").alias("feature_nulls"),
                 F.count_if(F.col(target).isNull()).alias("target_nulls"), F.count(F.lit(1)).alias("rows"))
    rep = attach_scalars(rep, order)
    return rep.select("*", F.lit(source not in features).alias("current_value_excluded"),
                      F.lit(len(fam["future_like"]) == 0).alias("no_future_like_inputs"),
                      F.lit(len(fam["lag"])).alias("lag_features"), F.lit(len(fam["mean"])).alias("mean_features"),
                      F.lit(len(fam["change"])).alias("change_features"),
                      ((F.col("order_violations") == 0) & (F.col("feature_nulls") == 0) & (F.col("target_nulls") == 0)
                       & F.lit(source not in features) & F.lit(len(fam["future_like"]) == 0)).alias("passed"))
