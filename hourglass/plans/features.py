"""The hourly feature build (raw hourly table -> feature matrix).

One lazy plan: scan -> (optional dedup) -> one Window node for every lag,
lead, rolling mean and change (they share ``partitionBy(keys).orderBy(ts)``)
-> calendar columns -> drop incomplete rows.  One hash exchange on ``keys``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hourglass.functions.calendar import calendar_columns
from hourglass.operators.guards import require_columns
from hourglass.operators.windows import (
    change,
    change_prior,
    dedup_keep_last,
    lag_col,
    lead_col,
    rolling_mean_prior,
    rolling_mean_trailing,
    series_window,
)
from hourglass.schema import DEFAULT_SPEC, FeatureSpec


def _q(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def feature_sql(spec: FeatureSpec, keys: Sequence[str], ts: str, align: str = "target") -> dict[str, str]:
    """Spark SQL text of every lag/lead/rolling/change column, keyed by name.

    The same expressions as ``hourglass.operators.windows`` (W1-W7), written as
    one ``selectExpr`` so the driver makes one call instead of hundreds; all
    share ``PARTITION BY keys ORDER BY ts`` and land in one Window node."""
    w = f"PARTITION BY {', '.join(_q(k) for k in keys)} ORDER BY {_q(ts)}"
    src = _q(spec.target_source)

    def lag(c, k):
        return f"lag({c}, {k}) OVER ({w})"

    def prior(c, n):
        fr = f"({w} ROWS BETWEEN {n} PRECEDING AND 1 PRECEDING)"
        return f"CASE WHEN count({c}) OVER {fr} = {n} THEN avg({c}) OVER {fr} END"

    def trailing(c, n):
        return f"avg({c}) OVER ({w} ROWS BETWEEN {n - 1} PRECEDING AND CURRENT ROW)"

    out = {}
    for k in spec.aqi_lags:
        out[f"{spec.target_alias}_lag_{k}"] = lag(src, k)
    out[spec.target] = f"lead({src}, 1) OVER ({w})"
    for p in spec.pollutants:
        for k in spec.pollutant_lags:
            out[f"{p}_lag_{k}"] = lag(_q(p), k)
    for name, col, width in spec.mean_cols():
        c = _q(col)
        if align == "reference":
            out[name] = prior(c, width - 1) if col == spec.target_source and width > 1 else trailing(c, width)
        else:
            out[name] = prior(c, width)
    for name, col, k in spec.change_cols():
        c = _q(col)
        if align == "reference" and col == spec.target_source:
            out[name] = f"{lag(c, 1)} - {lag(c, k + 1)}"
        else:
            out[name] = f"{c} - {lag(c, k)}"
    return out


def feature_columns_expr(spec: FeatureSpec, keys: Sequence[str], ts: str, align: str = "target") -> dict:
    """Column-API form of ``feature_sql`` (W1-W7 operators)."""
    w = series_window(keys, ts)
    src = spec.target_source
    out = {}
    for k in spec.aqi_lags:
        out[f"{spec.target_alias}_lag_{k}"] = lag_col(src, k, w)
    out[spec.target] = lead_col(src, 1, w)
    for p in spec.pollutants:
        for k in spec.pollutant_lags:
            out[f"{p}_lag_{k}"] = lag_col(p, k, w)
    for name, col, width in spec.mean_cols():
        if align == "reference":
            out[name] = (rolling_mean_prior(col, width - 1, w) if col == src and width > 1
                         else rolling_mean_trailing(col, width, w))
        else:
            out[name] = rolling_mean_prior(col, width, w)
    for name, col, k in spec.change_cols():
        out[name] = change_prior(col, k, w) if (align == "reference" and col == src) else change(col, k, w)
    return out


def build_features(raw: DataFrame, keys: Sequence[str] = ("location_id",), ts: str = "timestamp",
                   spec: FeatureSpec = DEFAULT_SPEC, dedup_order: Sequence[str] | None = None,
                   drop_incomplete: bool = True, align: str = "target") -> DataFrame:
    """Raw hourly rows -> raw columns + calendar + lags + target + means + changes.

    ``dedup_order``: ingest-order columns; when given, duplicates per
    (keys, ts) keep the last (W11).  Rows missing any feature or the target are
    dropped (P6) unless ``drop_incomplete`` is False.
    """
    keys = list(keys)
    require_columns(raw, [*keys, ts, *spec.required_raw()], "raw")
    df = raw
    if dedup_order is not None:
        df = dedup_keep_last(df, keys, ts, dedup_order)
    types = dict(df.dtypes)
    clean = set(c for c in spec.required_raw() if types[c] in ("double", "float"))
    t = _q(ts)
    first = [f"CASE WHEN NOT isnan({_q(c)}) THEN {_q(c)} END AS {_q(c)}" if c in clean else _q(c) for c in df.columns]
    first += [f"hour({t}) AS hour", f"weekday({t}) AS day_of_week", f"dayofmonth({t}) AS day_of_month",
              f"month({t}) AS month", f"CAST(weekday({t}) >= 5 AS INT) AS is_weekend"]
    df = df.selectExpr(*first)
    df = df.selectExpr("*", *[f"{e} AS {_q(n)}" for n, e in feature_sql(spec, keys, ts, align).items()])
    if drop_incomplete:
        df = df.na.drop(subset=spec.feature_columns() + [spec.target])
    return df


def feature_matrix(features: DataFrame, keys: Sequence[str] = ("location_id",), ts: str = "timestamp",
                   spec: FeatureSpec = DEFAULT_SPEC, extra: Sequence[str] = ()) -> DataFrame:
    """Keys, time, the ordered 70 features and the target (model order)."""
    return features.select(*keys, ts, *spec.feature_columns(), spec.target, *extra)


def build_features_chunked(raw: DataFrame, keys: Sequence[str] = ("location_id",), ts: str = "timestamp",
                           spec: FeatureSpec = DEFAULT_SPEC, chunk_rows: int = 24 * 7 * 8,
                           drop_incomplete: bool = True, align: str = "target",
                           bucket_seconds: int = 7 * 86400) -> DataFrame:
    """``build_features`` for very long series: windows run per (keys, chunk)
    with a halo of ``spec.max_lookback`` rows before and one row after each
    chunk, so no task holds a whole series.  Output equals ``build_features``."""
    from hourglass.operators.halo import CHUNK, drop_halo, halo_chunks

    keys = list(keys)
    h = halo_chunks(raw, keys, ts, chunk_rows, back=spec.max_lookback, ahead=1, bucket_seconds=bucket_seconds)
    f = build_features(h, [*keys, CHUNK], ts, spec, drop_incomplete=False, align=align)
    f = drop_halo(f)
    if drop_incomplete:
        f = f.na.drop(subset=spec.feature_columns() + [spec.target])
    return f
