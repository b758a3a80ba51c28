"""The forms for very long series (W8, P12, W13, W15, M14) and bucketed tables (S2, S4): the same results
as the plain entries', whose SQL they share."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from hourglass.catalog import ORACLE, register
from hourglass.catalog.common import KEYS, TS, features, raw, round_col, rounded
from hourglass.catalog.q_features import _AUDIT, _SEQ_FEATS
from hourglass.catalog.q_files import _path
from hourglass.catalog.q_model import FIXED_B0, FIXED_BETA, HORIZON
from hourglass.operators import longseries as LS
from hourglass.plans import forecast as FC
from hourglass.plans.features import build_features, build_features_chunked
from hourglass.session import write_table
from hourglass.sources.bucketed import open_bucketed, write_bucketed


@register("chrono_split_long", ORACLE["chrono_split"])
def q_chrono_split_long(spark, sf):
    """W8 with positions from time buckets."""
    f = write_table(features(spark, sf).select(*KEYS, TS))
    return LS.chrono_split_long(f, KEYS, TS)


@register("row_range_long", ORACLE["row_range"])
def q_row_range_long(spark, sf):
    """P12 with positions from time buckets."""
    return rounded(LS.row_range_long(write_table(raw(spark, sf).select(*KEYS, TS, "us_aqi")), KEYS, TS, 100, 200))


@register("lookback_sequences_long", ORACLE["lookback_sequences"])
def q_lookback_sequences_long(spark, sf):
    """W13 by chunks of consecutive rows with a halo of 24."""
    f = write_table(features(spark, sf).select(*KEYS, TS, "target_aqi", *[round_col(F.col(c)).alias(c) for c in _SEQ_FEATS]))
    return rounded(LS.lookback_sequences_long(f, KEYS, TS, _SEQ_FEATS, 24).select(*KEYS, TS, "target_aqi", "sequence"))


@register("lag_audit_long", ORACLE["lag_audit"])
def q_lag_audit_long(spark, sf):
    """W15 by chunks of consecutive rows with a halo of the largest lag."""
    return LS.lag_audit_long(write_table(features(spark, sf).select(*dict.fromkeys([*KEYS, TS, "us_aqi", *_AUDIT]))), KEYS, TS, "us_aqi", _AUDIT)


@register("recursive_forecast_long", ORACLE["recursive_forecast"])
def q_recursive_forecast_long(spark, sf):
    """M14 on features built by chunks: the fold reads the newest 145 rows of each series only."""
    f = build_features_chunked(write_table(raw(spark, sf)), KEYS, TS, drop_incomplete=False)
    newest = LS.last_rows(write_table(f), KEYS, TS, HORIZON + 73)
    return rounded(FC.recursive_forecast_linear(newest, FIXED_B0, FIXED_BETA, KEYS, TS, HORIZON))


@register("bucketed_features", ORACLE["hourly_features"])
def q_bucketed_features(spark, sf):
    """S2 + S4: the hourly rows written in buckets of the series key and opened again; the features
    are built from them without an exchange."""
    name, path = f"hourly_{uuid.uuid4().hex}", _path(spark, "bucketed")
    write_bucketed(raw(spark, sf), name, path, 8, KEYS, TS)
    table = open_bucketed(spark, f"{name}_again", path, 8, KEYS, TS)
    out = rounded(build_features(table, KEYS, TS))
    plan = out._jdf.queryExecution().executedPlan().toString()
    if "Exchange" in plan:
        raise RuntimeError("the features of a bucketed table are read with an exchange")
    return out
