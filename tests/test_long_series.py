"""Long series and bucketed tables: equal to the plain forms, with bounded tasks and without an exchange."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from hourglass.catalog.common import rounded
from hourglass.operators import longseries as LS
from hourglass.operators import projections as P
from hourglass.operators import windows as W
from hourglass.plans import forecast as FC
from hourglass.plans.features import build_features, build_features_chunked
from hourglass.sources.bucketed import open_bucketed, write_bucketed
from hourglass.sources.events import raw_hourly_from_dir
from table_dirs import SF0001

T0 = dt.datetime(2023, 1, 1)


@pytest.fixture(scope="module")
def rows(spark):
    """One series with a third of the rows, others short, a null key, gaps in the hours."""
    r = random.Random(4)
    out, sizes = [], {"long": 900, None: 30} | {f"s{i}": r.randint(1, 120) for i in range(28)}
    for k, n in sizes.items():
        t = T0
        for _ in range(n):
            t += dt.timedelta(hours=r.choice([1, 1, 1, 7]))
            out.append((k, t, None if r.random() < 0.05 else round(r.random(), 4)))
    r.shuffle(out)
    return spark.createDataFrame(out, "location_id string, timestamp timestamp_ntz, v double")


def _same(a, b):
    a = a.select(*b.columns)
    return a.count() == b.count() and a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


KEYS, TS = ["location_id"], "timestamp"
DAY = {"bucket_seconds": 86400}


def test_positions_equal_the_plain_window(rows):
    assert _same(LS.chrono_split_long(rows, KEYS, TS, **DAY), W.chrono_split(rows, KEYS, TS))
    for a, b in ((10, 60), (0, None), (850, None)):
        assert _same(LS.row_range_long(rows, KEYS, TS, a, b, **DAY), P.row_range(rows, KEYS, TS, a, b))
    newest = LS.last_rows(rows, KEYS, TS, 50, **DAY).groupBy(*KEYS).count()
    want = rows.groupBy(*KEYS).agg(F.least(F.lit(50), F.count(F.lit(1))).alias("count"))
    assert _same(newest, want)


@pytest.mark.parametrize("chunk_rows", [24, 100])
def test_lookback_and_audit_equal_the_plain_forms(rows, chunk_rows):
    x = rows.withColumn("lag_3", F.lag("v", 3).over(W.series_window(KEYS, TS))).withColumn("ahead", F.lead("v", 1).over(W.series_window(KEYS, TS)))
    x = x.withColumn("lag_3", F.when(F.col("v") > 0.9, 7.0).otherwise(F.col("lag_3")))
    got = LS.lookback_sequences_long(rows, KEYS, TS, ["v"], 24, chunk_rows=chunk_rows, **DAY)
    assert _same(got, W.lookback_sequences(rows, KEYS, TS, ["v"], 24))
    checks = {"lag_3": 3, "ahead": -1}
    audit = LS.lag_audit_long(x, KEYS, TS, "v", checks, chunk_rows, **DAY)
    assert _same(audit, W.lag_audit(x, KEYS, TS, "v", checks)) and audit.filter("mismatches > 0").count() == 1


def test_no_window_holds_more_than_a_chunk(rows):
    """The rows of the largest (series, chunk) and (series, bucket), halo included."""
    h = LS.halo_chunks(rows, KEYS, TS, 48, back=24, ahead=0, **DAY)
    assert h.groupBy(*KEYS, LS.CHUNK).count().agg(F.max("count")).first()[0] <= 48 + 24


def test_forecast_reads_the_newest_rows_only(spark):
    raw = raw_hourly_from_dir(spark, SF0001)
    beta = {"aqi_lag_1": 0.6, "aqi_24h_mean": 0.2, "aqi_lag_72": 0.05, "hour": 0.1}
    whole = FC.recursive_forecast_linear(build_features(raw, drop_incomplete=False), 1.0, beta, horizon=6)
    chunked = build_features_chunked(raw, chunk_rows=96, drop_incomplete=False, **DAY)
    newest = LS.last_rows(chunked, KEYS, TS, 6 + 73, **DAY)
    assert _same(rounded(FC.recursive_forecast_linear(newest, 1.0, beta, horizon=6)), rounded(whole))


def test_bucketed_tables_need_no_exchange(spark, tmp_path):
    raw = raw_hourly_from_dir(spark, SF0001)
    path = str(tmp_path / "hourly")
    table = write_bucketed(raw, "hourly_bucketed_test", path, buckets=4)
    feats = build_features(table)
    plan = feats._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Window" in plan
    assert "Exchange" in build_features(spark.read.parquet(path))._jdf.queryExecution().executedPlan().toString()
    assert _same(rounded(feats), rounded(build_features(raw)))
    again = open_bucketed(spark, "hourly_reopened_test", path, buckets=4)
    both = W.chrono_split(build_features(again), KEYS, TS)
    assert "Exchange" not in both._jdf.queryExecution().executedPlan().toString()
    assert _same(rounded(both.drop("split")), rounded(feats))
    for name in ("hourly_bucketed_test", "hourly_reopened_test"):
        spark.sql(f"DROP TABLE {name}")
