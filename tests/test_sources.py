"""File sources and sinks (S1, S3, S4, S9), the fixture (S10) and the shape
guard (P18): round trips through real files in a per-test folder."""

import glob
import os

import pyarrow.parquet as pq
import pytest

from hourglass.operators.guards import ContractError, assert_shape
from hourglass.schema import DEFAULT_SPEC, RAW_HOURLY_SCHEMA
from hourglass.sources import files as FS
from hourglass.sources.events import raw_hourly_from_dir

from table_dirs import SF0001


def _raw(spark):
    # the events mapping carries the 6 air columns; sub-indices are absent, so fill them
    r = raw_hourly_from_dir(spark, SF0001)
    for c in RAW_HOURLY_SCHEMA.fieldNames():
        if c not in r.columns:
            r = r.withColumn(c, r["us_aqi"].cast(RAW_HOURLY_SCHEMA[c].dataType))
    return r.select(*[r[f.name].cast(f.dataType).alias(f.name) for f in RAW_HOURLY_SCHEMA.fields])


def test_csv_round_trip(spark, tmp_path):
    """S3 then S1: the same rows come back with the declared types."""
    raw = _raw(spark)
    path = str(tmp_path / "raw_csv")
    FS.write_csv(raw, path)
    back = FS.read_hourly_csv(spark, path)
    assert [(f.name, f.dataType) for f in back.schema] == [(f.name, f.dataType) for f in RAW_HOURLY_SCHEMA]
    assert back.count() == raw.count()
    assert back.exceptAll(raw).count() == 0 and raw.exceptAll(back).count() == 0


def test_read_csv_names_missing_columns(spark, tmp_path):
    """G1 inside S1: a missing required column is named in the error."""
    path = str(tmp_path / "thin.csv")
    with open(path, "w") as fh:
        fh.write("timestamp,us_aqi\n2024-01-01 00:00:00,10.0\n")
    from pyspark.sql import types as T

    schema = T.StructType([T.StructField("timestamp", T.TimestampNTZType()), T.StructField("us_aqi", T.DoubleType())])
    with pytest.raises(ValueError, match="pm2_5"):
        FS.read_hourly_csv(spark, path, schema)


def test_parquet_sink_clusters_by_series(spark, tmp_path):
    """One hash partition per series group, each file sorted by (key, ts);
    S2 reads it back whole, and a pruned read only asks for its columns."""
    raw = _raw(spark)
    path = str(tmp_path / "feat")
    FS.write_features(raw, path, files_per_write=3)
    files = glob.glob(os.path.join(path, "*.parquet"))
    assert 1 <= len(files) <= 3
    seen = {}
    for f in files:
        t = pq.read_table(f, columns=["location_id", "timestamp"]).to_pandas()
        keys = list(zip(t["location_id"], t["timestamp"]))
        assert keys == sorted(keys)
        for k in set(t["location_id"]):
            assert k not in seen, "a series is split across files"
            seen[k] = f
    back = FS.read_features(spark, path)
    assert back.count() == raw.count()
    pruned = FS.read_features(spark, path, ["location_id", "us_aqi"]).filter("us_aqi > 0")
    plan = pruned._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<location_id:string,us_aqi:double>" in plan
    assert "GreaterThan(us_aqi,0.0)" in plan.split("PushedFilters:")[1].split("]")[0]


def test_csv_to_parquet(spark, tmp_path):
    """CSV in, clustered Parquet out, same rows."""
    raw = _raw(spark)
    src, dst = str(tmp_path / "in_csv"), str(tmp_path / "out_pq")
    FS.write_csv(raw, src)
    out = FS.csv_to_parquet(spark, src, dst)
    assert out.exceptAll(raw).count() == 0 and raw.exceptAll(out).count() == 0


def test_hourly_fixture_contract(spark):
    """N consecutive hours, all 70 features + target, calendar columns
    derived from time, values in range, reproducible by seed."""
    fx = FS.hourly_fixture(spark, n=100, seed=42)
    assert_shape(fx, rows=100)
    missing = set(DEFAULT_SPEC.feature_columns()) - set(fx.columns)
    assert not missing
    pdf = fx.orderBy("timestamp").toPandas()
    assert (pdf["timestamp"].diff().dropna().dt.total_seconds() == 3600).all()
    assert (pdf["hour"] == pdf["timestamp"].dt.hour).all()
    assert (pdf["day_of_week"] == pdf["timestamp"].dt.dayofweek).all()
    assert (pdf["is_weekend"] == (pdf["timestamp"].dt.dayofweek >= 5).astype(int)).all()
    assert pdf[DEFAULT_SPEC.target].between(20, 200).all()
    again = FS.hourly_fixture(spark, n=100, seed=42).orderBy("timestamp").toPandas()
    assert again.equals(pdf)


def test_assert_shape_fails_loudly(spark):
    """Wrong row or column counts raise."""
    fx = FS.hourly_fixture(spark, n=10)
    assert_shape(fx, rows=10, cols=len(fx.columns))
    with pytest.raises(ContractError):
        assert_shape(fx, rows=11)
    with pytest.raises(ContractError):
        assert_shape(fx, cols=len(fx.columns) + 1)
