"""Halo chunks: windows per (series, chunk) with copied edge rows
equal the plain per-series window, including on a series with gaps."""

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from hourglass.catalog.common import rounded
from hourglass.operators.halo import ORDINAL, with_ordinal
from hourglass.plans.features import build_features, build_features_chunked
from hourglass.sources.events import raw_hourly_from_dir

from table_dirs import SF0001


def _same(a, b):
    return a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_ordinal_equals_row_number(spark):
    raw = raw_hourly_from_dir(spark, SF0001)
    # small time buckets so every series spans many of them
    got = with_ordinal(raw, ["location_id"], "timestamp", bucket_seconds=6 * 3600).select("location_id", "timestamp", ORDINAL)
    want = raw.select("location_id", "timestamp",
                      (F.row_number().over(Window.partitionBy("location_id").orderBy("timestamp")) - 1)
                      .cast("long").alias(ORDINAL))
    assert _same(got, want)


@pytest.mark.parametrize("chunk_rows", [72, 100])
def test_chunked_features_equal_plain(spark, chunk_rows):
    raw = raw_hourly_from_dir(spark, SF0001)  # sf0.001 has gaps: positional lags must still agree
    plain = build_features(raw, drop_incomplete=False)
    chunked = build_features_chunked(raw, chunk_rows=chunk_rows, drop_incomplete=False, bucket_seconds=86400)
    cols = plain.columns
    assert sorted(chunked.columns) == sorted(cols)
    assert chunked.count() == plain.count()
    assert _same(rounded(chunked.select(*cols)), rounded(plain))


def test_chunk_smaller_than_halo_is_refused(spark):
    raw = raw_hourly_from_dir(spark, SF0001)
    with pytest.raises(ValueError):
        build_features_chunked(raw, chunk_rows=24)
