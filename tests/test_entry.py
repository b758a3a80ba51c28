import pytest

import __spark_entry__ as E
from hourglass.checks.compare import compare, duck
from hourglass.schema import FEATURE_COLUMNS

FAST = ["raw_hourly", "hourly_features", "dedup_keep_last", "describe", "point_in_time_join", "recursive_forecast",
        "backtest", "attribution", "payload_flatten", "histogram", "temporal_leakage_report"]


def test_entry_runs(spark):
    df = E.entry(spark)
    assert all(c in df.columns for c in FEATURE_COLUMNS)
    assert "split" in df.columns
    assert df.count() > 0


def test_registry_complete():
    q, o = E.queries(), E.oracle_sql()
    assert set(o) <= set(q)
    assert len(q) >= 80


@pytest.mark.parametrize("name", FAST)
def test_query_matches_duckdb_sf0001(spark, name):
    sf = "/root/testdata/sf0.001"
    pdf = E.queries()[name](spark, sf).toPandas()
    res = compare(pdf, duck(sf).execute(E.oracle_sql()[name]).df())
    assert res["values_match"], res
