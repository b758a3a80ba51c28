from hourglass.operators.guards import ContractError, check_feature_order, feature_list, name_families
from hourglass.schema import DEFAULT_SPEC, FEATURE_COLUMNS


def test_seventy_features_by_family():
    s = DEFAULT_SPEC
    assert len(FEATURE_COLUMNS) == 70
    assert len(set(FEATURE_COLUMNS)) == 70
    assert len(s.weather) + len(s.pollutants) == 12
    assert len(s.calendar) == 5
    assert len(s.aqi_lag_cols()) == 7
    assert len(s.pollutant_lag_cols()) == 24
    assert len(s.mean_cols()) == 14
    assert len(s.change_cols()) == 8
    assert FEATURE_COLUMNS[:2] == ["temperature_2m", "relative_humidity_2m"]
    assert FEATURE_COLUMNS[-1] == "pm10_change_24h"
    assert FEATURE_COLUMNS.index("aqi_3h_mean") < FEATURE_COLUMNS.index("pm2_5_3h_mean") < FEATURE_COLUMNS.index("ozone_24h_mean")
    assert "us_aqi" not in FEATURE_COLUMNS and "target_aqi" not in FEATURE_COLUMNS


def test_guards():
    fam = name_families(FEATURE_COLUMNS + ["target_aqi"])
    assert len(fam["lag"]) == 31 and len(fam["mean"]) == 14 and len(fam["change"]) == 8
    assert fam["future_like"] == ["target_aqi"]
    check_feature_order(FEATURE_COLUMNS, list(FEATURE_COLUMNS))
    try:
        check_feature_order(FEATURE_COLUMNS, FEATURE_COLUMNS[::-1])
    except ContractError:
        pass
    else:
        raise AssertionError("order mismatch not detected")


def test_feature_list_excludes(spark):
    df = spark.createDataFrame([(1.0, 2.0, 3.0, "x")], "us_aqi double, a double, target_aqi double, location_id string")
    assert feature_list(df) == ["a"]
