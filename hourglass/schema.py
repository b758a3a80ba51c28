"""Column names and schemas of the hourly data model.

Fixed values below must equal the reference model's for the feature matrix
to mean the same thing (names, lag offsets, window lengths, their order).
The ordered 70-name feature list is *derived* from these families by
``FeatureSpec.feature_columns``.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import types as T

# ---------------------------------------------------------------------------
# Fixed values (must equal the reference model's)
# ---------------------------------------------------------------------------
WEATHER_COLUMNS = [
    "temperature_2m",
    "relative_humidity_2m",
    "pressure_msl",
    "precipitation",
    "wind_speed_10m",
    "wind_direction_10m",
]
POLLUTANT_COLUMNS = ["pm2_5", "pm10", "carbon_monoxide", "nitrogen_dioxide", "sulphur_dioxide", "ozone"]
TARGET_SOURCE = "us_aqi"
TARGET = "target_aqi"
CALENDAR_COLUMNS = ["hour", "day_of_week", "day_of_month", "month", "is_weekend"]
AQI_LAGS = [1, 3, 6, 12, 24, 48, 72]
POLLUTANT_LAGS = [1, 3, 6, 24]
AQI_MEAN_WINDOWS = [3, 6, 12, 24]
PM_MEAN_WINDOWS = [3, 6, 24]          # pm2_5 and pm10
GAS_MEAN_WINDOWS = [24]               # carbon_monoxide, nitrogen_dioxide, sulphur_dioxide, ozone
AQI_CHANGES = [1, 3, 6, 24]
PM_CHANGES = [1, 24]                  # pm2_5 and pm10
SUB_INDEX_COLUMNS = [f"us_aqi_{p}" for p in POLLUTANT_COLUMNS]
AQI_CATEGORY_BOUNDS = [
    (50, "Good"),
    (100, "Moderate"),
    (150, "Unhealthy for Sensitive Groups"),
    (200, "Unhealthy"),
    (300, "Very Unhealthy"),
]
AQI_CATEGORY_ABOVE = "Hazardous"
# Columns never used as model inputs (current index, its sub-indices, keys, time, target).
NON_FEATURE_COLUMNS = ["timestamp", "location_id", TARGET_SOURCE, TARGET, "date", "aqi_category"] + SUB_INDEX_COLUMNS
FORECAST_HORIZON = 72
BLOCK_HOURS = 24


@dataclass(frozen=True)
class FeatureSpec:
    """Which columns and offsets make up the feature matrix.

    Defaults reproduce the reference model's 70 features.  Names are built by
    rule: ``aqi_lag_{k}``, ``{pollutant}_lag_{k}``, ``aqi_{w}h_mean``,
    ``{pollutant}_{w}h_mean``, ``aqi_change_{k}h``, ``{pollutant}_change_{k}h``.
    """

    target_source: str = TARGET_SOURCE
    target: str = TARGET
    target_alias: str = "aqi"
    weather: tuple = tuple(WEATHER_COLUMNS)
    pollutants: tuple = tuple(POLLUTANT_COLUMNS)
    aqi_lags: tuple = tuple(AQI_LAGS)
    pollutant_lags: tuple = tuple(POLLUTANT_LAGS)
    aqi_windows: tuple = tuple(AQI_MEAN_WINDOWS)
    pm_windows: tuple = tuple(PM_MEAN_WINDOWS)
    pm_columns: tuple = ("pm2_5", "pm10")
    gas_windows: tuple = tuple(GAS_MEAN_WINDOWS)
    aqi_changes: tuple = tuple(AQI_CHANGES)
    pm_changes: tuple = tuple(PM_CHANGES)
    calendar: tuple = tuple(CALENDAR_COLUMNS)

    @property
    def gases(self) -> list[str]:
        return [p for p in self.pollutants if p not in self.pm_columns]

    def aqi_lag_cols(self) -> list[str]:
        return [f"{self.target_alias}_lag_{k}" for k in self.aqi_lags]

    def pollutant_lag_cols(self) -> list[str]:
        return [f"{p}_lag_{k}" for p in self.pollutants for k in self.pollutant_lags]

    def mean_cols(self) -> list[tuple[str, str, int]]:
        """(output name, source column, window) in model order."""
        out = [(f"{self.target_alias}_{w}h_mean", self.target_source, w) for w in self.aqi_windows]
        for p in self.pm_columns:
            out += [(f"{p}_{w}h_mean", p, w) for w in self.pm_windows]
        for p in self.gases:
            out += [(f"{p}_{w}h_mean", p, w) for w in self.gas_windows]
        return out

    def change_cols(self) -> list[tuple[str, str, int]]:
        out = [(f"{self.target_alias}_change_{k}h", self.target_source, k) for k in self.aqi_changes]
        for p in self.pm_columns:
            out += [(f"{p}_change_{k}h", p, k) for k in self.pm_changes]
        return out

    def feature_columns(self) -> list[str]:
        return (
            list(self.weather)
            + list(self.pollutants)
            + list(self.calendar)
            + self.aqi_lag_cols()
            + self.pollutant_lag_cols()
            + [c for c, _, _ in self.mean_cols()]
            + [c for c, _, _ in self.change_cols()]
        )

    def required_raw(self) -> list[str]:
        return list(self.weather) + list(self.pollutants) + [self.target_source]

    @property
    def max_lookback(self) -> int:
        return max([*self.aqi_lags, *self.pollutant_lags, *self.aqi_windows, *self.pm_windows,
                    *self.gas_windows, *self.aqi_changes, *self.pm_changes])


DEFAULT_SPEC = FeatureSpec()
FEATURE_COLUMNS = DEFAULT_SPEC.feature_columns()
assert len(FEATURE_COLUMNS) == 70, len(FEATURE_COLUMNS)

# ---------------------------------------------------------------------------
# Schemas (FIXTURES.md)
# ---------------------------------------------------------------------------
_LONG_WEATHER = {"relative_humidity_2m", "wind_direction_10m"}

RAW_HOURLY_SCHEMA = T.StructType(
    [T.StructField("location_id", T.StringType(), False), T.StructField("timestamp", T.TimestampType(), False)]
    + [T.StructField(c, T.LongType() if c in _LONG_WEATHER else T.DoubleType()) for c in WEATHER_COLUMNS]
    + [T.StructField(c, T.DoubleType()) for c in POLLUTANT_COLUMNS + [TARGET_SOURCE] + SUB_INDEX_COLUMNS]
)

FORECAST_SCHEMA = T.StructType([
    T.StructField("location_id", T.StringType(), False),
    T.StructField("timestamp", T.TimestampType(), False),
    T.StructField("predicted_aqi", T.DoubleType()),
    T.StructField("forecast_day", T.IntegerType()),
    T.StructField("future_us_aqi", T.DoubleType()),
])

MODEL_METRICS_SCHEMA = T.StructType([
    T.StructField("model", T.StringType()),
    T.StructField("mae", T.DoubleType()),
    T.StructField("rmse", T.DoubleType()),
    T.StructField("r2", T.DoubleType()),
    T.StructField("rank", T.IntegerType()),
])

ATTRIBUTION_SCHEMA = T.StructType([
    T.StructField("row_id", T.LongType()),
    T.StructField("feature", T.StringType()),
    T.StructField("feature_value", T.DoubleType()),
    T.StructField("contribution", T.DoubleType()),
])

RUN_LEDGER_SCHEMA = T.StructType([
    T.StructField("run_id", T.StringType()),
    T.StructField("model", T.StringType()),
    T.StructField("version", T.IntegerType()),
    T.StructField("alias", T.StringType()),
    T.StructField("params", T.MapType(T.StringType(), T.StringType())),
    T.StructField("metrics", T.MapType(T.StringType(), T.DoubleType())),
    T.StructField("tags", T.MapType(T.StringType(), T.StringType())),
])
