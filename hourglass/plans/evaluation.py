"""Forecast evaluation summaries."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hourglass.functions.numeric import aqi_category, round_half_even


def forecast_block_summary(forecast: DataFrame, keys: Sequence[str], block: str = "forecast_day",
                           ts: str = "timestamp", pred: str = "predicted_aqi", digits: int = 2) -> DataFrame:
    """Per block first/last hour, hours, mean/min/max prediction rounded
    half-even (as NumPy does), and the AQI band of the mean."""
    g = forecast.groupBy(*keys, block).agg(
        F.min(ts).alias("first_ts"), F.max(ts).alias("last_ts"), F.count(F.lit(1)).alias("hours"),
        F.avg(pred).alias("_mean"), F.min(pred).alias("_min"), F.max(pred).alias("_max"))
    return g.select(*keys, block, "first_ts", "last_ts", "hours",
                    round_half_even("_mean", digits).alias("mean_aqi"), round_half_even("_min", digits).alias("min_aqi"),
                    round_half_even("_max", digits).alias("max_aqi"), aqi_category("_mean").alias("category"))
