"""hourglass: hourly time-series features, forecasts and evaluation on Spark."""

__version__ = "0.1.0"
