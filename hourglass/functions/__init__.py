"""Scalar column functions (all JVM-side built-ins, no Python UDFs)."""

from hourglass.functions.calendar import (  # noqa: F401
    calendar_columns,
    date_of,
    day_of_month,
    day_of_week,
    epoch_seconds,
    format_date,
    hour_grid,
    hour_of,
    hour_trunc,
    is_weekend,
    month_of,
    parse_ts_utc,
    shift_hours,
)
from hourglass.functions.numeric import aqi_category, clamp_nonneg, quantize, round_half_even, safe_div  # noqa: F401
