"""Calendar and time functions.

All timestamps are UTC; inputs may be TIMESTAMP or TIMESTAMP_NTZ.  Results
keep the input's timestamp flavour so they compare equal to DuckDB
``TIMESTAMP`` values.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def parse_ts_utc(col, fmt: str | None = None) -> Column:
    """Parse a string (ISO by default) to a UTC wall-clock TIMESTAMP_NTZ."""
    c = _c(col)
    return (F.to_timestamp_ntz(c, F.lit(fmt)) if fmt else F.to_timestamp_ntz(c))


def hour_trunc(col) -> Column:
    """Start of the hour, keeping TIMESTAMP_NTZ (``date_trunc`` alone yields LTZ)."""
    return F.date_trunc("hour", _c(col)).cast("timestamp_ntz")


def hour_of(col) -> Column:
    """F1."""
    return F.hour(_c(col))


def day_of_week(col) -> Column:
    """Monday = 0 ... Sunday = 6 (``weekday``, not ``dayofweek``)."""
    return F.weekday(_c(col))


def day_of_month(col) -> Column:
    """F3."""
    return F.dayofmonth(_c(col))


def month_of(col) -> Column:
    """F3."""
    return F.month(_c(col))


def is_weekend(col) -> Column:
    """Saturday or Sunday as int."""
    return (F.weekday(_c(col)) >= 5).cast("int")


def date_of(col) -> Column:
    """F5."""
    return F.to_date(_c(col))


def format_date(col, fmt: str = "yyyy-MM-dd") -> Column:
    """F6."""
    return F.date_format(_c(col), fmt)


def shift_hours(col, hours) -> Column:
    """``ts + hours`` (negative to go back); ``hours`` may be a column."""
    h = hours if isinstance(hours, Column) else F.lit(int(hours))
    return F.timestamp_add("HOUR", h, _c(col))


def epoch_seconds(col) -> Column:
    """seconds since 1970-01-01 UTC."""
    return F.unix_seconds(_c(col).cast("timestamp"))


def calendar_columns(df: DataFrame, ts: str = "timestamp") -> DataFrame:
    """F1-F4 as the five model columns."""
    return df.withColumns({
        "hour": hour_of(ts),
        "day_of_week": day_of_week(ts),
        "day_of_month": day_of_month(ts),
        "month": month_of(ts),
        "is_weekend": is_weekend(ts),
    })


def hour_grid(start, n: int) -> Column:
    """array of the ``n`` hourly timestamps starting at ``start`` (explode it).

    Bounded by ``n`` (the horizon), never by the data size.
    """
    s = _c(start)
    return F.sequence(s, F.timestamp_add("HOUR", F.lit(int(n) - 1), s), F.expr("INTERVAL 1 HOUR"))
