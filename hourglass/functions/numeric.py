"""Numeric helpers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from hourglass.schema import AQI_CATEGORY_ABOVE, AQI_CATEGORY_BOUNDS


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def aqi_category(col, null_as: str | None = AQI_CATEGORY_ABOVE) -> Column:
    """US AQI band.  Like the reference, NULL/NaN fall into the top band
    unless ``null_as`` says otherwise."""
    c = _c(col)
    expr = None
    for bound, name in AQI_CATEGORY_BOUNDS:
        cond = (c <= F.lit(float(bound))) & ~F.isnan(c)
        expr = F.when(cond, F.lit(name)) if expr is None else expr.when(cond, F.lit(name))
    if null_as != AQI_CATEGORY_ABOVE:
        expr = expr.when(c.isNull() | F.isnan(c), F.lit(null_as))
    return expr.otherwise(F.lit(AQI_CATEGORY_ABOVE))


def safe_div(num, den) -> Column:
    """F8: division that yields NULL instead of failing under ANSI mode."""
    return F.try_divide(_c(num), _c(den))


def round_half_even(col, digits: int) -> Column:
    """F9 with NumPy's rounding (banker's)."""
    return F.bround(_c(col), digits)


def clamp_nonneg(col) -> Column:
    """``max(0, x)``; NULL stays NULL."""
    c = _c(col)
    return F.when(c.isNull(), F.lit(None).cast("double")).otherwise(F.greatest(F.lit(0.0), c))


def quantize(col, digits: int) -> Column:
    """``rint(x * 10^d) / 10^d`` (half even), the same IEEE steps in any engine, so
    equal inputs give bit-equal outputs.  From 2^53 on a double is an integer and
    stays as it is.  No negative zero."""
    c, scale = _c(col), F.lit(float(10 ** digits))
    return F.when(F.abs(c) < F.lit(2.0 ** 53), F.rint(c * scale) / scale).otherwise(c) + F.lit(0.0)
