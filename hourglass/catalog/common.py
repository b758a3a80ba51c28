"""Shared inputs of the registered queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hourglass.functions.numeric import quantize
from hourglass.plans.features import build_features
from hourglass.sources.events import raw_hourly, read_table

KEYS = ["location_id"]
TS = "timestamp"


def round_col(c, digits: int = 6):
    """Rounding with the same IEEE steps in Spark and DuckDB (the engines' own
    ROUND differ on near-ties)."""
    return quantize(c, digits)


def rounded(df: DataFrame, digits: int = 6) -> DataFrame:
    """Round every double column (and drop negative zero) for exact compares.
    Built as SQL text in one ``selectExpr`` (one driver call for all columns)."""
    scale = f"CAST({10 ** digits} AS DOUBLE)"
    out = []
    for name, typ in df.dtypes:
        c = "`" + name.replace("`", "``") + "`"
        if typ in ("double", "float"):
            out.append(f"CASE WHEN abs({c}) < CAST(9007199254740992 AS DOUBLE) THEN rint({c} * {scale}) / {scale} ELSE {c} END "
                       f"+ CAST(0 AS DOUBLE) AS {c}")
        elif typ == "date":
            out.append(f"date_format({c}, 'yyyy-MM-dd') AS {c}")
        else:
            out.append(c)
    return df.selectExpr(*out)


def events(spark: SparkSession, sf: str) -> DataFrame:
    return read_table(spark, sf, "events")


def raw(spark: SparkSession, sf: str) -> DataFrame:
    return raw_hourly(events(spark, sf))


def features(spark: SparkSession, sf: str, drop_incomplete: bool = True, align: str = "target") -> DataFrame:
    return build_features(raw(spark, sf), drop_incomplete=drop_incomplete, align=align)
