"""The flagship query: events -> hourly series -> feature matrix -> split."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from hourglass.operators.windows import chrono_split
from hourglass.plans.features import build_features, feature_matrix
from hourglass.session import configure
from hourglass.sources.events import raw_hourly_from_dir


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    configure(spark)
    feats = build_features(raw_hourly_from_dir(spark, sf_dir))
    return chrono_split(feature_matrix(feats), ["location_id"], "timestamp")
