"""Registered queries: one per operator of the survey inventory.

Each entry is a callable ``(spark, sf_dir) -> DataFrame`` over the driver's
tables, plus (where SQL can state it) a DuckDB twin.  Doubles are rounded to
six places on both sides so the comparison is exact.
"""

from __future__ import annotations

from collections.abc import Callable

import functools

from pyspark.sql import DataFrame, SparkSession

from hourglass.session import configure

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn):
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")

        @functools.wraps(fn)
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            configure(spark)
            return fn(spark, sf_dir)

        QUERIES[name] = run
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


def load_all() -> None:
    from hourglass.catalog import (  # noqa: F401
        q_aggregates,
        q_features,
        q_files,
        q_joins,
        q_kept,
        q_model,
        q_ordering,
        q_sources,
        q_long,
        q_trees,
    )
