"""Run a Spark query and its DuckDB twin and compare them (local harness,
mirrors the driver's row-count + schema + order-insensitive value check)."""

from __future__ import annotations

import math

import duckdb
import pandas as pd

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents",
          "embeddings", "pages", "benchmark", "labels", "conversations"]


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v):
    if v is None or v is pd.NA:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return None
        return round(v, 6) + 0.0
    if isinstance(v, pd.Timestamp):
        return v.to_pydatetime().replace(tzinfo=None)
    if hasattr(v, "tolist"):
        return _norm(v.tolist())
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    if isinstance(v, dict):
        return tuple(sorted((k, _norm(x)) for k, x in v.items()))
    return v


def rows_of(pdf: pd.DataFrame) -> list[tuple]:
    cols = sorted(pdf.columns)
    out = []
    for rec in pdf[cols].itertuples(index=False, name=None):
        out.append(tuple(_norm(x) for x in rec))
    return sorted(out, key=lambda r: tuple((x is None, str(type(x)), x if x is not None else 0) for x in r))


def compare(spark_pdf: pd.DataFrame, duck_pdf: pd.DataFrame) -> dict:
    res = {"rows_spark": len(spark_pdf), "rows_oracle": len(duck_pdf),
           "cols_match": sorted(spark_pdf.columns) == sorted(duck_pdf.columns)}
    res["rows_match"] = res["rows_spark"] == res["rows_oracle"]
    if res["cols_match"] and res["rows_match"]:
        a, b = rows_of(spark_pdf), rows_of(duck_pdf)
        bad = [(x, y) for x, y in zip(a, b) if x != y]
        res["values_match"] = not bad
        if bad:
            res["first_diff"] = [str(bad[0][0])[:400], str(bad[0][1])[:400]]
    else:
        res["values_match"] = False
        res["spark_cols"] = sorted(spark_pdf.columns)
        res["oracle_cols"] = sorted(duck_pdf.columns)
    return res
