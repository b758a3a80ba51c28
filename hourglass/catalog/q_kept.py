"""Tables kept between runs: upserts into stored days (U2), newest features by refresh (J5), versions
given by the ledger (M19).  Files go to the cluster's shared folder."""

from __future__ import annotations

from pyspark.sql import functions as F

from hourglass.catalog import register
from hourglass.catalog.common import KEYS, TS, events, raw, rounded
from hourglass.catalog.q_files import _path
from hourglass.catalog.q_model import _MET, _ledger
from hourglass.checks.sqlfrag import RAW_HOURLY_CTE, r6
from hourglass.operators.aggregates import attach_scalars
from hourglass.plans import ledger as L
from hourglass.sources import kept


@register("upsert_stored", f"WITH {RAW_HOURLY_CTE},\nm AS (SELECT max(CAST(timestamp AS DATE)) AS last FROM raw)\n"
                           f"SELECT location_id, timestamp, {r6('CASE WHEN CAST(timestamp AS DATE) >= last - 2 THEN us_aqi + 1 ELSE us_aqi END', 'us_aqi')}, "
                           "CAST(timestamp AS DATE) >= last - 2 AS rewritten, false AS repeat_wrote FROM raw, m")
def q_upsert_stored(spark, sf):
    """U2 into a stored table: the hourly rows, then revised rows of the last three days.  Only
    those days are rewritten, and the same upsert again writes none."""
    path = _path(spark, "hourly")
    hourly = raw(spark, sf).select(*KEYS, TS, "us_aqi")
    kept.upsert_table(hourly, path, KEYS, TS)
    last = hourly.agg(F.max(F.to_date(TS)).alias("_last"))
    revised = attach_scalars(hourly, last).filter(F.to_date(TS) >= F.date_sub("_last", 2)).drop("_last").withColumn("us_aqi", F.col("us_aqi") + 1)
    days = kept.upsert_table(revised, path, KEYS, TS)
    again = kept.upsert_table(revised, path, KEYS, TS)
    out = kept.read_table(spark, path)
    return rounded(out.select(*KEYS, TS, "us_aqi", F.col("day").isin(days).alias("rewritten"), F.lit(bool(again)).alias("repeat_wrote")))


@register("latest_kept", "SELECT user_id, CAST(arg_max(ts, (ts, event_id % 3, event_id)) AS TIMESTAMP) AS ts, "
                         f"{r6('arg_max(value, (ts, event_id % 3, event_id))', 'value')}, CAST(3 AS INTEGER) AS version FROM events WHERE user_id IS NOT NULL GROUP BY user_id")
def q_latest_kept(spark, sf):
    """J5 kept between runs: events arrive in three batches (every third event each, so two of
    three batches are late throughout) and each refresh reads what arrived since the one before."""
    path = _path(spark, "latest")
    view = events(spark, sf).filter("user_id is not null").select("user_id", "ts", "value", ((F.col("event_id") % 3) * F.lit(1 << 40) + F.col("event_id")).alias("arrival"))
    version = 0
    for batch in (1, 2, 3):  # what has arrived so far
        version = kept.refresh_latest(view.filter(F.col("arrival") < batch * (1 << 40)), path, ["user_id"], "ts", ["value"], "arrival")
    users = view.select("user_id").distinct()
    return rounded(kept.read_latest(spark, path, users, ["user_id"], "ts").withColumn("version", F.lit(version).cast("int")))


@register("ledger_versions", f"WITH {_MET},\nm AS (SELECT model, CASE WHEN split = 'val' THEN 1 ELSE 2 END AS version, rmse FROM met WHERE split IN ('val', 'test'))\n"
                             f"SELECT model, CAST(version AS INTEGER) AS version, {r6('rmse', 'rmse')}, "
                             "CASE WHEN version = 2 AND rmse = min(CASE WHEN version = 2 THEN rmse END) OVER () THEN 'champion' END AS alias FROM m")
def q_ledger_versions(spark, sf):
    """M19 with versions given by the ledger: the validation runs registered first, then the test
    runs; the alias goes to the best latest version, by the later of two records."""
    path, aliases = _path(spark, "ledger"), _path(spark, "aliases")
    runs = _ledger(spark, sf).withColumn("alias", F.lit(None).cast("string"))
    for split in ("val", "test"):
        L.register_runs(runs.filter(F.col("params")["split"] == split).drop("version"), path)
        L.record_alias(L.read_ledger(spark, path), aliases, "rmse", "champion")
    ledger = L.read_ledger(spark, path)
    held = L.resolve_alias(ledger, L.read_aliases(spark, aliases), "champion").select("run_id", F.lit("champion").alias("alias"))
    out = ledger.drop("alias").join(held, "run_id", "left")
    return rounded(out.select("model", "version", F.col("metrics")["rmse"].alias("rmse"), "alias"))
