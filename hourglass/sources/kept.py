"""Tables that are kept between runs: an hourly table that takes upserts (U2), and the newest
features per entity (J5).

The hourly table is partitioned by day.  An upsert compares the new rows with the stored ones of
their days, and rewrites only the days in which a row is new or differs; other files are neither read
nor written, and a repeated upsert writes nothing.  A day is replaced whole (dynamic partition overwrite);
a run that dies between two days is mended by running it again.

The newest features are a table of one row an entity with the highest ingest number it has seen.  A
refresh reads only rows above that number, so a late row (an old hour that arrives now) counts like any
other, and writes a new version beside the old one, under a number that only it can claim; readers take
the newest version that was wholly written.  What two refreshes at once leave out is not lost: the
version with the higher number tells in ``seen`` what it holds, and the next refresh reads from there.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hourglass.operators.guards import ContractError, require_columns
from hourglass.session import write_table
from hourglass.sources.claims import claim, claimed, exists, names

DAY = "day"


# --------------------------------------------------------------------------- U2
def _by_day(df: DataFrame, ts: str) -> DataFrame:
    return df.withColumn(DAY, F.coalesce(F.date_format(F.col(ts), "yyyy-MM-dd"), F.lit("none")))


def upsert_table(updates: DataFrame, path: str, keys: Sequence[str], ts: str, order: Sequence[str] = ()) -> list[str]:
    """U2 into the table at ``path`` (made if it is not there): the new row of a (keys, ts) wins.  Of
    several new rows of one hour the one with the largest ``order`` columns wins, then with the
    largest values.  Returns the days that were rewritten.

    The rewritten days' names reach the driver: as many as the updates have days with a change."""
    spark = updates.sparkSession
    cols = updates.columns
    if DAY in cols:
        raise ContractError(f"column name {DAY} is taken by the table's partitions")
    rank = F.struct(*order, *[c for c in cols if c not in order])
    new = updates.groupBy(*keys, ts).agg(F.max_by(F.struct(*cols), rank).alias("_r")).select("_r.*")
    new = write_table(_by_day(new, ts))
    if any(n.startswith(f"{DAY}=") for n in names(spark, path)):
        have = read_table(spark, path)
        require_columns(have, cols, "stored table")
        days = [r[0] for r in new.select(DAY).distinct().collect()]
        have = have.filter(F.col(DAY).isin(days))  # read by partition
        same = [F.col(f"n.`{c}`").eqNullSafe(F.col(f"h.`{c}`")) for c in [DAY, *cols]]
        differs = new.alias("n").join(have.alias("h"), same, "left_anti")
        days = sorted(r[0] for r in differs.select(DAY).distinct().collect())
        if not days:
            return []
        new, have = new.filter(F.col(DAY).isin(days)), have.filter(F.col(DAY).isin(days))
        on = [F.col(f"n.`{c}`").eqNullSafe(F.col(f"h.`{c}`")) for c in [*keys, ts, DAY]]
        whole = have.alias("h").join(new.alias("n"), on, "left_anti").select(*cols, DAY).unionByName(new.select(*cols, DAY))
        whole = write_table(whole)  # the old files are read before any is replaced
    else:
        whole = new.select(*cols, DAY)
        days = sorted(r[0] for r in whole.select(DAY).distinct().collect())
    whole.repartition(DAY, *keys).sortWithinPartitions(DAY, *keys, ts).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(DAY).parquet(path)
    return days


def read_table(spark: SparkSession, path: str) -> DataFrame:
    """The stored table, its day as a string."""
    df = spark.read.parquet(path)
    return df.withColumn(DAY, F.col(DAY).cast("string")) if DAY in df.columns else df


# --------------------------------------------------------------------------- J5
def refresh_latest(view: DataFrame, path: str, keys: Sequence[str], ts: str, fields: Sequence[str], ingest: str,
                   ttl_seconds: int | None = None) -> int:
    """Bring the newest rows under ``path`` up to date with ``view``; returns the version written (or the
    current one, if ``view`` has nothing new).  ``ingest`` rises with arrival; of rows of one entity and
    time the one that came last is kept.  With ``ttl_seconds`` entities go whose newest row
    is older than that, counted from the newest time of all."""
    spark = view.sparkSession
    number, held, seen = _current(spark, path)
    cols = [*keys, ts, *[f for f in fields if f not in (*keys, ts)]]
    new = view.filter(F.col(ts).isNotNull() & F.col(ingest).isNotNull()).select(*cols, F.col(ingest).cast("long").alias("_in"))
    if seen is not None:
        new = new.filter(F.col("_in") > F.lit(seen))
    top = new.agg(F.max("_in")).first()[0]
    if top is None:
        return number
    rest = [c for c in [*cols, "_in"] if c not in keys]
    pool = new if held is None else held.select(*cols, "_in").unionByName(new)
    newest = pool.groupBy(*keys).agg(F.max_by(F.struct(*rest), F.struct(ts, "_in", *[c for c in rest if c not in (ts, "_in")])).alias("_r")).select(*keys, "_r.*")
    version = claim(spark, f"{path}/versions")
    at = f"{path}/rows/v{version}"
    if ttl_seconds is not None:
        newest = write_table(newest)
        last = newest.agg(F.max(ts)).first()[0]
        newest = newest.filter(F.col(ts) >= F.lit(last) - F.make_dt_interval(secs=F.lit(int(ttl_seconds))))
    newest.withColumn("_seen", F.lit(int(top))).write.mode("errorifexists").parquet(at)
    spark.createDataFrame([(version, int(top))], "version int, seen long").coalesce(1).write.mode("errorifexists").json(f"{path}/seen/v{version}")
    return version


def _current(spark: SparkSession, path: str) -> tuple[int, DataFrame | None, int | None]:
    """The newest wholly written version: its number, rows, and the highest ingest number it has seen."""
    for n in reversed(claimed(spark, f"{path}/versions")):
        if exists(spark, f"{path}/seen/v{n}/_SUCCESS"):
            seen = spark.read.schema("version int, seen long").json(f"{path}/seen/v{n}").first()["seen"]
            return n, spark.read.parquet(f"{path}/rows/v{n}"), seen
    return 0, None, None


def read_latest(spark: SparkSession, path: str, entity_rows: DataFrame, keys: Sequence[str], ts: str, as_of=None, ttl_seconds: int | None = None) -> DataFrame:
    """J5 from the kept rows: each entity's newest row, left joined; empty where that row is after
    ``as_of`` or older than ``ttl_seconds`` before it."""
    _, held, _ = _current(spark, path)
    if held is None:
        raise ContractError(f"no newest rows under {path}; refresh them first")
    held = held.drop("_in", "_seen")
    if as_of is not None:
        held = held.filter(F.col(ts) <= F.lit(as_of))
        if ttl_seconds is not None:
            held = held.filter(F.col(ts) >= F.lit(as_of) - F.make_dt_interval(secs=F.lit(int(ttl_seconds))))
    return entity_rows.join(held, list(keys), "left")
