"""Join operators.

Join strategy is left to Catalyst + AQE: the broadcast threshold
(``spark.sql.autoBroadcastJoinThreshold``) is Spark's size check on runtime
statistics, so a side is only broadcast when it is measured small; otherwise
the join is a sort-merge join on the keys.  Skewed partitions are split by
AQE's skew-join handling.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from hourglass.operators.guards import ContractError
from hourglass.operators.halo import RANGE_CHUNK, range_chunks
from hourglass.session import materialize


def join_hourly(weather: DataFrame, air: DataFrame, on: Sequence[str] = ("location_id", "timestamp")) -> DataFrame:
    """Inner equi-join of the two providers' hourly tables."""
    on = list(on)
    keys = [c for c in air.columns if c == "location_id" and c not in on]
    out = air.join(weather, on, "inner")
    return out.select(*keys, *on, *[c for c in weather.columns if c not in on],
                      *[c for c in air.columns if c not in on and c not in keys])


def attach(left: DataFrame, right: DataFrame, on: Sequence[str], cols: Sequence[str] | None = None) -> DataFrame:
    """Left outer join bringing ``cols`` of ``right``."""
    cols = list(cols) if cols is not None else [c for c in right.columns if c not in on]
    return left.join(right.select(*on, *cols), list(on), "left")


def duplicate_keys(df: DataFrame, on: Sequence[str]) -> DataFrame:
    """Keys that occur more than once (partial aggregation, no collect)."""
    return df.groupBy(*on).count().filter("count > 1")


def _unique(df: DataFrame, on: Sequence[str], side: str) -> DataFrame:
    """``df`` with a check in the plan that no key occurs twice (a window on the keys
    the join is hashed on, so the join needs no shuffle of its own)."""
    n = F.count(F.lit(1)).over(Window.partitionBy(*on))
    found = F.concat_ws(", ", *[F.coalesce(F.col(c).cast("string"), F.lit("NULL")) for c in on])
    fail = F.raise_error(F.concat(F.lit(f"duplicate join keys on the {side} side for {list(on)}: "), found))
    return df.withColumn("_n", n).filter(F.when(F.col("_n") == 1, F.lit(True)).otherwise(fail.cast("boolean"))).drop("_n")


def attach_one_to_one(left: DataFrame, right: DataFrame, on: Sequence[str], cols: Sequence[str] | None = None,
                      check: str = "eager") -> DataFrame:
    """J2 that refuses duplicate keys on either side.  ``check="eager"`` runs the
    check before it returns (for sides that are tables); ``check="plan"`` makes it part
    of the join's plan, so that sides with long plans are computed once and the job
    itself fails, naming a key."""
    on = list(on)
    if check == "plan":
        return attach(_unique(left, on, "left"), _unique(right, on, "right"), on, cols)
    for name, side in (("left", left), ("right", right)):
        if not duplicate_keys(side, on).isEmpty():
            raise ContractError(f"duplicate join keys on the {name} side for {on}")
    return attach(left, right, on, cols)


def keep_hours(df: DataFrame, grid: DataFrame, on: Sequence[str] = ("timestamp",)) -> DataFrame:
    """Semi-join by membership in a grid of hours."""
    return df.join(grid.select(*on).distinct(), list(on), "left_semi")


def latest_features(view: DataFrame, entity_rows: DataFrame, keys: Sequence[str], ts: str,
                    fields: Sequence[str]) -> DataFrame:
    """Newest view row per entity (``max_by`` aggregate, skew-safe), left
    joined from the entity rows."""
    latest = (view.groupBy(*keys)
                  .agg(F.max_by(F.struct(F.col(ts).alias(ts), *[F.col(f) for f in fields]), F.col(ts)).alias("_r"))
                  .select(*keys, "_r.*"))
    return entity_rows.join(latest, list(keys), "left")


def point_in_time_join(entity_rows: DataFrame, view: DataFrame, keys: Sequence[str], as_of: str, ts: str,
                       fields: Sequence[str], ttl_seconds: int | None = None,
                       chunks: int | None = None) -> DataFrame:
    """As-of join.  For each entity row, the newest view row with
    ``ts <= as_of`` (ties: the view row counts as known at ``as_of``; among view
    rows at the same time the largest payload wins), kept only if
    ``as_of - ts <= ttl``.

    No range join and no window over a whole key: both sides are range-
    partitioned together on (keys, time) into ``chunks`` parts of about equal
    row count (default ``spark.sql.shuffle.partitions``), so a key holding a
    third of all rows is cut into many time-ordered chunks.  Each (keys, chunk)
    is matched on its own; the newest view row of earlier chunks of the same
    key is carried forward on the small (keys x chunk) table.
    """
    keys = list(keys)
    vcols = [ts, *fields]
    ts_type = view.schema[ts].dataType

    payload = F.struct(*[F.col(c).alias(c) for c in vcols])
    v_type = view.select(payload.alias("_v")).schema["_v"].dataType
    e_cols = list(entity_rows.columns)
    e_payload = F.struct(*[F.col(c).alias(c) for c in e_cols])
    e_type = entity_rows.select(e_payload.alias("_e")).schema["_e"].dataType

    side_view = (view.select(*keys, *vcols)
                     .na.drop(subset=[*keys, ts])  # NULL keys never match, as in SQL
                     .select(*keys, F.col(ts).alias("_t"), F.lit(0).alias("_side"), payload.alias("_v"),
                             F.lit(None).cast(e_type).alias("_e")))
    side_ent = entity_rows.select(*keys, F.col(as_of).cast(ts_type).alias("_t"), F.lit(1).alias("_side"),
                                  F.lit(None).cast(v_type).alias("_v"), e_payload.alias("_e"))
    # 1) balanced, time-ordered chunks.  Two branches read the tagged rows, so
    #    they are written once (reliable checkpoint in the shared folder) and
    #    both see the same chunk ids.
    both = materialize(range_chunks(side_view.unionByName(side_ent), keys, ["_t", "_side"], chunks)
                       .withColumnRenamed(RANGE_CHUNK, "_c"))
    # 2) match inside each (keys, chunk): newest view row so far in time order.
    wc = Window.partitionBy(*keys, "_c").orderBy("_t", "_side", "_v").rowsBetween(Window.unboundedPreceding, 0)
    local = both.withColumn("_m", F.last("_v", ignorenulls=True).over(wc)).filter(F.col("_side") == 1)
    # 3) carry: newest view row of any strictly earlier chunk of the same key,
    #    on one row per (keys, chunk) (partial aggregation first).
    ends = (both.filter(F.col("_side") == 0).groupBy(*keys, "_c")
                .agg(F.max(F.struct(F.col("_t"), F.col("_v"))).getField("_v").alias("_end")))
    need = local.select(*keys, "_c").distinct().withColumn("_end", F.lit(None).cast(v_type))
    wk = Window.partitionBy(*keys).orderBy("_c").rangeBetween(Window.unboundedPreceding, -1)
    carry = (ends.unionByName(need)
                 .withColumn("_carry", F.last("_end", ignorenulls=True).over(wk))
                 .groupBy(*keys, "_c").agg(F.max("_carry").alias("_carry"))
                 .filter(F.col("_carry").isNotNull()))
    matched = local.join(carry, [*keys, "_c"], "left")
    m = F.when(F.col("_t").isNotNull(), F.coalesce(F.col("_m"), F.col("_carry")))
    if ttl_seconds is not None:
        age = (F.unix_micros(F.col("_t").cast("timestamp"))
               - F.unix_micros(m.getField(ts).cast("timestamp")))
        m = F.when(age <= F.lit(int(ttl_seconds) * 1_000_000), m)
    return matched.select(*[F.col("_e").getField(c).alias(c) for c in e_cols],
                          *[m.getField(c).alias(c if c not in e_cols else f"view_{c}") for c in vcols])
