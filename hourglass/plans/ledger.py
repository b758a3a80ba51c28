"""Run ledger (M19): an append-only table of model runs.

Re-aimed from a tracking server to a table: one row per run with
``map<string,string>`` params and tags and ``map<string,double>`` metrics.
Latest version per model is a ``max_by`` aggregate.  Versions and the order in which an
alias moves are numbers claimed by an atomic rename in the shared folder, so writers at
once get different ones and no clock decides.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hourglass.operators.guards import ContractError
from hourglass.schema import RUN_LEDGER_SCHEMA
from hourglass.sources.claims import claim


def append_runs(runs: DataFrame, path: str) -> None:
    """Append rows (RUN_LEDGER_SCHEMA) to the ledger table at ``path``."""
    runs.select(*[F.col(f.name).cast(f.dataType) for f in RUN_LEDGER_SCHEMA.fields]).write.mode("append").parquet(path)


def register_runs(runs: DataFrame, path: str) -> dict[str, int]:
    """Append ``runs`` (RUN_LEDGER_SCHEMA but for ``version``; one row a model) with the next version of
    each model, given by the ledger: model -> version.  A claimed version whose append
    fails is never given again."""
    spark = runs.sparkSession
    names = [r["model"] for r in runs.select("model").collect()]  # one row a model, as many as this run has fitted
    if len(set(names)) < len(names) or None in names:
        raise ContractError(f"one named row per model is registered at a time: {names}")
    given = {n: claim(spark, f"{path}-versions/{n}") for n in sorted(names)}
    if given:
        rows = spark.createDataFrame(list(given.items()), "model string, version int")
        append_runs(runs.drop("version").join(F.broadcast(rows), "model"), path)
    return given


def read_ledger(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(RUN_LEDGER_SCHEMA).parquet(path)


def latest_versions(ledger: DataFrame) -> DataFrame:
    """Newest version of every model (aggregate, skew-safe)."""
    cols = [c for c in ledger.columns if c != "model"]
    return (ledger.groupBy("model")
                  .agg(F.max_by(F.struct(*[F.col(c) for c in cols]), F.col("version")).alias("_r"))
                  .select("model", "_r.*"))


def assign_alias(latest: DataFrame, metric: str = "rmse", alias: str = "champion") -> DataFrame:
    """Give ``alias`` to the model with the lowest ``metrics[metric]``."""
    best = latest.agg(F.min_by(F.col("model"), F.col("metrics")[metric]).alias("_best"))
    from hourglass.operators.aggregates import attach_scalars

    j = attach_scalars(latest, best)
    return j.withColumn("alias", F.when(F.col("model") == F.col("_best"), F.lit(alias))).drop("_best")


ALIAS_SCHEMA = "alias string, model string, version int, run_id string, set_at timestamp, seq long"


def record_alias(ledger: DataFrame, path: str, metric: str = "rmse", alias: str = "champion") -> None:
    """Append who holds ``alias`` (the latest version with the lowest ``metric``) to the
    alias table at ``path``; the ledger itself is never rewritten.  ``seq`` orders the records."""
    seq = claim(ledger.sparkSession, f"{path}-order/{alias}")
    won = assign_alias(latest_versions(ledger).drop("alias"), metric, alias).filter("alias is not null")
    won.select("alias", "model", F.col("version").cast("int").alias("version"), "run_id", F.current_timestamp().alias("set_at"), F.lit(seq).cast("long").alias("seq")).write.mode("append").parquet(path)


def read_aliases(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(ALIAS_SCHEMA).parquet(path)


def resolve_alias(ledger: DataFrame, aliases: DataFrame, alias: str) -> DataFrame:
    """The run that holds ``alias`` by its newest record."""
    last = aliases.filter(F.col("alias") == alias).agg(F.max_by(F.struct("alias", "run_id"), "seq").alias("_a")).select("_a.*")
    return ledger.drop("alias").join(last, "run_id")

