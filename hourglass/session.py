"""Spark session helpers.

The engine never starts its own cluster: callers pass a ``SparkSession``.
``local_session`` exists for tests, benchmarks and the driver smoke check.
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

# Session settings every job in this package assumes.
REQUIRED_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Feature plans are wide (80+ columns); constraint inference over them
    # grows combinatorially in the optimizer and buys nothing here.
    "spark.sql.constraintPropagation.enabled": "false",
}


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "hourglass") -> SparkSession:
    """A local session for tests and benchmarks (UI off, UTC, AQE on)."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "16g")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.sql.adaptive.advisoryPartitionSizeInBytes", "64m")
    )
    for k, v in REQUIRED_CONF.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    configure(spark)
    return spark


def configure(spark: SparkSession) -> SparkSession:
    """Apply the session-level settings the operators rely on (idempotent)."""
    for k, v in REQUIRED_CONF.items():
        spark.conf.set(k, v)
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder, set from ``spark.checkpoint.dir``.

    On a cluster the folder must be shared storage named by the cluster in
    ``spark.checkpoint.dir``; we only read it.  When it is unset (local tests)
    a private temporary folder is created once per session.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    conf_dir = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if not conf_dir:
        if not sc.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a shared folder on a cluster")
        conf_dir = tempfile.mkdtemp(prefix="hourglass-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
        spark.conf.set("spark.checkpoint.dir", conf_dir)
    sc.setCheckpointDir(conf_dir)
    return sc.getCheckpointDir() or conf_dir


def materialize(df):
    """Cut a long lineage with a reliable checkpoint in the shared
    ``spark.checkpoint.dir`` (survives executor loss; never a local checkpoint)."""
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def write_table(df, reader: SparkSession | None = None):
    """Write ``df`` as parquet under the shared checkpoint folder and read it
    back: a lineage cut whose plan is a plain file scan, with no link to the
    plan that produced it.  Used inside driver loops (one table per step),
    where a checkpointed relation would keep its origin plan alive.  ``reader`` is
    the session that is to read it, if another."""
    import uuid

    base = checkpoint_dir(df.sparkSession).rstrip("/")
    path = f"{base}/tables/{uuid.uuid4().hex}"
    df.write.mode("errorifexists").parquet(path)
    WRITTEN.append(path)
    return (reader or df.sparkSession).read.schema(df.schema).parquet(path)


#: Tables that ``write_table`` has written and ``release_tables`` has not removed yet.
WRITTEN: list[str] = []


def release_tables(spark: SparkSession) -> int:
    """Remove the tables written by ``write_table`` so far, through Spark's own file
    system layer; call it when the results that read them have been written."""
    gone = 0
    while WRITTEN:
        path = spark._jvm.org.apache.hadoop.fs.Path(WRITTEN.pop())
        gone += bool(path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True))
    return gone

