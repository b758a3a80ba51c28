"""From raw documents to training shards, one operator a stage.

Each stage takes (spark, docs, sf_dir), with docs as the stage before wrote them, and
returns a DataFrame; all but the last return the columns of ``documents``.

1. ``language_id``: Kneser-Ney character models of the labelled documents; documents
   that the calibrated rejection refuses (no letter, or unlike every language) go.
2. ``near_duplicates``: of every group joined by word 5-gram Jaccard links of 0.8 or
   more, the row with the least id (nulls last, then the first row) stays.
3. ``decontaminate``: documents that align with a benchmark item go.
4. ``mix``: sources to target weights; a document is repeated as often as the mix takes it.
5. ``shard``: a uniform shuffle into 8 shards of equal row counts; adds shard and slot.

Stages 2 and 3 judge each row by its text under a row key of its own, so rows without an
id, with one id or with one id and text are documents of their own.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hourglass.llm import decontam, jaccard, langid, mixing, sharding
from hourglass.llm.common import saved, table
from hourglass.session import configure


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    model = langid.calibrate(langid.fit(docs), docs)
    return langid.accepted(docs, model)


def keyed(docs: DataFrame) -> DataFrame:
    """``docs`` written once with a key of each row: _doc, _row."""
    return saved(docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_doc"), F.monotonically_increasing_id().alias("_row")))


def read(rows: DataFrame) -> DataFrame:
    """What the operators read of keyed rows; other columns stay inside _doc, where no name can clash."""
    return rows.select(F.col("_doc.doc_id").alias("doc_id"), F.col("_doc.text").alias("text"), "_row")


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    rows = keyed(docs)
    gone = jaccard.jaccard_join(read(rows), row_col="_row").filter("_row <> class_row").select("_row")
    return rows.join(saved(gone), "_row", "left_anti").select("_doc.*")


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    rows = keyed(docs)
    gone = decontam.contaminated(read(rows), table(spark, sf_dir, "benchmark"), row_col="_row").select("_row").distinct()
    return rows.join(saved(gone), "_row", "left_anti").select("_doc.*")


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mixed(docs)


def shard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return sharding.sharded(docs, shards=8)


STAGES = [
    ("language_id", language_id),
    ("near_duplicates", near_duplicates),
    ("decontaminate", decontaminate),
    ("mix", mix),
    ("shard", shard),
]

#: Character models and hypergeometric draws have no SQL form; tests check each stage.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    configure(spark)
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = saved(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
