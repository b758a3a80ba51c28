"""Uniform shuffle into shards of exact sizes by a communication matrix.

The rows lie in blocks (their input partitions, folded to at most
``MAX_BLOCKS``).  How many rows of each block go to each shard is drawn from the
multivariate hypergeometric law, so that every assignment with the given shard
sizes is equally likely.  Each block permutes its rows by a seeded hash and cuts
them at the drawn counts; every shard permutes again what it received.

A row is known by its place in the input (partition and offset), which is fixed
by writing the keys once; a lost task draws the same numbers again.

Cases: null text has one byte of size and the checksum of no bytes; null, equal or
repeated ids and texts are rows of their own; fewer rows than shards leave shards
empty; an empty table gives an empty result.  Extra columns are ignored.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from hourglass.llm.common import saved

MAX_BLOCKS = 4096
#: Rows that one task of the second permutation takes, about.
SLOT_ROWS = 200_000


def communication_matrix(block_rows: list[int], shards: int, seed: int) -> np.ndarray:
    """Rows of block i that go to shard j; row sums are the blocks, column sums the shards."""
    total = sum(block_rows)
    left = np.array([total // shards + (j < total % shards) for j in range(shards)], dtype=np.int64)
    out = np.zeros((len(block_rows), shards), dtype=np.int64)
    rng = np.random.Generator(np.random.PCG64(seed))
    for i, n in enumerate(block_rows):
        out[i] = rng.multivariate_hypergeometric(left, n, method="marginals")
        left -= out[i]
    return out


def shard(docs: DataFrame, shards: int = 8, seed: int = 20_24, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, size, text_crc32, shard, slot: shard sizes at most one row apart,
    slots gapless from 0 within a shard."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    size, crc = (F.octet_length(text) + 1).cast("long"), F.crc32(F.encode(text, "UTF-8"))
    rows = saved(docs.select(F.col(id_col).alias("doc_id"), size.alias("size"), crc.alias("text_crc32"), F.monotonically_increasing_id().alias("_row")))
    return rows.join(places(rows, shards, seed), "_row").select("doc_id", "size", "text_crc32", "shard", "slot")


def sharded(docs: DataFrame, shards: int = 8, seed: int = 20_24) -> DataFrame:
    """``docs`` with shard and slot (columns of these names are replaced)."""
    whole = docs.drop("shard", "slot")
    rows = saved(whole.select(F.struct(*[F.col(f"`{c}`") for c in whole.columns]).alias("_doc"), F.monotonically_increasing_id().alias("_row")))
    return rows.join(places(rows, shards, seed), "_row").select("_doc.*", "shard", "slot")


def places(rows: DataFrame, shards: int, seed: int) -> DataFrame:
    """_row, shard, slot of written rows that hold their place in ``_row``."""
    spark = rows.sparkSession
    rows = rows.select("_row").withColumn("_block", F.pmod(F.shiftright("_row", 33), F.lit(MAX_BLOCKS)).cast("int"))
    counts = {r[0]: r[1] for r in rows.groupBy("_block").count().collect()}
    blocks = sorted(counts)
    matrix = communication_matrix([counts[b] for b in blocks], shards, seed)
    cuts = spark.createDataFrame([(b, [int(x) for x in np.cumsum(matrix[i])]) for i, b in enumerate(blocks)], "_block int, _cuts array<long>")
    order = lambda salt: F.xxhash64(F.lit(seed), F.lit(salt), F.col("_row"))
    local = rows.withColumn("_place", F.row_number().over(W.partitionBy("_block").orderBy(order(1), "_row")))
    dealt = saved(
        local.join(F.broadcast(cuts), "_block")  # at most MAX_BLOCKS rows of `shards` numbers
        .withColumn("shard", F.size(F.filter("_cuts", lambda c: c < F.col("_place"))).cast("int"))
        .withColumn("_key", order(2))
        .drop("_cuts", "_place", "_block")
    )
    # The second permutation orders a shard by _key; its leading bits name pieces, whose sizes give the first slots.
    total = sum(counts.values())
    bits = max(0, (max(1, total // shards // SLOT_ROWS) - 1).bit_length()) + 3
    piece = dealt.withColumn("_piece", F.shiftrightunsigned("_key", 64 - bits).cast("int"))
    sums = W.partitionBy("shard").orderBy("_piece").rowsBetween(W.unboundedPreceding, -1)
    first = piece.groupBy("shard", "_piece").agg(F.count("*").alias("_n")).withColumn("_first", F.coalesce(F.sum("_n").over(sums), F.lit(0))).drop("_n")
    # unsigned order of _key within a piece: the sign bit is part of the piece
    within = F.row_number().over(W.partitionBy("shard", "_piece").orderBy("_key", "_row")) - 1
    out = piece.withColumn("_within", within).join(first, ["shard", "_piece"])
    return out.select("_row", "shard", (F.col("_first") + F.col("_within")).cast("long").alias("slot"))
