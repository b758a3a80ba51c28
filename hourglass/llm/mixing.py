"""Mixing sources to target weights by hash-threshold histograms.

Every document gets a 60-bit hash of its id, text and source, and of its number among the rows
that share those (so rows without an id, with one id or with all alike are spread like others).  A source takes each document
``floor(target / size)`` whole times; of what is left, it takes the documents
whose hash lies below a threshold.  The threshold comes from nested histograms:
words summed by (source, hash bucket), the bucket in which the budget ends, then
the same within that bucket alone, until it holds one hash.  No rows are sorted,
and a larger budget always takes a superset of a smaller one.

Cases: null text counts no words; a null source is a source of its own and comes
last; which of the rows that agree in id, text and source are taken is left open, how many is
not; a source without words has target 0; an empty table gives an empty result.  Extra columns are
ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from hourglass.llm.common import join_small, saved

HASH_BITS = 60
WORD = r"[^\x20\x09-\x0D]+"


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)).cast("long"), F.lit(0).cast("long"))


def row_key(doc_id: Column, text: Column, source: Column) -> Column:
    """A digest of what tells documents apart: id, text and source."""
    text_digest = F.md5(F.coalesce(text, F.lit("")).cast("binary"))
    return F.md5(F.concat_ws("|", F.coalesce(doc_id.cast("string"), F.lit("-")), text_digest, F.coalesce(source.cast("string"), F.lit("-"))))


def row_hash(key: Column, number: Column) -> Column:
    """The first 60 bits of the MD5 of a row's key and its number among the rows of that key, as a long."""
    return F.conv(F.substring(F.md5(F.concat_ws("|", key, number.cast("string"))), 1, HASH_BITS // 4), 16, 10).cast("long")


def numbers(rows: DataFrame) -> DataFrame | None:
    """_n, number (from 1) of the written ``rows`` (_key, _n: a number of each row by partition and place)
    whose key repeats; None where none does.  Repeats are counted before the shuffle and numbered
    by partition, so a key of a third of all rows is split."""
    twice = saved(rows.groupBy("_key").agg(F.count("*").alias("_c")).filter("_c > 1").select("_key"))
    if not twice.take(1):
        return None
    placed = rows.select("_key", "_n", F.shiftright("_n", 33).alias("_piece"))
    before = F.coalesce(F.sum("_c").over(W.partitionBy("_key").orderBy("_piece").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    parts = placed.groupBy("_key", "_piece").agg(F.count("*").alias("_c")).join(twice, "_key").select("_key", "_piece", before.alias("_before"))
    within = F.row_number().over(W.partitionBy("_key", "_piece").orderBy("_n"))
    return placed.join(parts, ["_key", "_piece"]).select("_n", (F.col("_before") + within).alias("number"))


def ranked(totals: DataFrame, key: str) -> DataFrame:
    """``totals`` with each key's place (``rank``, from 0) by code point, nulls last:
    range partitions, their row counts, and a row number within each."""
    pieces = saved(totals.repartitionByRange(F.col(key).isNull(), F.col(key)).withColumn("_piece", F.spark_partition_id()))
    sizes = {r["_piece"]: r["n"] for r in pieces.groupBy("_piece").agg(F.count("*").alias("n")).collect()}
    offsets, total = {}, 0
    for p in sorted(sizes):
        offsets[p] = total
        total += sizes[p]
    if not offsets:
        return pieces.withColumn("rank", F.lit(0).cast("long")).drop("_piece")
    offset = F.create_map(*[F.lit(x) for kv in offsets.items() for x in kv])
    w = W.partitionBy("_piece").orderBy(F.col(key).asc_nulls_last())
    return pieces.withColumn("rank", F.row_number().over(w) - 1 + offset[F.col("_piece")].cast("long")).drop("_piece")


def targets(totals: DataFrame, weights=(5, 2, 1), cap: int = 3, share: float = 1.0, source_col: str = "source") -> DataFrame:
    """Targets of the sources: (source, source_size, weight, target).

    Weights repeat in the order of the sources.  ``share`` of all words is dealt
    by weight; a source stops at ``cap`` times its size and the rest is dealt
    again among the others until none is above.  A round reads two sums."""
    arr = F.array(*[F.lit(float(x)) for x in weights])
    t = saved(ranked(totals, source_col).withColumn("weight", F.element_at(arr, (F.col("rank") % len(weights) + 1).cast("int"))))
    whole = t.agg(F.sum("source_size"), F.sum("weight")).first()
    if whole[1] is None:
        return t.withColumn("target", F.lit(0.0)).drop("rank")
    budget, free, capped = share * float(whole[0]), float(whole[1]), 0
    most = F.col("source_size") * float(cap)
    while True:
        over = F.col("weight") * F.lit(budget) / F.lit(free) > most if free > 0 else F.lit(True)
        got = t.filter(over).agg(F.count("*"), F.sum("source_size"), F.sum("weight")).first()
        if got[0] == capped:
            break
        capped, budget, free = got[0], share * float(whole[0]) - cap * float(got[1]), float(whole[1]) - float(got[2])
    even = F.col("weight") * F.lit(budget) / F.lit(free) if free > 0 else most
    return t.withColumn("target", F.when(over, most).otherwise(even)).drop("rank")


def thresholds(rows: DataFrame, goals: DataFrame, bits: int = 12) -> DataFrame:
    """For each source the hash below which the sum of sizes comes nearest ``rest``.

    ``rows``: source, h, size.  ``goals``: source, rest.  Returns source,
    threshold.  Each round sums one histogram over the rows of the boundary
    buckets only."""
    state = goals.withColumns({"lo": F.lit(0).cast("long"), "below": F.lit(0).cast("long")})
    shift = HASH_BITS
    while True:
        step = min(bits, shift)
        shift -= step
        inside = join_small(rows, state, "source").filter(F.shiftright(F.col("h") - F.col("lo"), shift + step) == 0).filter(F.col("h") >= F.col("lo"))
        hist = (
            inside.withColumn("b", F.shiftright(F.col("h") - F.col("lo"), shift))
            .groupBy("source", "rest", "lo", "below", "b")
            .agg(F.sum("size").alias("s"), F.min("h").alias("h0"), F.max("h").alias("h1"))
        )
        w = W.partitionBy("source").orderBy("b").rowsBetween(W.unboundedPreceding, W.currentRow)
        cum = hist.withColumn("upto", F.col("below") + F.sum("s").over(w))
        edge = cum.filter(F.col("upto") >= F.col("rest")).groupBy("source").agg(F.min_by(F.struct("rest", "lo", "b", "s", "upto", "h0", "h1"), "b").alias("e"))
        state = saved(edge.select("source", "e.rest", (F.col("e.lo") + F.shiftleft(F.col("e.b"), shift)).alias("lo"), (F.col("e.upto") - F.col("e.s")).alias("below"), "e.s", "e.upto", "e.h0", "e.h1"))
        if shift == 0 or not state.filter(F.col("h0") != F.col("h1")).take(1):
            nearer = F.col("upto") - F.col("rest") < F.col("rest") - F.col("below")
            return state.select("source", F.when(nearer, F.col("h1") + 1).otherwise(F.col("h0")).alias("threshold"))
        state = state.select("source", "rest", "lo", "below")


def plan(rows: DataFrame, weights=(5, 2, 1), cap: int = 3, share: float = 1.0, bits: int = 12) -> DataFrame:
    """source, source_size, target, whole, threshold of written rows (source, size, h):
    a document is taken ``whole`` times, and once more if its hash is below the threshold."""
    totals = rows.groupBy("source").agg(F.sum("size").alias("source_size"))
    t = targets(totals, weights, cap, share)
    whole = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(F.lit(0)).cast("long")
    t = saved(t.withColumn("whole", whole).withColumn("rest", F.greatest(F.lit(0.0), F.col("target") - F.col("whole") * F.col("source_size"))))
    cut = thresholds(rows.select("source", "h", "size"), t.select("source", "rest"), bits).withColumnRenamed("source", "_s")
    t = t.join(cut, t["source"].eqNullSafe(cut["_s"]), "left")
    return saved(t.select("source", "source_size", "target", "whole", F.coalesce("threshold", F.lit(0).cast("long")).alias("threshold")))


def _rows(docs: DataFrame, id_col: str, text_col: str, source_col: str) -> DataFrame:
    """doc_id, source, size, h, _n of ``docs``, written."""
    key = row_key(F.col(id_col), F.col(text_col), F.col(source_col))
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(source_col).alias("source"), word_count(F.col(text_col)).alias("size"), key.alias("_key"))
    return _hashed(saved(rows.withColumn("_n", F.monotonically_increasing_id())))


def _hashed(rows: DataFrame) -> DataFrame:
    """Written ``rows`` (_key, _n) with h instead of _key."""
    several = numbers(rows)
    if several is None:
        return rows.withColumn("h", row_hash(F.col("_key"), F.lit(1))).drop("_key")
    h = row_hash(F.col("_key"), F.coalesce("number", F.lit(1)))
    return saved(rows.join(several, "_n", "left").withColumn("h", h).drop("_key", "number"))


def mix(docs: DataFrame, weights=(5, 2, 1), cap: int = 3, share: float = 1.0, bits: int = 12, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """One row per document: doc_id, source, size, source_size, target, copies,
    taken.  ``copies`` is how often the mix repeats it."""
    rows = _rows(docs, id_col, text_col, source_col)
    copies = F.col("whole") + F.when(F.col("h") < F.col("threshold"), 1).otherwise(0)
    out = join_small(rows, plan(rows, weights, cap, share, bits), "source").withColumn("copies", copies)
    return out.select("doc_id", "source", "size", "source_size", "target", "copies", (F.col("size") * F.col("copies")).alias("taken"))


def mixed(docs: DataFrame, weights=(5, 2, 1), cap: int = 3, share: float = 1.0, bits: int = 12, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """``docs`` with each row as often as the mix takes it.  The rows stay where they are and only the
    sources' thresholds travel, unless rows repeat id, text and source: then they are written once
    with numbers of their own and meet those by them."""
    doc = lambda c: F.col(f"_doc.`{c}`")
    whole = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_doc")).withColumn("_key", row_key(doc(id_col), doc(text_col), doc(source_col)))
    small = saved(whole.select("_key", doc(source_col).alias("source"), word_count(doc(text_col)).alias("size")).withColumn("_n", F.monotonically_increasing_id()))
    if numbers(small) is None:
        rows, whole = _hashed(small), whole.withColumn("_h", row_hash(F.col("_key"), F.lit(1)))
    else:
        whole = saved(whole.withColumn("_n", F.monotonically_increasing_id()))
        rows = _hashed(whole.select("_key", "_n", doc(source_col).alias("source"), word_count(doc(text_col)).alias("size")))
        whole = whole.join(rows.select("_n", F.col("h").alias("_h")), "_n")
    p = plan(rows, weights, cap, share, bits).select(F.col("source").alias("_source"), F.struct("whole", "threshold").alias("_plan"))
    out = join_small(whole.withColumn("_source", doc(source_col)), p, "_source").withColumn("_copies", (F.col("_plan.whole") + F.when(F.col("_h") < F.col("_plan.threshold"), 1).otherwise(0)).cast("int"))
    return out.filter("_copies > 0").select("_doc", F.explode(F.sequence(F.lit(1), F.col("_copies")))).select("_doc.*")
