"""Lines that nearly repeat an earlier line, by deletion neighbourhoods.

A line goes when an earlier line (by document id, then place) equals it or lies
within one edit: a replaced, inserted or deleted character.  Two such lines share a
variant, a line with one character deleted: either both lose the character at one
place (replaced), or one line is the other's variant (inserted, deleted).  So all
lines of a bucket of equal variants are neighbours, or neighbours of the one line
that equals the variant, and the earliest of a bucket is all that its lines ask for:
no pairs are listed, however many lines meet.

1. Equal lines are counted before the shuffle; each different line goes on once,
   with its earliest place.
2. Variants are emitted in steps.  A line with the edit in one part keeps the rest, so
   it first emits what is left without its first or second half, then, where another
   line left the same, without an eighth of that half, and last the variants of the
   places that are left.  Every variant that another line shares is emitted.
3. Equal hashes are joined, the earliest line of each bucket is fetched, and its edit
   distance is verified.

The joins are plain: one side has a row a key, and Spark splits the partition of a line
or variant that fills many rows (adaptive skew joins).

All of it is DataFrame functions.  The edit bound is 0 or 1: the variants of two
edits grow with the square of the length.

Cases: null texts have no lines; empty and blank lines stay and are never compared;
lines of fewer than ``min_chars`` characters (none by default) go only if they repeat exactly; rows
with equal ids follow each other in the order they are read; null ids come last; very
long lines are compared whole; an empty table gives an empty result.  Extra columns
are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hourglass.llm.common import saved

PARTS = 8


def _hashes(line: str) -> list[Column]:
    """96 bits that stand for a line."""
    return [F.xxhash64(line).alias("h"), F.hash(line, F.lit(1)).alias("g")]


def _rest(line: Column, size: Column, a: Column, b: Column) -> list[Column]:
    """The line without what lies between ``a`` and ``size - b`` from its end."""
    keep = size - b
    return [F.substring(line, F.lit(1), a), F.when(keep > 0, F.substring(line, F.char_length(line) - keep + 1, keep)).otherwise("")]


def _shared(states: DataFrame, key: list[Column], own: list[str]) -> DataFrame:
    """The states (``own`` columns, id first) whose key (of size, a, b and ``key``) another line has too."""
    keyed = states.withColumn("key", F.xxhash64("size", "a", "b", *key)).select(*own, "key")
    many = keyed.groupBy("key").agg(F.min("id").alias("_x"), F.max("id").alias("_y")).filter("_x <> _y").select("key")
    return keyed.join(many, "key").drop("key")


def near_lines(lines: DataFrame, min_chars: int = 1) -> DataFrame:
    """id, earlier, h, g: for each line the id of the earliest line (by ``pos``) within one
    edit, if that is earlier.  ``lines``: id, line, pos, all lines different."""
    src = lines.filter(F.char_length("line") >= min_chars).select("id", "line", "pos")
    size = F.char_length("line")
    # ``size`` is the shorter line's length: a line's own, or one less as the longer one.
    # A state of the first step is told by a small number: twice the size's difference, and the half.
    tags = F.explode(F.array(*[F.lit(t).cast("byte") for t in range(4)]))
    middle = F.floor(F.col("size") / 2).cast("int")
    half = F.col("tag") % 2

    def first_states(rows):
        rows = rows.withColumn("size", (size - F.floor(F.col("tag") / 2)).cast("int"))
        return rows.withColumn("a", F.when(half == 0, 0).otherwise(middle)).withColumn("b", F.when(half == 0, middle).otherwise(F.col("size")))

    line, n, a, b = F.col("line"), F.col("size"), F.col("a"), F.col("b")
    left = saved(_shared(first_states(src.select("id", "line", tags.alias("tag"))), _rest(line, n, a, b), ["id", "tag"]))
    cut = lambda k: (F.col("a0") + F.floor((F.col("b0") - F.col("a0")) * k / PARTS)).cast("int")
    second = first_states(left.join(src.select("id", "line"), "id")).withColumnsRenamed({"a": "a0", "b": "b0"}).withColumn("k", F.explode(F.sequence(F.lit(0), F.lit(PARTS - 1))))
    second = second.withColumn("a", cut(F.col("k"))).withColumn("b", cut(F.col("k") + 1)).filter("b > a or a0 = b0")
    left = saved(_shared(second, _rest(line, n, a, b), ["id", "size", "a", "b"]))
    last = left.join(src, "id")
    own = last.filter(F.char_length("line") == n)
    drop = [F.substring(line, F.lit(1), F.col("i")), F.substring(line, F.col("i") + 2, F.char_length(line))]
    replaced = own.filter("b > a").withColumn("i", F.explode(F.sequence(a, b - 1))).select("id", "pos", F.xxhash64(F.lit("replaced"), n, F.col("i"), *drop).alias("key"), F.lit(0).alias("role"))
    whole = own.select("id", "pos", F.xxhash64(F.lit("deleted"), n, line).alias("key"), F.lit(1).alias("role")).distinct()
    longer = last.filter(F.char_length("line") > n).withColumn("i", F.explode(F.sequence(a, b))).select("id", "pos", F.xxhash64(F.lit("deleted"), n, F.concat(*drop)).alias("key"), F.lit(2).alias("role"))
    variants = saved(replaced.unionByName(whole).unionByName(longer))
    mine = lambda r: F.min(F.when(F.col("role") == r, F.struct("pos", "id")))
    buckets = variants.groupBy("key").agg(mine(0).alias("r"), mine(1).alias("w"), mine(2).alias("l"), F.min("id").alias("_x"), F.max("id").alias("_y")).filter("_x <> _y").drop("_x", "_y")
    met = variants.join(buckets, "key")
    other = F.when(F.col("role") == 0, F.col("r")).when(F.col("role") == 1, F.col("l")).otherwise(F.col("w"))
    asked = met.select("id", "pos", other.alias("o")).filter("o is not null and o.pos < pos").groupBy("id").agg(F.min("o").alias("o"))
    pair = asked.select("id", F.col("o.id").alias("earlier")).join(src.select("id", "line"), "id").join(src.select(F.col("id").alias("earlier"), F.col("line").alias("other")), "earlier")
    return pair.filter(F.levenshtein("line", "other", 1).between(0, 1)).select("id", "earlier", *_hashes("line"))


def line_decisions(docs: DataFrame, edits: int = 1, min_chars: int = 1, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, row, n_lines, removed (places from 0, in order): the lines of each document that go.

    ``docs`` is read more than once and its rows are told apart by their place, so it
    must be a table read from files; anything else goes through ``saved`` first."""
    if edits not in (0, 1):
        raise ValueError("edits must be 0 or 1")
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")).withColumn("row", F.monotonically_increasing_id())
    split = rows.select("doc_id", "row", F.posexplode(F.split("text", "\n")).alias("place", "line")).withColumn("full", F.col("line").rlike(r"[^\x20\x09-\x0D]"))
    found = saved(split.select("doc_id", "row", "place", "full", *[F.when(F.col("full"), x).alias(n) for x, n in zip(_hashes("line"), "hg", strict=True)]))
    pos = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "row", "place").alias("pos")
    lines = saved(split.filter("full").groupBy("line").agg(F.min(pos).alias("pos"), F.count("*").alias("n")).withColumn("id", F.monotonically_increasing_id()))
    # Only lines that repeat or go have anything to say to their places.
    named = lines.filter("n > 1").select(*_hashes("line"), "pos", F.lit(False).alias("gone"))
    if edits:
        near = near_lines(lines, min_chars).select("h", "g", F.lit(None).cast(named.schema["pos"].dataType).alias("pos"), F.lit(True).alias("gone"))
        named = named.unionByName(near).groupBy("h", "g").agg(F.max("pos").alias("pos"), F.max("gone").alias("gone"))
    judged = found.filter("full").drop("full", "doc_id").join(named, ["h", "g"])
    gone = judged.filter(F.col("gone") | (F.col("pos.row") != F.col("row")) | (F.col("pos.place") != F.col("place"))).groupBy("row").agg(F.sort_array(F.collect_list("place")).alias("removed"))
    count = found.groupBy("row").agg(F.first("doc_id").alias("doc_id"), F.count("*").alias("n_lines"))
    empty = rows.filter("text is null").select("row", "doc_id", F.lit(0).cast("long").alias("n_lines"))
    return count.unionByName(empty).join(gone, "row", "left").select("doc_id", "row", "n_lines", F.coalesce("removed", F.array().cast("array<int>")).alias("removed"))


def dedup_lines(docs: DataFrame, edits: int = 1, min_chars: int = 1, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with the lines that go taken out of the text."""
    docs = saved(docs)
    rows = docs.withColumn("_row", F.monotonically_increasing_id())
    gone = line_decisions(docs, edits, min_chars, id_col, text_col).filter("size(removed) > 0").select(F.col("row").alias("_row"), F.col("removed").alias("_gone"))
    kept = F.array_join(F.filter(F.split(text_col, "\n"), lambda x, i: ~F.array_contains("_gone", i)), "\n")
    return rows.join(gone, "_row", "left").withColumn(text_col, F.when(F.col("_gone").isNull(), F.col(text_col)).otherwise(kept)).drop("_row", "_gone")
