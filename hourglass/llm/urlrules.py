"""Allow and block rules on URLs by a sort-merge range join.

A rule is a host and a path prefix with a verdict.  It fits its host and every
subdomain, where the path starts with the rule's.  A host's canonical key is its
labels from the last to the first, each closed by a dot (``com.example.www.``), so a
rule's host becomes the interval of all keys that begin with its own.  Such intervals
nest or are apart, and so do those of path prefixes below one host.

``sweep`` merges keys with intervals in one sorted order.  A rule opens where its
interval starts and closes behind it (the key and the byte FF, which no UTF-8 text
holds); in between it stays on the stack, at the level of its nesting.  The stack of a
row is the last thing that happened at each level before it.  Sorted rows are cut into
ranges of equal size; the state at the end of a range is handed to the next ones on the
small (range x level) table, so neither a host with a third of all rows nor a rule over
all of them meets in one task.

A rule is a pair of prefixes, so there are two sweeps: the first finds the rule hosts
that are open at each row, the second the longest open path below each of those.
Of a row's rules the longest (characters of host and path) wins, then that of the longer
host.  Everything is DataFrame functions.

Cases: a null url, or one without ``://``, has an empty host and path; only rules with an
empty host and path fit it.  A rule with an empty host fits all hosts, one with an empty
path all paths.  Hosts keep ports and user names, as part of their last label.  Rules that
repeat a host and path count once, and block beats allow.  Null parts of rules are empty;
a rule without a verdict is left out.  Repeated rows and null ids are rows of their own.
Urls of any length are judged whole.  An empty table gives an empty result; without rules
every row gets the default.  Only the id and the url are read, so other columns cannot clash.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hourglass.llm.common import saved
from hourglass.operators.halo import RANGE_CHUNK, range_chunks

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def url_host(url: Column) -> Column:
    """What follows the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased."""
    return F.translate(F.regexp_extract(_behind_scheme(url), r"^[^/?#]*", 0), _UPPER, _LOWER)


def url_path(url: Column) -> Column:
    """What follows the host up to ``?``, ``#`` or the end."""
    return F.regexp_extract(_behind_scheme(url), r"^[^/?#]*([^?#]*)", 1)


def _behind_scheme(url: Column) -> Column:
    at = F.locate("://", url)
    return F.when(at > 0, F.substring(url, at + F.lit(3), F.length(url))).otherwise("")


def host_key(host: Column) -> Column:
    """The canonical key: the labels reversed, each with a dot behind it; nothing for no host."""
    labels = F.reverse(F.split(host, r"\."))
    return F.when(host == "", F.lit("")).otherwise(F.concat(F.array_join(labels, "."), F.lit("."))).cast("binary")


def _path_key(key: Column, path: Column) -> Column:
    """A host's key and a path in one; the byte FE, which no UTF-8 text holds, parts them."""
    return F.concat(key, F.unhex(F.lit("FE")), path.cast("binary"))


def _events(keys: DataFrame) -> DataFrame:
    """The interval of each of ``keys`` (_key and any columns) as two events: _k (where), _kind
    (0 opens, 2 closes), _level if there is one, _rule (the row of ``keys``; null where it closes)."""
    ends = F.array(F.struct(F.col("_key").alias("k"), F.lit(0).alias("kind")), F.struct(F.concat("_key", F.unhex(F.lit("FF"))).alias("k"), F.lit(2).alias("kind")))
    rule = F.struct(*[c for c in keys.columns if c != "_level"])
    level = [c for c in keys.columns if c == "_level"]
    e = keys.select(rule.alias("_rule"), *level, F.explode(ends).alias("_e"))
    return e.select(F.col("_e.k").alias("_k"), F.col("_e.kind").alias("_kind"), *level, F.when(F.col("_e.kind") == 0, F.col("_rule")).alias("_rule"))


def _before():
    """All earlier ranges, in a table of one row a range (so as many rows as range partitions)."""
    return W.orderBy(RANGE_CHUNK).rowsBetween(W.unboundedPreceding, -1)


def levels(keys: DataFrame) -> DataFrame:
    """``keys`` (_key: different binary prefixes, and any columns) with _level: how many of
    the prefixes each of them begins with, itself included."""
    e = saved(range_chunks(_events(keys).withColumn("_step", F.when(F.col("_kind") == 0, 1).otherwise(-1)), [], ["_k", "_kind"]))
    start = e.groupBy(RANGE_CHUNK).agg(F.sum("_step").alias("_n")).select(RANGE_CHUNK, F.coalesce(F.sum("_n").over(_before()), F.lit(0)).alias("_n"))
    inside = W.partitionBy(RANGE_CHUNK).orderBy("_k", "_kind").rowsBetween(W.unboundedPreceding, W.currentRow)
    depth = e.withColumn("_d", F.sum("_step").over(inside)).join(F.broadcast(start), RANGE_CHUNK)
    return depth.filter("_kind = 0").select("_rule.*", (F.col("_d") + F.col("_n")).cast("int").alias("_level"))


def sweep(rows: DataFrame, keys: DataFrame) -> DataFrame:
    """``rows`` (a binary _k each) with _stack: the rows of ``keys`` (_key: different prefixes,
    and any columns) whose _key starts _k, from the shortest to the longest."""
    ruled = saved(levels(keys))
    kind = ruled.drop("_level").schema
    depth = ruled.agg(F.max("_level")).first()[0]
    if not depth:
        return rows.withColumn("_stack", F.array().cast(T.ArrayType(kind)))
    own = [c for c in rows.columns if c != "_k"]
    points = rows.select("_k", F.lit(1).alias("_kind"), F.lit(None).cast("int").alias("_level"), F.lit(None).cast(kind).alias("_rule"), F.struct(*own).alias("_row"))
    # Rows of one key are parted by a hash, so that ranges cut through a key that many rows share.
    merged = points.unionByName(_events(ruled), allowMissingColumns=True).withColumn("_by", F.xxhash64("_row"))
    merged = saved(range_chunks(merged, [], ["_k", "_kind", "_by"]))
    at = range(1, depth + 1)
    # What happened last at a level: a rule opened, or (a null rule) closed.
    happened = [F.when(F.col("_level") == i, F.struct(F.col("_rule").alias("r"))) for i in at]
    order = F.struct("_k", "_kind")
    ends = merged.groupBy(RANGE_CHUNK).agg(*[F.max_by(h, F.when(h.isNotNull(), order)).alias(f"_e{i}") for i, h in zip(at, happened, strict=True)])
    start = ends.select(RANGE_CHUNK, *[F.last(f"_e{i}", ignorenulls=True).over(_before()).alias(f"_s{i}") for i in at])
    inside = W.partitionBy(RANGE_CHUNK).orderBy("_k", "_kind", "_by").rowsBetween(W.unboundedPreceding, W.currentRow)
    now = merged.select("*", *[F.last(h, ignorenulls=True).over(inside).alias(f"_h{i}") for i, h in zip(at, happened, strict=True)])
    now = now.filter("_kind = 1").join(F.broadcast(start), RANGE_CHUNK)  # start: one row a range
    stack = F.array(*[F.coalesce(F.col(f"_h{i}"), F.col(f"_s{i}"))["r"] for i in at])
    return now.select("_row.*", "_k", F.filter(stack, lambda r: r.isNotNull()).alias("_stack"))


def judge(pages: DataFrame, rules: DataFrame, id_col: str = "page_id", url_col: str = "url", default: str = "allow") -> DataFrame:
    """Per row of ``pages``: id_col, host, path, rule (the winning rule's host and path in one,
    null without one) and verdict (the rule's, else ``default``).  ``rules``: host, path, verdict."""
    url = F.coalesce(F.col(url_col), F.lit(""))
    base = pages.select(F.col(id_col).alias("_id"), url_host(url).alias("host"), url_path(url).alias("path"))
    base = saved(base.withColumn("_n", F.monotonically_increasing_id()))
    parts = [F.translate(F.coalesce("host", F.lit("")), _UPPER, _LOWER).alias("host"), F.coalesce("path", F.lit("")).alias("path"), "verdict"]
    given = rules.filter("verdict is not null").select(*parts).groupBy("host", "path").agg(F.max_by("verdict", F.struct(F.col("verdict") == "block", "verdict")).alias("verdict"))
    given = saved(given.withColumn("_h", host_key(F.col("host"))))
    hosts = sweep(base.select("_n", "path", host_key(F.col("host")).alias("_k")), given.select(F.col("_h").alias("_key")).distinct())
    below = hosts.select("_n", "path", F.explode("_stack._key").alias("_h")).select("_n", _path_key(F.col("_h"), F.col("path")).alias("_k"))
    text = F.concat("host", "path")
    told = given.select(_path_key(F.col("_h"), F.col("path")).alias("_key"), text.alias("rule"), "verdict", F.struct(F.length(text).alias("all"), F.length("host").alias("host")).alias("size"))
    top = sweep(below, told).select("_n", F.try_element_at("_stack", F.lit(-1)).alias("_r")).filter("_r is not null")
    best = top.groupBy("_n").agg(F.max_by("_r", "_r.size").alias("_r"))
    out = base.join(best, "_n", "left")
    return out.select(F.col("_id").alias(id_col), "host", "path", F.col("_r.rule").alias("rule"), F.coalesce("_r.verdict", F.lit(default)).alias("verdict"))
