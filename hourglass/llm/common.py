"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import uuid

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hourglass.session import checkpoint_dir

#: A side is broadcast by hand only up to this many rows (all such rows are a few numbers wide).
BROADCAST_ROWS = 50_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_path(spark: SparkSession, kind: str) -> str:
    """A fresh folder under the cluster's ``spark.checkpoint.dir``."""
    return f"{checkpoint_dir(spark).rstrip('/')}/{kind}/{uuid.uuid4().hex}"


def saved(df: DataFrame) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back: later branches
    read files instead of repeating the plan, and survive a lost executor."""
    path = shared_path(df.sparkSession, "tables")
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def join_small(rows: DataFrame, small: DataFrame, key: str, salts: int = 16) -> DataFrame:
    """Inner join to a table with one row a key, where a key may hold a third of
    ``rows``.  ``small`` is broadcast up to ``BROADCAST_ROWS`` counted rows; beyond
    that each of its rows is repeated per salt and ``rows`` are dealt by (key, salt).
    Null keys meet null keys."""
    r = small.withColumnRenamed(key, "_key")
    if small.count() <= BROADCAST_ROWS:
        return rows.join(F.broadcast(r), rows[key].eqNullSafe(r["_key"])).drop("_key")
    r = r.withColumn("_salt_r", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    l = rows.withColumn("_salt", F.pmod(F.monotonically_increasing_id(), F.lit(salts)).cast("int"))
    return l.join(r, l[key].eqNullSafe(r["_key"]) & (l["_salt"] == r["_salt_r"])).drop("_key", "_salt", "_salt_r")


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit mixer (xor-shift and odd multipliers)."""
    x = np.asarray(x, dtype=np.uint64)
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15)
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0xC2B2AE3D27D4EB4F)
    return x ^ (x >> np.uint64(32))


def text_bytes(texts) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of a batch of texts in one array, and each text's start
    (one more entry for the end).  Null texts are empty."""
    parts = [t.encode("utf-8", "surrogatepass") if isinstance(t, str) else b"" for t in texts]
    starts = np.zeros(len(parts) + 1, dtype=np.int64)
    np.cumsum([len(p) for p in parts], out=starts[1:])
    return np.frombuffer(b"".join(parts), dtype=np.uint8), starts


def _word_bytes() -> np.ndarray:
    t = np.zeros(256, dtype=bool)
    t[128:] = True
    for lo, hi in ((48, 58), (65, 91), (97, 123), (95, 96)):
        t[lo:hi] = True
    return t


WORD_BYTE = _word_bytes()
_POWERS: dict[int, np.ndarray] = {}


def word_hashes(texts) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words of a batch, and the index of each text's first word
    (one more entry for the end).

    Texts are lower-cased; a word is a run of ASCII letters, digits, ``_`` and
    characters beyond ASCII.  A word's hash is a sum of mixed (byte, place)
    values, so it depends on the word alone."""
    data, starts = text_bytes([t.lower() if isinstance(t, str) else "" for t in texts])
    n = len(data)
    if not n:
        return np.zeros(0, np.uint64), np.zeros(len(starts), np.int64)
    word = WORD_BYTE[data]
    edge = np.zeros(n + 1, dtype=bool)
    edge[starts] = True
    first = word.copy()
    first[1:] &= ~word[:-1] | edge[1:n]
    begin = np.flatnonzero(first)
    if not len(begin):
        return np.zeros(0, np.uint64), np.zeros(len(starts), np.int64)
    idx = np.flatnonzero(word)
    which = np.searchsorted(idx, begin)
    counts = np.diff(np.append(which, len(idx)))
    place = np.arange(len(idx)) - np.repeat(which, counts)
    longest = int(place.max()) + 1
    size = 1 << max(8, (longest - 1).bit_length())
    if size not in _POWERS:
        _POWERS.clear()
        _POWERS[size] = mix64(np.arange(size, dtype=np.uint64) + np.uint64(0x51ED27)) | np.uint64(1)
    byte = mix64(np.arange(256, dtype=np.uint64) + np.uint64(0xA5A5A5))
    h = np.add.reduceat(byte[data[idx]] * _POWERS[size][place], which)
    return mix64(h), np.searchsorted(begin, starts).astype(np.int64)


def ngram_hashes(words: np.ndarray, n: int) -> np.ndarray:
    """Hash of the ``n`` words from each place on (``len(words) - n + 1`` values)."""
    m = len(words) - n + 1
    if m <= 0:
        return np.zeros(0, np.uint64)
    h = np.zeros(m, np.uint64)
    for i in range(n):
        h = mix64(h * np.uint64(0x100000001B3) + words[i : i + m])
    return h


def salted(rows: DataFrame, keys: DataFrame, on: list[str], by: list[str], salts: int = 16, how: str = "inner") -> DataFrame:
    """Join ``rows`` to ``keys`` (one row a key), where a key may hold a third of the
    rows: each key is repeated per salt, the rows are dealt by key and a hash of ``by``."""
    k = keys.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    return rows.withColumn("_salt", F.pmod(F.xxhash64(*by), F.lit(salts)).cast("int")).join(k, [*on, "_salt"], how).drop("_salt")


def sorted_groups(batches, keys: list[str]):
    """The groups of a partition that is sorted by ``keys``, one DataFrame each."""
    held: list = []
    for pdf in batches:
        if not len(pdf):
            continue
        k = pdf[keys].to_numpy()
        new = np.flatnonzero((k[1:] != k[:-1]).any(1)) + 1
        cuts = [0, *new.tolist(), len(pdf)]
        for i, (a, b) in enumerate(zip(cuts[:-1], cuts[1:], strict=True)):
            part = pdf.iloc[a:b]
            if i == 0 and held and (held[-1][keys].iloc[-1].to_numpy() != k[0]).any():
                yield pd.concat(held)
                held = []
            if i:
                yield pd.concat(held)
                held = []
            held.append(part)
    if held:
        yield pd.concat(held)


def components(edges: DataFrame) -> DataFrame:
    """node, label: the least node of each connected component of ``edges`` (u, v; longs).

    Alternating stars: every node links its larger neighbours to its least one, then
    its smaller ones; a round is two counts before the shuffle and two salted joins.
    Nodes with very many neighbours are split by salt."""
    cur = saved(edges.filter("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct())
    before = None
    while True:
        both = cur.unionByName(cur.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        large = salted(both.filter("v > u"), least, ["u"], ["v"]).select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u <> v").distinct()
        large = saved(large)
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = salted(large, least, ["u"], ["v"]).select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(least.select("u", F.col("m").alias("v")))
        cur = saved(small.filter("u <> v").distinct())
        now = cur.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == before:
            break
        before = now
    return cur.select(F.col("u").alias("node"), F.col("v").alias("label")).unionByName(cur.select(F.col("v").alias("node"), F.col("v").alias("label")).distinct())
