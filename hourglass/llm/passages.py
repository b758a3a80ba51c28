"""Removal of byte strings that repeat anywhere, by suffix arrays of shards.

A start is a repeat if its ``length`` bytes also start elsewhere (in any document,
the same one included); every byte under a repeat is removed.

1. Anchors.  Of the 64-byte grams in the ``length`` bytes from a start, the one
   with the least hash (the leftmost of equals) is the start's anchor, so equal strings have equal anchors.
   Neighbouring starts share an anchor: one row holds a run of starts with the
   anchor's hash and a hash of its context, the bytes that the run's strings cover.
2. Anchors that occur once cannot repeat and go no further.  Contexts that occur
   more than once (copies, shared passages) are repeats throughout; they are
   counted before the shuffle, and one of each stands for all.
3. The different contexts of an anchor are laid in one shard text.  Its suffix
   array (induced sorting) and permuted common prefixes show the repeated starts.
   An anchor with more than ``hot`` different contexts is split first: the places that
   it can have in a string are halved, and the starts of a half share the bytes that all
   strings with the anchor at those places cover.  Those bytes are the half's own anchor,
   so equal strings stay together; step 2 is applied to it again, and so on down to
   one place, where the shared bytes are the whole string.

Every count covers all documents; no anchor or context is dropped.  Texts cross
the network once, and once more for documents with contexts to sort.

Cases: null text is empty; texts shorter than ``length`` keep all bytes; rows with
equal ids and texts repeat each other; null ids are ids; very long texts are cut
into overlapping pieces; an empty table gives an empty result.  Extra columns are
ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hourglass.llm.common import mix64, saved
from hourglass.llm.suffix import repeated_starts

GRAM = 64
PIECE = 1 << 20
SHARD = 1 << 18
SEPARATOR = b"\xff"  # in no UTF-8 text
SORTED = ["doc_id", "t", "h", "copies", "lo", "n", "ctx"]
C1, C2 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)


def window_hashes(data: np.ndarray, width: int, seed: int) -> np.ndarray:
    """Hashes of the ``width`` bytes from each place on, by doubling."""
    h, m = mix64(np.arange(256, dtype=np.uint64) + np.uint64(seed))[data], 1
    while m < width:
        k = min(m, width - m)
        h = (h[:-k] * C1) ^ ((h[k:] + (h[k:] >> np.uint64(29))) * C2) if len(h) > k else h[:0]
        m += k
    return mix64(h)


def _least(h: np.ndarray, width: int) -> np.ndarray:
    m = 1
    while m < width and len(h):
        k = min(m, width - m)
        h = np.minimum(h[:-k], h[k:]) if len(h) > k else h[:0]
        m += k
    return h


def pieces(docs: list[bytes], length: int) -> Iterator[tuple[list[tuple[int, int]], bytes]]:
    """Lists of (document, offset) with their bytes, about PIECE bytes each; a longer
    document goes in pieces that overlap by ``length - 1`` bytes."""
    part, held, at = [], [], 0
    for i, d in enumerate(docs):
        if len(d) < length:
            continue
        for lo in range(0, len(d) - length + 1, PIECE):
            b = d[lo : lo + PIECE + length - 1]
            part.append((i, lo, at))
            held.append(b)
            at += len(b)
            if at >= PIECE:
                yield part, b"".join(held)
                part, held, at = [], [], 0
    if part:
        yield part, b"".join(held)


def anchors(docs: list[bytes], length: int) -> dict[str, np.ndarray]:
    """Runs of starts with one anchor: document, first start, number of starts,
    anchor hash, context hash."""
    out = {k: [] for k in ("doc", "lo", "n", "h", "c")}
    for part, raw in pieces(docs, length):
        data = np.frombuffer(raw, np.uint8)
        first = np.array([p[2] for p in part])
        size = np.diff(np.append(first, len(data)))
        grams = window_hashes(data, GRAM, 77)
        least = _least(grams, length - GRAM + 1)
        which = np.repeat(np.arange(len(part)), size)[: len(least)]
        new = np.ones(len(least), dtype=bool)
        # the leftmost of equal grams is the anchor: a run also ends at its anchor
        new[1:] = (least[1:] != least[:-1]) | (which[1:] != which[:-1]) | (grams[: len(least) - 1] == least[:-1])
        lo = np.flatnonzero(new)
        hi = np.append(lo[1:], len(least))
        doc = which[lo]
        hi = np.minimum(hi, (first + size - length + 1)[doc])
        keep = hi > lo
        lo, hi, doc = lo[keep], hi[keep], doc[keep]
        # context hash: the hashes of 32-byte grams at the distance 32 from its start, and the last one
        gram = window_hashes(data, 32, 99)
        n = hi - lo
        total = n + length - 1
        c = mix64(total.astype(np.uint64)) ^ gram[lo + total - 32]
        for k in range(0, int(total.max()) - 31 if len(total) else 0, 32):
            inside = k + 32 <= total
            c[inside] = mix64(c[inside] * C1 + gram[lo[inside] + k])
        base = np.array([p[1] - p[2] for p in part])
        out["doc"].append(np.array([p[0] for p in part])[doc])
        out["lo"].append(lo + base[doc])
        out["n"].append(n)
        out["h"].append(least[lo])
        out["c"].append(c)
    empty = np.zeros(0, np.int64)
    got = {k: np.concatenate(v) if v else empty for k, v in out.items()}
    return {k: v.view(np.int64) if v.dtype == np.uint64 else v for k, v in got.items()}


def _bytes(text) -> bytes:
    return text.encode("utf-8", "surrogatepass") if isinstance(text, str) else b""


def removed_spans(starts: np.ndarray, length: int) -> list[tuple[int, int]]:
    """Maximal byte runs under the (first, last + 1) runs of repeated starts."""
    if not len(starts):
        return []
    s = starts[np.argsort(starts[:, 0], kind="stable")]
    reach = np.maximum.accumulate(s[:, 1] + length - 1)
    new = np.ones(len(s), dtype=bool)
    new[1:] = s[1:, 0] > reach[:-1]
    first = np.flatnonzero(new)
    return list(zip(s[first, 0].tolist(), reach[np.append(first[1:], len(s)) - 1].tolist(), strict=True))


def _find_anchors(docs: DataFrame, length: int) -> DataFrame:
    def run(batches):
        for pdf in batches:
            ids, keys, texts = pdf["doc_id"].to_numpy(), pdf["t"].to_numpy(), pdf["text"]
            for at in range(0, len(pdf), 512):
                a = anchors([_bytes(x) for x in texts.iloc[at : at + 512]], length)
                d = a.pop("doc") + at
                yield pd.DataFrame({"doc_id": ids[d], "t": keys[d], **a})

    return docs.mapInPandas(run, "doc_id string, t long, lo int, n int, h long, c long")


def _sorted_shards(contexts: DataFrame, length: int) -> DataFrame:
    """Repeated starts among the contexts of each anchor; contexts of one anchor lie
    in one partition, next to each other."""

    def run(batches):
        held, size, last = [], 0, None

        def flush():
            data = np.frombuffer(SEPARATOR.join(r.ctx for r in held) + SEPARATOR, np.uint8)
            hit = repeated_starts(data, length)
            at, rows = 0, []
            for r in held:
                if r.copies == 1:
                    edge = np.diff(np.concatenate([[0], hit[at : at + r.n].astype(np.int8), [0]]))
                    for a, b in zip(np.flatnonzero(edge == 1), np.flatnonzero(edge == -1), strict=True):
                        rows.append((r.doc_id, r.t, r.lo + int(a), r.lo + int(b)))
                at += len(r.ctx) + 1
            return pd.DataFrame(rows, columns=["doc_id", "t", "a", "b"])

        for pdf in batches:
            for r in pdf.itertuples():
                if r.h != last and size >= SHARD:
                    yield flush()
                    held, size = [], 0
                last = r.h
                held.append(r)
                size += len(r.ctx)
        if held:
            yield flush()

    return contexts.mapInPandas(run, "doc_id string, t long, a int, b int")


def _hash(*parts) -> int:
    h = hashlib.blake2b(digest_size=8)
    for p in parts:
        h.update(p if isinstance(p, bytes) else b"%d|" % p)
    return int.from_bytes(h.digest(), "little", signed=True)


def _halves(contexts: DataFrame, length: int) -> DataFrame:
    """Each context's starts by the two halves of the places p0 to p1 that the anchor may
    have in a string.  ``first`` is its place in the context's first string (-1: not known yet)."""

    def run(batches):
        for pdf in batches:
            rows = []
            for r in pdf.itertuples():
                first = r.first if r.first >= 0 else int(window_hashes(np.frombuffer(r.ctx[:length], np.uint8), GRAM, 77).argmin())
                mid = (r.p0 + r.p1) // 2
                cut = min(max(first - mid + 1, 0), r.n)  # starts before it have the anchor at mid or later
                for p0, p1, a, b in ((mid, r.p1, 0, cut), (r.p0, mid, cut, r.n)):
                    if b > a:
                        ctx = r.ctx[a : b - 1 + length]
                        core = r.ctx[first - p0 : first - p1 + 1 + length]
                        rows.append((r.doc_id, r.t, _hash(r.h, p0, p1, core), _hash(ctx), r.copies, r.lo + a, b - a, first - a, p0, p1, ctx))
            yield pd.DataFrame(rows, columns=["doc_id", "t", "h", "c", "copies", "lo", "n", "first", "p0", "p1", "ctx"])

    return contexts.mapInPandas(run, "doc_id string, t long, h long, c long, copies long, lo int, n int, first int, p0 int, p1 int, ctx binary")


def _split(contexts: DataFrame, length: int, hot: int) -> tuple[list[DataFrame], list[DataFrame]]:
    """Contexts of anchors with more than ``hot`` different ones, split until none has more:
    the runs of repeated starts met on the way, and the contexts to sort."""
    level = contexts.withColumns({"first": F.lit(-1), "p0": F.lit(0), "p1": F.lit(length - GRAM + 1)})
    starts, cold = [], []
    while True:
        parts = saved(_halves(level, length))
        one = saved(parts.groupBy("h", "c").agg(F.sum("copies").alias("copies"), F.min(F.struct("t", "doc_id", "lo", "n", "first", "p0", "p1", "ctx")).alias("r")))
        again = _salted(parts.filter("copies = 1").select("doc_id", "t", "h", "c", "lo", "n"), one.filter("copies > 1").select("h", "c"), ["h", "c"])
        starts.append(again.select("doc_id", "t", F.col("lo").alias("a"), (F.col("lo") + F.col("n")).alias("b")))
        sizes = saved(one.groupBy("h").agg(F.count("*").alias("variants")).filter("variants > 1"))
        left = _salted(one.select("h", "copies", "r.*"), sizes, ["h"])
        cold.append(left.filter(F.col("variants") <= hot).select(SORTED))
        level = left.filter(F.col("variants") > hot)
        if not sizes.filter(F.col("variants") > hot).take(1):
            return starts, cold


def _salted(rows: DataFrame, keys: DataFrame, on: list[str], salts: int = 8) -> DataFrame:
    """Inner join to unique keys of which one may hold a third of the rows."""
    k = keys.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    return rows.withColumn("_salt", F.pmod(F.xxhash64("doc_id", "t", "lo"), F.lit(salts)).cast("int")).join(k, [*on, "_salt"]).drop("_salt")


def _finish(batches, length: int):
    """Digest of each document from its text and the runs of repeated starts."""
    for pdf in batches:
        rows = []
        for doc, text, flat in zip(pdf["doc_id"], pdf["text"], pdf["runs"], strict=True):
            data = _bytes(text)
            runs = np.asarray(flat if flat is not None else [], dtype=np.int64).reshape(-1, 2)
            spans = removed_spans(runs, length)
            kept, at = [], 0
            for a, b in spans:
                kept.append(data[at:a])
                at = b
            kept.append(data[at:])
            body = b"".join(kept)
            rows.append((doc, len(data), len(data) - len(body), len(spans), [x for s in spans for x in s], hashlib.sha256(body).hexdigest()))
        yield pd.DataFrame(rows, columns=["doc_id", "n_bytes", "n_removed", "n_spans", "spans", "kept_sha256"])



def repeated_passages(docs: DataFrame, length: int = 200, hot: int = 4096, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id (as text), n_bytes, n_removed, n_spans, spans (first byte, last byte + 1,
    ... of each removed run), kept_sha256 (of the bytes that stay)."""
    if length < GRAM:
        raise ValueError(f"length must be at least {GRAM}")
    rows = docs.select(F.col(id_col).cast("string").alias("doc_id"), F.col(text_col).alias("text")).withColumn("t", F.xxhash64(F.coalesce("doc_id", F.lit("-")), "text"))
    found = saved(_find_anchors(rows, length))
    repeated = found.groupBy("h").agg(F.count("*").alias("_c")).filter("_c > 1").select("h")
    some = saved(_salted(found, repeated, ["h"]))
    contexts = saved(some.groupBy("h", "c").agg(F.count("*").alias("copies"), F.min(F.struct("t", "doc_id", "lo", "n")).alias("r")))
    copied = contexts.filter("copies > 1").select("h", "c")
    full = _salted(some, copied, ["h", "c"]).groupBy("doc_id", "t").agg(F.collect_list(F.array(F.col("lo"), F.col("lo") + F.col("n"))).alias("full"))
    mixed = contexts.groupBy("h").agg(F.count("*").alias("variants")).filter("variants > 1")
    asks = contexts.join(mixed, "h").select("h", "copies", "variants", "r.*").groupBy("doc_id", "t").agg(F.collect_list(F.struct("h", "copies", "variants", "lo", "n")).alias("asks"))
    null_safe = lambda d: d.withColumn("doc_id", F.coalesce("doc_id", F.lit("-")))
    info = null_safe(full).join(null_safe(asks), ["doc_id", "t"], "full").withColumnRenamed("doc_id", "_k")
    joined = saved(rows.join(info, (F.coalesce("doc_id", F.lit("-")) == F.col("_k")) & (rows["t"] == info["t"]), "left").select(rows["doc_id"], rows["t"], "text", F.flatten("full").alias("runs"), "asks"))
    out = "doc_id string, n_bytes long, n_removed long, n_spans long, spans array<long>, kept_sha256 string"
    done = joined.filter("asks is null").select("doc_id", "text", "runs").mapInPandas(lambda b: _finish(b, length), out)

    def cut(batches):
        for pdf in batches:
            rows = []
            for doc, t, text, asked in zip(pdf["doc_id"], pdf["t"], pdf["text"], pdf["asks"], strict=True):
                data = _bytes(text)
                rows += [(doc, t, x["h"], x["copies"], x["variants"], x["lo"], x["n"], data[x["lo"] : x["lo"] + x["n"] + length - 1]) for x in asked]
            yield pd.DataFrame(rows, columns=["doc_id", "t", "h", "copies", "variants", "lo", "n", "ctx"])

    pending = joined.filter("asks is not null")
    spread = pending.select("doc_id", "t", "text", "asks").mapInPandas(cut, "doc_id string, t long, h long, copies long, variants long, lo int, n int, ctx binary")
    total = contexts.join(mixed, "h").agg(F.sum(F.col("r.n") + length)).first()[0] or 0
    parts = max(spark_parts(docs), int(total // (8 * SHARD)) + 1)
    cold, starts = spread.filter(F.col("variants") <= hot).select(SORTED), []
    if mixed.filter(F.col("variants") > hot).take(1):
        starts, split = _split(spread.filter(F.col("variants") > hot).select(SORTED), length, hot)
        cold = reduce(DataFrame.unionByName, split, cold)
    starts = reduce(DataFrame.unionByName, starts, _sorted_shards(cold.repartition(parts, "h").sortWithinPartitions("h"), length))
    more = null_safe(starts.groupBy("doc_id", "t").agg(F.collect_list(F.array("a", "b")).alias("more"))).withColumnRenamed("doc_id", "_k")
    both = pending.join(more, (F.coalesce(pending["doc_id"], F.lit("-")) == F.col("_k")) & (pending["t"] == more["t"]), "left")
    merged = both.select(pending["doc_id"], "text", F.concat(F.coalesce("runs", F.array().cast("array<int>")), F.coalesce(F.flatten("more"), F.array().cast("array<int>"))).alias("runs"))
    return done.unionByName(merged.mapInPandas(lambda b: _finish(b, length), out))


def spark_parts(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
