"""Training documents that hold exact, edited or paraphrased benchmark items.

1. The word n-grams of all items are seeds, and so are n words with one word in between skipped
   (so a copy with every third word replaced still holds some).  One pass over all documents finds their
   occurrences: a fixed bit table passes every seed (and few others), a join by hash
   keeps exactly the seeds.  Occurrences are counted over the whole corpus.
2. An item's ``rare`` rarest seeds of each kind of those that occur join documents to it at one
   occurrence; its other seeds join where two of them lie about as far apart as in the
   item (so the seeds that survive an edit count although copies make them frequent).
3. Around the occurrences of a document and an item, Smith-Waterman aligns the words of
   both (match 2, mismatch and gap -1).  The score is divided by that of a whole copy.

Cases: null texts and ids: a text without words matches nothing, null ids come back
null; an item shorter than n words is one seed; items without words match nothing;
repeated items count once, repeated documents are reported each, with their ids or
without; very long texts are read whole; empty
tables give an empty result.  Extra columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from hourglass.llm.common import mix64, ngram_hashes, salted, saved, sorted_groups, word_hashes

MATCH, MISMATCH, GAP = 2, -1, -1
BITS = 24  # the bit table has a fixed size, whatever the benchmark's


def align(item: np.ndarray, windows: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Smith-Waterman scores of the item with each window, and where each alignment
    ends (one past its last word).  A row at a time for all windows; gaps along a row
    are a running maximum."""
    width = max(map(len, windows))
    text = np.zeros((len(windows), width), np.uint64)
    real = np.zeros((len(windows), width), dtype=bool)
    for i, w in enumerate(windows):
        text[i, : len(w)], real[i, : len(w)] = w, True
    step = np.arange(width + 1, dtype=np.int64) * -GAP
    h = np.zeros((len(windows), width + 1), np.int64)
    best, end = np.zeros(len(windows), np.int64), np.zeros(len(windows), np.int64)
    for word in item:
        hit = np.where((text == word) & real, MATCH, MISMATCH)
        new = np.zeros_like(h)
        new[:, 1:] = np.maximum(0, np.maximum(h[:, :-1] + hit, h[:, 1:] + GAP))
        h = np.maximum.accumulate(new + step, axis=1) - step
        h[:, 1:][~real] = 0
        top = h.argmax(1)
        value = h[np.arange(len(h)), top]
        better = value > best
        best[better], end[better] = value[better], top[better]
    return best, end


def kinds_of(size: int, n: int) -> list[tuple[int, int]]:
    """(words, skipped place) of the seeds of a text of ``size`` words; place 0: none is skipped."""
    return [(min(n, size), 0)] + [(n, skip) for skip in range(1, n) if size > n]


def seed_hashes(words: np.ndarray, n: int, skip: int) -> np.ndarray:
    """The seed of one kind from each place on."""
    if not skip:
        return ngram_hashes(words, n)
    h = np.zeros(max(0, len(words) - n), np.uint64)
    for i in range(n + 1):
        if i != skip:
            h = mix64(h * np.uint64(0x100000001B3) + words[i : i + len(h)])
    return mix64(h + np.uint64(skip))


def _items(benchmark: DataFrame, n: int, id_col: str, text_col: str) -> DataFrame:
    """item_id, words (hashes), seeds (hash, place, kind) and size of the items that have words."""

    def run(batches):
        for pdf in batches:
            words, starts = word_hashes(pdf["text"].tolist())
            out = []
            for i, a, b in zip(pdf["item_id"], starts[:-1], starts[1:], strict=True):
                if b > a:
                    seeds = [{"seed": int(h), "at": p, "kind": skip} for k, skip in kinds_of(b - a, n) for p, h in enumerate(seed_hashes(words[a:b], k, skip).view(np.int64))]
                    out.append((i, words[a:b].view(np.int64), seeds, int(b - a)))
            yield pd.DataFrame(out, columns=["item_id", "words", "seeds", "size"])

    return benchmark.select(F.col(id_col).cast("string").alias("item_id"), F.col(text_col).alias("text")).mapInPandas(run, "item_id string, words array<long>, seeds array<struct<seed: long, at: int, kind: int>>, size int")


def _bits(seeds: DataFrame) -> np.ndarray:
    """The bit table of the seeds, gathered as 64-bit words (at most 2**BITS / 64 rows)."""
    low = F.col("seed").bitwiseAND(F.lit((1 << BITS) - 1))
    rows = seeds.select(F.shiftright(low, 6).alias("w"), F.expr(f"shiftleft(1L, cast((seed & {(1 << BITS) - 1}L) & 63L as int))").alias("b")).groupBy("w").agg(F.bit_or("b").alias("b")).toPandas()
    table = np.zeros((1 << BITS) >> 6, np.int64)
    table[rows["w"].to_numpy()] = rows["b"].to_numpy()
    return np.unpackbits(table.view(np.uint8), bitorder="little").astype(bool)


def _blocks(texts, size: int = 1 << 20):
    at = held = 0
    for i, t in enumerate(texts):
        held += len(t) if isinstance(t, str) else 0
        if held >= size:
            yield at, i + 1
            at, held = i + 1, 0
    if at < len(texts):
        yield at, len(texts)


def _occurrences(docs: DataFrame, bits: np.ndarray, kinds: list[tuple[int, int]]) -> DataFrame:
    """doc_id, t, place, seed of the seeds of these kinds that the bit table passes."""
    shared = docs.sparkSession.sparkContext.broadcast(np.packbits(bits))

    def run(batches):
        table = np.unpackbits(shared.value).astype(bool)
        mask = np.uint64((1 << BITS) - 1)
        for pdf in batches:
            text = pdf["text"].tolist()
            for a, b in _blocks(text):
                words, starts = word_hashes(text[a:b])
                for n, skip in kinds:
                    g = seed_hashes(words, n, skip)
                    at = np.flatnonzero(table[(g & mask).astype(np.int64)])
                    doc = np.searchsorted(starts, at, side="right") - 1
                    inside = at + n + (skip > 0) <= starts[doc + 1]
                    at, doc = at[inside], doc[inside]
                    yield pd.DataFrame({"doc_id": pdf["doc_id"].to_numpy()[a + doc], "t": pdf["t"].to_numpy()[a + doc], "place": at - starts[doc], "seed": g[at].view(np.int64)})

    return docs.mapInPandas(run, "doc_id string, t long, place int, seed long")


def contaminated(docs: DataFrame, benchmark: DataFrame, n: int = 3, rare: int = 16, threshold: float = 0.5, id_col: str = "doc_id", text_col: str = "text", item_id_col: str = "item_id", item_text_col: str = "text", row_col: str | None = None) -> DataFrame:
    """doc_id, item_id, score (1: a whole copy), last_word (one past the aligned words)
    of documents and items with a score of at least ``threshold``; one row per pair of a row and an item.

    With ``row_col`` (a long, different in every row) each row is a document of its own,
    whatever its id, and the result has that column too."""
    items = saved(_items(benchmark, n, item_id_col, item_text_col))
    # null ids of items stay apart by a key of their own
    items = items.withColumn("item", F.xxhash64(F.coalesce("item_id", F.lit("-")), "words"))
    seeds = saved(items.select("item", F.explode("seeds").alias("s"), "size").select("item", "s.*", "size"))
    out = "doc_id string, t long, item long, score double, last_word int"
    src = docs.select(F.col(id_col).cast("string").alias("doc_id"), F.col(text_col).alias("text"), *([F.col(row_col).alias("t")] if row_col else []))
    if not row_col:
        src = src.withColumn("t", F.xxhash64(F.coalesce("doc_id", F.lit("-")), "text"))
    kinds = sorted({k for r in items.select(F.least("size", F.lit(n + 1))).distinct().collect() for k in kinds_of(r[0], n)})
    hits = saved(_occurrences(src, _bits(seeds), kinds).join(seeds.select("seed").distinct(), "seed", "left_semi"))
    counts = hits.groupBy("seed").agg(F.count("*").alias("hits"))
    rank = F.row_number().over(W.partitionBy("item", "kind").orderBy("hits", "at"))
    occur = seeds.join(counts, "seed").withColumn("rare", rank <= rare)
    # A seed may lie in a third of all documents: its rows are dealt by salt.
    by_seed = occur.groupBy("seed").agg(F.collect_list(F.struct("item", "at", "size", "rare")).alias("of"))
    met = salted(hits, by_seed, ["seed"], ["t", "place"]).select("doc_id", "t", "place", F.explode("of").alias("o"))
    found = met.groupBy("doc_id", "t", "o.item").agg(F.sort_array(F.collect_set(F.struct((F.col("place") - F.col("o.at")).alias("d"), "o.at", "o.rare"))).alias("f"), F.max("o.size").alias("size"))
    near = lambda x, y: (F.abs(x["d"] - y["d"]) <= F.col("size") / 4 + 2) & (x["at"] != y["at"])
    beside = lambda x, i: x["rare"] | ((i > 0) & near(x, F.get("f", i - 1))) | ((i < F.size("f") - 1) & near(x, F.get("f", i + 1)))
    spans = found.withColumn("starts", F.transform(F.filter("f", beside), lambda x: x["d"])).filter("size(starts) > 0").select("doc_id", "t", "item", "size", F.array_distinct("starts").alias("starts"))
    asks = spans.groupBy("doc_id", "t").agg(F.collect_list(F.struct("item", "size", "starts")).alias("asks")).withColumn("key", F.coalesce("doc_id", F.lit("-"))).drop("doc_id")
    texts = src.withColumn("key", F.coalesce("doc_id", F.lit("-"))).join(asks, ["t", "key"]).select("doc_id", "t", "text", "asks")

    def windows(batches):
        """The words around the likely places of each item, overlapping ones joined."""
        for pdf in batches:
            text, rows = pdf["text"].tolist(), []
            for a, b in _blocks(text):
                words, starts = word_hashes(text[a:b])
                for i in range(a, b):
                    own = words[starts[i - a] : starts[i - a + 1]]
                    for ask in pdf["asks"].iloc[i]:
                        pad, lo, hi = ask["size"] // 2 + 4, None, None
                        for s in [*sorted(ask["starts"]), None]:
                            x = None if s is None else max(0, s - pad)
                            if lo is not None and (x is None or x > hi):
                                rows.append((pdf["doc_id"].iloc[i], pdf["t"].iloc[i], ask["item"], lo, own[lo:hi].view(np.int64)))
                                lo = None
                            if x is not None:
                                lo, hi = x if lo is None else lo, min(len(own), s + ask["size"] + pad)
            yield pd.DataFrame(rows, columns=["doc_id", "t", "item", "lo", "window"])

    spread = texts.mapInPandas(windows, "doc_id string, t long, item long, lo int, window array<long>")

    def score(batches):
        for g in sorted_groups(batches, ["item"]):
            item = np.asarray(g["words"].iloc[0], np.int64).view(np.uint64)
            g = g.iloc[np.argsort([len(x) for x in g["window"]])]
            for at in range(0, len(g), 256):
                part = g.iloc[at : at + 256]
                best, end = align(item, [np.asarray(x, np.int64).view(np.uint64) for x in part["window"]])
                yield pd.DataFrame({"doc_id": part["doc_id"], "t": part["t"], "item": part["item"], "score": best / (MATCH * len(item)), "last_word": part["lo"].to_numpy() + end})

    both = salted(spread, items.select("item", "words").dropDuplicates(["item"]), ["item"], ["t", "lo"])
    scored = both.sortWithinPartitions("item").mapInPandas(score, out).filter(F.col("score") >= threshold)
    best = scored.groupBy("doc_id", "t", "item").agg(F.max(F.struct("score", "last_word")).alias("b")).join(items.dropDuplicates(["item"]).select("item", "item_id"), "item")
    if not row_col:  # rows that repeat both id and text were judged as one
        key = F.coalesce("doc_id", F.lit("-"))
        copies = src.join(best.select("t").distinct(), "t", "left_semi").groupBy("t", key.alias("key")).agg(F.count("*").alias("copies"))
        best = best.withColumn("key", key).join(copies, ["t", "key"]).withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies"))))
    kind, ikind = docs.schema[id_col].dataType, benchmark.schema[item_id_col].dataType
    rows = [F.col("t").alias(row_col)] if row_col else []
    return best.select(F.col("doc_id").cast(kind), F.col("item_id").cast(ikind), F.col("b.score").alias("score"), F.col("b.last_word").alias("last_word"), *rows)
