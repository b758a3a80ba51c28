"""Documents whose word n-gram sets have a Jaccard similarity of at least a threshold.

1. Each text becomes the set of hashes of its word n-grams, a MinHash signature cut
   into bands, and a 128-bit key of the set.  Texts with equal sets are one class and
   go on as one row.
2. Classes are shuffled on band hashes.  Rows and bands are chosen for the target
   recall of a pair at the threshold.  A bucket links its members to its least one,
   never to each other; connected buckets form a family.
3. Families are verified on the full sets.  A family of more than ``block`` classes is
   dealt into chunks, and every pair of chunks is a task of its own.  A task intersects
   sets as one product of 0/1 matrices and returns a count and a label per class, not
   the pairs.

Every pair within a family is verified, so a pair is found if a chain of shared bands
joins it.  No bucket, family or partner list is capped.

Cases: null texts and texts without words have no n-grams, belong to no pair and are
their own class; a text of fewer words than n is one n-gram; rows with equal ids are
rows of their own; a class is named by its least id (null only if all are null);
very long texts are read whole; an empty table gives an empty result.  Extra columns
are ignored.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hourglass.llm.common import components, mix64, ngram_hashes, salted, saved, sorted_groups, word_hashes

BLOCK = 4096
COLUMNS = 2048


def banding(threshold: float, recall: float, rows: int = 5) -> tuple[int, int]:
    """(bands, rows) such that a pair at ``threshold`` shares a band with probability ``recall``."""
    hit = threshold**rows
    return (1 if hit >= 1 else max(1, math.ceil(math.log(1 - recall) / math.log(1 - hit)))), rows


def gram_sets(texts, n: int) -> list[np.ndarray]:
    """The sorted distinct n-gram hashes of each text."""
    words, starts = word_hashes(texts)
    out = []
    for a, b in zip(starts[:-1].tolist(), starts[1:].tolist(), strict=True):
        k = min(n, b - a)
        out.append(np.unique(ngram_hashes(words[a:b], k)) if k else np.zeros(0, np.uint64))
    return out


def _signatures(sets: list[np.ndarray], bands: int, rows: int) -> np.ndarray:
    """Band hashes of non-empty sets."""
    flat = np.concatenate(sets)
    starts = np.cumsum([0] + [len(s) for s in sets[:-1]])
    seeds = mix64(np.arange(1, 2 * bands * rows + 1, dtype=np.uint64))
    out = np.zeros((len(sets), bands), np.uint64)
    for b in range(bands):
        h = np.full(len(sets), b + 1, np.uint64)
        for r in range(rows):
            i = 2 * (b * rows + r)
            least = np.minimum.reduceat((flat ^ seeds[i + 1]) * (seeds[i] | np.uint64(1)), starts)
            h = mix64(h * np.uint64(0x100000001B3) + least)
        out[:, b] = h
    return out.view(np.int64)


def _blocks(texts, size: int = 1 << 20):
    at = held = 0
    for i, t in enumerate(texts):
        held += len(t) if isinstance(t, str) else 0
        if held >= size:
            yield at, i + 1
            at, held = i + 1, 0
    if at < len(texts):
        yield at, len(texts)


def sketch(docs: DataFrame, n: int, bands: int, rows: int) -> DataFrame:
    """doc_id, t, grams, k1, k2, bands; no key or bands where there are no n-grams."""

    def run(batches):
        for pdf in batches:
            text = pdf["text"].tolist()
            for a, b in _blocks(text):
                sets = gram_sets(text[a:b], n)
                full = [i for i, s in enumerate(sets) if len(s)]
                sig = _signatures([sets[i] for i in full], bands, rows) if full else np.zeros((0, bands), np.int64)
                k1, k2, band = [None] * len(sets), [None] * len(sets), [None] * len(sets)
                for i, x in zip(full, sig, strict=True):
                    m = mix64(sets[i] + np.uint64(11))
                    k1[i], k2[i], band[i] = int(m.sum().view(np.int64)), int((m * m).sum().view(np.int64)), x
                yield pd.DataFrame({"doc_id": pdf["doc_id"].iloc[a:b].to_numpy(), "t": pdf["t"].iloc[a:b].to_numpy(), "grams": [len(s) for s in sets], "k1": pd.array(k1, "Int64"), "k2": pd.array(k2, "Int64"), "bands": band})

    return docs.mapInPandas(run, "doc_id string, t long, grams int, k1 long, k2 long, bands array<long>")


def linked(a: list[np.ndarray], b: list[np.ndarray], threshold: float) -> np.ndarray:
    """True where the sets a[i] and b[j] are similar: intersections as a product of 0/1
    matrices over the n-grams that two sets at least share, some columns at a time."""
    sets = a if b is a else a + b
    size = np.array([len(s) for s in sets])
    _, col = np.unique(np.concatenate(sets), return_inverse=True)
    shared = np.bincount(col) > 1
    place = np.cumsum(shared) - 1
    row = np.repeat(np.arange(len(sets)), size)
    keep = shared[col]
    row, col = row[keep], place[col[keep]]
    order = np.argsort(col, kind="stable")
    row, col = row[order], col[order]
    both = np.zeros((len(a), len(b)), np.float32)
    for c in range(0, int(shared.sum()), COLUMNS):
        lo, hi = np.searchsorted(col, [c, c + COLUMNS])
        m = np.zeros((len(sets), COLUMNS), np.float32)
        m[row[lo:hi], col[lo:hi] - c] = 1
        both += m[: len(a)] @ (m.T if b is a else m[len(a) :].T)
    x, y = size[: len(a), None], size[None, :] if b is a else size[None, len(a) :]
    return both.astype(np.float64) * (1 + threshold) >= threshold * (x + y) - 1e-9


def _labels(link: np.ndarray, name: np.ndarray) -> np.ndarray:
    """The least name of each node's component in a symmetric link matrix."""
    label, seen = name.copy(), np.full(len(name), False)
    for start in np.argsort(name, kind="stable"):
        if seen[start]:
            continue
        front = np.array([start])
        seen[start] = True
        while len(front):
            label[front] = name[start]
            reach = link[front].any(0) & ~seen
            front = np.flatnonzero(reach)
            seen[front] = True
    return label


def _verify(batches, threshold: float):
    """c, label, links of the classes of each pair of chunks."""
    for g in sorted_groups(batches, ["family", "i", "j"]):
        g = g.drop_duplicates("c")  # rows that repeat both id and text
        sets = [np.frombuffer(x, np.uint64) for x in g["set"]]
        name, copies, chunk = g["c"].to_numpy(), g["copies"].to_numpy(), g["chunk"].to_numpy()
        i, j = int(g["i"].iloc[0]), int(g["j"].iloc[0])
        if i == j:
            link = linked(sets, sets, threshold)
            np.fill_diagonal(link, False)
            count = link @ copies
            label = _labels(link, name)
        else:
            p, q = np.flatnonzero(chunk == i), np.flatnonzero(chunk == j)
            if not len(p) or not len(q):
                continue
            part = linked([sets[x] for x in p], [sets[x] for x in q], threshold)
            count = np.zeros(len(g), np.int64)
            count[p], count[q] = part @ copies[q], copies[p] @ part
            link = np.zeros((len(g), len(g)), dtype=bool)
            link[np.ix_(p, q)] = part
            link[np.ix_(q, p)] = part.T
            label = _labels(link, name)
        yield pd.DataFrame({"c": name, "label": label, "links": count})


def jaccard_join(docs: DataFrame, n: int = 5, threshold: float = 0.8, recall: float = 0.9999, block: int = BLOCK, id_col: str = "doc_id", text_col: str = "text", row_col: str | None = None) -> DataFrame:
    """doc_id, class_id, n_links, n_grams, copies: for every document the least id of the
    documents that links join it with, and the number of documents it is linked to.

    With ``row_col`` (a long, different in every row) also that column and class_row: the
    row with the least id, nulls last, then the least ``row_col``, among those joined."""
    bands, rows = banding(threshold, recall)
    kind = docs.schema[id_col].dataType
    src = docs.select(F.col(id_col).cast("string").alias("doc_id"), F.col(text_col).alias("text"), *([F.col(row_col).alias("t")] if row_col else []))
    if not row_col:
        src = src.withColumn("t", F.xxhash64(F.coalesce("doc_id", F.lit("-")), "text"))
    sketches = saved(sketch(src, n, bands, rows))
    # A class is named by a number of its key; its least document stands for it.
    number = F.xxhash64("k1", "k2").alias("c")
    classes = saved(sketches.filter("k1 is not null").groupBy("k1", "k2").agg(F.count("*").alias("copies"), F.min(F.col("doc_id").cast(kind)).alias("first"), F.min(F.struct("t", "doc_id")).alias("r"), F.min(F.struct(F.col("doc_id").isNull().alias("none"), F.col("doc_id").cast(kind).alias("id"), "t")).alias("head"), F.first("bands").alias("bands")).withColumn("c", number))
    heads = classes.select("c", "copies", F.col("r.t").alias("t"), F.coalesce("r.doc_id", F.lit("-")).alias("key"))
    buckets = classes.select("c", F.posexplode("bands").alias("b", "h")).select("c", F.xxhash64("b", "h").alias("h"))
    centre = buckets.groupBy("h").agg(F.min("c").alias("m"), F.count("*").alias("_n")).filter("_n > 1").drop("_n")
    family = components(salted(buckets, centre, ["h"], ["c"]).select(F.col("c").alias("u"), F.col("m").alias("v")))
    family = saved(family)
    chunks = family.groupBy("label").agg(F.ceil(F.count("*") / block).cast("int").alias("chunks"))
    placed = salted(family, chunks, ["label"], ["node"]).select(F.col("node").alias("c"), F.col("label").alias("family"), "chunks", F.pmod(F.xxhash64("node"), F.col("chunks")).cast("int").alias("chunk"))
    asked = heads.join(placed, "c")
    members = src.withColumn("key", F.coalesce("doc_id", F.lit("-"))).join(asked, ["t", "key"]).select("c", "copies", "family", "chunks", "chunk", "text")

    def sets(batches):
        for pdf in batches:
            text = pdf["text"].tolist()
            for a, b in _blocks(text, 4 << 20):
                yield pdf.iloc[a:b].drop(columns="text").assign(set=[s.tobytes() for s in gram_sets(text[a:b], n)])

    full = members.mapInPandas(sets, "c long, copies long, family long, chunks int, chunk int, set binary")
    pair = F.explode(F.sequence(F.lit(0), F.col("chunks") - 1))
    tasks = full.withColumn("other", pair).select("c", "copies", "family", "chunk", "set", F.least("chunk", "other").alias("i"), F.greatest("chunk", "other").alias("j"))
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    found = saved(tasks.repartition(parts, "family", "i", "j").sortWithinPartitions("family", "i", "j").mapInPandas(lambda b: _verify(b, threshold), "c long, label long, links long"))
    links = found.groupBy("c").agg(F.sum("links").alias("links"))
    group = components(found.select(F.col("c").alias("u"), F.col("label").alias("v")))
    named = classes.select("c", "k1", "k2", "copies", "first", "head").join(links, "c", "left").join(group.withColumnRenamed("node", "c"), "c", "left").withColumn("label", F.coalesce("label", "c"))
    named = saved(named)
    least = named.groupBy("label").agg(F.min("first").alias("class_id"), F.min("head").alias("least"))
    classed = salted(named, least, ["label"], ["c"]).select("k1", "k2", "class_id", F.col("least.t").alias("class_row"), "copies", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"))
    out = salted(sketches.drop("bands"), classed, ["k1", "k2"], ["t", "doc_id"], how="left")
    own = F.col("doc_id").cast(kind)
    rows = [F.col("t").alias(row_col), F.coalesce("class_row", "t").alias("class_row")] if row_col else []
    return out.select(own.alias("doc_id"), F.when(F.col("k1").isNull(), own).otherwise(F.col("class_id")).alias("class_id"), F.coalesce("n_links", F.lit(0).cast("long")).alias("n_links"), F.col("grams").cast("long").alias("n_grams"), F.coalesce("copies", F.lit(1).cast("long")).alias("copies"), *rows)
