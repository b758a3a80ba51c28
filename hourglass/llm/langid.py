"""Language identification by interpolated Kneser-Ney character models.

Training counts the character n-grams of every labelled text in one Spark job
(counted per batch before the shuffle).  A model holds, for each order, every
n-gram by its full 64-bit code and its counts by language, and grows with the
corpus.  While an order has at most ``slots`` counts (n-grams times languages), they
are sorted arrays that tasks share.  Beyond that they stay tables: the texts to score
are cut into blocks, each block's different n-grams are joined to the tables order by
order, and the bits of each n-gram go back to its blocks.  Both ways give the same
probabilities.  A text gets the language of the lowest cross-entropy per character.

Rejection is calibrated on all training texts, each scored by a model of the other
half of them (halves by text hash, so copies stay together): a text is rejected when its
cross-entropy under the best language lies above that language's median by more than
``MARGIN`` times the excess that 99% (``QUANTILES``) of the training texts stay below, and three
deviations of texts of its length (``reject`` of 12; other values scale both), or when
it has no letter.

Cases: null texts and texts without a letter (category L: neither marks nor emoji are letters)
get ``und``, score 0 and are rejected; a text that two languages fit alike gets the first by name; repeated
rows are judged alike; null labels do not train; without any training text every text gets
``und``; very long texts are read whole, in pieces; an empty table gives an empty
result.  Extra columns are ignored.
"""

from __future__ import annotations

import unicodedata

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hourglass.llm.common import saved

ORDER = 4
SLOTS = 1 << 20
PIECE = 1 << 20
BLOCK = 1 << 22
#: The highest of these that leaves a language at least one out-of-fold text above it counts.
QUANTILES = (0.95, 0.97, 0.98, 0.99)
MARGIN = 2.5
#: With fewer out-of-fold texts a language takes the widest margin of all languages.
FEW = 32
SPACE = 32
LETTER = regex.compile(r"\p{L}")


def _classes() -> np.ndarray:
    """The lower-case form of each code point of the basic plane; a space for
    everything that is no letter or mark."""
    t = np.full(1 << 16, SPACE, np.uint16)
    for c in range(1 << 16):
        if unicodedata.category(chr(c))[0] in "LM":
            low = chr(c).lower()
            t[c] = ord(low) if len(low) == 1 and ord(low) < 1 << 16 else c
    return t


_TABLE: list[np.ndarray] = []


def letters(texts) -> tuple[np.ndarray, np.ndarray]:
    """Code units of the composed (NFKC) texts in one array, each text after a space, with runs of
    other characters as one space; and each text's start (one more for the end).
    Characters beyond the basic plane stand for themselves by their surrogates."""
    if not _TABLE:
        _TABLE.append(_classes())
        _TABLE[0][0xD800:0xE000] = np.arange(0xD800, 0xE000)
    raw = [(" " + unicodedata.normalize("NFKC", t)).encode("utf-16-le", "surrogatepass") if isinstance(t, str) else b" \0" for t in texts]
    starts = np.cumsum([0] + [len(r) // 2 for r in raw])
    x = _TABLE[0][np.frombuffer(b"".join(raw), np.uint16)]
    first = np.zeros(len(x), dtype=bool)
    first[starts[:-1]] = True
    keep = first | (x != SPACE)
    keep[1:] |= x[:-1] != SPACE
    return x[keep], np.concatenate([[0], np.cumsum(keep)])[starts]


def has_letter(text) -> bool:
    """Whether a text holds a letter (category L); marks and signs are read by the models but make no language."""
    return isinstance(text, str) and LETTER.search(text) is not None


def grams(x: np.ndarray, starts: np.ndarray, order: int = ORDER) -> np.ndarray:
    """For each place the ``order`` code units that end there, in one number (the
    latest lowest); units before the text's start are 0."""
    place = np.arange(len(x)) - np.repeat(starts[:-1], np.diff(starts))
    code = x.astype(np.uint64)
    for k in range(1, order):
        code[k:] |= np.where(place[k:] >= k, x[:-k], 0).astype(np.uint64) << np.uint64(16 * k)
    return code


def _blocks(texts, size: int = PIECE):
    """Row ranges of about ``size`` characters."""
    at, held = 0, 0
    for i, t in enumerate(texts):
        held += len(t) if isinstance(t, str) else 1
        if held >= size:
            yield at, i + 1
            at, held = i + 1, 0
    if at < len(texts):
        yield at, len(texts)


def count_grams(docs: DataFrame, order: int = ORDER) -> DataFrame:
    """lang, fold, code, n over all texts, for n-grams of the highest order."""

    def run(batches):
        for pdf in batches:
            for (lang, fold), part in pdf.groupby(["lang", "fold"]):
                text = part["text"].tolist()
                for a, b in _blocks(text):
                    x, s = letters(text[a:b])
                    code, n = np.unique(grams(x, s, order), return_counts=True)
                    yield pd.DataFrame({"lang": lang, "fold": fold, "code": code.view(np.int64), "n": n})

    return docs.mapInPandas(run, "lang string, fold int, code long, n long").groupBy("lang", "fold", "code").agg(F.sum("n").alias("n"))


def orders(top: DataFrame, order: int) -> list[DataFrame]:
    """lang, code, n for each order from 1: raw counts at the highest, and below it the
    number of different characters seen before (the continuation count)."""
    levels = [top]
    for k in range(order - 1, 0, -1):
        low = F.col("code").bitwiseAND(F.lit((1 << (16 * k)) - 1))
        levels.insert(0, levels[0].withColumn("code", low).groupBy("lang", "code").agg(F.count("*").alias("n")))
    return levels


class Model:
    """Counts of each order, for all languages: sorted arrays, or else ``tables``."""

    def __init__(self, langs: list[str], order: int):
        self.langs, self.order = langs, order
        self.keys: list[np.ndarray] = []
        self.counts: list[np.ndarray] = []
        self.ctx_keys: list[np.ndarray] = []
        self.ctx_total: list[np.ndarray] = []
        self.ctx_kinds: list[np.ndarray] = []
        #: per order: (code, n) and (ctx, total, kinds), each number an array by language
        self.tables: list[tuple[DataFrame, DataFrame]] = []
        self.discount: list[np.ndarray] = []
        #: models of the training texts without each fold, until calibrated
        self.without: list[Model] = []
        self.mean = np.zeros(len(langs))
        self.spread = np.ones(len(langs))
        self.floor = np.zeros(len(langs))

    def __getstate__(self):
        return self.__dict__ | {"tables": [], "without": []}  # these stay on the driver

    def log_probability(self, code: np.ndarray) -> np.ndarray:
        """Bits of the last character of each n-gram given those before it, by language."""
        p = np.full((len(code), len(self.langs)), 1.0 / 1024)
        for k in range(1, self.order + 1):
            part = code if k == 4 and self.order == 4 else code & np.uint64((1 << (16 * k)) - 1)
            n = _lookup(self.keys[k - 1], self.counts[k - 1], part)
            ctx = part >> np.uint64(16)
            total = _lookup(self.ctx_keys[k - 1], self.ctx_total[k - 1], ctx)
            kinds = _lookup(self.ctx_keys[k - 1], self.ctx_kinds[k - 1], ctx)
            d, seen = self.discount[k - 1], total > 0
            whole = np.where(seen, total, 1.0)
            q = (np.maximum(n - d, 0) + d * kinds * p) / whole
            p = np.where(seen, q, p)
        return -np.log2(p)

    def table_bits(self, asked: DataFrame) -> DataFrame:
        """code, bits (by language) of the codes of ``asked``: ``log_probability`` by joins.
        No key has more than 2**16 rows, as many as a code unit has values."""
        asks = [asked.select("code").distinct()]
        for k in range(self.order - 1, 0, -1):
            asks.insert(0, asks[0].select(F.col("code").bitwiseAND(F.lit((1 << (16 * k)) - 1)).alias("code")).distinct())
        p = None
        for k in range(1, self.order + 1):
            grams_k, ctx_k = self.tables[k - 1]
            at = asks[k - 1].withColumn("ctx", F.shiftrightunsigned("code", 16)).join(grams_k, "code", "left").join(ctx_k, "ctx", "left")
            if p is None:
                at = at.withColumn("p", F.array(*[F.lit(1.0 / 1024)] * len(self.langs)))
            else:
                at = at.withColumn("low", F.col("code").bitwiseAND(F.lit((1 << (16 * (k - 1))) - 1))).join(p.withColumnRenamed("code", "low"), "low")
            d = "array(" + ",".join(f"{float(x)!r}D" for x in self.discount[k - 1]) + ")"
            q = f"(greatest(coalesce(n[i], 0D) - {d}[i], 0D) + {d}[i] * kinds[i] * x) / total[i]"
            p = saved(at.select("code", F.expr(f"transform(p, (x, i) -> if(coalesce(total[i], 0D) > 0, {q}, x))").alias("p")))
        return p.select("code", F.expr("transform(p, x -> -log2(x))").alias("bits"))

    def entropies(self, texts, bits_of=None) -> tuple[np.ndarray, np.ndarray]:
        """Bits a character of each text under each language, and its number of characters
        (spaces between words included); texts without a letter have none."""
        x, s = letters(texts)
        code, back = np.unique(grams(x, s, self.order), return_inverse=True)
        n = np.diff(s) - 1
        bits = (bits_of or self.log_probability)(code).astype(np.float32)[back]
        bits[s[:-1]] = 0  # the space before a text is given
        sums = np.add.reduceat(bits.astype(np.float64), s[:-1], axis=0) if len(n) else np.zeros((0, len(self.langs)))
        n = np.where([has_letter(t) for t in texts], np.maximum(n, 1), 0) if len(n) else n
        return sums / np.maximum(n, 1)[:, None], n


def _lookup(keys: np.ndarray, values: np.ndarray, at: np.ndarray) -> np.ndarray:
    if not len(keys):
        return np.zeros((len(at), values.shape[1]))
    i = np.minimum(np.searchsorted(keys, at), len(keys) - 1)
    out = values[i].astype(np.float64)
    out[keys[i] != at] = 0
    return out


def _grid(code: np.ndarray, lang: np.ndarray, value, langs: int):
    keys, at = np.unique(code, return_inverse=True)
    out = np.zeros((len(keys), langs))
    np.add.at(out, (at, lang), value)
    return keys, out


def _by_lang(value, langs: list[str]):
    return F.array(*[F.coalesce(F.sum(F.when(F.col("lang") == x, value)), F.lit(0)).cast("double") for x in langs])


def model_of(top: DataFrame, order: int, slots: int) -> Model:
    """The model of written counts (lang, code, n) of the highest order."""
    levels = orders(top, order)
    sums = levels[0].withColumn("k", F.lit(1))
    for k, d in enumerate(levels[1:], 2):
        sums = sums.unionByName(d.withColumn("k", F.lit(k)))
    stats = sums.groupBy("lang", "k").agg(F.count_if(F.col("n") == 1).alias("ones"), F.count_if(F.col("n") == 2).alias("twos")).toPandas()
    langs = sorted(stats["lang"].unique())
    m = Model(langs, order)
    for k in range(1, order + 1):
        ones, twos = (stats[stats["k"] == k].set_index("lang")[x].reindex(langs, fill_value=0).to_numpy(np.float64) for x in ("ones", "twos"))
        m.discount.append(np.clip(ones / np.maximum(ones + 2 * twos, 1), 0.1, 0.95))
    if top.select("code").distinct().count() * len(langs) > slots:
        for d in levels:
            ctx = d.groupBy(F.shiftrightunsigned("code", 16).alias("ctx")).agg(_by_lang(F.col("n"), langs).alias("total"), _by_lang(F.lit(1), langs).alias("kinds"))
            m.tables.append((saved(d.groupBy("code").agg(_by_lang(F.col("n"), langs).alias("n"))), saved(ctx)))
        return m
    # At most ``slots`` rows an order, as plain number columns (Arrow): the driver makes no object of a row.
    names = F.array(*[F.lit(x) for x in langs]) if langs else F.array(F.lit(""))
    got = sums.select("k", "code", "n", (F.array_position(names, F.col("lang")) - 1).cast("short").alias("lang")).toArrow()
    order_of = got.column("k").to_numpy()
    for k in range(1, order + 1):
        a = got.filter(pa.array(order_of == k))
        code, lang, n = a["code"].to_numpy().astype(np.int64).view(np.uint64), a["lang"].to_numpy(), a["n"].to_numpy()
        keys, grid = _grid(code, lang, n, len(langs))
        m.keys.append(keys)
        m.counts.append(grid)
        keys, grid = _grid(code >> np.uint64(16), lang, n, len(langs))
        m.ctx_keys.append(keys)
        m.ctx_total.append(grid)
        m.ctx_kinds.append(_grid(code >> np.uint64(16), lang, 1, len(langs))[1])
    return m


def fit(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", order: int = ORDER, slots: int = SLOTS) -> Model:
    """Models of all languages of ``lang_col``.  ``docs`` holds the training rows; an order
    of more than ``slots`` n-grams times languages is kept in tables."""
    if not 2 <= order <= 4:
        raise ValueError("order must be 2, 3 or 4")
    counts = saved(count_grams(_labelled(docs, text_col, lang_col), order))
    model = model_of(saved(counts.groupBy("lang", "code").agg(F.sum("n").alias("n"))), order, slots)  # read by every order
    model.without = [model_of(counts.filter(F.col("fold") != f).select("lang", "code", "n"), order, slots) for f in (0, 1)]
    return model


def _labelled(docs: DataFrame, text_col: str, lang_col: str) -> DataFrame:
    """text, lang, fold of the training rows; equal texts are of one fold."""
    rows = docs.select(F.col(text_col).alias("text"), F.col(lang_col).alias("lang")).filter("text is not null and lang is not null")
    return rows.withColumn("fold", F.pmod(F.xxhash64("text"), F.lit(2)).cast("int"))


def scored(docs: DataFrame, model: Model, run, schema: T.StructType, text_col: str = "text") -> DataFrame:
    """``run(model, rows, h, n)`` over Arrow tables of ``docs`` and the entropies and lengths of their texts."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def held(batches):
        for batch in batches:
            text = batch.column(text_col).to_pylist()
            for a, b in _blocks(text):
                yield from run(shared.value, pa.Table.from_batches([batch.slice(a, b - a)]), *shared.value.entropies(text[a:b])).to_batches()

    if not model.tables:
        return docs.mapInArrow(held, schema)

    name = "_block"
    while name in docs.columns:
        name += "_"

    def cut(batches):
        """Each row's block: about BLOCK characters of one task."""
        block, size = TaskContext.get().partitionId() << 33, 0
        for batch in batches:
            out = []
            for t in batch.column(text_col).to_pylist():
                out.append(block)
                size += len(t or "") + 1
                if size >= BLOCK:
                    block, size = block + 1, 0
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(out, pa.int64())], [*batch.schema.names, name])

    def ask(batches):
        for pdf in batches:
            for block, part in pdf.groupby(name):
                x, s = letters(part["text"].tolist())
                yield pd.DataFrame({name: block, "code": np.unique(grams(x, s, shared.value.order)).view(np.int64)})

    def judge(rows, bits):
        code = bits.column("code").to_numpy().view(np.uint64)
        value = pc.list_flatten(bits.column("bits")).to_numpy().reshape(len(code), -1)
        sort = np.argsort(code)
        code, value = code[sort], value[sort]
        h, n = shared.value.entropies(rows.column(text_col).to_pylist(), lambda c: value[np.searchsorted(code, c)])
        return run(shared.value, rows.drop_columns(name), h, n)

    rows = saved(docs.mapInArrow(cut, T.StructType([*docs.schema.fields, T.StructField(name, T.LongType())])))
    asked = saved(rows.select(F.col(text_col).alias("text"), name).mapInPandas(ask, f"{name} long, code long").distinct())
    bits = asked.join(model.table_bits(asked), "code")  # a code has at most one row a block
    return rows.groupBy(name).cogroup(bits.groupBy(name)).applyInArrow(judge, schema)


def calibrate(model: Model, docs: DataFrame, text_col: str = "text", lang_col: str = "lang") -> Model:
    """Median of the cross-entropy of texts judged as a language, and how far such texts
    exceed it: from all training texts, each under the model without its fold.

    The limit for a text of n characters is ``reject * (spread / sqrt(n) + floor)``."""
    rows = _labelled(docs, text_col, lang_col)

    def run(held, part, h, n):
        best = h.argmin(1)
        return pa.table({"lang": pa.array([held.langs[i] for i in best], pa.string()), "h": h[np.arange(len(h)), best], "n": n})

    halves = [scored(rows.filter(F.col("fold") == f), m, run, _schema("lang string, h double, n long")) for f, m in enumerate(model.without) if m.langs]
    model.floor = np.full(len(model.langs), np.inf)
    if not halves:
        return model  # one text, or copies of one: nothing to judge others by
    got = halves[0] if len(halves) == 1 else halves[0].unionByName(halves[1])
    got = saved(got.filter("n > 0"))
    mids = got.groupBy("lang").agg(F.expr("percentile_approx(h, 0.5, 100000)").alias("mid"))
    over = got.join(F.broadcast(mids), "lang").withColumn("x", F.col("h") - F.col("mid"))  # a row a language
    wide = F.expr(f"percentile_approx(x, array{QUANTILES}, 100000)").alias("wide")
    stats = over.groupBy("lang", "mid").agg(F.count("*").alias("texts"), wide, F.expr("percentile_approx(abs(x) * sqrt(n), 0.95, 100000)").alias("s")).collect()
    wide = {r["lang"]: [x for x, q in zip(r["wide"], QUANTILES, strict=True) if (1 - q) * r["texts"] >= 1 or q == QUANTILES[0]][-1] for r in stats}
    for r in stats:
        i = model.langs.index(r["lang"])
        model.mean[i], model.spread[i] = r["mid"], 3 * max(1.0, r["s"] / 2) / 12
        model.floor[i] = MARGIN * (wide[r["lang"]] if r["texts"] >= FEW else max(wide.values())) / 12
    return model


def _schema(ddl: str) -> T.StructType:
    return T.StructType.fromDDL(ddl)


def _judged(model: Model, h: np.ndarray, n: np.ndarray, reject: float):
    """Language, score, cross-entropy and rejection of texts by their entropies and lengths."""
    if not model.langs:
        zero = np.zeros(len(n))
        return np.full(len(n), "und", dtype=object), zero, zero, np.ones(len(n), dtype=bool)
    names = np.array([*model.langs, "und"], dtype=object)
    best = h.argmin(1)
    low = h[np.arange(len(h)), best]
    odds = np.exp2(-(h - low[:, None]) * np.minimum(n, 100)[:, None])
    score = np.where(n > 0, 1 / odds.sum(1), 0.0)
    over = low - model.mean[best] > reject * (model.spread[best] / np.sqrt(np.maximum(n, 1)) + model.floor[best])
    return names[np.where(n > 0, best, len(model.langs))], score, low, (n == 0) | over


def accepted(docs: DataFrame, model: Model, reject: float = 12.0, text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` whose text is not rejected, as they are."""

    def run(model, part, h, n):
        return part.filter(pa.array(~_judged(model, h, n, reject)[3]))

    return scored(docs, model, run, docs.schema, text_col)


def identify(docs: DataFrame, model: Model, reject: float = 12.0, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, lang_pred, score (0 to 1), cross_entropy, rejected."""
    src = docs.select(F.col(id_col).cast("string").alias("doc_id"), F.col(text_col).alias("_text"))

    def run(model, part, h, n):
        lang, score, low, over = _judged(model, h, n, reject)
        return pa.table({"doc_id": part.column("doc_id"), "lang_pred": pa.array(lang, pa.string()), "score": score, "cross_entropy": low, "rejected": over})

    out = scored(src, model, run, _schema("doc_id string, lang_pred string, score double, cross_entropy double, rejected boolean"), "_text")
    return out.withColumn("doc_id", F.col("doc_id").cast(docs.schema[id_col].dataType))
