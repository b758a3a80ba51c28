"""Toxicity by a support vector machine over a subsequence string kernel.

The kernel of two words sums over all common subsequences of ``LENGTH`` letters,
each weighted by ``DECAY`` to the letters it spans in both, so words with inserted
or left-out letters stay close.  Nystroem: a word is described by its normalised
kernel with a set of landmark words, and the machine is linear in them.

A sentence is as toxic as its worst word; a document as its worst sentence.  Labels
belong to documents, so training alternates: the machine picks the worst sentences
of each labelled document, those of toxic documents are positive examples, those
of clean ones negative, and it is fitted again.  It is fitted on at most
``train_rows`` labelled documents of each label (those with the least id hashes);
scoring reads every word of every document.

Words are runs of letters in lower case; signs inside a word are dropped, letters
set apart by blanks are joined ("i d i o t"), and words above ``LONGEST`` letters go
as overlapping windows of that length.

Cases: null and empty texts have the score of a text without words; null labels do
not train; without labels of both kinds every score is 0; null ids are scored; very
long texts are read whole; an empty table gives an empty result.  Extra columns are
ignored.
"""

from __future__ import annotations

import itertools
import re
import unicodedata
from collections import Counter

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hourglass.llm.common import saved

LENGTH, DECAY, LONGEST = 3, 0.6, 16
BLOCK = 4 << 20
CACHE = 400_000

_SPACED = re.compile(r"(?<!\S)(?:[^\W\d_] ){2,}[^\W\d_](?!\S)")
_SENTENCE = re.compile(r"(?<=[.!?])\s+|\n")


class _Letters(dict):
    """Maps a code point to itself if it is a letter or mark, to a blank if it is one, else to nothing."""

    def __missing__(self, c):
        x = chr(c)
        self[c] = y = c if x.isalpha() or unicodedata.category(x) == "Mn" else " " if x.isspace() or x in "|/" else None
        return y


_KEEP = _Letters()
for _c in range(128):
    _KEEP[_c]


def units(text: str) -> set[str]:
    """The words of a text."""
    low = text.lower().translate(_KEEP)
    out = set(low.split())
    out.update(m.group().replace(" ", "") for m in _SPACED.finditer(low))
    for w in [w for w in out if len(w) > LONGEST]:
        out.remove(w)
        out.update(w[i : i + LONGEST] for i in range(0, len(w) - LONGEST // 2, LONGEST // 2))
    return out


def sentences(text: str) -> list[set[str]]:
    """The words of each sentence (or line) that has any."""
    return [u for part in _SENTENCE.split(text) if (u := units(part))]


def _triples(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Places of all subsequences of three letters of a word of n, and their weights."""
    at = np.array(list(itertools.combinations(range(n), LENGTH)), np.int64).reshape(-1, LENGTH)
    return at, DECAY ** (at[:, -1] - at[:, 0] + 1.0)


_TRIPLES = {n: _triples(n) for n in range(LONGEST + 1)}


def _raw(words: list[str], n: int) -> np.ndarray:
    return np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), np.uint32).reshape(len(words), n)


def _norms(words: list[str], n: int) -> np.ndarray:
    """Root of the kernel of each word of n letters with itself."""
    if n < LENGTH:
        return np.ones(len(words))
    at, weight = _TRIPLES[n]
    out = np.full(len(words), np.sqrt((weight**2).sum()))
    raw = _raw(words, n).astype(np.int64)
    letters = np.sort(raw, axis=1)
    twice = np.flatnonzero((letters[:, 1:] == letters[:, :-1]).any(1))
    if len(twice):
        x = raw[twice]
        code = (x[:, at[:, 0]] << 42) | (x[:, at[:, 1]] << 21) | x[:, at[:, 2]]
        order = np.argsort(code, axis=1)
        code = np.take_along_axis(code, order, 1)
        new = np.ones(code.shape, dtype=bool)
        new[:, 1:] = code[:, 1:] != code[:, :-1]
        first = np.flatnonzero(new)
        square = np.add.reduceat(weight[order].ravel(), first) ** 2
        out[twice] = np.sqrt(np.add.reduceat(square, np.searchsorted(first, np.arange(len(x)) * code.shape[1])))
    return out


class Machine:
    """The landmarks' subsequences as a table: a word's kernel with all landmarks is the
    sum of the table's rows of its own subsequences, over its norm."""

    def __init__(self, landmarks: list[str]):
        self.landmarks = landmarks
        self.letters = np.zeros(1 << 16, np.int64)
        used = sorted({c for w in landmarks for c in w if ord(c) < 1 << 16})
        self.letters[[ord(c) for c in used]] = np.arange(1, len(used) + 1)
        self.size = len(used) + 1
        self.which = np.full(self.size**LENGTH, -1, np.int32)
        self.table = np.zeros((0, len(landmarks)))
        found: dict[int, np.ndarray] = {}
        for j, w in enumerate(landmarks):
            codes, weight = self._codes([w], len(w))
            for c, x in zip(codes[0].tolist(), (weight / _norms([w], len(w))[0]).tolist(), strict=True):
                found.setdefault(c, np.zeros(len(landmarks)))[j] += x
        if found:
            self.which[list(found)] = np.arange(len(found))
            self.table = np.array(list(found.values()))
        self.weight = np.zeros(len(landmarks))
        self.bias, self.slope, self.shift = 0.0, 1.0, 0.0
        k = self.kernel(landmarks)
        value, vector = np.linalg.eigh((k + k.T) / 2)
        self.root = vector / np.sqrt(np.maximum(value, 1e-6)) @ vector.T

    def _codes(self, words: list[str], n: int) -> tuple[np.ndarray, np.ndarray]:
        """Codes of the subsequences of words of n letters; code 0 holds a letter that no landmark has."""
        raw = _raw(words, n)
        x = self.letters[np.where(raw < 1 << 16, raw, 0)]
        at, weight = _TRIPLES[n]
        code, known = np.zeros((len(words), len(at)), np.int64), np.ones((len(words), len(at)), dtype=bool)
        for i in range(LENGTH):
            code = code * self.size + x[:, at[:, i]]
            known &= x[:, at[:, i]] > 0
        return np.where(known, code, 0), weight

    def kernel(self, words: list[str]) -> np.ndarray:
        out = np.zeros((len(words), len(self.landmarks)))
        by_size: dict[int, list[int]] = {}
        for i, w in enumerate(words):
            if len(w) >= LENGTH:
                by_size.setdefault(len(w), []).append(i)
        for n, rows in by_size.items():
            for at in range(0, len(rows), 8192):
                part = np.array(rows[at : at + 8192])
                codes, weight = self._codes([words[i] for i in part], n)
                hit = self.which[codes]
                r, c = np.nonzero(hit >= 0)
                if len(r):
                    first = np.flatnonzero(np.diff(r, prepend=-1))
                    out[part[r[first]]] = np.add.reduceat(self.table[hit[r, c]] * weight[c][:, None], first, axis=0)
                    out[part] /= _norms([words[i] for i in part], n)[:, None]
        return out

    def values(self, words: list[str]) -> np.ndarray:
        """``kernel(words) @ root @ weight`` from one number a subsequence."""
        w = self.table @ (self.root @ self.weight)
        out = np.zeros(len(words))
        by_size: dict[int, list[int]] = {}
        for i, x in enumerate(words):
            if len(x) >= LENGTH:
                by_size.setdefault(len(x), []).append(i)
        w = np.append(w, 0.0)
        for n, rows in by_size.items():
            for at in range(0, len(rows), 8192):
                part = rows[at : at + 8192]
                x = [words[i] for i in part]
                codes, weight = self._codes(x, n)
                out[part] = w[self.which[codes]] @ weight / _norms(x, n)
        return out

    def margin(self, words: list[str]) -> np.ndarray:
        return self.values(words) + self.bias

    def fit(self, positive: list[str], negative: list[str], cost: float = 30.0, rounds: int = 30) -> None:
        """The primal squared-hinge machine by Newton steps; both classes weigh the same."""
        z = self.kernel(positive + negative) @ self.root
        x = np.hstack([z, np.ones((len(z), 1))])
        y = np.concatenate([np.ones(len(positive)), -np.ones(len(negative))])
        c = np.where(y > 0, cost / max(1, len(positive)), cost / max(1, len(negative)))
        w = np.zeros(x.shape[1])
        ridge = np.eye(len(w)) / 100
        ridge[-1, -1] = 1e-6
        for _ in range(rounds):
            on = y * (x @ w) < 1
            a = x[on] * c[on, None]
            new = np.linalg.solve(ridge + a.T @ x[on], a.T @ y[on])
            if np.abs(new - w).max() < 1e-6:
                break
            w = new
        self.weight, self.bias = w[:-1], float(w[-1])

    def calibrate(self, margin: np.ndarray, label: np.ndarray) -> None:
        """A logistic curve over the documents' margins, by Newton steps."""
        x = np.stack([margin, np.ones(len(margin))], 1)
        pos, neg = label.sum(), (1 - label).sum()
        t = np.where(label > 0, (pos + 1) / (pos + 2), 1 / (neg + 2))
        w = np.zeros(2)
        for _ in range(50):
            p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
            s = np.maximum(p * (1 - p), 1e-6)
            step = np.linalg.solve((x * s[:, None]).T @ x + 1e-3 * np.eye(2), x.T @ (t - p) - 1e-3 * w)
            w = w + np.clip(step, -5, 5)
            if np.abs(step).max() < 1e-7:
                break
        self.slope, self.shift = float(w[0]), float(w[1])

    def probability(self, margin: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.slope * margin + self.shift, -30, 30)))


def _known(machine: Machine, cache: dict, words: set) -> None:
    new = [u for u in words if u not in cache]
    if len(cache) + len(new) > CACHE:
        cache.clear()
        new = list(words)
    cache.update(zip(new, machine.margin(new).tolist(), strict=True))


def _word_counts(docs: DataFrame) -> DataFrame:
    """unit, toxic, clean: documents of each label that hold it."""

    def run(batches):
        for pdf in batches:
            rows: dict[str, list[int]] = {}
            for text, label in zip(pdf["text"], pdf["label"], strict=True):
                for u in units(text):
                    rows.setdefault(u, [0, 0])[int(label)] += 1
            yield pd.DataFrame([(u, b, a) for u, (a, b) in rows.items()], columns=["unit", "toxic", "clean"])

    return docs.mapInPandas(run, "unit string, toxic long, clean long").groupBy("unit").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))


def _worst(docs: DataFrame, machine: Machine, each: int) -> pd.DataFrame:
    """label, unit, margin, rank of the worst words of the ``each`` worst sentences of each document."""
    shared = docs.sparkSession.sparkContext.broadcast(machine)

    def run(batches):
        cache: dict[str, float] = {}
        for pdf in batches:
            rows = []
            held = [sentences(t) for t in pdf["text"]]
            _known(shared.value, cache, {u for parts in held for s in parts for u in s})
            for parts, label in zip(held, pdf["label"], strict=True):
                top = sorted(((cache[u], u) for u in {max(s, key=cache.__getitem__) for s in parts}), reverse=True)[:each]
                rows += [(int(label), u, m, k) for k, (m, u) in enumerate(top)]
            yield pd.DataFrame(rows, columns=["label", "unit", "margin", "rank"])

    return docs.mapInPandas(run, "label int, unit string, margin double, rank int").toPandas()


def fit(docs: DataFrame, text_col: str = "text", label_col: str = "label", id_col: str = "doc_id", train_rows: int = 4000, landmarks: int = 64, rounds: int = 3) -> Machine | None:
    """A machine fitted on labelled documents; None without documents of both labels."""
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), F.col(label_col).cast("int").alias("label")).filter("label in (0, 1) and text is not null")
    sample = saved(rows.repartition(32, F.xxhash64("id")))
    have = {r[0]: r[1] for r in sample.groupBy("label").count().collect()}
    if len(have) < 2:
        return None
    words = saved(_word_counts(sample))
    odds = F.log((F.col("toxic") + 0.5) / (have[1] - F.col("toxic") + 0.5)) - F.log((F.col("clean") + 0.5) / (have[0] - F.col("clean") + 0.5))
    surprise = odds * F.sqrt(F.col("toxic").cast("double"))
    hot = words.filter((F.length("unit") >= LENGTH) & (odds > 0)).orderBy(surprise.desc(), "unit").limit(12 * landmarks).collect()
    often = [r["unit"] for r in words.filter(F.length("unit") >= LENGTH).filter(F.col("clean") * have[1] >= F.col("toxic") * have[0]).orderBy(F.col("clean").desc(), "unit").limit(2000).collect()]
    held, clean = _holds(sample, [r["unit"] for r in hot]), {r["unit"]: r["clean"] for r in hot}
    strong = _cover(held, clean, have, 4 * landmarks)
    strong += [u for u in _proven(held, clean, have, words.count()) if u not in strong]
    base = _diverse(strong, often, landmarks)
    machine = Machine(base)
    machine.fit(strong, often)
    for _ in range(rounds):
        worst = _worst(sample, machine, each=3)
        first = worst[worst["rank"] == 0]
        positive = first[(first["label"] == 1) & (first["margin"] > 0)]["unit"].tolist() + strong
        negative = worst[worst["label"] == 0].sort_values(["margin", "unit"], ascending=False)["unit"].drop_duplicates().tolist()
        # the clean words that come nearest to insults are landmarks too
        machine = Machine(base + [u for u in negative if u not in base][: landmarks // 4])
        machine.fit(positive, negative + often)
    last = _worst(sample, machine, each=1)
    machine.calibrate(last["margin"].to_numpy(), last["label"].to_numpy())
    return machine


def _holds(docs: DataFrame, hot: list[str]) -> list[set[str]]:
    """For each toxic document the suspicious words that it holds."""
    known = set(hot)

    def run(batches):
        for pdf in batches:
            yield pd.DataFrame({"held": [sorted(units(t) & known) for t in pdf["text"]]})

    return [set(r["held"]) for r in docs.filter("label = 1").select("text").mapInPandas(run, "held array<string>").collect()]


def _cover(held: list[set[str]], clean: dict[str, int], have: dict[int, int], many: int) -> list[str]:
    """Suspicious words one after another, each by the toxic documents that hold none of
    those before it: words that only lie next to an insult, as in copies, add none."""
    where: dict[str, set[int]] = {}
    for i, words in enumerate(held):
        for u in words:
            where.setdefault(u, set()).add(i)
    picked: list[str] = []
    odds = lambda u: np.log((len(where[u]) + 0.5) / (have[1] + 0.5)) - np.log((clean[u] + 0.5) / (have[0] + 0.5))
    while where and len(picked) < many:
        best = max(where, key=lambda u: (np.sqrt(len(where[u])) * odds(u), u))
        gone = where.pop(best)
        if picked and len(gone) < 2:
            break
        picked.append(best)
        where = {u: rest for u, w in where.items() if (rest := w - gone)}
    return picked


def _proven(held: list[set[str]], clean: dict[str, int], have: dict[int, int], words: int) -> list[str]:
    """Suspicious words that stand for themselves although other insults cover their documents.
    They are sharp (at least 20 times as often in toxic documents as in clean ones), lie in toxic
    documents beyond chance by a likelihood test over all words, and no other sharp word lies in over 0.8 of
    the same documents.  Documents with the same sharp words, as copies have, count once."""
    seen = Counter(u for h in held for u in h)
    sharp = {u for u, n in seen.items() if 20 * clean[u] * have[1] <= n * have[0]}
    where: dict[str, list[frozenset[str]]] = {}
    for own in {frozenset(h & sharp) for h in held}:
        for u in own:
            where.setdefault(u, []).append(own)
    base, out = have[1] / (have[0] + have[1]), []
    for u, own in sorted(where.items(), key=lambda x: (-len(x[1]), x[0])):
        a, b = len(own), clean[u]
        share = a / (a + b)
        if share <= base:
            continue
        gain = a * np.log(share / base) + (b * np.log((1 - share) / (1 - base)) if b else 0)
        beside = Counter(w for s in own for w in s if w != u)
        if gain > np.log(words / 0.05) and max(beside.values(), default=0) <= 0.8 * a:
            out.append(u)
    return out


def _diverse(hot: list[str], often: list[str], many: int) -> list[str]:
    """Landmarks: suspicious words that are not near copies of one another, and common ones."""
    picked: list[str] = []
    machine = None
    for u in hot:
        if len(picked) >= many - many // 4:
            break
        if machine is None or machine.kernel([u]).max() < 0.75:
            picked.append(u)
            machine = Machine(picked)
    return picked + [u for u in often if u not in picked][: many // 4]


def score(docs: DataFrame, machine: Machine | None, threshold: float = 0.3, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, score, predicted, worst_word of every document."""
    kind = docs.schema[id_col].dataType
    src = docs.select(F.col(id_col).cast("string").alias("doc_id"), F.col(text_col).alias("_text"))
    ddl = "doc_id string, score double, predicted int, worst_word string"
    if machine is None:
        return src.select(F.col("doc_id").cast(kind).alias("doc_id"), F.lit(0.0).alias("score"), F.lit(0).alias("predicted"), F.lit(None).cast("string").alias("worst_word"))
    shared = docs.sparkSession.sparkContext.broadcast(machine)

    def run(batches):
        m: Machine = shared.value
        cache: dict[str, float] = {}
        none = m.bias
        for pdf in batches:
            texts = pdf["_text"].tolist()
            for a, b in _blocks(texts):
                held = [units(t) if isinstance(t, str) else set() for t in texts[a:b]]
                _known(m, cache, set().union(*held))
                top = [max(d, key=cache.__getitem__) if d else None for d in held]
                margin = np.array([none if u is None else max(none, cache[u]) for u in top])
                p = m.probability(margin)
                yield pd.DataFrame({"doc_id": pdf["doc_id"].iloc[a:b], "score": p, "predicted": (p >= threshold).astype(int), "worst_word": top})

    return src.mapInPandas(run, ddl).withColumn("doc_id", F.col("doc_id").cast(kind))


def _blocks(texts):
    at = held = 0
    for i, t in enumerate(texts):
        held += len(t) if isinstance(t, str) else 0
        if held >= BLOCK:
            yield at, i + 1
            at, held = i + 1, 0
    if at < len(texts):
        yield at, len(texts)
