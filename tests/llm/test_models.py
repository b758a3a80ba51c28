"""Language identification and toxicity: kernels and probabilities against plain
definitions, held-out accuracy, and odd inputs."""

import itertools
import math
from collections import Counter, defaultdict

import numpy as np

from hourglass.llm import langid, toxicity
from hourglass.llm.queries import QUERIES
from tests_llm_texts import english, german

SF = "/root/testdata/sf0.01"


def plain_kneser_ney(texts, order):
    """Interpolated Kneser-Ney by dictionaries: p(history, character)."""
    top = Counter()
    for t in texts:
        x, s = langid.letters([t])
        u = [0] * (order - 1) + x.tolist()
        top.update(tuple(u[i : i + order]) for i in range(len(x)))
    levels = {order: top}
    for k in range(order - 1, 0, -1):
        levels[k] = Counter(g[1:] for g in levels[k + 1])
    stats = {}
    for k, c in levels.items():
        total, kinds = defaultdict(int), defaultdict(int)
        for g, n in c.items():
            total[g[:-1]] += n
            kinds[g[:-1]] += 1
        ones, twos = sum(n == 1 for n in c.values()), sum(n == 2 for n in c.values())
        stats[k] = (c, total, kinds, min(max(ones / max(1, ones + 2 * twos), 0.1), 0.95))

    def p(gram):
        q = 1 / 1024
        for k in range(1, order + 1):
            c, total, kinds, d = stats[k]
            g = gram[order - k :]
            if total[g[:-1]]:
                q = (max(c[g] - d, 0) + d * kinds[g[:-1]] * q) / total[g[:-1]]
        return q

    return p


def test_probabilities_equal_the_plain_model(spark):
    texts = ["the cat sat on the mat", "a dog and the cat", "cats, dogs & mats!"]
    df = spark.createDataFrame([(t, "en") for t in texts], "text string, lang string")
    model = langid.fit(df, order=4, slots=1 << 20)
    p = plain_kneser_ney(texts, 4)
    for t in ("the mat", "a dig", "zebra"):
        x, s = langid.letters([t])
        u = [0, 0, 0, *x.tolist()]
        want = [-math.log2(p(tuple(u[i : i + 4]))) for i in range(1, len(x))]
        got = model.log_probability(langid.grams(x, s, 4))[1:, 0]
        assert np.allclose(got, want, rtol=1e-5)
        h, n = model.entropies([t])
        assert n[0] == len(x) - 1 and np.isclose(h[0, 0], sum(want) / n[0], rtol=1e-4)


def test_odd_texts_and_missing_labels(spark):
    rows = [(1, german(1), "de"), (2, english(1), "en"), (3, None, "en"), (4, "", None), (5, "1234 !!", "en"), (None, english(2) * 300, None)]
    rows += [(10 + i, english(10 + i), "en") for i in range(20)] + [(40 + i, german(40 + i), "de") for i in range(20)]
    df = spark.createDataFrame([(*r, 0.5) for r in rows], "doc_id long, text string, lang string, score double")
    model = langid.calibrate(langid.fit(df), df)
    got = {r.doc_id: r for r in langid.identify(df, model).collect()}
    assert [got[i].lang_pred for i in (1, 2, 3, 4, 5, None)] == ["de", "en", "und", "und", "und", "en"]
    assert [got[i].rejected for i in (3, 4, 5)] == [True] * 3 and got[3].score == 0
    kept = langid.accepted(df, model)
    assert kept.schema.simpleString() == df.schema.simpleString() and {r.doc_id for r in kept.collect()} == {r[0] for r in rows} - {3, 4, 5}
    none = df.withColumn("lang", df.lang.substr(9, 1)).filter("lang is null or lang = ''").replace("", None, ["lang"])
    assert {r.lang_pred for r in langid.identify(none, langid.fit(none)).collect()} == {"und"}
    assert langid.identify(df.limit(0), model).count() == 0


def test_model_of_many_ngrams_keeps_them_apart(spark):
    """A script of many characters: more n-grams than ``slots``, kept in tables."""
    rng = np.random.default_rng(5)
    signs = np.array([chr(0x4E00 + i) for i in range(1500)])
    east = ["".join(signs[np.minimum(rng.zipf(1.2, 400) - 1, 1499)]) for _ in range(60)]
    rows = [(i, t, "zh") for i, t in enumerate(east[:50])] + [(100 + i, english(i), "en") for i in range(20)] + [(200 + i, german(i), "de") for i in range(20)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    held = langid.fit(df)
    tables = langid.fit(df, slots=1 << 10)
    assert tables.tables and not held.tables
    p = plain_kneser_ney(east[:50], 4)
    x, s = langid.letters([east[55]])
    u = [0, 0, 0, *x.tolist()]
    want = [-math.log2(p(tuple(u[i : i + 4]))) for i in range(len(x))]
    assert np.allclose(held.log_probability(langid.grams(x, s))[:, held.langs.index("zh")], want)
    test = [(i, t) for i, t in enumerate([*east[50:], german(90), english(90), "", None, "12", german(91) * 9])]
    test.append((None, english(91)))
    asked = spark.createDataFrame(test, "doc_id long, text string").repartition(3)
    one, two = ({r.doc_id: r for r in langid.identify(asked, langid.calibrate(m, df)).collect()} for m in (held, tables))
    assert [two[i].lang_pred for i in (*range(10), 10, 11, 12, 13, 14, 15, None)] == ["zh"] * 10 + ["de", "en", "und", "und", "und", "de", "en"]
    assert one.keys() == two.keys()
    for i in one:
        assert one[i][1::3] == two[i][1::3] and np.allclose(one[i][2:4], two[i][2:4], rtol=1e-5)
    kept = langid.accepted(asked, tables)
    assert kept.columns == asked.columns and {r.doc_id for r in kept.collect()} == {i for i in two if not two[i].rejected}


def test_a_left_out_language_is_rejected(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").filter("lang is not null and length(text) >= 300")
    out = "crc32(cast(coalesce(doc_id, '') as string)) % 3 = 1"
    train, test = docs.filter(f"lang <> 'en' and not ({out})"), docs.filter(f"lang = 'en' or {out}")
    model = langid.calibrate(langid.fit(train), train)
    assert np.isfinite(model.floor).all() and (model.floor * 12 < 2.5).all()
    got = langid.identify(test.drop("lang"), model).join(test.select("doc_id", "lang"), "doc_id").toPandas()
    new = got["lang"] == "en"
    assert new.sum() > 200 and got[new]["rejected"].mean() > 0.95
    assert (~new).sum() > 100 and got[~new]["rejected"].mean() <= 0.01


def test_calibration_reads_every_text(spark):
    """A third of all rows is one text: both folds, and all other texts, still count."""
    rows = [(german(i), "de") for i in range(40)] + [(english(1), "en")] * 20
    df = spark.createDataFrame(rows, "text string, lang string")
    model = langid.calibrate(langid.fit(df), df)
    held = spark.createDataFrame([(i, german(90 + i)) for i in range(20)] + [(50, english(1))], "doc_id long, text string")
    assert not any(r.rejected for r in langid.identify(held, model).collect())


def test_calibration_scores_all_training_rows(spark, monkeypatch):
    df = spark.range(6000).selectExpr("concat('some words ', md5(cast(id % 4500 as string))) as text", "'en' as lang")
    model, seen, scored = langid.fit(df), [], langid.scored
    monkeypatch.setattr(langid, "scored", lambda docs, *a: seen.append(docs.count()) or scored(docs, *a))
    langid.calibrate(model, df)
    assert sum(seen) == 6000


def test_language_query_on_held_out_documents(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "lang")
    got = QUERIES["op5_langid"](spark, SF).join(docs, "doc_id").filter("held_out and lang is not null").toPandas()
    assert len(got) > 200 and (got["lang"] == got["lang_pred"]).mean() > 0.98 and got["rejected"].sum() == 0


def plain_kernel(a, b):
    total = 0.0
    for x in itertools.combinations(range(len(a)), 3):
        for y in itertools.combinations(range(len(b)), 3):
            if [a[i] for i in x] == [b[i] for i in y]:
                total += toxicity.DECAY ** (x[2] - x[0] + y[2] - y[0] + 2)
    return total


def test_kernel_equals_the_plain_sum():
    marks = ["idiot", "moron", "llama", "übel"]
    words = ["idiot", "idxiot", "idot", "ororon", "llamma", "x", "", "übeln", "зло", "aaaaaa"]
    machine = toxicity.Machine(marks)
    want = np.array([[plain_kernel(w, m) / math.sqrt(max(plain_kernel(w, w), 1e-300) * plain_kernel(m, m)) if len(w) > 2 else 0 for m in marks] for w in words])
    assert np.allclose(machine.kernel(words), want)
    machine.weight = np.array([1.0, -2.0, 0.5, 3.0])
    assert np.allclose(machine.values(words), want @ machine.root @ machine.weight)


def test_words_with_inserted_signs_and_gaps():
    assert toxicity.units("You i d i o t, you i.d*i-o_t! x") >= {"idiot", "you", "x"}
    assert toxicity.units("a" * 40) == {"a" * 16}
    assert [sorted(s) for s in toxicity.sentences("One two. Three!\n\n?")] == [["one", "two"], ["three"]]


def labelled(rng, words, n):
    rows = []
    for i in range(n):
        t = [" ".join(rng.choice(words, 12)) for _ in range(rng.integers(1, 5))]
        toxic = int(i % 4 == 0)
        if toxic:
            bad = str(rng.choice(["grobian", "stinker"])) + str(rng.choice(["", "s", "en"]))
            at = int(rng.integers(0, len(t)))
            t[at] = t[at] + " " + bad
        rows.append((i, ". ".join(t) + ".", toxic))
    return rows


def test_toxicity_learns_insults_and_their_variants(spark):
    rng = np.random.default_rng(21)
    words = ["".join(rng.choice(["ka", "lo", "mi", "ne", "tu", "ra"], rng.integers(1, 5))) for _ in range(300)]
    df = spark.createDataFrame(labelled(rng, words, 600), "doc_id long, text string, label int")
    machine = toxicity.fit(df, landmarks=16)
    test = labelled(np.random.default_rng(22), words, 200)
    plain = {i: t for i, t, _ in test}
    got = {r.doc_id: r for r in toxicity.score(spark.createDataFrame(test, "doc_id long, text string, label int"), machine).collect()}
    assert all(got[i].predicted == label for i, _, label in test)
    odd = [(1, plain[1] + " g r o b i a n"), (2, "stinkker " + plain[1]), (3, "grob-ian " + plain[1]), (4, plain[1]), (5, None), (6, ""), (None, plain[1])]
    got = {r.doc_id: r for r in toxicity.score(spark.createDataFrame(odd, "doc_id long, text string"), machine).collect()}
    assert [got[i].predicted for i in (1, 2, 3, 4, 5, 6, None)] == [1, 1, 1, 0, 0, 0, 0]
    assert all(0 <= r.score <= 1 for r in got.values())


def test_toxicity_without_labels_of_both_kinds(spark):
    df = spark.createDataFrame([(1, "some text", 0), (2, "more", None)], "doc_id long, text string, label int")
    assert toxicity.fit(df) is None
    assert {(r.score, r.predicted) for r in toxicity.score(df, None).collect()} == {(0.0, 0)}
    assert toxicity.score(df.limit(0), None).count() == 0


def test_letters_are_of_category_l(spark):
    train = spark.createDataFrame([(i, english(i), "en", 0) for i in range(30)] + [(100 + i, german(i), "de", 0) for i in range(30)], "doc_id long, text string, lang string, _block int")
    model = langid.calibrate(langid.fit(train), train)
    texts = ["\U0001F600\U0001F680", "\u2764\ufe0f", "\u2122", "\u0301\u0301", "12 34", "", None, "\U00020000", "a", "\u00aa", english(3), english(3)]
    df = spark.createDataFrame([(i, t, None, 0) for i, t in enumerate(texts)], "doc_id long, text string, lang string, _block int")
    got = {r.doc_id: r.lang_pred for r in langid.identify(df, model).collect()}
    assert [got[i] == "und" for i in range(len(texts))] == [True] * 7 + [False] * 5
    assert got[10] == got[11] == "en"
    few = langid.fit(train, slots=100)  # kept in tables
    few = langid.calibrate(few, train)
    assert few.tables and {r.doc_id: r.lang_pred for r in langid.identify(df, few).collect()} == got
    kept = langid.accepted(df, few)
    assert kept.columns == df.columns and {10, 11} <= {r.doc_id for r in kept.collect()} <= {7, 8, 9, 10, 11}


def test_toxicity_query_on_held_out_labels(spark):
    """The registered query over whole tables; rows that it learnt from are left out of the count."""
    from hourglass.llm.queries import QUERIES

    sf = "/root/testdata/sf0.01"
    rows = QUERIES["op6_toxicity"](spark, sf).filter("held_out").join(spark.read.parquet(f"{sf}/labels.parquet").filter("toxic is not null"), "doc_id").select("score", "predicted", "toxic").collect()
    bad, good = [r for r in rows if r.toxic == 1], [r for r in rows if r.toxic == 0]
    caught, wrong = sum(r.predicted for r in bad) / len(bad), sum(r.predicted for r in good) / len(good)
    # 14 toxic and 80 other rows: five of the toxic ones hold no insult that the rest of the table knows
    assert len(bad) >= 10 and len(good) >= 50
    assert caught >= 0.6 and wrong <= 0.05


def test_toxicity_words_that_others_cover_are_proven_but_not_neighbours_of_copies():
    insults = [{"scum", "trash"}, {"scum", "idiot"}, {"trash", "idiot"}, {"scum"}, {"trash", "idiot", "the"}, {"scum", "trash", "idiot"}, {"idiot"}, {"trash"}]
    copies = [{"scum", "lorem", "ipsum"}] * 50
    clean = {"scum": 0, "trash": 0, "idiot": 0, "the": 90, "lorem": 0, "ipsum": 0}
    have = {0: 400, 1: 58}
    assert toxicity._cover(insults + copies, clean, have, 9)[0] == "scum"
    assert toxicity._proven(insults + copies, clean, have, 50) == ["scum", "idiot", "trash"]
    assert toxicity._proven([], {}, have, 0) == []
