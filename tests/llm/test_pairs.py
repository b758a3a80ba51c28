"""Line dedup, Jaccard join and decontamination against brute force."""

import itertools
import re

import numpy as np
import pytest

from hourglass.llm import decontam, jaccard, linededup
from hourglass.llm.common import components, saved, word_hashes


def vocabulary(rng, n=200):
    return ["".join(rng.choice(list("abcdefgé"), rng.integers(2, 8))) for _ in range(n)]


def distance_one(a, b):
    if abs(len(a) - len(b)) > 1:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) <= 1
    short, long = sorted((a, b), key=len)
    return any(long[:i] + long[i + 1 :] == short for i in range(len(long)))


def edited(rng, line):
    i = int(rng.integers(0, len(line)))
    return rng.choice([line[:i] + "X" + line[i + 1 :], line[:i] + "Y" + line[i:], line[:i] + line[i + 1 :], line])


def test_line_decisions_against_brute_force(spark):
    rng = np.random.default_rng(7)
    words = vocabulary(rng)
    base = [" ".join(rng.choice(words, rng.integers(3, 12))) for _ in range(25)] + ["aaaaaaaaaaaaaaaaaaaaaaaa", "ab" * 20, "short", "shor"]
    docs = [(i, "\n".join([*(edited(rng, str(x)) for x in rng.choice(base, 6)), "", "  ", "short"])) for i in range(40)]
    docs += [(40, None), (41, ""), (42, "a" * 3000 + "\n" + "a" * 3001)]
    df = spark.createDataFrame([(i, t, 5, "x") for i, t in docs], "doc_id long, text string, id int, line string").repartition(3)
    df = saved(df)
    got = {r.doc_id: (r.n_lines, r.removed) for r in linededup.line_decisions(df).collect()}
    seen: list[str] = []
    for i, text in docs:
        gone = []
        for k, line in enumerate(text.split("\n") if text is not None else []):
            if not line.strip():
                continue
            if any(s == line or distance_one(s, line) for s in seen):
                gone.append(k)
            seen.append(line)
        assert got[i] == (0 if text is None else len(text.split("\n")), gone), i
    kept = {r.doc_id: r.text for r in linededup.dedup_lines(df).collect()}
    assert kept[42] == "a" * 3000 and kept[40] is None and len(kept) == len(docs)


def test_lines_of_every_length_against_brute_force(spark):
    rng = np.random.default_rng(12)
    lines = [""] + ["".join(rng.choice(list("abé"), n)) for n in range(1, 41) for _ in range(3)]
    lines += [edited(rng, x) for x in lines[1:]] + ["a", "b", "ab", "ba", "x" * 40, "x" * 39 + "y"]
    docs = [(i, "\n".join(map(str, rng.choice(lines, 7)))) for i in range(60)]
    df = saved(spark.createDataFrame(docs, "doc_id long, text string"))
    for least in (1, 12):
        got = {r.doc_id: r.removed for r in linededup.line_decisions(df, min_chars=least).collect()}
        seen: set[str] = set()
        for i, text in docs:
            gone = []
            for k, line in enumerate(text.split("\n")):
                if line.strip():
                    if line in seen or any(min(len(s), len(line)) >= least and distance_one(s, line) for s in seen):
                        gone.append(k)
                    seen.add(line)
            assert got[i] == gone, (least, i)


def test_lines_of_repeated_rows_null_ids_and_empty_tables(spark):
    line = "this line is long enough to compare"
    df = spark.createDataFrame([(1, line), (1, line), (None, line + "!")], "doc_id long, text string").coalesce(1)
    got = sorted(((r.doc_id is None, r.removed) for r in linededup.line_decisions(df).collect()), key=str)
    assert got == [(False, [0]), (False, []), (True, [0])] or got == [(False, []), (False, [0]), (True, [0])]
    assert linededup.line_decisions(df.limit(0)).count() == 0
    assert {tuple(r.removed) for r in linededup.line_decisions(df, edits=0).filter("doc_id is null").collect()} == {()}
    with pytest.raises(ValueError, match="edits"):
        linededup.line_decisions(df, edits=2)


def grams(text, n=5):
    w = re.findall(r"[0-9a-z_\x80-\U0010ffff]+", (text or "").lower())
    k = min(n, len(w))
    return {tuple(w[i : i + k]) for i in range(len(w) - k + 1)} if k else set()


def near_texts(rng, words):
    out = [None, "", "...", "one two", "One, two!", "two one"]
    for _ in range(8):
        base = list(rng.choice(words, rng.integers(30, 200)))
        for _ in range(rng.integers(1, 9)):
            t = list(base)
            for _ in range(int(rng.integers(0, 4))):
                t[int(rng.integers(0, len(t)))] = "edit"
            out.append(" ".join(t))
    return out


@pytest.mark.parametrize("block", [4096, 3])
def test_jaccard_against_brute_force(spark, block):
    rng = np.random.default_rng(11)
    texts = near_texts(rng, vocabulary(rng))
    sets = [grams(t) for t in texts]
    links = {(i, j) for i, j in itertools.permutations(range(len(texts)), 2) if sets[i] and sets[j] and len(sets[i] & sets[j]) >= 0.8 * len(sets[i] | sets[j]) - 1e-9}
    label = list(range(len(texts)))
    for _ in texts:
        for i, j in links:
            label[i] = min(label[i], label[j])
    df = spark.createDataFrame([(i, t, 1, 2) for i, t in enumerate(texts)], "doc_id long, text string, c int, t int").repartition(4)
    got = {r.doc_id: r for r in jaccard.jaccard_join(df, block=block).collect()}
    for i in range(len(texts)):
        assert (got[i].class_id, got[i].n_links, got[i].n_grams) == (label[i], sum(a == i for a, _ in links), len(sets[i])), i


def test_jaccard_repeated_rows_nulls_and_empty_table(spark):
    text = "a b c d e f g h"
    df = spark.createDataFrame([(1, text), (1, text), (None, text), (None, None)], "doc_id long, text string")
    got = sorted((r.doc_id is None, r.class_id, r.n_links) for r in jaccard.jaccard_join(df).filter("n_grams > 0").collect())
    assert got == [(False, 1, 2), (False, 1, 2), (True, 1, 2)]
    assert jaccard.jaccard_join(df.limit(0)).count() == 0


def test_banding_meets_the_target():
    for recall in (0.9, 0.999, 0.9999):
        b, r = jaccard.banding(0.8, recall)
        assert 1 - (1 - 0.8**r) ** b >= recall


def test_linked_sets_with_many_columns(monkeypatch):
    monkeypatch.setattr(jaccard, "COLUMNS", 7)
    rng = np.random.default_rng(2)
    sets = [np.unique(rng.integers(0, 60, rng.integers(1, 40))).astype(np.uint64) for _ in range(40)]
    want = np.array([[len(np.intersect1d(a, b)) >= 0.5 * len(np.union1d(a, b)) for b in sets] for a in sets])
    assert (jaccard.linked(sets, sets, 0.5) == want).all()
    assert (jaccard.linked(sets[:9], sets[9:], 0.5) == want[:9, 9:]).all()


def test_components(spark):
    rng = np.random.default_rng(5)
    edges = [(int(a), int(b)) for a, b in rng.integers(0, 120, (70, 2))] + [(200 + i, 201 + i) for i in range(30)]
    label = {v: v for e in edges for v in e}
    for _ in label:
        for a, b in edges:
            label[a] = label[b] = min(label[a], label[b])
    got = {r.node: r.label for r in components(spark.createDataFrame(edges, "u long, v long")).collect()}
    assert got == {v: k for v, k in label.items() if any(a != b and v in (a, b) for a, b in edges)}


def test_word_hashes_do_not_depend_on_place():
    a, s = word_hashes(["The cat, the CAT", None, "", "été-the"])
    assert s.tolist() == [0, 4, 4, 4, 6]
    assert a[0] == a[2] == a[5] and a[1] == a[3] and a[4] not in a[:4]


def smith_waterman(a, b):
    h = np.zeros((len(a) + 1, len(b) + 1), int)
    for i, j in itertools.product(range(len(a)), range(len(b))):
        h[i + 1, j + 1] = max(0, h[i, j] + (2 if a[i] == b[j] else -1), h[i, j + 1] - 1, h[i + 1, j] - 1)
    return h.max()


def test_align_against_the_plain_table():
    rng = np.random.default_rng(9)
    for _ in range(40):
        item = rng.integers(0, 6, rng.integers(1, 12)).astype(np.uint64)
        windows = [rng.integers(0, 6, rng.integers(0, 20)).astype(np.uint64) for _ in range(5)]
        best, end = decontam.align(item, windows)
        assert best.tolist() == [smith_waterman(item, w) for w in windows]
        assert all(e <= len(w) for e, w in zip(end, windows, strict=True))


def test_contaminated_finds_copies_and_leaves_clean_documents(spark):
    rng = np.random.default_rng(13)
    words = vocabulary(rng)
    draw = lambda n: list(rng.choice(words, n))
    items = [draw(rng.integers(15, 50)) for _ in range(12)] + [["lone", "pair"], []]
    docs, want = [], set()
    for i in range(90):
        t = draw(rng.integers(60, 400))
        if i % 3 == 0:
            k = int(rng.integers(0, 12))
            copy = list(items[k])
            if i % 2:  # every sixth word replaced, one dropped, one added
                copy[::6] = ["edit"] * len(copy[::6])
                del copy[4]
                copy.insert(9, "more")
            at = int(rng.integers(0, len(t)))
            t[at:at] = copy
            want.add((i, k))
        docs.append((i, " ".join(t).capitalize(), "z"))
    docs += [(90, None, "z"), (91, "", "z"), (92, "Some lone pair.", "z")]
    want.add((92, 12))
    df = spark.createDataFrame(docs, "doc_id long, text string, item long".replace("item long", "item string")).repartition(3)
    bench = spark.createDataFrame([(i, " ".join(x), 1) for i, x in enumerate(items)] + [(99, None, 1)], "item_id long, text string, size int")
    got = decontam.contaminated(df, bench).collect()
    assert {(r.doc_id, r.item_id) for r in got} == want
    assert all(r.score == 1 for r in got if r.doc_id % 2 == 0 and r.doc_id < 90)
    assert decontam.contaminated(df.limit(0), bench).count() == 0
    assert decontam.contaminated(df, bench.limit(0)).count() == 0


def test_contaminated_rows_without_ids_and_with_one_id(spark):
    rng = np.random.default_rng(17)
    words = vocabulary(rng)
    draw = lambda n: " ".join(rng.choice(words, n))
    item = draw(40)
    rows = [(None, item + " " + draw(30)), (None, item + " " + draw(30)), (5, item), (5, draw(9) + " " + item), (5, draw(50)), (6, item), (6, item), (None, item), (None, item), (None, None)]
    df = spark.createDataFrame([(i, t, 0, 0) for i, t in rows], "doc_id long, text string, t int, seed int").repartition(3)
    got = decontam.contaminated(df, spark.createDataFrame([(1, item), (1, item)], "item_id long, text string")).collect()
    assert sorted(str(r.doc_id) for r in got) == sorted(str(i) for i, t in rows if t and item in t)


def test_recall_at_the_threshold_against_all_pairs(spark):
    """Copies with words replaced at random, or every third: found wherever alignment with all
    documents scores them at the threshold or above."""
    rng = np.random.default_rng(23)
    words = vocabulary(rng)
    items = [list(rng.choice(words, 40)) for _ in range(10)]
    docs = []
    for i in range(240):
        copy = list(items[i % 10])
        at = np.arange(i % 3, 40, 3) if i % 4 == 0 else np.flatnonzero(rng.random(40) < rng.uniform(0.15, 0.4))
        for j in at:
            copy[j] = "new" + str(rng.integers(1000))
        docs.append(list(rng.choice(words, 60)) + copy + list(rng.choice(words, 60)))
    code = {w: k for k, w in enumerate({w for d in docs + items for w in d})}
    number = lambda ws: np.array([code[w] for w in ws], np.uint64)
    want = set()
    for k, item in enumerate(items):
        best, _ = decontam.align(number(item), [number(d) for d in docs])
        want |= {(int(i), k) for i in np.flatnonzero(best / (2 * len(item)) >= 0.5)}
    assert 100 < len(want) < 240 and {(i, i % 10) for i in range(0, 240, 4)} <= want
    df = spark.createDataFrame([(i, " ".join(d)) for i, d in enumerate(docs)], "doc_id long, text string")
    got = {(r.doc_id, r.item_id) for r in decontam.contaminated(df, spark.createDataFrame([(k, " ".join(x)) for k, x in enumerate(items)], "item_id long, text string")).collect()}
    assert got <= want and len(got) >= 0.99 * len(want)
