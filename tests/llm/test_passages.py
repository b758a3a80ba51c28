import hashlib
from collections import Counter

import numpy as np
import pytest

from hourglass.llm.passages import repeated_passages
from hourglass.llm.suffix import permuted_prefixes, repeated_starts, suffix_array


def brute(texts, length):
    """(n_bytes, n_removed, n_spans, sha256) by counting every string."""
    data = [(t or "").encode() for t in texts]
    count = Counter(d[i : i + length] for d in data for i in range(len(d) - length + 1))
    out = []
    for d in data:
        hit = np.zeros(len(d) + 1, dtype=bool)
        for i in range(len(d) - length + 1):
            if count[d[i : i + length]] > 1:
                hit[i : i + length] = True
        spans = int((np.diff(np.concatenate([[0], hit.astype(int)])) == 1).sum())
        kept = bytes(np.frombuffer(d, np.uint8)[~hit[:-1]])
        out.append((len(d), int(hit.sum()), spans, hashlib.sha256(kept).hexdigest()))
    return out


def texts_of(rng, n):
    words = ["".join(rng.choice(list("abcdeé"), rng.integers(1, 7))) for _ in range(300)]
    passage = " ".join(rng.choice(words, 120))
    out = [None, "", "x" * 5000, passage, passage, "short", "ab" * 900]
    for i in range(n):
        t = list(rng.choice(words, rng.integers(5, 260)))
        if i % 3 == 0:
            at = rng.integers(0, len(t))
            t[at:at] = passage.split(" ")[int(rng.integers(0, 60)) :]
        if i % 5 == 0 and out[-1]:
            t = out[-1].split(" ")
            t[int(rng.integers(0, len(t)))] = "edited"
        out.append(" ".join(t))
    return out


def run(spark, texts, **kw):
    rows = [(i, t, "clash") for i, t in enumerate(texts)]
    df = spark.createDataFrame(rows, "doc_id long, text string, h string").repartition(5)
    got = {int(r.doc_id): r for r in repeated_passages(df, **kw).collect()}
    return [(got[i].n_bytes, got[i].n_removed, got[i].n_spans, got[i].kept_sha256) for i in range(len(texts))]


@pytest.mark.parametrize("hot", [4096, 20, 1])
def test_passages_against_brute_force(spark, hot):
    texts = texts_of(np.random.default_rng(3), 90)
    assert run(spark, texts, length=200, hot=hot) == brute(texts, 200)


def test_anchor_with_ten_thousand_contexts(spark):
    """One passage of 90 bytes between different texts: more contexts than one shard takes, by the default limit."""
    rng = np.random.default_rng(9)
    mark = "".join(rng.choice(list("abcdefgh"), 90))
    sides = ["".join(x) for x in rng.choice(list("stuvwxyz"), (10_000, 160))]
    texts = [s[:80] + mark + s[80:] for s in sides]
    # equal strings on one side of the passage only, and within a longer text
    texts += [sides[1][20:80] + mark + sides[1][80:] + "!", "?" + sides[2][:80] + mark + sides[2][80:120], "~" * 150 + sides[3][:80] + mark + sides[3][80:]]
    assert run(spark, texts, length=200) == brute(texts, 200)


def test_repeated_rows_and_empty_table(spark):
    df = spark.createDataFrame([(1, "p" * 300)] * 3 + [(None, "q" * 250), (None, "q" * 250)], "doc_id long, text string")
    got = repeated_passages(df).collect()
    assert len(got) == 5 and all(r.n_removed == r.n_bytes for r in got)
    assert repeated_passages(df.limit(0)).count() == 0


def test_pieces_of_long_texts_agree(spark, monkeypatch):
    import hourglass.llm.passages as P

    texts = texts_of(np.random.default_rng(4), 40) + ["long " * 50 + " ".join(texts_of(np.random.default_rng(5), 30)[7:])]
    monkeypatch.setattr(P, "PIECE", 700)
    docs = [(t or "").encode() for t in texts]
    a = P.anchors(docs, 200)
    assert a["n"].sum() == sum(max(0, len(d) - 199) for d in docs)


def test_suffix_array_and_prefixes():
    rng = np.random.default_rng(1)
    for _ in range(150):
        t = rng.integers(0, rng.integers(1, 5), rng.integers(0, 60)).astype(np.uint8)
        b = t.tobytes()
        order = sorted(range(len(b)), key=lambda i: b[i:])
        sa = suffix_array(t)
        assert sa.tolist() == order
        if len(b):
            before, shared = permuted_prefixes(t, sa)
            for x, y in zip(order[1:], order, strict=False):
                n = next((k for k in range(len(b)) if b[x + k : x + k + 1] != b[y + k : y + k + 1] or x + k >= len(b)), len(b))
                assert (before[x], shared[x]) == (y, n)
            for length in (1, 3):
                c = Counter(b[i : i + length] for i in range(len(b) - length + 1))
                assert repeated_starts(t, length).tolist() == [i + length <= len(b) and c[b[i : i + length]] > 1 for i in range(len(b))]
