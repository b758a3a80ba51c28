"""Archives (exact round trip), mixing and top-k search (against DuckDB and brute
force) and sharding (its invariants)."""

import gzip
import hashlib
import zlib
from base64 import b32encode

import numpy as np
import pytest
from scipy_free import chi_square_high  # local helper below tests/llm

from hourglass.checks.compare import compare, duck
from hourglass.llm import archives, mixing, sharding, topk
from hourglass.llm.queries import ORACLE, QUERIES

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", [n for n in ORACLE if n != "op8_jaccard"])
def test_query_matches_duckdb(spark, name):
    got = QUERIES[name](spark, SF).toPandas()
    want = duck(SF).execute(ORACLE[name]).df()
    assert compare(got, want)["values_match"]


def test_archives_round_trip(spark, tmp_path):
    rows = [(1, "http://a b/ü\n", "same"), (2, None, None), (3, "http://c", ""), (4, "http://d", "same"), (5, "http://e", "WARC/1.0\r\n\r\nx\n\n\r\n" * 50), (None, "http://f", "same"), (4, "http://g", "same"), (6, "u", "ü" * 70_000)]
    df = spark.createDataFrame([(*r, b"x") for r in rows], "page_id long, url string, html string, payload binary").repartition(3)
    for version in (1, 2):
        arc, warc = str(tmp_path / f"arc{version}"), str(tmp_path / f"warc{version}")
        archives.write_arc(df, arc, version)
        read = archives.read_arc(spark, arc)
        assert {r.version for r in read.collect()} == {version}
        assert sorted(bytes(r.payload) for r in read.collect()) == sorted((h or "").encode() for _, _, h in rows)
        archives.to_warc(read, warc)
        got = archives.read_warc(spark, warc).collect()
        assert len(got) == len(rows)
        for r in got:
            text = [h for i, _, h in rows if i == r.page_id][0] or ""
            assert r.payload_bytes == len(text.encode()) and r.payload_digest == b32encode(hashlib.sha1(text.encode()).digest()).decode()
        response = [r for r in got if r.record_type == "response"]
        same = [r for r in got if r.payload_bytes == 4]
        assert sorted(r.record_type for r in same) == ["response"] + ["revisit"] * 3
        assert next(r for r in same if r.record_type == "response").page_id == 4
        assert {r.refers_to_id for r in same if r.record_type == "revisit"} == {r.record_id for r in same if r.record_type == "response"}
        assert [r.page_id for r in response if r.payload_bytes == 0] == [3]
        assert len({r.record_id for r in got}) == len(rows)


def test_archives_of_an_empty_table_and_min_bytes(spark, tmp_path):
    df = spark.createDataFrame([(1, "u", "ab"), (2, "u", "ab")], "page_id long, url string, html string")
    archives.write_arc(df.limit(0), str(tmp_path / "a0"))
    archives.write_arc(df, str(tmp_path / "a"))
    archives.to_warc(archives.read_arc(spark, str(tmp_path / "a")), str(tmp_path / "w"), min_bytes=3)
    assert {r.record_type for r in archives.read_warc(spark, str(tmp_path / "w")).collect()} == {"response"}
    arc = archives.read_arc(spark, str(tmp_path / "a0"))
    assert arc.count() == 0
    archives.to_warc(arc, str(tmp_path / "w0"))
    assert archives.read_warc(spark, str(tmp_path / "w0")).count() == 0


def test_arc_records_of_foreign_files(spark, tmp_path):
    block = b"not http"
    one = archives.version_block(1) + b"\n" + b"ftp://x 1.2.3.4 19991231235959 text/plain 8\n" + block + b"\n"
    (tmp_path / "x.arc").write_bytes(one)
    (tmp_path / "y.arc.gz").write_bytes(gzip.compress(archives.version_block(2) + b"\n") + gzip.compress(b"ftp://y 1.2.3.4 19991231235959 text/plain 200 - - 0 - 8\n" + block + b"\n"))
    archives.to_warc(archives.read_arc(spark, str(tmp_path)), str(tmp_path / "w"))
    got = archives.read_warc(spark, str(tmp_path / "w")).collect()
    assert sorted(r.record_type for r in got) == ["resource", "revisit"] or {r.record_type for r in got} == {"resource"}
    assert {r.warc_date for r in got} == {"1999-12-31T23:59:59Z"}
    (tmp_path / "cut").mkdir()
    (tmp_path / "cut/z.arc").write_bytes(one[:-6])
    with pytest.raises(Exception, match="cut short"):
        archives.read_arc(spark, str(tmp_path / "cut")).count()


def mix_rows(rng, n=400):
    rows = [(i, "w " * int(rng.integers(0, 40)), f"s{min(9, int(rng.geometric(0.4)))}", i) for i in range(n)]
    return rows + [(n, None, "s1", 1), (n + 1, "one two", None, 1), (None, "x y z", "s2", 1), (n + 2, "", "empty", 1)]


def test_mixing_targets_thresholds_and_repeats(spark):
    rng = np.random.default_rng(3)
    rows = mix_rows(rng)
    df = spark.createDataFrame(rows, "doc_id long, text string, source string, size long").repartition(3)
    got = mixing.mix(df, bits=3).toPandas()
    assert len(got) == len(rows) and got["size"].sum() == sum(len((t or "").split()) for _, t, _, _ in rows)
    per = got.groupby("source", dropna=False).agg(size=("size", "sum"), target=("target", "first"), taken=("taken", "sum"), most=("size", "max"))
    assert np.isclose(per["target"].sum(), got["size"].sum())
    assert (per["target"] <= 3 * per["size"] + 1e-9).all()
    assert ((per["taken"] - per["target"]).abs() <= per["most"] / 2 + 1e-9).all()
    assert (got["taken"] <= 3 * got["size"]).all()
    again = mixing.mix(df.repartition(7), bits=12).toPandas()
    key = lambda d: sorted(map(tuple, d[["doc_id", "source", "taken"]].astype(str).to_numpy()))
    assert key(got) == key(again)
    less = mixing.mix(df, share=0.3).toPandas()
    both = got.merge(less, on=["doc_id", "source"], suffixes=("", "_less"))
    assert (both["taken_less"] <= both["taken"]).all()  # nested
    repeated = mixing.mixed(df)
    assert repeated.columns == df.columns and repeated.count() == got["copies"].sum()
    assert mixing.mix(df.limit(0)).count() == 0 and mixing.mixed(df.limit(0)).count() == 0


@pytest.mark.parametrize("alike", ["no ids", "one id", "one id and text"])
def test_mixing_splits_rows_without_an_id_and_repeated_ones(spark, alike):
    rng = np.random.default_rng(8)
    text = lambda: " ".join(["w"] * int(rng.integers(1, 40)))
    rows = [(i, text() + f" x{i}", f"s{i % 3}", 0) for i in range(600)]
    same = text()
    rows += [(None if alike == "no ids" else 7, same if alike == "one id and text" else text() + f" y{i}", f"s{i % 4 // 2}", 0) for i in range(300)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string, h int").selectExpr("*", "h AS _key", "h AS _n", "h AS _doc", "h AS number", "h AS _h", "h AS size", "h AS whole").repartition(5)
    got = mixing.mix(df).toPandas()
    per = got.groupby("source").agg(target=("target", "first"), taken=("taken", "sum"), most=("size", "max"))
    assert len(got) == 900 and ((per["taken"] - per["target"]).abs() <= per["most"] / 2 + 1e-9).all()
    key = lambda d: sorted(map(tuple, d[["doc_id", "source", "size", "taken"]].astype(str).to_numpy()))
    assert key(got) == key(mixing.mix(df.repartition(2)).toPandas())
    whole = mixing.mixed(df)
    assert whole.columns == df.columns
    assert sorted(map(str, whole.groupBy("source").count().collect())) == sorted(f"Row(source='{s}', count={n})" for s, n in got.groupby("source")["copies"].sum().items())


def test_mixing_beyond_the_broadcast_bound(spark, monkeypatch):
    import hourglass.llm.common as common

    rows = mix_rows(np.random.default_rng(4), 120)
    df = spark.createDataFrame(rows, "doc_id long, text string, source string, size long")
    want = sorted(map(str, mixing.mix(df).collect()))
    monkeypatch.setattr(common, "BROADCAST_ROWS", 1)
    assert sorted(map(str, mixing.mix(df).collect())) == want


def test_sharding_is_exact_uniform_and_stable(spark):
    rows = [(i % 90 if i % 7 else None, None if i % 11 == 0 else "t" * (i % 5), i, i) for i in range(803)]
    df = spark.createDataFrame(rows, "doc_id long, text string, shard long, _row long").repartition(6)
    got = sharding.shard(df, 8, seed=1).toPandas()
    sizes = got.groupby("shard").size()
    assert sorted(sizes) == [100] * 5 + [101] * 3
    assert all(sorted(g) == list(range(len(g))) for _, g in got.groupby("shard")["slot"])
    assert sorted(got["size"]) == sorted(len(t or "") + 1 for _, t, _, _ in rows)
    assert sorted(got["text_crc32"]) == sorted(zlib.crc32((t or "").encode()) for _, t, _, _ in rows)
    whole = sharding.sharded(df.drop("_row"), 8, seed=1)
    assert whole.columns == ["doc_id", "text", "shard", "slot"] and whole.count() == 803
    few = sharding.shard(df.limit(3), 8).toPandas()
    assert sorted(few["slot"]) == [0, 0, 0] and few["shard"].nunique() == 3
    assert sharding.shard(df.limit(0)).count() == 0
    # a row's shard does not depend on its place: over seeds, the first row goes everywhere
    m = np.array([sharding.communication_matrix([50, 30, 3], 4, s) for s in range(400)])
    assert (m.sum(2) == [50, 30, 3]).all() and (np.sort(m.sum(1)) == [20, 21, 21, 21]).all()
    assert not chi_square_high(m[:, 2].sum(0))


def plain_places(rows, order, shards, seed):
    """Shard and slot of each row by lists: ``order`` holds both permutations' keys of a row."""
    blocks = {}
    for r in rows:
        blocks.setdefault((r >> 33) % sharding.MAX_BLOCKS, []).append(r)
    matrix = sharding.communication_matrix([len(blocks[b]) for b in sorted(blocks)], shards, seed)
    got = [[] for _ in range(shards)]
    for b, counts in zip(sorted(blocks), matrix, strict=True):
        own = iter(sorted(blocks[b], key=lambda r: (order[r][0], r)))
        for j, n in enumerate(counts):
            got[j] += [next(own) for _ in range(n)]
    return {r: (j, i) for j, part in enumerate(got) for i, r in enumerate(sorted(part, key=lambda r: (order[r][1] % (1 << 64), r)))}


def test_sharding_equals_plain_lists_and_every_assignment_is_as_likely(spark):
    from pyspark.sql import functions as F

    rows = [(b << 33) + i for b, n in ((0, 11), (1, 3), (5, 10)) for i in range(n)]
    seeds, shards = 600, 4
    table = spark.createDataFrame([(r,) for r in rows], "_row long")
    keys = table.crossJoin(spark.range(seeds).select(F.col("id").cast("int").alias("seed")))
    order = [{} for _ in range(seeds)]
    for r in keys.select("_row", "seed", F.xxhash64("seed", F.lit(1), "_row").alias("a"), F.xxhash64("seed", F.lit(2), "_row").alias("b")).collect():
        order[r.seed][r._row] = (r.a, r.b)
    plain = [plain_places(rows, order[s], shards, s) for s in range(seeds)]
    for s in (0, 7):
        got = {r._row: (r.shard, r.slot) for r in sharding.places(table.repartition(3), shards, s).collect()}
        assert got == plain[s]
    # every row goes to every shard and slot as often, rows of one block and of two blocks meet as often
    for r in rows[::5]:
        assert not chi_square_high(np.bincount([p[r][0] for p in plain], minlength=shards))
        assert not chi_square_high(np.bincount([p[r][1] for p in plain], minlength=6))
    for a, b in ((rows[0], rows[1]), (rows[0], rows[12])):
        met = sum(p[a][0] == p[b][0] for p in plain) / seeds
        assert abs(met - 5 / 23) < 4 * (5 / 23 * 18 / 23 / seeds) ** 0.5


def plain_top(vectors, k):
    out = []
    for q, (i, v) in enumerate(vectors):
        if i is None or i % 100 or v is None:
            continue
        scored = sorted((-sum(a * b for a, b in zip(v, w, strict=True)), j is None, j or 0, j) for p, (j, w) in enumerate(vectors) if p != q and w is not None and len(w) == len(v))
        out += [(i, r + 1, j, -s) for r, (s, _, _, j) in enumerate(scored[:k])]
    return sorted(out, key=str)


@pytest.mark.parametrize("block", [4096, 40])
def test_top_k_against_brute_force(spark, block):
    rng = np.random.default_rng(6)
    centers = rng.normal(0, 300, (5, 8))
    vectors = [(int(i), (centers[i % 5] + rng.normal(0, 20, 8)).astype(int).tolist()) for i in range(330)]
    vectors += [(100, vectors[0][1]), (None, vectors[1][1]), (401, None), (500, [1, 2]), (600, []), (601, []), (700, [0] * 8)]
    df = spark.createDataFrame([(i, v, 1) for i, v in vectors], "vec_id long, embedding array<long>, row int").repartition(4)
    from pyspark.sql import functions as F

    got = sorted(((r.query_id, r.rank, r.vec_id, r.score) for r in topk.top_k(df, F.col("vec_id") % 100 == 0, 7, block_rows=block).collect()), key=str)
    assert got == plain_top(vectors, 7)
    assert topk.top_k(df.limit(0), F.col("vec_id") % 100 == 0).count() == 0


def test_top_k_sends_queries_only_to_cells_that_can_beat_them(spark):
    from pyspark.sql import functions as F

    rng = np.random.default_rng(12)
    centers = rng.normal(0, 400, (12, 16))
    vectors = [(int(i), (centers[i % 12] + rng.normal(0, 10, 16)).astype(int).tolist()) for i in range(1200)]
    vectors += [(2000 + i, [7] * 16) for i in range(600)]  # one very common vector
    df = spark.createDataFrame(vectors, "vec_id long, embedding array<long>").repartition(4)
    sent = []
    met = topk._met

    def counted(data, asks, sizes, k):
        sent.append(asks.count())
        return met(data, asks, sizes, k)

    topk._met = counted
    try:
        found = topk.top_k(df, F.col("vec_id") % 100 == 0, 5, block_rows=60)
    finally:
        topk._met = met
    got = sorted(((r.query_id, r.rank, r.vec_id, r.score) for r in found.collect()), key=str)
    assert got == plain_top(vectors, 5)
    queries, asked = sent
    cells = 1800 // 60
    assert queries == 18 and asked < queries * cells / 3
    one = topk.top_k(df, F.col("vec_id") % 100 == 0, 5, block_rows=500, cells=1)
    assert sorted(((r.query_id, r.rank, r.vec_id, r.score) for r in one.collect()), key=str) == got


def test_top_k_refuses_vectors_too_long_for_exact_scores(spark):
    from pyspark.sql import functions as F

    df = spark.createDataFrame([(100, [1 << 27, 1]), (1, [1, 1])], "vec_id long, embedding array<long>")
    with pytest.raises(ValueError, match="too large for exact scores"):
        topk.top_k(df, F.col("vec_id") == 100)


def test_top_k_prunes_and_takes_only_valid_vectors(spark):
    from pyspark.sql import functions as F

    df = spark.createDataFrame([([0.5, -0.25],), ([float("nan"), 1.0],), ([float("inf")],), ([None],), (None,), ([],)], "v array<float>")
    got = df.select(topk.valid(F.col("v")).alias("ok"), topk.quantized(F.col("v")).alias("q")).collect()
    assert [r.ok for r in got] == [True, False, False, False, False, True] and got[0].q == [512, -256]
    rng = np.random.default_rng(8)
    x = np.repeat(rng.normal(0, 1000, (20, 4)), 60, 0) + rng.normal(0, 1, (1200, 4))
    tree = topk.CoverTree(x)
    stack, seen = [tree.root], 0
    while stack:
        n = stack.pop()
        rows = x[tree.order[n.lo : n.hi]]
        assert np.sqrt(((rows - n.center) ** 2).sum(1)).max() <= n.radius + 1e-9
        seen += n.own[1] - n.own[0]
        stack += n.children
    assert seen == len(x) and tree.root.children
