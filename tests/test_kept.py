"""Kept tables: upserts by day, newest features by refresh, versions given by the ledger."""

import datetime as dt
import os
import random
from concurrent.futures import ThreadPoolExecutor

import pytest
from pyspark.sql import functions as F

from hourglass.operators.guards import ContractError, write_checked
from hourglass.operators.joins import latest_features
from hourglass.plans import ledger as L
from hourglass.sources import claims, kept

T0 = dt.datetime(2024, 3, 1)
ROWS = "location_id string, timestamp timestamp_ntz, v double, note string"


def _df(spark, rows, schema=ROWS):
    return spark.createDataFrame(rows, schema)


def _files(path):
    return {os.path.relpath(os.path.join(d, f), path): os.stat(os.path.join(d, f)).st_mtime_ns for d, _, fs in os.walk(path) for f in fs if f.endswith(".parquet")}


def _content(spark, path):
    return sorted(map(tuple, kept.read_table(spark, path).drop("day").collect()), key=str)


def test_upsert_rewrites_only_changed_days(spark, tmp_path):
    path = str(tmp_path / "t")
    r = random.Random(1)
    want = {}
    hour = lambda h: T0 + dt.timedelta(hours=h)
    first = [(k, hour(h), float(h), "a") for k in ("x", "y", None) for h in range(24 * 6)]
    want |= {(k, t): (k, t, v, n) for k, t, v, n in first}
    assert len(kept.upsert_table(_df(spark, first), path, ["location_id"], "timestamp")) == 6
    assert _content(spark, path) == sorted(want.values(), key=str)
    before = _files(path)
    assert kept.upsert_table(_df(spark, first), path, ["location_id"], "timestamp") == [] and _files(path) == before
    for step in range(3):
        days = r.sample(range(7), 2)
        rows = [(r.choice(["x", "y", "z", None]), hour(24 * d + r.randrange(24)), r.random(), None if r.random() < 0.3 else "b") for d in days for _ in range(5)]
        rows = list({(k, t): (k, t, v, n) for k, t, v, n in rows}.values())
        want |= {(k, t): (k, t, v, n) for k, t, v, n in rows}
        before = _files(path)
        touched = kept.upsert_table(_df(spark, rows), path, ["location_id"], "timestamp")
        assert touched == sorted({f"{t:%Y-%m-%d}" for _, t, _, _ in rows})
        assert _content(spark, path) == sorted(want.values(), key=str)
        after = _files(path)
        kept_files = {f: m for f, m in before.items() if f.split("=")[1].split("/")[0] not in touched}
        assert kept_files and all(after[f] == m for f, m in kept_files.items())
    same = _files(path)
    assert kept.upsert_table(_df(spark, rows), path, ["location_id"], "timestamp") == [] and _files(path) == same


def test_upsert_cases(spark, tmp_path):
    path = str(tmp_path / "t")
    rows = [("x", T0, 1.0, "a"), ("x", T0, 2.0, "b"), ("x", None, 3.0, "c")]
    kept.upsert_table(_df(spark, rows), path, ["location_id"], "timestamp", order=["note"])
    assert _content(spark, path) == sorted([rows[1], rows[2]], key=str)
    assert kept.upsert_table(_df(spark, []), path, ["location_id"], "timestamp") == []
    with pytest.raises(ContractError):
        kept.upsert_table(_df(spark, rows).withColumn("day", F.lit(1)), path, ["location_id"], "timestamp")


VIEW = "id string, ts timestamp_ntz, v double, n long"


def test_refresh_equals_a_full_recompute(spark, tmp_path):
    path = str(tmp_path / "latest")
    r = random.Random(2)
    rows, n = [], 0
    ids = spark.createDataFrame([(x,) for x in ["a", "b", "c", "d", "none"]], "id string")
    with pytest.raises(ContractError):
        kept.read_latest(spark, path, ids, ["id"], "ts")
    for batch in range(4):
        for _ in range(30):
            n += 1
            # late rows: times up to three days before the newest
            rows.append((r.choice("abcd"), T0 + dt.timedelta(hours=24 * batch - r.randrange(72) + (r.random() < 0.1) * 24), round(r.random(), 3), n))
        if batch == 2:
            rows += [("a", None, 9.0, n + 1), ("a", T0 + dt.timedelta(days=99), 9.0, None)]
            n += 1
        view = spark.createDataFrame(rows, VIEW)
        version = kept.refresh_latest(view, path, ["id"], "ts", ["v"], "n")
        assert version == batch + 1
        best = {}
        for i, t, v, k in rows:
            if t is not None and k is not None and (t, k) > best.get(i, (dt.datetime.min, 0))[:2]:
                best[i] = (t, k, v)
        got = {x.id: (x.ts, x.v) for x in kept.read_latest(spark, path, ids, ["id"], "ts").collect()}
        assert got == {i: (best[i][0], best[i][2]) if i in best else (None, None) for i in ["a", "b", "c", "d", "none"]}
    assert kept.refresh_latest(view, path, ["id"], "ts", ["v"], "n") == version  # nothing new
    # only rows behind the stored number are read: a changed old row does not count
    changed = view.withColumn("ts", F.col("ts") + F.expr("INTERVAL 100 DAYS"))
    assert kept.refresh_latest(changed, path, ["id"], "ts", ["v"], "n") == version
    full = latest_features(view.filter("ts is not null and n is not null"), ids, ["id"], "ts", ["v"])
    assert sorted(map(str, full.select("id", "ts").collect())) == sorted(map(str, kept.read_latest(spark, path, ids, ["id"], "ts").select("id", "ts").collect()))


def test_ttl_and_broken_versions(spark, tmp_path):
    path = str(tmp_path / "latest")
    rows = [("a", T0, 1.0, 1), ("b", T0 - dt.timedelta(days=3), 2.0, 2)]
    ids = spark.createDataFrame([("a",), ("b",)], "id string")
    kept.refresh_latest(spark.createDataFrame(rows, VIEW), path, ["id"], "ts", ["v"], "n")
    claims.claim(spark, f"{path}/versions")  # a refresh that died
    read = lambda **how: {r.id: r.v for r in kept.read_latest(spark, path, ids, ["id"], "ts", **how).collect()}
    assert read() == {"a": 1.0, "b": 2.0}
    assert read(as_of=T0 - dt.timedelta(days=1)) == {"a": None, "b": 2.0}
    assert read(as_of=T0, ttl_seconds=86400) == {"a": 1.0, "b": None}
    rows.append(("c", T0, 3.0, 3))
    assert kept.refresh_latest(spark.createDataFrame(rows, VIEW), path, ["id"], "ts", ["v"], "n", ttl_seconds=86400) == 3
    assert read() == {"a": 1.0, "b": None}


def test_writers_at_once_get_different_numbers(spark, tmp_path):
    base = str(tmp_path / "numbers")
    with ThreadPoolExecutor(8) as pool:
        got = list(pool.map(lambda _: claims.claim(spark, base), range(24)))
    assert sorted(got) == list(range(1, 25)) == claims.claimed(spark, base)
    assert not [f for f in os.listdir(base) if f.startswith("claim-")]


def test_ledger_gives_versions_and_orders_aliases(spark, tmp_path):
    path, aliases = str(tmp_path / "runs"), str(tmp_path / "aliases")
    runs = lambda a, b: spark.createDataFrame([(f"{a}{b}x", "x", {"p": "1"}, {"rmse": a}), (f"{a}{b}y", "y", {"p": "1"}, {"rmse": b})],
                                              "run_id string, model string, params map<string,string>, metrics map<string,double>") \
        .withColumn("alias", F.lit(None).cast("string")).withColumn("tags", F.create_map(F.lit("k"), F.lit("v")))
    with ThreadPoolExecutor(3) as pool:
        given = list(pool.map(lambda i: L.register_runs(runs(float(i), 2.0 * i), path), [1, 2, 3]))
    assert sorted(g["x"] for g in given) == sorted(g["y"] for g in given) == [1, 2, 3]
    ledger = L.read_ledger(spark, path)
    assert {(r.model, r.version) for r in ledger.collect()} == {(m, v) for m in "xy" for v in (1, 2, 3)}
    for better in (1.0, 0.5):
        L.register_runs(runs(9.0, better), path)
        L.record_alias(L.read_ledger(spark, path), aliases)
    # a record whose clock is ahead does not win over a later sequence
    ahead = L.read_aliases(spark, aliases).filter("seq = 1").withColumn("set_at", F.expr("current_timestamp() + INTERVAL 9 DAYS")).withColumn("seq", F.lit(0).cast("long"))
    ahead.write.mode("append").parquet(aliases)
    found = L.resolve_alias(L.read_ledger(spark, path), L.read_aliases(spark, aliases), "champion").first()
    assert (found.model, found.version, found.metrics["rmse"]) == ("y", 5, 0.5)
    with pytest.raises(ContractError):
        L.register_runs(runs(1.0, 1.0).withColumn("model", F.lit("x")), path)


def test_checked_write_keeps_only_tables_that_pass(spark, tmp_path):
    df = _df(spark, [("x", T0, 1.0, "a"), ("y", T0, None, "b")])
    path = str(tmp_path / "t")
    with pytest.raises(ContractError, match=r"Null values in columns: \['v'\]"):
        write_checked(df, path, not_null=["location_id", "v"], rows=2, cols=4)
    with pytest.raises(ContractError, match="Expected 3 rows, found 2"):
        write_checked(df, path, rows=3)
    with pytest.raises(ContractError, match="columns"):
        write_checked(df, path, cols=5)
    assert os.listdir(tmp_path) == []
    assert write_checked(df, path, not_null=["note"], rows=2, cols=4).count() == 2
    assert write_checked(df.filter("v > 5"), f"{path}2", not_null=["v"], rows=0).count() == 0
    with pytest.raises(ContractError, match="there already"):
        write_checked(df, path)
