import collections

import corpus_pipeline as P
from hourglass.llm.common import saved
from hourglass.llm.mixing import mix
from tests_llm_texts import english, german

SF = "/root/testdata/sf0.001"


def test_stages_apply_their_decisions(spark):
    bench = [r.text for r in spark.read.parquet(f"{SF}/benchmark.parquet").limit(2).collect()]
    rows = [(i, english(i), "en", f"s{i % 3}") for i in range(40)] + [(100 + i, german(i), "de", "s1") for i in range(20)]
    rows += [(200, english(3), "en", "s0"), (201, english(4) + " extra", "en", "s0"), (202, "123 456", None, "s0"), (203, None, None, "s1"), (204, english(50) + "\n" + bench[0], "en", "s2"), (None, english(60), "en", None)]
    docs = spark.createDataFrame([(*r, len(r[1] or "")) for r in rows], "doc_id long, text string, lang string, source string, n_chars long")
    cols = docs.columns
    one = saved(P.language_id(spark, docs, SF))
    assert one.columns == cols and {r.doc_id for r in one.collect()} == {r[0] for r in rows} - {202, 203}
    two = saved(P.near_duplicates(spark, one, SF))
    assert two.columns == cols and {r.doc_id for r in two.collect()} == {r[0] for r in rows} - {200, 201, 202, 203}
    three = saved(P.decontaminate(spark, two, SF))
    assert three.columns == cols and {r.doc_id for r in three.collect()} == {r[0] for r in rows} - {200, 201, 202, 203, 204}
    four = saved(P.mix(spark, three, SF))
    want = {r.doc_id: r.copies for r in mix(three).collect()}
    assert four.columns == cols and collections.Counter(r.doc_id for r in four.collect()) == collections.Counter(want)
    five = P.shard(spark, four, SF)
    sizes = [r["count"] for r in five.groupBy("shard").count().collect()]
    assert five.columns == [*cols, "shard", "slot"] and sum(sizes) == four.count() and max(sizes) - min(sizes) <= 1


def test_empty_documents_pass_every_stage(spark):
    docs = spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long")
    for _, stage in P.STAGES:
        docs = saved(stage(spark, docs, SF))
    assert docs.count() == 0


def test_run_keeps_each_document_at_most_three_times(spark):
    got = P.run(spark, SF).groupBy("doc_id").count().toPandas()
    assert len(got) > 50 and got["count"].max() <= 3


def test_rows_are_judged_by_their_own_key(spark):
    bench = spark.read.parquet(f"{SF}/benchmark.parquet").first().text
    rows = [(None, english(1)), (None, english(1)), (None, english(1) + " extra"), (7, english(1))]  # three copies without an id
    rows += [(8, english(2)), (8, english(2))]  # id and text repeated
    rows += [(None, english(3)), (None, english(3))]  # no id in the group
    rows += [(9, english(4)), (9, english(5) + "\n" + bench)]  # one id, one of two texts unclean
    rows += [(None, english(6) + "\n" + bench), (10, english(5)), (3, english(4)), (None, None), (None, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    count = lambda d: collections.Counter((r.doc_id, r.text) for r in d.collect())
    two = saved(P.near_duplicates(spark, docs, SF))
    assert count(two) == collections.Counter([(7, english(1)), (8, english(2)), (None, english(3)), (3, english(4)), *rows[9:12], (None, None), (None, None)])
    three = P.decontaminate(spark, saved(docs), SF)
    assert count(three) == collections.Counter(r for r in rows if not (r[1] or "").endswith(bench))


def test_input_columns_may_have_any_name(spark):
    names = ["_row", "_doc", "_block", "t", "key", "item", "c", "label", "size", "shard", "slot", "source_size", "_plan", "lang", "source", "n_chars"]
    docs = spark.createDataFrame([(i, english(i % 9)) for i in range(30)], "doc_id long, text string")
    for n in names:
        docs = docs.selectExpr("*", f"CAST(doc_id % 3 AS STRING) AS `{n}`")
    for name, stage in P.STAGES:
        before, docs = docs.columns, saved(stage(spark, docs, SF))
        assert set(docs.columns) >= set(before), name
    assert docs.count() > 0
