"""The queries opN_<name> over the driver's tables, and their DuckDB twins."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hourglass.llm import archives, centroids, decontam, jaccard, langid, linededup, mixing, passages, sharding, topk, toxicity, urlrules, whitening
from hourglass.llm.common import shared_path, table
from hourglass.session import configure

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            configure(spark)
            return fn(spark, sf_dir)

        QUERIES[name] = run
        if sql:
            ORACLE[name] = sql
        return fn

    return deco


@register(
    "op2_warc",
    """
    WITH p AS (SELECT page_id, encode(coalesce(html, '')) AS b FROM pages),
    q AS (SELECT page_id, octet_length(b)::BIGINT AS payload_bytes, sha1(b) AS h FROM p),
    digits AS (SELECT page_id, payload_bytes, h, max(page_id) OVER (PARTITION BY h, payload_bytes) AS top FROM q),
    coded AS (
        SELECT page_id, payload_bytes, top,
               string_agg(substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + (('0x' || substr(h, 1 + 5 * g, 5))::BIGINT >> (5 * (3 - k)))::INT % 32, 1), '' ORDER BY g, k) AS payload_digest
        FROM digits, range(8) t(g), range(4) u(k) GROUP BY ALL)
    SELECT page_id, payload_bytes, payload_digest, CASE WHEN page_id = top THEN 'response' ELSE 'revisit' END AS record_type,
           CASE WHEN page_id = top THEN NULL ELSE top END AS refers_to
    FROM coded
    """,
)
def op2_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages to ARC files of both versions (by the parity of the id), those to WARC, and back."""
    pages = table(spark, sf_dir, "pages")
    arcs = [shared_path(spark, "arc") for _ in range(2)]
    odd = F.coalesce(F.col("page_id") % 2 != 0, F.lit(False))
    archives.write_arc(pages.filter(~odd), arcs[0], version=1)
    archives.write_arc(pages.filter(odd), arcs[1], version=2)
    out = shared_path(spark, "warc")
    archives.to_warc(archives.read_arc(spark, *arcs), out, index=archives.arc_index(spark, *arcs))
    records = archives.read_warc(spark, out).drop("http", "payload")
    # A response may stand for a third of all pages: its row is repeated by salt.
    target = records.filter("record_type = 'response'").select(F.col("record_id").alias("refers_to_id"), F.col("page_id").alias("refers_to"), F.explode(F.sequence(F.lit(0), F.lit(15))).alias("salt"))
    revisits = records.filter("record_type = 'revisit'").withColumn("salt", F.pmod(F.xxhash64("record_id"), F.lit(16)).cast("int"))
    cols = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]
    plain = records.filter("record_type <> 'revisit'").withColumn("refers_to", F.lit(None).cast("long"))
    return plain.select(cols).unionByName(revisits.join(target, ["refers_to_id", "salt"]).select(cols))


_MIX_SQL = r"""
WITH RECURSIVE k AS (SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size,
                  md5(coalesce(doc_id::VARCHAR, '-') || '|' || md5(coalesce(text, '')) || '|' || coalesce(source, '-')) AS k FROM documents),
d AS (SELECT doc_id, source, size, ('0x' || substr(md5(k || '|' || row_number() OVER (PARTITION BY k)), 1, 15))::BIGINT AS h FROM k),
t AS (SELECT source, sum(size)::DOUBLE AS s, [5.0, 2.0, 1.0][(row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1]::DOUBLE AS w FROM d GROUP BY source),
r AS (SELECT sum(s) AS budget, sum(w) AS free, 0::BIGINT AS capped, -1::BIGINT AS before FROM t
      UNION ALL
      SELECT g.total - 3 * g.cs, g.wall - g.cw, g.n, g.capped
      FROM (SELECT (SELECT sum(s) FROM t) AS total, (SELECT sum(w) FROM t) AS wall, r.capped,
                   coalesce((SELECT sum(s) FROM t WHERE w * r.budget / r.free > 3 * s), 0) AS cs,
                   coalesce((SELECT sum(w) FROM t WHERE w * r.budget / r.free > 3 * s), 0) AS cw,
                   (SELECT count(*) FROM t WHERE w * r.budget / r.free > 3 * s) AS n
            FROM r WHERE r.capped <> r.before) g WHERE g.n <> g.capped),
f AS (SELECT budget, free FROM r ORDER BY capped DESC LIMIT 1),
g AS (SELECT source, s, CASE WHEN w * budget / free > 3 * s THEN 3 * s ELSE w * budget / free END AS target FROM t, f),
e AS (SELECT *, CASE WHEN s > 0 THEN floor(target / s) ELSE 0 END AS whole FROM g),
c AS (SELECT d.*, e.s, e.target, e.whole, greatest(0.0, e.target - e.whole * e.s) AS rest,
             sum(size) OVER (PARTITION BY d.source ORDER BY h)::DOUBLE AS upto FROM d JOIN e ON d.source IS NOT DISTINCT FROM e.source),
b AS (SELECT *, coalesce(max(upto) OVER (PARTITION BY source ORDER BY h RANGE BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS below FROM c)
SELECT doc_id, size, s::BIGINT AS source_size, target::DOUBLE AS target,
       (size * (whole + CASE WHEN upto < rest OR (below < rest AND upto >= rest AND upto - rest < rest - below) THEN 1 ELSE 0 END))::BIGINT AS taken
FROM b
"""


@register("op3_mixing", _MIX_SQL)
def op3_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = mixing.mix(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "size", "source_size", "target", "taken")


@register("op4_sharding")
def op4_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = sharding.shard(table(spark, sf_dir, "documents"), shards=8)
    return out.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


@register(
    "op7_topk",
    """
    WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: floor(1024 * x::DOUBLE)) AS e, row_number() OVER () AS r FROM embeddings
               WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
    s AS (SELECT q.vec_id AS query_id, q.r, p.vec_id, list_inner_product(q.e, p.e)::BIGINT AS score FROM v q JOIN v p ON q.r <> p.r WHERE q.vec_id % 100 = 0),
    k AS (SELECT *, row_number() OVER (PARTITION BY r ORDER BY score DESC, vec_id)::INT AS rank FROM s)
    SELECT query_id, rank, vec_id, score FROM k WHERE rank <= 10
    """,
)
def op7_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "embeddings").filter(topk.valid(F.col("embedding")))
    return topk.top_k(rows.select("vec_id", topk.quantized(F.col("embedding")).alias("embedding")), F.col("vec_id") % 100 == 0, k=10)


@register("op10_suffix")
def op10_suffix(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = passages.repeated_passages(table(spark, sf_dir, "documents"), length=200)
    return out.select(F.col("doc_id").cast("long"), "n_bytes", "n_removed", "n_spans", "kept_sha256")


def _crc(mod: int):
    return F.crc32(F.encode(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), "UTF-8")) % mod


def language_model(docs: DataFrame) -> langid.Model:
    """A calibrated model of the documents whose id hash does not hold them out."""
    train = docs.filter(_crc(3) != 1)
    return langid.calibrate(langid.fit(train), train)


@register("op5_langid")
def op5_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    out = langid.identify(docs, language_model(docs))
    return out.select("doc_id", (_crc(3) == 1).alias("held_out"), "lang_pred", "score", "cross_entropy", "rejected")


@register("op6_toxicity")
def op6_toxicity(spark: SparkSession, sf_dir: str, train_rows: int = 4000) -> DataFrame:
    """Fitted on at most ``train_rows`` labelled documents of each label: the ones
    with the least id hashes, found before any text is read.  A document with labels
    that disagree is toxic."""
    docs = table(spark, sf_dir, "documents")
    held = F.crc32(F.encode(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), "UTF-8")) % 4 == 2
    labels = table(spark, sf_dir, "labels").filter("doc_id is not null and toxic in (0, 1)").filter(~held).groupBy("doc_id").agg(F.max("toxic").alias("label"))
    ids = [labels.filter(F.col("label") == k).orderBy(F.xxhash64("doc_id"), "doc_id").limit(train_rows) for k in (0, 1)]
    train = docs.select("doc_id", "text").join(F.broadcast(ids[0].unionByName(ids[1])), "doc_id")  # at most 2 * train_rows rows
    out = toxicity.score(docs, toxicity.fit(train))
    return out.select("doc_id", held.alias("held_out"), "score", "predicted", "worst_word")


@register(
    "op8_jaccard",
    r"""
    WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all(lower(text), '[0-9a-z_\x{80}-\x{10FFFF}]+') AS w FROM documents),
    s AS (SELECT doc_id, CASE WHEN len(w) >= 5 THEN list_distinct(list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')))
                              WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END AS s FROM w),
    z AS (SELECT doc_id, len(s)::BIGINT AS n FROM s),
    g AS (SELECT doc_id, unnest(s) AS g FROM s),
    p AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM g a JOIN g b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY ALL),
    e AS (SELECT a, b FROM p JOIN z x ON x.doc_id = a JOIN z y ON y.doc_id = b WHERE c >= 0.8 * (x.n + y.n - c) - 1e-9),
    r AS (SELECT a, b FROM e UNION SELECT r.a, e.b FROM r JOIN e ON r.b = e.a)
    SELECT z.doc_id, least(z.doc_id, (SELECT min(b) FROM r WHERE r.a = z.doc_id)) AS class_id, (SELECT count(*) FROM e WHERE e.a = z.doc_id) AS n_links, n AS n_grams
    FROM z
    """,
)
def op8_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = jaccard.jaccard_join(table(spark, sf_dir, "documents"), n=5, threshold=0.8)
    return out.select("doc_id", "class_id", "n_links", "n_grams")


@register(
    "op1_linededup",
    r"""
    WITH l AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) - 1 AS place FROM documents WHERE text IS NOT NULL),
    f AS (SELECT * FROM l WHERE regexp_matches(line, '[^\x20\x09-\x0D]')),
    d AS (SELECT line, min((doc_id, place)) AS pos, length(line) AS n FROM f GROUP BY line),
    k AS (SELECT *, m, unnest([(m, 'p' || left(line, m // 2)), (m, 's' || right(line, m - m // 2))]) AS key FROM d, LATERAL (SELECT unnest([n, n - 1]) AS m)),
    p AS (SELECT DISTINCT x.line AS line, y.line AS other FROM k x JOIN k y ON x.key = y.key AND y.pos < x.pos AND abs(x.n - y.n) <= 1),
    -- levenshtein() counts bytes here, of which an edited character has up to 4: the edit is looked for by character
    near AS (SELECT DISTINCT line FROM p WHERE levenshtein(line, other) <= 4 AND len(list_filter(range(greatest(length(line), length(other))), lambda i:
        CASE WHEN length(line) = length(other) THEN left(line, i) || substr(line, i + 2) = left(other, i) || substr(other, i + 2)
             WHEN length(line) > length(other) THEN left(line, i) || substr(line, i + 2) = other ELSE left(other, i) || substr(other, i + 2) = line END)) > 0),
    g AS (SELECT f.doc_id, f.place FROM f JOIN d USING (line) WHERE d.pos <> (f.doc_id, f.place) OR line IN (SELECT line FROM near)),
    r AS (SELECT doc_id, count(*) AS n_removed, string_agg(place::VARCHAR, ',' ORDER BY place) AS removed FROM g GROUP BY doc_id)
    SELECT doc_id, coalesce(len(string_split(text, chr(10))), 0)::BIGINT AS n_lines, coalesce(n_removed, 0)::BIGINT AS n_removed, coalesce(removed, '') AS removed
    FROM documents LEFT JOIN r USING (doc_id)
    """,
)
def op1_linededup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = linededup.line_decisions(table(spark, sf_dir, "documents"), edits=1)
    return out.select("doc_id", "n_lines", F.size("removed").cast("long").alias("n_removed"), F.array_join("removed", ",").alias("removed"))


@register("op9_decontam")
def op9_decontam(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


#: The rules of the url filter: host, path, verdict.
URL_RULES = [("com", "/", "allow"), ("example.com", "/en/", "block"), ("www.example.com", "/en/", "allow"), ("net", "/es/", "block"), ("net", "/fr/", "block")]


@register(
    "op13_urlfilter",
    """
    WITH u AS (SELECT row_number() OVER () AS r, page_id, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages),
    p AS (SELECT r, page_id, translate(regexp_extract(rest, '^([^/?#]*)([^?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
                 regexp_extract(rest, '^([^/?#]*)([^?#]*)', 2) AS path FROM u),
    rules(rh, rp, v) AS (VALUES %s),
    m AS (SELECT p.*, rh || rp AS rule, v, row_number() OVER (PARTITION BY r ORDER BY length(rh || rp) DESC, length(rh) DESC) AS k
          FROM p LEFT JOIN rules ON (host = rh OR ends_with(host, '.' || rh)) AND starts_with(path, rp))
    SELECT page_id, host, path, rule, coalesce(v, 'allow') AS verdict FROM m WHERE k = 1
    """
    % ", ".join(map(str, URL_RULES)),
)
def op13_urlfilter(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = spark.createDataFrame(URL_RULES, "host string, path string, verdict string")
    return urlrules.judge(table(spark, sf_dir, "pages"), rules)


def _cluster_sql(k: int, rounds: int, dims: int, scale: int) -> str:
    """The rounds written out: c0, m0 (distance * k + centroid, least by vector), c1, m1, ..."""
    square = "list_sum(list_transform(list_zip(v.e, c.e), lambda z: (z[1] - z[2]) * (z[1] - z[2])))::BIGINT"
    parts = [
        f"""v AS MATERIALIZED (SELECT row_number() OVER () AS r, vec_id, list_transform(embedding, lambda x: floor({scale} * x::DOUBLE)::BIGINT) AS e FROM embeddings
        WHERE embedding IS NOT NULL AND len(embedding) = {dims} AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0)""",
        f"""c0 AS MATERIALIZED (SELECT (row_number() OVER (ORDER BY h, e) - 1)::INT AS c, e FROM (SELECT sha256('1:' || coalesce(vec_id::VARCHAR, '')) AS h, e FROM v ORDER BY h, e LIMIT {k}))""",
    ]
    for i in range(rounds + 1):
        parts.append(f"m{i} AS MATERIALIZED (SELECT v.r, min({square} * {k} + c.c) AS m FROM v, c{i} AS c GROUP BY v.r)")
        if i < rounds:
            parts.append(f"""c{i + 1} AS MATERIALIZED (SELECT o.c, coalesce(n.e, o.e) AS e FROM c{i} AS o LEFT JOIN (
            SELECT c, list(((s - ((s % n) + n) % n) // n)::BIGINT ORDER BY i) AS e FROM (
                SELECT (m.m % {k})::INT AS c, i, sum(v.e[i])::BIGINT AS s, count(*) AS n FROM m{i} AS m JOIN v USING (r), range(1, {dims + 1}) t(i) GROUP BY ALL) GROUP BY c) n USING (c))""")
    return f"""
    WITH {", ".join(parts)},
    a AS (SELECT r, (m % {k})::INT AS cluster, m // {k} AS distance FROM m{rounds})
    SELECT vec_id, cluster, distance, (sum(distance) OVER (PARTITION BY cluster))::BIGINT AS cluster_inertia, (sum(distance) OVER ())::BIGINT AS inertia,
           sha256(array_to_string(list_transform(c.e, lambda x: x::VARCHAR), ',')) AS centroid_sha256
    FROM a JOIN v USING (r) JOIN c{rounds} AS c ON c.c = cluster
    """


@register("op11_centroids", _cluster_sql(k=16, rounds=3, dims=64, scale=64))
def op11_centroids(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = centroids.cluster(table(spark, sf_dir, "embeddings"), k=16, rounds=3, dims=64, scale=64)
    return out.withColumn("centroid_sha256", centroids.centroid_digest(F.col("centroid"))).drop("centroid")


@register("op12_whitening")
def op12_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(table(spark, sf_dir, "embeddings"), components=8, scale=1024, add=100_000)
