"""The thin queries over the operators of this subpackage, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import decontaminate, hard_negatives, hmm, language_id, mixing, ngram_join, reputation, secrets, store, substring_dedup, token_output, topk, warc, yinyang


def _read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op5_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top_k(_read(spark, sf_dir, "embeddings"), k=10, every=100, scale=1024.0)


OP5_SQL = """
WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: floor(1024 * x::DOUBLE)::BIGINT) AS e FROM embeddings
           WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT q.vec_id AS query_id, c.vec_id, list_sum(list_transform(list_zip(q.e, c.e), lambda z: z[1] * z[2]))::BIGINT AS score
      FROM v q JOIN v c ON q.vec_id <> c.vec_id WHERE q.vec_id % 100 = 0),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s)
SELECT query_id, rank::INTEGER AS rank, vec_id, score FROM r WHERE rank <= 10
"""


URL_RULES = [("allow", "com/"), ("block", "example.com/en/"), ("allow", "www.example.com/en/"), ("block", "net/es/"), ("block", "net/fr/")]


def op6_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Page outcomes are the labels of the document of the same number: bad is toxic or of low quality."""
    labels = _read(spark, sf_dir, "labels")
    bad = F.greatest(F.col("toxic"), 1 - F.col("quality"))
    judged = reputation.filter_urls(_read(spark, sf_dir, "pages"), labels.select(F.col("doc_id").alias("page_id"), bad.alias("bad")), URL_RULES)
    return judged.select("page_id", "host", "path", "rule", "verdict")


OP6_SQL = r"""
WITH p AS (
  SELECT page_id,
         translate(coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)', 1), ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         coalesce(regexp_extract(url, '(?s)^.*?://[^/?#]*([^?#]*)', 1), '') AS path
  FROM pages),
l AS (SELECT doc_id, sum(CASE WHEN toxic = 1 OR quality = 0 THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END) AS bad, count(*)::DOUBLE AS seen
      FROM labels WHERE doc_id IS NOT NULL AND toxic IS NOT NULL AND quality IS NOT NULL GROUP BY doc_id),
h AS (SELECT host, list_reverse(string_split(host, '.'))[1] AS suffix,
             array_to_string(list_reverse(list_reverse(string_split(host, '.'))[1:2]), '.') AS domain,
             coalesce(sum(bad), 0.0::DOUBLE) AS bad, coalesce(sum(seen), 0.0::DOUBLE) AS seen
      FROM p LEFT JOIN l ON l.doc_id = p.page_id GROUP BY host),
d AS (SELECT domain, suffix, sum(bad) AS bad, sum(seen) AS seen FROM h GROUP BY domain, suffix),
s0 AS (SELECT suffix, sum(bad) AS bad, sum(seen) AS seen FROM d GROUP BY suffix),
s AS (SELECT *, (SELECT (sum(bad) + 1.0) / (sum(seen) + 2.0) FROM s0) AS m FROM s0),
sr AS (SELECT (sum(seen*seen*(bad/seen-m)*(bad/seen-m)) - sum(seen*m*(1-m))) / nullif(sum(seen*(seen-1)*m*(1-m)), 0) AS rho FROM s WHERE seen > 0),
sk AS (SELECT CASE WHEN rho IS NULL OR rho <= 0.0001 THEN 10000.0::DOUBLE ELSE greatest(1.0, least(10000.0, 1.0/rho - 1.0)) END AS k FROM sr),
sm AS (SELECT suffix, (bad + k*m) / (seen + k) AS mean FROM s, sk),
d1 AS (SELECT d.*, sm.mean AS m FROM d JOIN sm USING (suffix)),
dr AS (SELECT (sum(seen*seen*(bad/seen-m)*(bad/seen-m)) - sum(seen*m*(1-m))) / nullif(sum(seen*(seen-1)*m*(1-m)), 0) AS rho FROM d1 WHERE seen > 0),
dk AS (SELECT CASE WHEN rho IS NULL OR rho <= 0.0001 THEN 10000.0::DOUBLE ELSE greatest(1.0, least(10000.0, 1.0/rho - 1.0)) END AS k FROM dr),
dm AS (SELECT domain, (bad + k*m) / (seen + k) AS mean FROM d1, dk),
h1 AS (SELECT h.*, dm.mean AS m FROM h JOIN dm USING (domain)),
hr AS (SELECT (sum(seen*seen*(bad/seen-m)*(bad/seen-m)) - sum(seen*m*(1-m))) / nullif(sum(seen*(seen-1)*m*(1-m)), 0) AS rho FROM h1 WHERE seen > 0),
hk AS (SELECT CASE WHEN rho IS NULL OR rho <= 0.0001 THEN 10000.0::DOUBLE ELSE greatest(1.0, least(10000.0, 1.0/rho - 1.0)) END AS k FROM hr),
ab AS (SELECT host, bad + k*m AS a, seen - bad + k*(1.0-m) AS b FROM h1, hk),
low AS (SELECT host, a/(a+b) - 1.645*sqrt(a*b/((a+b)*(a+b)*(a+b+1.0))) AS low FROM ab),
r AS (SELECT * FROM (VALUES ('allow','com','/','com/'), ('block','example.com','/en/','example.com/en/'), ('allow','www.example.com','/en/','www.example.com/en/'),
      ('block','net','/es/','net/es/'), ('block','net','/fr/','net/fr/')) AS t(verdict, on_host, on_path, rule)),
best AS (SELECT p.page_id, p.host, p.path, arg_max(r.rule, length(r.rule)) AS rule, arg_max(r.verdict, length(r.rule)) AS verdict
         FROM p LEFT JOIN r ON (p.host = r.on_host OR ends_with(p.host, '.' || r.on_host)) AND starts_with(p.path, r.on_path)
         GROUP BY p.page_id, p.host, p.path)
SELECT page_id, host, path, rule, coalesce(verdict, CASE WHEN low > 0.5 THEN 'block' ELSE 'allow' END) AS verdict
FROM best JOIN low USING (host)
"""


def op1_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.round_trip(_read(spark, sf_dir, "pages"))


OP1_SQL = """
WITH p AS (SELECT page_id, octet_length(encode(coalesce(html, ''))) AS payload_bytes, sha1(coalesce(html, '')) AS payload_digest FROM pages),
m AS (SELECT *, max(page_id) OVER (PARTITION BY payload_digest, payload_bytes) AS kept FROM p)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN payload_bytes >= 1000 AND page_id <> kept THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN payload_bytes >= 1000 AND page_id <> kept THEN kept END AS refers_to
FROM m
"""


def token_vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


END_ID = 2


def op2_token_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = store.new_path(spark, "token-ids")
    token_output.write_tokens(_read(spark, sf_dir, "documents"), path, token_vocabulary(), END_ID)
    return token_output.read_digests(spark, path)


def op3_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.ngram_components(_read(spark, sf_dir, "documents"), n=5, near=75).drop("copies")


OP3_SQL = r"""
WITH RECURSIVE d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (SELECT DISTINCT doc_id, md5(array_to_string(list_slice(w, i, i + 4), ' ')) AS g FROM d, unnest(range(1, greatest(len(w) - 3, 2))) AS t(i) WHERE len(w) >= 1),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
p AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS k FROM s a JOIN s b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY 1, 2),
l AS (SELECT a, b FROM p JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * k >= 75 * (x.n + y.n - k)),
r AS (SELECT doc_id, doc_id AS root FROM d UNION SELECT l.b, r.root FROM r JOIN l ON l.a = r.doc_id)
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, c.component_id
FROM d LEFT JOIN n USING (doc_id) JOIN (SELECT doc_id, min(root) AS component_id FROM r GROUP BY 1) c USING (doc_id)
"""


def op4_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = substring_dedup.remove_repeats(_read(spark, sf_dir, "documents"), window=20)
    return found.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


OP4_SQL = r"""
WITH d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
k AS (SELECT doc_id, i, md5(array_to_string(list_slice(w, i, i + 19), ' ')) AS h FROM d, unnest(range(1, len(w) - 18)) AS t(i) WHERE len(w) >= 20),
again AS (SELECT doc_id, i FROM (SELECT *, row_number() OVER (PARTITION BY h ORDER BY doc_id, i) AS r FROM k) WHERE r > 1),
gone AS (SELECT DISTINCT doc_id, i + j AS i FROM again, unnest(range(0, 20)) AS t(j)),
x AS (SELECT doc_id, unnest(w) AS word, generate_subscripts(w, 1) AS i FROM d),
kept AS (SELECT x.doc_id, count(*) FILTER (WHERE gone.i IS NOT NULL) AS n_removed, string_agg(word, ' ' ORDER BY x.i) FILTER (WHERE gone.i IS NULL) AS t FROM x LEFT JOIN gone ON gone.doc_id = x.doc_id AND gone.i = x.i GROUP BY 1)
SELECT d.doc_id, len(w)::BIGINT AS n_words, coalesce(n_removed, 0) AS n_removed, sha256(coalesce(t, '')) AS kept_sha256 FROM d LEFT JOIN kept USING (doc_id)
"""


OP7_SQL = r"""
WITH d AS (SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size, substr(md5(coalesce(CAST(doc_id AS VARCHAR), '') || ':' || coalesce(text, '')), 1, 15) AS h FROM documents),
s AS (SELECT source, sum(size)::BIGINT AS source_size FROM d GROUP BY source),
w AS (SELECT *, row_number() OVER (ORDER BY source IS NULL, source) - 1 AS n FROM s),
v AS (SELECT *, (1 + n % 3)::DOUBLE AS wt, source_size * 3.0::DOUBLE AS cap, source_size * 3.0::DOUBLE / (1 + n % 3)::DOUBLE AS ratio FROM w),
q AS (SELECT *, (sum(source_size) OVER ())::DOUBLE AS total, coalesce(sum(cap) OVER b, 0.0::DOUBLE) AS capped, sum(wt) OVER () - coalesce(sum(wt) OVER b, 0.0::DOUBLE) AS rest FROM v WINDOW b AS (ORDER BY ratio, n ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
f AS (SELECT arg_min((total - capped) / rest, ratio) FILTER (WHERE ratio > (total - capped) / rest) AS level FROM q),
t AS (SELECT source, source_size, least(coalesce(level * wt, cap), cap) AS target FROM q, f),
c AS (SELECT d.*, t.source_size, t.target, floor(CASE WHEN t.source_size > 0 THEN t.target / t.source_size ELSE 0.0 END) AS whole FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source),
e AS (SELECT *, target - whole * source_size AS budget, sum(size) OVER (PARTITION BY source ORDER BY h) AS upto, sum(size) OVER (PARTITION BY source, h) AS own FROM c)
SELECT doc_id, size, source_size, target, (size * (whole + CASE WHEN whole < 3 AND (upto <= budget OR (upto - own <= budget AND upto - budget < budget - (upto - own))) THEN 1 ELSE 0 END))::BIGINT AS taken FROM e
"""


def op7_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_sources(_read(spark, sf_dir, "documents")).drop("repeats")


def op8_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _read(spark, sf_dir, "documents")
    model = language_id.train(language_id.training_rows(docs))
    return language_id.identify(docs, model).select("doc_id", "held_out", "lang_pred", "score", "ambiguous")


def op9_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Only documents that hold a benchmark passage have rows: one for each item."""
    return decontaminate.find_leaks(_read(spark, sf_dir, "documents"), _read(spark, sf_dir, "benchmark"))


def op10_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every candidate of every document; a document's path is its source."""
    words = token_vocabulary()
    model = secrets.train(secrets.example_findings(spark), vocabulary=words)
    return secrets.scan(_read(spark, sf_dir, "documents"), model, path="source", vocabulary=words)


def op11_codebooks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return yinyang.encode(_read(spark, sf_dir, "embeddings"), parts=16, entries=64, rounds=2, scale=256.0).drop("looked")


OP11_SQL = """
WITH v AS (SELECT vec_id, label, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS e FROM embeddings
           WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
p AS (SELECT vec_id, label, j AS part, list_slice(e, j * len(e) // 16 + 1, (j + 1) * len(e) // 16) AS x FROM v, unnest(range(16)) AS t(j)),
c0 AS (SELECT part, n - 1 AS entry, x AS c FROM (SELECT *, row_number() OVER (PARTITION BY part ORDER BY vec_id) AS n FROM p) WHERE n <= 64),
a1 AS MATERIALIZED (SELECT p.vec_id, p.part, any_value(p.x) AS x, min({'d': list_sum(list_transform(list_zip(x, c), lambda z: (z[1] - z[2]) * (z[1] - z[2])))::BIGINT, 'entry': entry}) AS best FROM p JOIN c0 USING (part) GROUP BY 1, 2),
m1 AS (SELECT part, entry, list((s - ((s % n) + n) % n) // n ORDER BY i) AS c FROM (SELECT part, best.entry AS entry, i, sum(x[i])::BIGINT AS s, count(*) AS n FROM a1, unnest(range(1, len(x) + 1)) AS t(i) GROUP BY 1, 2, 3) GROUP BY 1, 2),
c1 AS MATERIALIZED (SELECT part, entry, coalesce(m1.c, c0.c) AS c FROM c0 LEFT JOIN m1 USING (part, entry)),
a2 AS MATERIALIZED (SELECT p.vec_id, p.part, any_value(p.x) AS x, min({'d': list_sum(list_transform(list_zip(x, c), lambda z: (z[1] - z[2]) * (z[1] - z[2])))::BIGINT, 'entry': entry}) AS best FROM p JOIN c1 USING (part) GROUP BY 1, 2),
m2 AS (SELECT part, entry, list((s - ((s % n) + n) % n) // n ORDER BY i) AS c FROM (SELECT part, best.entry AS entry, i, sum(x[i])::BIGINT AS s, count(*) AS n FROM a2, unnest(range(1, len(x) + 1)) AS t(i) GROUP BY 1, 2, 3) GROUP BY 1, 2),
c2 AS MATERIALIZED (SELECT part, entry, coalesce(m2.c, c1.c) AS c FROM c1 LEFT JOIN m2 USING (part, entry)),
a3 AS (SELECT p.vec_id, any_value(p.label) AS label, p.part, min({'d': list_sum(list_transform(list_zip(x, c), lambda z: (z[1] - z[2]) * (z[1] - z[2])))::BIGINT, 'entry': entry}) AS best FROM p JOIN c2 USING (part) GROUP BY p.vec_id, p.part),
r AS (SELECT vec_id, any_value(label) AS label, string_agg(format('{:02x}', best.entry), '' ORDER BY part) AS code, sum(best.d)::BIGINT AS error FROM a3 GROUP BY vec_id),
h AS (SELECT sha256(string_agg(array_to_string(c, ','), ',' ORDER BY part, entry)) AS codebooks_sha256 FROM c2)
SELECT vec_id, label, code, error, (sum(error) OVER (PARTITION BY label))::BIGINT AS label_error, codebooks_sha256 FROM r, h
"""


def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives.mine(_read(spark, sf_dir, "embeddings"), label, every=50, scale=256.0, positives=5, k=3, low=50, high=95).drop("positive_rank")


OP12_SQL = """
WITH v AS (SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS e FROM embeddings
           WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS MATERIALIZED (SELECT a.vec_id AS anchor_id, c.vec_id, a.label = c.label AS same, list_sum(list_transform(list_zip(a.e, c.e), lambda z: z[1] * z[2]))::BIGINT AS score
      FROM v a JOIN v c ON a.vec_id <> c.vec_id WHERE a.vec_id % 50 = 0),
p AS (SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM (SELECT *, row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) AS n FROM s WHERE same) WHERE n <= 5),
r AS (SELECT p.*, s.vec_id AS negative_id, s.score AS negative_score, row_number() OVER (PARTITION BY p.anchor_id, positive_id ORDER BY s.score DESC, s.vec_id) AS rank
      FROM p JOIN s ON s.anchor_id = p.anchor_id AND NOT s.same AND 50 * positive_score <= 100 * s.score AND 100 * s.score <= 95 * positive_score)
SELECT anchor_id, positive_id, rank::INTEGER AS rank, negative_id, positive_score, negative_score FROM r WHERE rank <= 3
"""


def op13_hmm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hmm.score(_read(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_warc": op1_warc,
    "op2_token_ids": op2_token_ids,
    "op3_ngram_join": op3_ngram_join,
    "op4_substring_dedup": op4_substring_dedup,
    "op5_topk": op5_topk,
    "op6_url_filters": op6_url_filters,
    "op7_mixing": op7_mixing,
    "op8_language_id": op8_language_id,
    "op9_decontamination": op9_decontamination,
    "op10_secrets": op10_secrets,
    "op11_codebooks": op11_codebooks,
    "op12_hard_negatives": op12_hard_negatives,
    "op13_hmm": op13_hmm,
}

ORACLES: dict[str, str] = {
    "op1_warc": OP1_SQL,
    "op3_ngram_join": OP3_SQL,
    "op4_substring_dedup": OP4_SQL,
    "op5_topk": OP5_SQL,
    "op6_url_filters": OP6_SQL,
    "op7_mixing": OP7_SQL,
    "op11_codebooks": OP11_SQL,
    "op12_hard_negatives": OP12_SQL,
}
