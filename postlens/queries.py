"""The operators over the driver's tables, each with SQL for comparison where SQL can say it.

Tables stand in for the library's entities: ``documents`` are postings (platform
= source, company = source/lang, title = first line), ``events`` are daily
sightings of identities (event_type, user_id), ``orders`` and ``lineitem`` are
snapshots and what they are reconciled with.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .functions import text as X
from .operators import classify, clean, evidence, health, lifecycle, ops, quality, report, scoring, trends
from .operators.ontology import LATIN_TAGS
from .plans.cut import cut

c = F.col
Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None) -> Callable[[Query], Query]:
    def add(f: Query) -> Query:
        QUERIES[f.__name__] = f
        if sql:
            ORACLES[f.__name__] = sql
        return f

    return add


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def postings(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = read(spark, sf_dir, "documents")
    return d.select(
        c("doc_id").alias("row_number"), c("source").alias("platform"), c("doc_id").cast("string").alias("job_id"), F.concat_ws("/", "source", "lang").alias("company"),
        F.split_part("text", F.lit("\n"), F.lit(1)).alias("title"), c("text").alias("description"), F.lit("").alias("requirements"), F.lit("").alias("location"), F.lit("").alias("url"),
    )


RULES = "(VALUES " + ", ".join("('{}', '{}')".format(n, p.replace("'", "''")) for n, p in LATIN_TAGS) + ") AS r(name, pattern)"
POSTINGS = "p AS (SELECT doc_id AS row_number, source AS platform, CAST(doc_id AS VARCHAR) AS job_id, source || '/' || lang AS company, split_part(text, chr(10), 1) AS title, text AS description, lang FROM documents)"


@query(f"SELECT name, count(*) AS n, count(*)::DOUBLE / (SELECT count(*) FROM documents) AS share FROM documents, {RULES} WHERE regexp_matches(text, pattern) GROUP BY name")
def tag_ranking(spark, sf_dir):
    rows = postings(spark, sf_dir).withColumn("tags", X.tags(c("description"), LATIN_TAGS))
    return report.ranking(rows, "tags").select("name", "n", "share")


@query(f"WITH {POSTINGS} SELECT name AS tag, count(*) AS mentions, count(DISTINCT company) AS companies FROM p, {RULES} WHERE regexp_matches(description, pattern) GROUP BY name")
def tag_company_breadth(spark, sf_dir):
    return trends.tag_breadth(postings(spark, sf_dir).withColumn("skill_tags", X.tags(c("description"), LATIN_TAGS)))


@query(f"SELECT name, doc_id FROM documents, {RULES} WHERE regexp_matches(text, pattern)")
def tag_rows(spark, sf_dir):
    rules = spark.createDataFrame(list(LATIN_TAGS), "name string, pattern string")
    return X.tag_rows(read(spark, sf_dir, "documents"), "text", rules).select("name", "doc_id")


@query("""WITH j AS (SELECT d.*, l.quality, l.toxic FROM documents d LEFT JOIN labels l USING (doc_id))
SELECT 'text' AS field, count(*) FILTER (WHERE text IS NULL OR trim(text) = '') AS n FROM j UNION ALL
SELECT 'lang', count(*) FILTER (WHERE lang IS NULL OR trim(lang) = '') FROM j UNION ALL
SELECT 'quality', count(*) FILTER (WHERE quality IS NULL) FROM j UNION ALL SELECT 'toxic', count(*) FILTER (WHERE toxic IS NULL) FROM j""")
def missing_values(spark, sf_dir):
    rows = read(spark, sf_dir, "documents").join(read(spark, sf_dir, "labels"), "doc_id", "left")
    return quality.missing_values(rows, ("text", "lang", "quality", "toxic"))


@query("SELECT doc_id FROM documents WHERE length(regexp_replace(text, '^\\s+|\\s+$', '', 'g')) < 50")
def short_texts(spark, sf_dir):
    return quality.short_texts(read(spark, sf_dir, "documents"), ("text",)).select("doc_id")


@query("SELECT page_id FROM pages WHERE html IS NULL OR regexp_replace(html, '^\\s+|\\s+$', '', 'g') = ''")
def empty_texts(spark, sf_dir):
    return quality.empty_texts(read(spark, sf_dir, "pages"), ("html",)).select("page_id")


@query(f"""WITH {POSTINGS} SELECT lower(regexp_replace(company, '\\s+', ' ', 'g')) AS company, lower(regexp_replace(regexp_replace(title, '^\\s+|\\s+$', '', 'g'), '\\s+', ' ', 'g')) AS title,
count(*) AS n, min(row_number) AS first_row, count(*) - 1 AS extra FROM p WHERE trim(title) <> '' GROUP BY 1, 2 HAVING count(*) > 1""")
def duplicate_groups(spark, sf_dir):
    return quality.duplicate_groups(postings(spark, sf_dir), ["company", "title"], "row_number")


@query("SELECT sha256(text) AS content_sha256, count(*) AS n, min(doc_id) AS first FROM documents GROUP BY 1")
def content_groups(spark, sf_dir):
    return report.content_groups(read(spark, sf_dir, "documents").withColumn("content_sha256", F.sha2("text", 256)), order="doc_id")


@query("SELECT doc_id, CASE WHEN doc_id <> min(doc_id) OVER (PARTITION BY text) THEN min(doc_id) OVER (PARTITION BY text) END AS duplicate_of FROM documents")
def first_occurrences(spark, sf_dir):
    return report.first_occurrences(read(spark, sf_dir, "documents"), F.sha2("text", 256), "doc_id").select("doc_id", "duplicate_of")


@query("SELECT platform, job_id FROM (SELECT source AS platform, CAST(doc_id AS VARCHAR) AS job_id, row_number() OVER (PARTITION BY source ORDER BY doc_id) AS k FROM documents) WHERE k <= 2")
def samples_per_platform(spark, sf_dir):
    return quality.samples(postings(spark, sf_dir), "platform", "row_number", 2).select("platform", "job_id")


@query("SELECT page_id, regexp_matches(trim(url), '^[hH][tT][tT][pP][sS]?://[^/?#]+') AS valid FROM pages")
def url_validity(spark, sf_dir):
    return read(spark, sf_dir, "pages").select("page_id", quality.valid_http_url(c("url")).alias("valid"))


@query("""SELECT coalesce(a.k, b.k) AS orderkey, coalesce(a.n, 0) AS left_rows, coalesce(b.n, 0) AS right_rows, coalesce(a.n, 0) = coalesce(b.n, 0) AS agree
FROM (SELECT o_orderkey k, count(*) n FROM orders GROUP BY 1) a FULL JOIN (SELECT l_orderkey k, count(*) n FROM lineitem GROUP BY 1) b ON a.k = b.k""")
def reconcile(spark, sf_dir):
    return quality.reconcile(read(spark, sf_dir, "orders").select(c("o_orderkey").alias("orderkey")), read(spark, sf_dir, "lineitem").select(c("l_orderkey").alias("orderkey")), ["orderkey"])


@query("""SELECT k AS orderkey, 'left' AS side FROM (SELECT o_orderkey k FROM orders EXCEPT ALL SELECT l_orderkey FROM lineitem) UNION ALL
SELECT k, 'right' FROM (SELECT l_orderkey k FROM lineitem EXCEPT ALL SELECT o_orderkey FROM orders)""")
def multiset_difference(spark, sf_dir):
    return ops.multiset_difference(read(spark, sf_dir, "orders").select(c("o_orderkey").alias("orderkey")), read(spark, sf_dir, "lineitem").select(c("l_orderkey").alias("orderkey")))


ENUMS = {"o_orderstatus": (["O", "F"], [""], []), "o_orderpriority": (["1-URGENT", "2-HIGH", "3-MEDIUM"], [""], ["5-LOW"])}
STATUS = """e AS (SELECT CAST(extract(year FROM o_orderdate) AS VARCHAR) AS platform, CAST(o_orderkey AS VARCHAR) AS job_id, 'o_orderstatus' AS field, o_orderstatus AS raw_value,
  CASE WHEN o_orderstatus = '' THEN 'missing' WHEN o_orderstatus IN ('O','F') THEN 'known' ELSE 'unknown' END AS status FROM orders UNION ALL
  SELECT CAST(extract(year FROM o_orderdate) AS VARCHAR), CAST(o_orderkey AS VARCHAR), 'o_orderpriority', o_orderpriority,
  CASE WHEN o_orderpriority = '' THEN 'missing' WHEN o_orderpriority IN ('1-URGENT','2-HIGH','3-MEDIUM') THEN 'known' WHEN o_orderpriority = '5-LOW' THEN 'invalid_format' ELSE 'unknown' END FROM orders)"""


def _enum_orders(spark, sf_dir):
    o = read(spark, sf_dir, "orders")
    return o.select(F.year("o_orderdate").cast("string").alias("platform"), c("o_orderkey").cast("string").alias("job_id"), F.concat(F.lit("u"), "o_orderkey").alias("url"), *ENUMS)


@query(f"WITH {STATUS} SELECT platform, field, raw_value, status, count(*) AS n, min(job_id) AS first_sample FROM e GROUP BY 1, 2, 3, 4")
def enum_histogram(spark, sf_dir):
    rows = quality.enum_histogram(_enum_orders(spark, sf_dir), ENUMS)
    return rows.select("platform", "field", "raw_value", "status", "n", F.element_at("samples", 1).alias("first_sample"))


@query(f"WITH {STATUS} SELECT platform, field, raw_value, status, count(*) AS n, 'u' || min(job_id) AS url FROM e WHERE status NOT IN ('known', 'missing') GROUP BY 1, 2, 3, 4")
def enum_exceptions(spark, sf_dir):
    return quality.enum_exceptions(_enum_orders(spark, sf_dir), ENUMS)


@query(f"""WITH {STATUS}, a AS (SELECT field, count(*) AS rows, count(*) FILTER (WHERE status = 'known') AS known, count(*) FILTER (WHERE status = 'missing') AS missing,
count(*) FILTER (WHERE status = 'unknown') AS unknown, count(*) FILTER (WHERE status LIKE 'invalid%') AS invalid FROM e GROUP BY field)
SELECT *, missing::DOUBLE / rows AS missing_rate, unknown > 0 AS blocking FROM a""")
def enum_health(spark, sf_dir):
    return quality.enum_health(_enum_orders(spark, sf_dir), ENUMS)


@query("SELECT n_name AS place, c_mktsegment AS company, count(*) AS n FROM customer JOIN nation ON c_nationkey = n_nationkey GROUP BY 1, 2")
def place_companies(spark, sf_dir):
    rows = read(spark, sf_dir, "customer").join(read(spark, sf_dir, "nation"), c("c_nationkey") == c("n_nationkey"))
    return clean.place_companies(rows.select(F.array("n_name").alias("city_norm"), c("c_mktsegment").alias("company")))


@query("SELECT p_brand AS company, p_type AS value, count(*) AS n FROM part GROUP BY 1, 2")
def company_values(spark, sf_dir):
    return clean.company_values(read(spark, sf_dir, "part").select(c("p_brand").alias("company"), "p_type"), "p_type")


@query("SELECT doc_id FROM documents WHERE source = 'src1' OR (source = 'src2' AND source || '/' || lang IN ('src2/en', 'src2/de'))")
def scope_filter(spark, sf_dir):
    scope = spark.createDataFrame([("src1", None), ("src2", ["src2/en", "src2/de"])], "platform string, companies array<string>")
    return clean.in_scope(postings(spark, sf_dir), scope).select(c("row_number").alias("doc_id"))


@query("SELECT DISTINCT n_name AS name FROM nation WHERE n_nationkey NOT IN (SELECT s_nationkey FROM supplier WHERE s_acctbal > 8000)")
def names_missing(spark, sf_dir):
    nation = read(spark, sf_dir, "nation")
    seen = read(spark, sf_dir, "supplier").where("s_acctbal > 8000").join(nation, c("s_nationkey") == c("n_nationkey")).select(c("n_name").alias("name"))
    return report.names_missing(nation.select(c("n_name").alias("name")), seen)


@query("""SELECT n_name AS name FROM nation WHERE n_nationkey IN (SELECT c_nationkey FROM customer) AND n_nationkey NOT IN (SELECT s_nationkey FROM supplier WHERE s_acctbal > 8000)""")
def names_unmatched(spark, sf_dir):
    nation = read(spark, sf_dir, "nation")
    name = c("n_name").alias("name")
    seen = read(spark, sf_dir, "customer").join(nation, c("c_nationkey") == c("n_nationkey")).select(name)
    chosen = read(spark, sf_dir, "supplier").where("s_acctbal > 8000").join(nation, c("s_nationkey") == c("n_nationkey")).select(name)
    return report.names_unmatched(nation.select(name), seen, chosen)


@query(f"""WITH {POSTINGS}, s AS (SELECT p.company FROM p JOIN labels l ON p.row_number = l.doc_id WHERE l.quality = 1), t AS (SELECT count(*) AS n FROM s),
a AS (SELECT company, count(*) AS in_scope FROM p GROUP BY 1), b AS (SELECT company, count(*) AS matched FROM s GROUP BY 1)
SELECT a.company, in_scope, coalesce(matched, 0) AS matched, coalesce(matched, 0)::DOUBLE / t.n AS of_matched, coalesce(matched, 0)::DOUBLE / in_scope AS of_in_scope FROM a LEFT JOIN b USING (company), t""")
def company_table(spark, sf_dir):
    scoped = postings(spark, sf_dir)
    good = read(spark, sf_dir, "labels").where("quality = 1").select(c("doc_id").alias("row_number"))
    return report.company_table(scoped.join(good, "row_number"), scoped)


@query("""WITH r AS (SELECT source AS company, unnest(list_filter([CASE WHEN length(text) < 300 THEN 'short' END, CASE WHEN lang <> 'en' THEN 'language' END, CASE WHEN contains(text, '&&&') THEN 'junk' END], lambda x: x IS NOT NULL)) AS reason FROM documents),
k AS (SELECT reason, company, count(*) AS n FROM r GROUP BY 1, 2), t AS (SELECT *, row_number() OVER (PARTITION BY reason ORDER BY n DESC, company) AS i FROM k)
SELECT reason, sum(n)::BIGINT AS n, string_agg(company, ',' ORDER BY i) FILTER (WHERE i <= 5) AS top_companies FROM t GROUP BY reason""")
def exclusion_breakdown(spark, sf_dir):
    d = read(spark, sf_dir, "documents")
    codes = F.array_compact(F.array(F.when(F.length("text") < 300, "short"), F.when(c("lang") != "en", "language"), F.when(F.contains("text", F.lit("&&&")), "junk")))
    rows = report.exclusion_breakdown(d.select(c("source").alias("company"), codes.alias("exclusion_codes")))
    return rows.withColumn("top_companies", F.array_join("top_companies", ","))


@query("""WITH w AS (SELECT doc_id, source, unnest(list_distinct(list_transform(regexp_extract_all(regexp_replace(text, '(^|[^A-Za-z])that([^A-Za-z]|$)', ' ', 'g'), '[A-Za-z][a-z]{6,}'), lambda x: lower(x)))) AS term FROM documents),
t AS (SELECT term, count(*) AS job_count, count(DISTINCT source) AS company_breadth FROM w GROUP BY term HAVING count(*) >= 3)
SELECT * FROM t ORDER BY job_count DESC, term LIMIT 40""")
def term_candidates(spark, sf_dir):
    d = read(spark, sf_dir, "documents")
    return report.term_candidates(d, c("text"), rules=(("that", r"(^|[^A-Za-z])that([^A-Za-z]|$)"),), company="source", pattern="[A-Za-z][a-z]{6,}")


def _manifest(spark, sf_dir):
    """Platforms' counters: a posting under 200 characters counts as a failed detail page; every seventh platform stopped early."""
    p = postings(spark, sf_dir)
    n = F.substring("platform", 4, 9).cast("int")
    rows = p.groupBy("platform").agg(F.count("*").alias("k"), F.count_if(F.length("description") < 200).alias("failed"))
    return rows.select(
        F.lit("2024-01-31").cast("date").alias("snapshot_date"), "platform", c("k").alias("source_total"), F.lit(10).alias("expected_pages"), F.when(n % 7 == 3, 9).otherwise(10).alias("pages_fetched"), c("k").alias("records_fetched"),
        c("k").alias("jobs_mapped"), F.when(n % 5 == 4, c("k") - 1).otherwise(c("k")).alias("jobs_in_scope"), c("failed").alias("detail_failed"), F.lit(0).alias("duplicate_records"), F.lit(0).alias("missing_job_id"),
        F.when(n % 11 == 10, "error").when(c("failed") > 0, "partial").otherwise("success").alias("status"), (c("failed") == 0).alias("complete"),
        F.when(n % 7 == 3, "empty_page").when(c("failed") > 0, "detail_errors").otherwise("source_total_reached").alias("stopped_by"), F.lit("").alias("error"),
        *[F.lit(None).cast("array<string>").alias(k) for k in ("failed_companies", "attempted_companies", "detail_failed_job_ids")],
    )


MANIFEST = """g AS (SELECT source AS platform, count(*) AS k, count(*) FILTER (WHERE length(text) < 200) AS failed, CAST(substr(source, 4) AS INT) AS n FROM documents GROUP BY source),
h AS (SELECT platform, list_filter([CASE WHEN n % 5 = 4 THEN 'SNAPSHOT_COUNT_MISMATCH' END, CASE WHEN n % 11 = 10 THEN 'SOURCE_ERROR' END, CASE WHEN n % 7 = 3 THEN 'LIST_PAGES_INCOMPLETE' END, CASE WHEN n % 7 = 3 THEN 'LIST_INCOMPLETE' END,
  CASE WHEN failed > 0 AND n % 7 = 3 THEN 'SOURCE_INCOMPLETE' END, CASE WHEN n % 7 = 3 THEN 'UNVERIFIED_STOP_REASON' END], lambda x: x IS NOT NULL) AS codes, n % 11 <> 10 AS content, failed, CASE WHEN n % 7 = 3 THEN 'empty_page' WHEN failed > 0 THEN 'detail_errors' ELSE '' END AS stop FROM g)"""


def _scope_health(spark, sf_dir):
    jobs = postings(spark, sf_dir).withColumn("snapshot_date", F.lit("2024-01-31").cast("date"))
    total = jobs.groupBy("snapshot_date").agg(F.count("*").alias("job_count"))
    return jobs, health.resolve_scopes(health.context(_manifest(spark, sf_dir), jobs, total), jobs)


@query(f"WITH {MANIFEST} SELECT platform, '' AS company, len(codes) = 0 AS presence_reliable, content AS content_reliable, array_to_string(codes, ',') AS reason_codes FROM h")
def source_health(spark, sf_dir):
    _, scopes = _scope_health(spark, sf_dir)
    return scopes.select("platform", "company", "presence_reliable", "content_reliable", F.array_join("reason_codes", ",").alias("reason_codes"))


@query(f"""WITH {MANIFEST} SELECT platform, count(*) AS n, count(*) FILTER (WHERE content AND trim(split_part(text, chr(10), 1)) <> '') AS content_reliable, count(*) FILTER (WHERE len(codes) = 0) AS present
FROM documents JOIN h ON source = platform GROUP BY platform""")
def posting_health(spark, sf_dir):
    jobs, scopes = _scope_health(spark, sf_dir)
    rows = health.resolve_jobs(jobs, scopes)
    return rows.groupBy("platform").agg(F.count("*").alias("n"), F.count_if("content_reliable").alias("content_reliable"), F.count_if("presence_reliable").alias("present"))


def _sightings(spark, sf_dir):
    e = read(spark, sf_dir, "events").withColumn("snapshot_date", F.to_date("ts"))
    return e.groupBy("snapshot_date", c("event_type").alias("platform"), c("user_id").cast("string").alias("job_id")).agg(F.sum("event_id").alias("total"), F.count("*").alias("k"))


def _presence(s):
    """Sightings as ``lifecycle`` takes them, and the health of their days."""
    # a sighting of one row alone has no trusted text; one day in nine no platform is reliable
    presence = s.select("snapshot_date", "platform", "job_id", F.lit("co").alias("company"), F.lit("t").alias("title"), F.when(c("k") > 1, F.sha2(c("total").cast("string"), 256)).alias("sha"))
    day = F.dayofmonth("snapshot_date")
    days = s.select("snapshot_date", "platform").distinct().select("snapshot_date", "platform", F.lit(None).cast("string").alias("company"), (day % 9 != 4).alias("presence_reliable"), F.array(F.when(day >= 20, "b").otherwise("a")).alias("cities"), F.array().cast("array<string>").alias("reason_codes"))
    return presence, days


def _events(spark, sf_dir, s=None):
    """s: the sightings, where they are written already. What the plan reads many times, sightings and days, is computed once."""
    presence, days = _presence(cut(_sightings(spark, sf_dir)) if s is None else s)
    return lifecycle.lifecycle(presence, cut(days))


LIFECYCLE = """s AS (SELECT CAST(ts AS DATE) AS d, event_type AS p, user_id AS id, CASE WHEN count(*) > 1 THEN sha256(CAST(sum(event_id)::BIGINT AS VARCHAR)) END AS sha FROM events GROUP BY 1, 2, 3),
dd AS (SELECT d, day(d) % 9 <> 4 AS rel, day(d) >= 20 AS city, lag(day(d) % 9 <> 4) OVER (ORDER BY d) AS prel, coalesce((day(d) >= 20) <> lag(day(d) >= 20) OVER (ORDER BY d), false) AS ch FROM (SELECT DISTINCT d FROM s)),
f AS (SELECT p, id, min(d) AS fd FROM s GROUP BY 1, 2),
g AS (SELECT f.p, f.id, f.fd, dd.*, s.sha, s.d IS NOT NULL AS seen FROM f JOIN dd ON dd.d >= f.fd LEFT JOIN s ON s.p = f.p AND s.id = f.id AND s.d = dd.d),
w AS (SELECT *, sum(seen::INT) OVER (PARTITION BY p, id ORDER BY d) AS isl, last_value(sha IGNORE NULLS) OVER (PARTITION BY p, id ORDER BY d ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS psha,
  last_value(CASE WHEN seen THEN city END IGNORE NULLS) OVER (PARTITION BY p, id ORDER BY d) AS lcity, lag(seen) OVER (PARTITION BY p, id ORDER BY d) AS wseen FROM g),
x AS (SELECT *, (NOT seen AND rel AND NOT ch AND lcity = city)::INT AS cnt FROM w),
y AS (SELECT *, sum(cnt) OVER (PARTITION BY p, id, isl ORDER BY d) AS streak FROM x),
z AS (SELECT *, coalesce(lag(streak) OVER (PARTITION BY p, id ORDER BY d), 0) AS ws FROM y),
ev AS (
  SELECT d, p, id, CASE WHEN prel AND NOT ch AND rel THEN 'NEW' ELSE 'FIRST_SEEN' END AS t, CASE WHEN prel AND NOT ch AND rel THEN 'confirmed' ELSE 'provisional' END AS st FROM z WHERE seen AND d = fd
  UNION ALL SELECT d, p, id, 'REAPPEARED', CASE WHEN rel AND NOT ch THEN 'confirmed' ELSE 'provisional' END FROM z WHERE seen AND d > fd AND NOT wseen
  UNION ALL SELECT d, p, id, 'UPDATED', 'confirmed' FROM z WHERE seen AND d > fd AND sha <> psha
  UNION ALL SELECT d, p, id, CASE WHEN cnt = 1 AND streak >= 2 THEN 'REMOVED' ELSE 'MISSING' END, CASE WHEN cnt = 1 AND streak >= 2 THEN 'confirmed' ELSE 'provisional' END FROM z WHERE NOT seen AND NOT (ws >= 2 AND NOT wseen))"""


@query(f"WITH {LIFECYCLE} SELECT d AS event_date, p AS platform, CAST(id AS VARCHAR) AS job_id, t AS event_type, st AS event_status FROM ev")
def lifecycle_events(spark, sf_dir):
    return _events(spark, sf_dir).select("event_date", "platform", "job_id", "event_type", "event_status")


@query(f"WITH {LIFECYCLE} SELECT d AS event_date, t AS event_type, st AS event_status, count(*) AS n FROM ev GROUP BY 1, 2, 3")
def lifecycle_daily_counts(spark, sf_dir):
    return lifecycle.daily_counts(_events(spark, sf_dir))


@query(f"WITH {LIFECYCLE} SELECT t AS event_type, count(*) AS n FROM ev WHERE d > (SELECT max(d) FROM s) - 7 AND st = 'confirmed' AND t IN ('NEW', 'REMOVED') GROUP BY 1")
def window_totals(spark, sf_dir):
    last = _sightings(spark, sf_dir).agg(F.max("snapshot_date")).first()[0]
    return trends.window_totals(_events(spark, sf_dir), F.lit(last).cast("date"))


@query("SELECT * FROM (SELECT event_type, user_id, lag(d) OVER w AS after, d AS before, datediff('day', lag(d) OVER w, d)::INT - 1 AS missing_days FROM (SELECT DISTINCT event_type, user_id, CAST(ts AS DATE) AS d FROM events) WINDOW w AS (PARTITION BY event_type, user_id ORDER BY d)) WHERE missing_days > 0")
def observation_gaps(spark, sf_dir):
    return ops.observation_gaps(read(spark, sf_dir, "events").select("event_type", "user_id", F.to_date("ts").alias("date")), keys=("event_type", "user_id"))


@query("SELECT * FROM (SELECT user_id, lag(d) OVER w AS after, d AS before, datediff('day', lag(d) OVER w, d)::INT - 1 AS missing_days FROM (SELECT DISTINCT user_id, CAST(ts AS DATE) AS d FROM events) WINDOW w AS (PARTITION BY user_id ORDER BY d)) WHERE missing_days > 0")
def observation_gaps_by_user(spark, sf_dir):
    return ops.observation_gaps(read(spark, sf_dir, "events").select("user_id", F.to_date("ts").alias("date")), keys=("user_id",))


@query("SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_orderkey DESC LIMIT 10")
def latest_rows(spark, sf_dir):
    return ops.latest(read(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice"), "o_orderkey", 10)


@query("""WITH s AS (SELECT event_type AS platform, CAST(user_id AS VARCHAR) AS job_id, CAST(ts AS DATE) AS d, CASE WHEN count(*) > 1 THEN CAST(sum(event_id)::BIGINT AS VARCHAR) END AS label FROM events GROUP BY 1, 2, 3),
g AS (SELECT s.platform, s.job_id, x.d AS snapshot_date, max(s.d) AS at FROM s JOIN (SELECT DISTINCT d FROM s) x ON s.d <= x.d GROUP BY 1, 2, 3)
SELECT g.platform, g.job_id, snapshot_date, label FROM g JOIN s ON s.platform = g.platform AND s.job_id = g.job_id AND s.d = g.at""")
def asof_labels(spark, sf_dir):
    s = _sightings(spark, sf_dir)
    return trends.asof_labels(s.withColumn("label", F.when(c("k") > 1, c("total").cast("string"))), s, ["platform", "job_id"], "label")


def _classified(spark, sf_dir):
    o = read(spark, sf_dir, "orders")
    return o.select(
        F.trunc("o_orderdate", "month").alias("snapshot_date"), c("o_orderpriority").alias("platform"), F.when(c("o_orderstatus") == "O", "core").otherwise("adjacent").alias("market_relevance"),
        c("o_orderstatus").alias("role_family"), F.when(c("o_totalprice") > 200000, "core_ai_evaluation").otherwise("ai_for_testing").alias("ai_relation"), F.when(c("o_totalprice") > 100000, "P1").otherwise("X").alias("career_pool"),
        F.when(c("o_custkey") % 3 == 0, F.array(F.lit("F"))).otherwise(F.array().cast("array<string>")).alias("secondary_role_families"), F.array(F.concat(F.lit("t"), c("o_custkey") % 4), F.lit("all")).alias("skill_tags"), F.concat(F.lit("c"), c("o_custkey") % 10).alias("company"),
    )


INVENTORY = """o AS (SELECT CAST(date_trunc('month', o_orderdate) AS DATE) AS snapshot_date, o_orderpriority AS platform, CASE WHEN o_orderstatus = 'O' THEN 'core' ELSE 'adjacent' END AS mr, o_orderstatus AS rf,
  CASE WHEN o_totalprice > 200000 THEN 'core_ai_evaluation' ELSE 'ai_for_testing' END AS ar, CASE WHEN o_totalprice > 100000 THEN 'P1' ELSE 'X' END AS cp, o_custkey % 3 = 0 AS hy, 't' || (o_custkey % 4) AS tag, 'c' || (o_custkey % 10) AS company FROM orders),
u AS (SELECT snapshot_date, platform, 'by_market_relevance' AS dimension, mr AS key FROM o UNION ALL SELECT snapshot_date, platform, 'by_role_family', rf FROM o UNION ALL SELECT snapshot_date, platform, 'by_ai_relation', ar FROM o UNION ALL
  SELECT snapshot_date, platform, 'by_career_pool', cp FROM o UNION ALL SELECT snapshot_date, platform, 'by_company', company FROM o UNION ALL SELECT snapshot_date, platform, 'active_jobs', 'all' FROM o UNION ALL
  SELECT snapshot_date, platform, 'hybrid_roles', 'all' FROM o WHERE hy UNION ALL SELECT snapshot_date, platform, 'by_role_family_any', rf FROM o UNION ALL SELECT snapshot_date, platform, 'by_role_family_any', 'F' FROM o WHERE hy AND rf <> 'F' UNION ALL
  SELECT snapshot_date, platform, 'by_skill_tag', tag FROM o UNION ALL SELECT snapshot_date, platform, 'by_skill_tag', 'all' FROM o),
i AS (SELECT snapshot_date, platform, dimension, key, count(*) AS n FROM u GROUP BY 1, 2, 3, 4),
zk AS (SELECT * FROM (SELECT DISTINCT snapshot_date, platform FROM o), (VALUES ('by_market_relevance', 'core'), ('by_market_relevance', 'adjacent'), ('by_career_pool', 'P1'), ('by_career_pool', 'P2'), ('by_career_pool', 'REF'), ('by_career_pool', 'X')) AS v(dimension, key)),
inv AS (SELECT snapshot_date, platform, dimension, key, sum(n)::BIGINT AS n FROM (SELECT * FROM i UNION ALL SELECT *, 0 FROM zk) GROUP BY 1, 2, 3, 4)"""


@query(f"WITH {INVENTORY} SELECT * FROM inv")
def snapshot_inventory(spark, sf_dir):
    return trends.inventory(_classified(spark, sf_dir))


@query(f"WITH {INVENTORY}, a AS (SELECT snapshot_date, platform, n AS denominator FROM inv WHERE dimension = 'active_jobs') SELECT inv.*, denominator, n::DOUBLE / denominator AS share FROM inv JOIN a USING (snapshot_date, platform)")
def snapshot_shares(spark, sf_dir):
    return trends.with_shares(trends.inventory(_classified(spark, sf_dir)))


@query("SELECT o_orderstatus AS status, o_orderpriority AS platform, count(*) AS n, count(*) FILTER (WHERE o_totalprice > 200000) AS large FROM orders GROUP BY GROUPING SETS ((o_orderstatus, o_orderpriority), (o_orderstatus))")
def platform_and_total(spark, sf_dir):
    o = read(spark, sf_dir, "orders").select(c("o_orderstatus").alias("status"), c("o_orderpriority").alias("platform"), "o_totalprice")
    return trends.platform_and_total(o, ["status"], {"n": F.lit(1), "large": (c("o_totalprice") > 200000).cast("int")})


def _two_months(spark, sf_dir):
    """The first month of all and the last."""
    rows = _classified(spark, sf_dir)
    ends = rows.agg(F.min("snapshot_date"), F.max("snapshot_date")).first()
    rows = trends.inventory(rows.where(c("snapshot_date").isin(*ends)))
    return tuple(rows.where(c("snapshot_date") == F.lit(d)).drop("snapshot_date") for d in ends)


def _steady(spark, sf_dir):
    """The platforms that count, here those of an even number of orders."""
    return read(spark, sf_dir, "orders").groupBy(c("o_orderpriority").alias("platform")).agg(F.count("*").alias("n")).where("n % 2 = 0").select("platform")


TWO = f"""{INVENTORY}, fa AS (SELECT * FROM inv WHERE snapshot_date = (SELECT min(snapshot_date) FROM o)), fb AS (SELECT * FROM inv WHERE snapshot_date = (SELECT max(snapshot_date) FROM o)),
pw AS (SELECT platform FROM o GROUP BY 1 HAVING count(*) % 2 = 0)"""


@query(f"""WITH {TWO}, ks AS (SELECT dimension, key FROM fa UNION SELECT dimension, key FROM fb), sa AS (SELECT dimension, key, sum(n)::BIGINT AS a FROM fa WHERE platform IN (SELECT platform FROM pw) GROUP BY 1, 2), sb AS (SELECT dimension, key, sum(n)::BIGINT AS b FROM fb WHERE platform IN (SELECT platform FROM pw) GROUP BY 1, 2)
SELECT dimension, key, coalesce(a, 0) AS from_n, coalesce(b, 0) AS to_n, coalesce(b, 0) - coalesce(a, 0) AS delta, (coalesce(b, 0) - coalesce(a, 0))::DOUBLE / nullif(coalesce(a, 0), 0) AS pct_change, true AS comparable FROM ks LEFT JOIN sa USING (dimension, key) LEFT JOIN sb USING (dimension, key)""")
def snapshot_comparison(spark, sf_dir):
    before, after = _two_months(spark, sf_dir)
    return trends.compare(before, after, _steady(spark, sf_dir))


@query(f"WITH {TWO} SELECT DISTINCT dimension, key, NULL::BIGINT AS from_n, NULL::BIGINT AS to_n, NULL::BIGINT AS delta, NULL::DOUBLE AS pct_change, false AS comparable FROM (SELECT * FROM fa UNION ALL SELECT * FROM fb)")
def comparison_without_platforms(spark, sf_dir):
    before, after = _two_months(spark, sf_dir)
    return trends.compare(before, after, spark.createDataFrame([], "platform string"))


@query(f"""WITH {TWO}, sa AS (SELECT dimension, key, sum(n)::BIGINT AS previous FROM fa GROUP BY 1, 2), sb AS (SELECT dimension, key, sum(n)::BIGINT AS current FROM fb GROUP BY 1, 2),
j AS (SELECT dimension, key, coalesce(previous, 0) AS previous, coalesce(current, 0) AS current FROM sa FULL JOIN sb USING (dimension, key))
SELECT *, current - previous AS delta FROM j WHERE abs(current - previous) >= 3 AND abs(current - previous)::DOUBLE / greatest(previous, 1) >= 0.25""")
def count_anomalies(spark, sf_dir):
    total = lambda df: df.groupBy("dimension", "key").agg(F.sum("n").alias("n"))
    before, after = _two_months(spark, sf_dir)
    return trends.anomalies(total(before), total(after))


@query("""WITH k AS (SELECT o_orderpriority AS platform, count(*) FILTER (WHERE month(o_orderdate) % 2 = 1) AS a, count(*) FILTER (WHERE month(o_orderdate) % 2 = 0) AS b FROM orders GROUP BY 1),
r AS (SELECT 'inventory' AS family, platform, CASE WHEN a = 0 OR b = 0 THEN 'PLATFORM_NOT_OBSERVED_BOTH_DAYS' WHEN a % 2 = 0 OR b % 2 = 0 THEN 'METRIC_SOURCE_UNRELIABLE' ELSE '' END AS reason_codes FROM k) SELECT *, reason_codes = '' AS comparable FROM r""")
def comparability(spark, sf_dir):
    """The orders of odd months and those of even ones; a platform of an even number of orders is not reliable."""
    o = read(spark, sf_dir, "orders")
    side = lambda odd: o.where(F.month("o_orderdate") % 2 == odd).groupBy(c("o_orderpriority").alias("platform")).agg(F.count("*").alias("n")).select(F.lit("inventory").alias("family"), "platform", (c("n") % 2 == 1).alias("reliable"), F.array().cast("array<string>").alias("reason_codes"), F.lit("").alias("scope"), F.lit("v1").alias("versions"))
    return trends.comparability(side(1), side(0)).withColumn("reason_codes", F.array_join("reason_codes", ","))


@query("""WITH m AS (SELECT make_timestamp((epoch_us(min(o_orderdate)) + epoch_us(max(o_orderdate))) // 2) AS middle FROM orders), a AS (SELECT o_orderpriority AS platform, count(*) AS n FROM orders, m WHERE o_orderdate < middle GROUP BY 1), b AS (SELECT o_orderpriority AS platform, count(*) AS n FROM orders, m WHERE o_orderdate >= middle GROUP BY 1),
r AS (SELECT 'inventory' AS family, coalesce(a.platform, b.platform) AS platform, CASE WHEN a.n IS NULL OR b.n IS NULL THEN 'PLATFORM_NOT_OBSERVED_BOTH_DAYS' WHEN a.n % 2 = 0 OR b.n % 2 = 0 THEN 'METRIC_SOURCE_UNRELIABLE' ELSE '' END AS reason_codes FROM a FULL JOIN b USING (platform))
SELECT *, reason_codes = '' AS comparable FROM r""")
def comparability_of_halves(spark, sf_dir):
    """The orders before and from the middle of their time."""
    o = read(spark, sf_dir, "orders").select(c("o_orderpriority").alias("platform"), F.unix_micros(c("o_orderdate").cast("timestamp")).alias("at"))
    first, last = o.agg(F.min("at"), F.max("at")).first()
    middle = F.lit(None if first is None else (first + last) // 2).cast("long")
    side = lambda when: o.where(when).groupBy("platform").agg(F.count("*").alias("n")).select(F.lit("inventory").alias("family"), "platform", (c("n") % 2 == 1).alias("reliable"), F.array().cast("array<string>").alias("reason_codes"), F.lit("").alias("scope"), F.lit("v1").alias("versions"))
    return trends.comparability(side(c("at") < middle), side(c("at") >= middle)).withColumn("reason_codes", F.array_join("reason_codes", ","))


@query("""WITH w AS (SELECT o_orderstatus AS platform, min(o_orderdate) AS a, max(o_orderdate) AS b FROM orders GROUP BY 1) SELECT l_orderkey, l_linenumber, l_shipdate FROM lineitem l WHERE NOT EXISTS (SELECT 1 FROM w WHERE w.platform = l.l_linestatus AND l.l_shipdate >= w.a AND l.l_shipdate <= w.b)""")
def outside_windows(spark, sf_dir):
    w = read(spark, sf_dir, "orders").groupBy(c("o_orderstatus").alias("platform")).agg(F.min("o_orderdate").alias("started_at"), F.max("o_orderdate").alias("finished_at"))
    rows = read(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", c("l_linestatus").alias("platform"), c("l_shipdate").alias("scraped_at"))
    return ops.outside_windows(rows, w).select("l_orderkey", "l_linenumber", c("scraped_at").alias("l_shipdate"))


def _predicted(spark, sf_dir):
    rows = read(spark, sf_dir, "documents").join(read(spark, sf_dir, "labels"), "doc_id")
    return rows.select("doc_id", c("quality").cast("string").alias("expected"), F.when(F.contains("text", F.lit("&&&")) | (F.length("text") < 300), "0").otherwise("1").alias("predicted"))


PREDICTED = "p AS (SELECT CAST(quality AS VARCHAR) AS expected, CASE WHEN contains(text, '&&&') OR length(text) < 300 THEN '0' ELSE '1' END AS predicted FROM documents JOIN labels USING (doc_id))"


@query(f"WITH {PREDICTED} SELECT expected, predicted, count(*) AS n FROM p GROUP BY 1, 2")
def confusion_matrix(spark, sf_dir):
    return scoring.confusion(_predicted(spark, sf_dir), "expected", "predicted")


@query(f"""WITH {PREDICTED}, k AS (SELECT count(*) FILTER (WHERE expected = '0' AND predicted = '0') AS tp, count(*) FILTER (WHERE expected = '1' AND predicted = '0') AS fp, count(*) FILTER (WHERE expected = '1' AND predicted = '1') AS tn, count(*) FILTER (WHERE expected = '0' AND predicted = '1') AS fn FROM p)
SELECT *, tp::DOUBLE / (tp + fp) AS precision, tp::DOUBLE / (tp + fn) AS recall, (2 * tp)::DOUBLE / (2 * tp + fp + fn) AS f1, (tp + tn)::DOUBLE / (tp + fp + tn + fn) AS accuracy FROM k""")
def precision_recall(spark, sf_dir):
    return scoring.precision_recall(_predicted(spark, sf_dir), c("expected") == "0", c("predicted") == "0")


@query("SELECT c_custkey, c_name FROM customer WHERE c_custkey % 10 <> 0 UNION ALL SELECT c_custkey, upper(c_name) FROM customer WHERE c_custkey % 10 = 0")
def upsert(spark, sf_dir):
    rows = read(spark, sf_dir, "customer").select("c_custkey", "c_name")
    return ops.upsert(rows, rows.where("c_custkey % 10 = 0").withColumn("c_name", F.upper("c_name")), ["c_custkey"])


@query("SELECT CAST(o_orderdate AS DATE) AS date, bool_or(o_orderstatus = 'F') AS \"F\", bool_or(o_orderstatus = 'O') AS \"O\", bool_or(o_orderstatus = 'P') AS \"P\" FROM orders GROUP BY 1")
def coverage(spark, sf_dir):
    """Which of the three statuses each day's orders have."""
    found = ops.coverage(read(spark, sf_dir, "orders").select(c("o_orderstatus").alias("artifact"), F.to_date("o_orderdate").alias("date")))
    for k in ("F", "O", "P"):
        found = found if k in found.columns else found.withColumn(k, F.lit(False))
    return found.select("date", "F", "O", "P")


@query("SELECT o_orderkey FROM orders WHERE o_orderkey < (SELECT max(o_orderkey) FROM orders) AND o_orderkey IN (SELECT l_orderkey FROM lineitem WHERE l_returnflag = 'A')")
def recovery_candidates(spark, sf_dir):
    runs = read(spark, sf_dir, "orders").select(c("o_orderkey").alias("run_date"))
    incidents = read(spark, sf_dir, "lineitem").select(c("l_orderkey").alias("run_date"), F.when(c("l_returnflag") == "A", "open").otherwise("closed").alias("status"))
    return ops.recovery_candidates(runs, incidents, F.lit(runs.agg(F.max("run_date")).first()[0])).select(c("run_date").alias("o_orderkey"))


@query("WITH e AS (SELECT DISTINCT CAST(ts AS DATE) AS date, event_type AS artifact FROM events) SELECT d.date, t.artifact, e.date IS NOT NULL AS present FROM (SELECT DISTINCT date FROM e) d CROSS JOIN (SELECT DISTINCT artifact FROM e) t LEFT JOIN e ON e.date = d.date AND e.artifact = t.artifact")
def coverage_of_all_types(spark, sf_dir):
    """A row for each date and event type, as the types are not known beforehand."""
    found = ops.coverage(read(spark, sf_dir, "events").select(c("event_type").alias("artifact"), F.to_date("ts").alias("date")))
    return found.unpivot("date", [k for k in found.columns if k != "date"], "artifact", "present")


@query("SELECT o_orderkey FROM orders WHERE o_orderkey < (SELECT max(o_orderkey) FROM orders) AND o_orderkey IN (SELECT l_orderkey FROM lineitem WHERE l_returnflag = 'R')")
def recovery_candidates_of_all(spark, sf_dir):
    runs = read(spark, sf_dir, "orders").select(c("o_orderkey").alias("run_date"))
    incidents = read(spark, sf_dir, "lineitem").select(c("l_orderkey").alias("run_date"), F.when(c("l_returnflag") == "R", "open").otherwise("closed").alias("status"))
    return ops.recovery_candidates(runs, incidents, F.lit(runs.agg(F.max("run_date")).first()[0])).select(c("run_date").alias("o_orderkey"))


@query("SELECT conv_id, turn, list_aggregate(list_sort(list_distinct(list_filter(list_transform(regexp_split_to_array(text, '[；;。\\n\\r]+'), lambda x: trim(x)), lambda x: x <> ''))), 'count') AS clauses FROM conversations")
def clause_counts(spark, sf_dir):
    return read(spark, sf_dir, "conversations").select("conv_id", "turn", F.size(X.clauses(c("text"), ordered=False)).cast("long").alias("clauses"))


@query()
def content_hashes(spark, sf_dir):
    """Rows only: SQL engines lack the compatibility form and case folding."""
    return postings(spark, sf_dir).select("job_id", X.content_sha256().alias("content_sha256"))


#: Cuts after sentence marks (a full stop only if it does not end a number before a blank) and before bullets inside the text.
SENTENCES = r"""t AS (SELECT CAST(doc_id AS VARCHAR) AS job_id, text, length(text) AS n FROM documents WHERE trim(text) <> ''),
c0 AS (SELECT job_id, generate_subscripts(cs, 1) AS i, unnest(cs) AS ch FROM (SELECT job_id, string_split(text, '') AS cs FROM t)),
ch AS (SELECT job_id, i, ch, coalesce(lead(ch) OVER w, '') AS nx, coalesce(lag(ch) OVER w, '') AS pv FROM c0 WINDOW w AS (PARTITION BY job_id ORDER BY i)),
ct AS (SELECT job_id, i AS pos FROM ch WHERE ch IN ('。', '；', ';', chr(10), chr(13)) OR (ch = '.' AND NOT (regexp_matches(pv, '[0-9]') AND (nx = '' OR regexp_matches(nx, '\s')))) UNION
  SELECT job_id, i - 1 FROM ch JOIN t USING (job_id) WHERE regexp_matches(pv, '[\s。；;]') AND regexp_matches(ch, '[-*•0-9（(]') AND regexp_matches(substr(text, i, 40), '^([-*•]|[0-9]+[.)、]|（[0-9]+）|\([0-9]+\))\s+') UNION SELECT job_id, 0 FROM t UNION SELECT job_id, n FROM t),
rg AS (SELECT job_id, pos AS a, lead(pos) OVER (PARTITION BY job_id ORDER BY pos) AS b FROM ct),
sg AS (SELECT job_id, a, substr(text, a + 1, b - a) AS raw FROM rg JOIN t USING (job_id) WHERE b IS NOT NULL),
lg AS (SELECT job_id, a, CASE WHEN length(regexp_replace(raw, '^\s+|\s+$', '', 'g')) > 180 THEN regexp_replace(raw, '[；;\n\r]$', '') ELSE raw END AS raw FROM sg),
bd AS (SELECT job_id, a + length(raw) - length(regexp_replace(raw, '^\s+', '')) AS s0, a + length(regexp_replace(raw, '\s+$', '')) AS e, regexp_replace(raw, '^\s+|\s+$', '', 'g') AS body FROM lg),
nb AS (SELECT *, regexp_replace(body, '^\s*([-*•]|[0-9]+[.)、]|（[0-9]+）|\([0-9]+\))\s*', '') AS bare FROM bd)"""


@query(f"WITH {SENTENCES} SELECT job_id, 'description' AS source_section, bare AS sentence, (s0 + length(body) - length(bare))::INTEGER AS sentence_start, e::INTEGER AS sentence_end FROM nb WHERE bare <> ''")
def sentence_spans(spark, sf_dir):
    return evidence.sentence_table(postings(spark, sf_dir).select("job_id", "description"), "description").drop("description")


@query()
def experience_evidence(spark, sf_dir):
    return evidence.experience_evidence(postings(spark, sf_dir).withColumn("experience", F.lit("")))


@query()
def posting_labels(spark, sf_dir):
    rows = classify.add_labels(classify.spread(postings(spark, sf_dir)))
    return rows.select("job_id", "market.in_scope", "fit.career_pool", F.array_join("fit.reason_codes", ",").alias("fit_reasons"), F.array_join("skill_tags", ",").alias("skills"))


from . import queries_jobs, queries_labels, queries_sources, queries_trend  # noqa: E402,F401  further queries of the same tables
