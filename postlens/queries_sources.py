"""Queries of landed pages, scope health by company, provenance gates and regression checks."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .operators import health, ops, scoring
from .plans import daily
from .queries import _predicted, c, query, read
from .sources import postings as P

PLATFORMS = ("netease", "xiaohongshu")


def _pages(spark, sf_dir) -> DataFrame:
    """Customers as two platforms' list pages of 20 (their numbers' parity says which); page two of the second was not fetched."""
    rows = read(spark, sf_dir, "customer").select("c_custkey", F.when(c("c_custkey") % 2 == 0, PLATFORMS[0]).otherwise(PLATFORMS[1]).alias("platform"), F.when(c("c_nationkey") % 3 == 0, "深圳").otherwise("北京").alias("place"))
    # numbered by ranges of keys: how many lie in earlier ranges, and the place within the own one
    rows = rows.withColumn("range", F.floor(c("c_custkey") / 10_000))
    counts = rows.groupBy("platform", "range").agg(F.count("*").alias("n"))
    by_range = Window.partitionBy("platform").orderBy("range")  # a row a range
    counts = counts.withColumns({"before": F.coalesce(F.sum("n").over(by_range.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)), "total": F.sum("n").over(Window.partitionBy("platform"))})
    place = F.row_number().over(Window.partitionBy("platform", "range").orderBy("c_custkey")) - 1
    rows = rows.join(counts.drop("n"), ["platform", "range"]).withColumn("page", (F.floor((c("before") + place) / 20) + 1).cast("int"))
    item = F.struct(c("c_custkey").alias("id"), c("c_custkey").alias("positionId"), F.lit("x").alias("name"), F.array("place").alias("workPlaceNameList"), c("place").alias("workplace"))
    pages = rows.groupBy("platform", "page").agg(F.first("total").alias("total"), F.array_sort(F.collect_list(item)).alias("list"))
    return pages.where("NOT (platform = 'xiaohongshu' AND page = 2)").select("platform", "page", F.to_json(F.struct(F.struct("total", "list").alias("data"))).alias("payload"))


PAGES = """c AS (SELECT c_custkey, c_nationkey % 3 = 0 AS inside, CASE WHEN c_custkey % 2 = 0 THEN 'netease' ELSE 'xiaohongshu' END AS p, row_number() OVER (PARTITION BY c_custkey % 2 ORDER BY c_custkey) - 1 AS rn FROM customer),
k AS (SELECT *, rn // 20 + 1 AS page, count(*) OVER (PARTITION BY p) AS total FROM c), f AS (SELECT * FROM k WHERE NOT (p = 'xiaohongshu' AND page = 2))"""


@query(f"""WITH {PAGES}, m AS (SELECT p AS platform, max(total) AS source_total, greatest(ceil(max(total) / 20), max(page))::BIGINT AS expected_pages, count(DISTINCT page) AS pages_fetched, count(*) AS records_fetched, count(*) FILTER (WHERE inside) AS jobs_in_scope FROM f GROUP BY 1)
SELECT *, pages_fetched = expected_pages AS complete, CASE WHEN pages_fetched = expected_pages THEN 'success' ELSE 'partial' END AS status, CASE WHEN pages_fetched = expected_pages THEN 'source_total_reached' ELSE 'incomplete_list' END AS stopped_by FROM m""")
def collection_manifest(spark, sf_dir):
    _, m = daily.collect(_pages(spark, sf_dir), list(PLATFORMS), ["深圳"])
    return m.select("platform", "source_total", "expected_pages", "pages_fetched", "records_fetched", "jobs_in_scope", "complete", "status", "stopped_by")


@query(f"WITH {PAGES} SELECT p AS platform, CAST(c_custkey AS VARCHAR) AS job_id, '深圳' AS location FROM f WHERE inside")
def collected_postings(spark, sf_dir):
    rows, _ = daily.collect(_pages(spark, sf_dir), list(PLATFORMS), ["深圳"])
    return rows.select("platform", "job_id", "location")


@query(f"""WITH {PAGES}, s AS (SELECT p AS platform, count(*) AS n, max(total) AS total, max(page) AS last, count(*) FILTER (WHERE page = 1) AS first FROM f GROUP BY 1), l AS (SELECT f.p AS platform, count(*) AS m FROM f JOIN s ON s.platform = f.p AND f.page = s.last GROUP BY 1)
SELECT platform, array_to_string(list_filter([CASE WHEN n < total THEN 'unique_deficit' END, CASE WHEN NOT (m < first) THEN 'incomplete_list' END], lambda x: x IS NOT NULL), ',') AS reasons FROM s JOIN l USING (platform)""")
def list_reasons(spark, sf_dir):
    """What speaks against each platform's list; page one is the same when read again."""
    pages = _pages(spark, sf_dir)
    ledgers = [P.page_ledger(pages, p).withColumn("platform", F.lit(p)) for p in PLATFORMS]
    ledger = ledgers[0].unionByName(ledgers[1])
    rows = P.list_problems(ledger, ledger.where("page = 1").select("platform", "ids"), keys=("platform",))
    return rows.select("platform", F.array_join("reasons", ",").alias("reasons"))


def _companies(spark, sf_dir) -> tuple[DataFrame, DataFrame]:
    """Orders as postings of one platform of many companies, on two days; the second day's manifest names its failed ones in its error alone."""
    jobs = read(spark, sf_dir, "orders").select(F.date_add(F.lit("2024-01-01").cast("date"), (c("o_orderkey") % 2).cast("int")).alias("snapshot_date"), F.lit("feishu").alias("platform"), c("o_orderkey").cast("string").alias("job_id"), c("o_orderpriority").alias("company"), F.lit("t").alias("title"), F.lit("d").alias("description"), F.lit("r").alias("requirements"))
    n = jobs.groupBy("snapshot_date", "platform").agg(F.count("*").alias("n"))
    old = c("snapshot_date") == F.lit("2024-01-02").cast("date")
    names = jobs.select("company").distinct().agg(F.sort_array(F.collect_list("company")).alias("attempted_companies"))
    manifest = n.crossJoin(F.broadcast(names)).select(  # one row
        "snapshot_date", "platform", "attempted_companies", *[c("n").alias(k) for k in ("source_total", "records_fetched", "jobs_mapped", "jobs_in_scope")], *[F.lit(1).cast("long").alias(k) for k in ("expected_pages", "pages_fetched")], *[F.lit(0).cast("long").alias(k) for k in ("detail_failed", "duplicate_records", "missing_job_id")],
        F.lit("partial").alias("status"), F.lit(False).alias("complete"), F.lit("company_error").alias("stopped_by"), F.when(old, "5-LOW: timeout; 1-URGENT: no answer").otherwise("5-LOW: timeout").alias("error"), F.when(~old, F.array(F.lit("5-LOW"))).alias("failed_companies"), F.lit(None).cast("array<string>").alias("detail_failed_job_ids"),
    )
    return jobs, manifest


@query("""WITH o AS (SELECT DISTINCT o_orderpriority AS company, o_orderkey % 2 = 1 AS old FROM orders), x AS (SELECT *, company = '5-LOW' OR (old AND company = '1-URGENT') AS failed FROM o)
SELECT CASE WHEN old THEN DATE '2024-01-02' ELSE DATE '2024-01-01' END AS snapshot_date, company, NOT failed AS presence_reliable, true AS content_reliable, array_to_string(list_filter([CASE WHEN failed THEN 'COMPANY_ERROR' END, CASE WHEN old THEN 'LEGACY_COMPANY_ERROR_PARSED' END], lambda v: v IS NOT NULL), ',') AS reason_codes FROM x""")
def company_scope_health(spark, sf_dir):
    """Of a platform of many companies only those that failed lose trust in their lists."""
    jobs, manifest = _companies(spark, sf_dir)
    total = jobs.groupBy("snapshot_date").agg(F.count("*").alias("job_count"))
    rows = health.resolve_scopes(health.context(manifest, jobs, total), jobs)
    return rows.select("snapshot_date", "company", "presence_reliable", "content_reliable", F.array_join("reason_codes", ",").alias("reason_codes"))


@query("SELECT o_orderpriority AS company, count(*) AS n, count(*) FILTER (WHERE NOT (o_orderpriority = '5-LOW' OR (o_orderkey % 2 = 1 AND o_orderpriority = '1-URGENT'))) AS present FROM orders GROUP BY 1")
def company_posting_health(spark, sf_dir):
    jobs, manifest = _companies(spark, sf_dir)
    total = jobs.groupBy("snapshot_date").agg(F.count("*").alias("job_count"))
    rows = health.resolve_jobs(jobs, health.resolve_scopes(health.context(manifest, jobs, total), jobs))
    return rows.groupBy("company").agg(F.count("*").alias("n"), F.count_if("presence_reliable").alias("present"))


@query("""WITH o AS (SELECT o_orderstatus AS platform, o_orderkey, o_custkey, o_orderdate FROM orders)
SELECT 'raw' AS gate, platform, 'COUNT_MISMATCH' AS code, 1::BIGINT AS n FROM (SELECT DISTINCT platform FROM o) WHERE platform = 'P' UNION ALL SELECT 'raw', platform, 'WINDOW_INVALID', 1 FROM (SELECT DISTINCT platform FROM o) UNION ALL
SELECT 'raw', platform, 'SCRAPED_OUTSIDE_WINDOW', count(*) FROM o WHERE o_orderdate < TIMESTAMP '1993-01-01' OR o_orderdate > TIMESTAMP '1997-01-01' GROUP BY platform UNION ALL
SELECT 'clean', platform, 'IDENTITIES_DIFFER', count(*) FROM o WHERE o_custkey % 50 = 0 GROUP BY platform UNION ALL SELECT 'analysis', platform, 'IDENTITY_UNKNOWN', count(*) FROM o WHERE o_orderkey % 7 = 0 AND o_custkey % 50 = 0 GROUP BY platform""")
def provenance_gates(spark, sf_dir):
    """Orders as one run's rows: their windows are longer than two days, customers of a multiple of fifty are lost in cleaning."""
    o = read(spark, sf_dir, "orders").select(c("o_orderstatus").alias("platform"), c("o_orderkey").cast("string").alias("job_id"), "o_custkey", c("o_orderdate").alias("scraped_at"))
    t = lambda y: F.lit(dt.datetime(y, 1, 1)).cast("timestamp_ntz")
    manifest = o.groupBy("platform").agg((F.count("*") + F.when(c("platform") == "P", 1).otherwise(0)).alias("jobs_in_scope")).withColumns({"invocation_id": F.lit("i"), "started_at": t(1993), "finished_at": t(1997)})
    return ops.provenance_problems(manifest, o, o.where("o_custkey % 50 <> 0"), o.where("job_id % 7 = 0").select("platform", "job_id"), t(1993), t(1997), F.lit("i"))


@query("""WITH p AS (SELECT doc_id, CAST(quality AS VARCHAR) AS expected, CASE WHEN contains(text, '&&&') OR length(text) < 300 THEN '0' ELSE '1' END AS actual FROM documents JOIN labels USING (doc_id))
SELECT doc_id AS case_id, 'quality' AS label, expected, actual FROM p WHERE expected <> actual""")
def label_changes(spark, sf_dir):
    rows = _predicted(spark, sf_dir).select(c("doc_id").alias("case_id"), c("expected").alias("expected_quality"), c("predicted").alias("actual_quality"))
    return scoring.label_diff(rows, ["quality"])


@query("""WITH k AS (SELECT doc_id, quality FROM labels) SELECT CAST(doc_id AS VARCHAR) AS case_id, CASE WHEN doc_id % 10 = 1 THEN 'CASE_NOT_FROZEN' WHEN doc_id % 10 = 2 THEN 'CASE_TEXT_CHANGED' ELSE 'EXPECTATION_MISSING' END AS problem FROM k WHERE doc_id % 10 IN (1, 2, 3)
UNION ALL SELECT '-' || doc_id, 'CASE_MISSING' FROM k WHERE doc_id % 10 = 4""")
def regression_problems(spark, sf_dir):
    """Labelled documents as frozen cases: some came, some went, some have another text or no expectation."""
    k = c("doc_id") % 10
    rows = read(spark, sf_dir, "labels").select("doc_id", c("doc_id").cast("string").alias("case_id"), F.lit("a").alias("title"), F.when(k != 3, c("quality")).alias("expected_quality"))
    sha = lambda x: F.sha2(F.to_json(F.array(F.lit(x))), 256)
    frozen = rows.where(k != 1).select("case_id", F.when(k == 2, sha("b")).otherwise(sha("a")).alias("content_sha256")).unionByName(rows.where(k == 4).select(F.concat(F.lit("-"), "case_id").alias("case_id"), sha("a").alias("content_sha256")))
    return scoring.regression_problems(rows.drop("doc_id"), frozen, ["quality"], ["title"])
