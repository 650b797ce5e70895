"""Queries of stored state, validators, promotion, decisions, region covers and payload shapes."""

from __future__ import annotations

import uuid

from pyspark.sql import Window
from pyspark.sql import functions as F

from .operators import decisions, evidence
from .plans import incremental, promote, validate
from .plans.cut import cut, drop, shared_folder
from .queries import LIFECYCLE, _presence, _sightings, c, query, read
from .sources import drift, regions


_EVENTS = f"WITH {LIFECYCLE} SELECT d AS event_date, p AS platform, CAST(id AS VARCHAR) AS job_id, t AS event_type, st AS event_status FROM ev"
_COLUMNS = ("event_date", "platform", "job_id", "event_type", "event_status")


@query(_EVENTS)
def lifecycle_day_by_day(spark, sf_dir):
    """Each day from the stored state of the last one: all days in one plan give the same (``lifecycle_events``)."""
    s = cut(_sightings(spark, sf_dir))  # read for the days, their scopes and their postings
    events = incremental.lifecycle_days(*_presence(s)).select(*_COLUMNS)
    drop(s)
    return events


@query(_EVENTS)
def lifecycle_by_fold(spark, sf_dir):
    """The same events by going along each identity's days."""
    return validate.lifecycle_by_fold(*_presence(_sightings(spark, sf_dir))).select(*_COLUMNS)


@query("""WITH o AS (SELECT CAST(date_trunc('month', o_orderdate) AS DATE) AS m, o_orderstatus AS s FROM orders), e AS (SELECT min(m) + CAST((max(m) - min(m)) // 2 AS INTEGER) AS half FROM o),
k AS (SELECT m, count(*) AS n, bool_or(s = 'P') AS changed FROM o GROUP BY 1)
SELECT CAST(m AS VARCHAR) AS partition, CASE WHEN m > half THEN 'generated' WHEN changed THEN 'refused' ELSE 'preserved' END AS outcome, n AS staged_rows, CASE WHEN m <= half THEN n END AS stored_rows, CASE WHEN m <= half AND changed THEN 'MISMATCH' END AS reason FROM k, e""")
def promotion_outcomes(spark, sf_dir):
    """Orders by month: the earlier half is stored; then all are promoted, with other totals where an order is in state P."""
    o = read(spark, sf_dir, "orders").withColumn("snapshot_date", F.trunc("o_orderdate", "month"))
    first, last = o.agg(F.min("snapshot_date"), F.max("snapshot_date")).first()
    store = f"{shared_folder(spark)}/postlens/promotion-{uuid.uuid4().hex[:8]}"
    if first is not None:
        promote.promote(o.where(c("snapshot_date") <= F.lit(first + (last - first) // 2)), store)
    changed = F.when(c("o_orderstatus") == "P", c("o_totalprice") + 1).otherwise(c("o_totalprice"))
    return promote.promote(o.withColumn("o_totalprice", changed), store)


_PARSED = """x AS (SELECT l_orderkey, l_linenumber, l_shipdate, l_partkey, CASE WHEN l_discount > 0.09 THEN 'conflict' WHEN l_discount > 0.08 THEN 'partial' WHEN l_discount > 0.07 THEN 'not_experience' WHEN l_discount > 0.06 THEN 'unknown' ELSE 'ok' END AS status,
CASE WHEN l_tax > 0.07 THEN 'mixed' WHEN l_tax > 0.06 THEN 'none' WHEN l_tax > 0.05 THEN 'prefer_only' ELSE 'hard_min' END AS kind, l_quantity / 5 AS years, l_partkey % 3 = 0 AS good, l_partkey % 5 = 0 AS bad, l_partkey % 7 = 0 AS other FROM lineitem),
y AS (SELECT *, CASE WHEN status = 'conflict' THEN 1 WHEN status = 'unknown' THEN 2 WHEN kind = 'mixed' THEN 3 WHEN status = 'partial' THEN 4 WHEN status = 'not_experience' THEN 5 WHEN kind = 'none' THEN 6 WHEN years > 5 AND bad AND NOT good AND NOT other THEN 7 WHEN years > 5 THEN 8
WHEN good AND bad THEN 9 WHEN other THEN 10 WHEN bad THEN 11 WHEN kind = 'prefer_only' THEN 12 ELSE 13 END AS rule FROM x)"""


def _parsed(spark, sf_dir):
    d, t, k = c("l_discount"), c("l_tax"), c("l_partkey")
    status = F.when(d > 0.09, "conflict").when(d > 0.08, "partial").when(d > 0.07, "not_experience").when(d > 0.06, "unknown").otherwise("ok")
    kind = F.when(t > 0.07, "mixed").when(t > 0.06, "none").when(t > 0.05, "prefer_only").otherwise("hard_min")
    tags = F.array_compact(F.array(F.when(k % 3 == 0, "ai"), F.when(k % 5 == 0, "game"), F.when(k % 7 == 0, "other")))
    rows = read(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", status.alias("experience_parse_status"), kind.alias("experience_requirement_type"), (c("l_quantity") / 5).alias("experience_min_years"), tags.alias("experience_required_tags"))
    return rows, decisions.experience_facts(["ai"], ["game"], 5.0)


@query(f"WITH {_PARSED} SELECT l_orderkey, l_linenumber, rule, CASE WHEN rule IN (1, 2, 3, 4, 9, 10) THEN 'grey' WHEN rule IN (7, 8, 11) THEN 'reject' ELSE 'pass' END AS decision FROM y")
def experience_decisions(spark, sf_dir):
    rows, facts = _parsed(spark, sf_dir)
    return decisions.decide(rows, decisions.EXPERIENCE, facts, "experience").select("l_orderkey", "l_linenumber", c("experience_rule").alias("rule"), c("experience_decision").alias("decision"))


@query(f"""WITH {_PARSED}, z AS (SELECT *, row_number() OVER () AS id FROM x), r AS (SELECT id, unnest([1, 2, 3, 4, 5, 6, 7, 8, 9, 10, 11, 12, 13]) AS rule, unnest([status = 'conflict', status = 'unknown', kind = 'mixed', status = 'partial', status = 'not_experience', status = 'ok' AND kind = 'none', years > 5 AND bad AND NOT good AND NOT other, years > 5,
good AND bad, other, bad AND NOT good AND NOT other, kind = 'prefer_only', NOT years > 5 AND NOT bad AND NOT other]) AS holds FROM z), h AS (SELECT id, rule, CASE WHEN rule IN (1, 2, 3, 4, 9, 10) THEN 'grey' WHEN rule IN (7, 8, 11) THEN 'reject' ELSE 'pass' END AS d FROM r WHERE holds)
SELECT 'CONFLICT' AS problem, a.rule, b.rule AS other, count(*) AS n FROM h a JOIN h b ON a.id = b.id AND a.rule < b.rule AND a.d <> b.d GROUP BY 2, 3""")
def decision_conflicts(spark, sf_dir):
    """Which rules hold together and would decide otherwise, over all rows."""
    rows, facts = _parsed(spark, sf_dir)
    return decisions.table_problems(rows, decisions.EXPERIENCE, facts).where("problem = 'CONFLICT'")


@query("""WITH d AS (SELECT event_type AS platform, CAST(ts AS DATE) AS snapshot_date, count(*) AS of_pages, count(*) FILTER (WHERE json_extract(props, '$.k') IS NOT NULL) AS k FROM events GROUP BY 1, 2)
SELECT platform, snapshot_date, '$.items' AS path, 'MISSING' AS problem, 'ARRAY' AS expected, NULL::VARCHAR AS found, 0::BIGINT AS pages, of_pages FROM d UNION ALL
SELECT platform, snapshot_date, '$.k', 'RETYPED', 'OBJECT', 'BIGINT', k, of_pages FROM d WHERE k > 0""")
def payload_drift(spark, sf_dir):
    """``props`` of the events as payloads, against a shape that has a list and takes ``k`` for an object."""
    pages = read(spark, sf_dir, "events").select(c("event_type").alias("platform"), F.to_date("ts").alias("snapshot_date"), c("props").alias("payload"))
    names = pages.select("platform").distinct()
    shape = spark.createDataFrame([("$", "OBJECT", True), ("$.k", "OBJECT", True), ("$.items", "ARRAY", True), ("$.items[]", "OBJECT", True)], "path string, kind string, needed boolean")
    return drift.drift(pages, names.crossJoin(F.broadcast(shape)))  # four paths a platform


#: Customers of a nation are its list, those of its region the region's; a list of over CAP customers is cut there.
_CAP, _PAGE = 40, 20
_LISTS = f"""n AS (SELECT CAST(n_regionkey AS VARCHAR) AS r, CAST(n_regionkey AS VARCHAR) || '/' || CAST(n_nationkey AS VARCHAR) AS rn, c_custkey AS id FROM customer JOIN nation ON c_nationkey = n_nationkey),
l AS (SELECT 'all' AS region, NULL AS parent, count(*) AS total FROM n UNION ALL SELECT r, 'all', count(*) FROM n GROUP BY r UNION ALL SELECT rn, r, count(*) FROM n GROUP BY rn, r),
w AS (SELECT l.region, l.parent, l.total, l.total > {_CAP} AND l.parent IS DISTINCT FROM p.region AS ov, p.total AS ptotal, g.total AS gtotal FROM l LEFT JOIN l p ON p.region = l.parent LEFT JOIN l g ON g.region = p.parent)"""


def _lists(spark, sf_dir):
    """``id, region`` of all lists, and each list's total."""
    nation = read(spark, sf_dir, "nation").select("n_nationkey", c("n_regionkey").cast("string").alias("r"))
    rows = read(spark, sf_dir, "customer").join(F.broadcast(nation), c("c_nationkey") == c("n_nationkey"))  # 25 nations
    rows = rows.select(c("c_custkey").cast("string").alias("id"), F.array(F.lit("all"), c("r"), F.concat_ws("/", "r", "n_nationkey")).alias("in"))
    lists = rows.select("id", F.explode("in").alias("region"))
    totals = lists.groupBy("region").agg(F.count("*").alias("total"))
    return lists, totals


@query(f"""WITH {_LISTS} SELECT region, total AS source_total, least(total, {_CAP}) AS records_fetched, CASE WHEN total > {_CAP} THEN 'partition_limit' ELSE 'source_total_reached' END AS stopped_by,
CASE WHEN ptotal <= {_CAP} OR gtotal <= {_CAP} THEN 'idle' WHEN total > {_CAP} AND region NOT LIKE '%/%' THEN 'split' WHEN total > {_CAP} THEN 'capped' ELSE 'used' END AS role FROM w""")
def region_cover(spark, sf_dir):
    """Which lists of customers by region and nation stand for the whole, where a list shows its first customers only."""
    lists, totals = _lists(spark, sf_dir)
    place = Window.partitionBy("region").orderBy(c("id").cast("long"))
    shown = lists.withColumn("n", F.row_number().over(place)).where(c("n") <= _CAP)  # a group limit before the shuffle
    pages = shown.groupBy("region", F.ceil(c("n") / _PAGE).cast("int").alias("page")).agg(F.transform(F.array_sort(F.collect_list(F.struct("n", "id"))), lambda x: x["id"]).alias("ids"))  # PAGE ids at most
    end = totals.where(c("total") > _CAP).select("region", F.lit(_CAP // _PAGE + 1).alias("page"), F.array().cast("array<string>").alias("ids"))
    found = regions.details(pages.unionByName(end).join(totals, "region"), _PAGE, _CAP)
    name = c("region")
    parent = F.when(name == "all", F.lit(None)).when(~F.contains(name, F.lit("/")), "all").otherwise(F.split_part(name, F.lit("/"), F.lit(1)))
    tree = totals.select("region", parent.alias("parent"))
    return regions.cover(found, tree, _CAP).select("region", "source_total", "records_fetched", "stopped_by", "role")


_YEARS = """x AS (SELECT l_orderkey, l_linenumber, l_partkey, CAST(l_quantity AS INTEGER) AS y, l_suppkey % 4 AS t FROM lineitem)"""


@query(f"""WITH {_YEARS} SELECT l_orderkey::VARCHAR || '-' || l_linenumber::VARCHAR || '-' || l_partkey::VARCHAR AS job_id, CASE t WHEN 0 THEN 'min_years' WHEN 1 THEN 'year_range' WHEN 2 THEN 'exact_years' ELSE 'no_requirement' END AS pattern_name,
CASE t WHEN 0 THEN y || '年以上' WHEN 1 THEN y || '-' || (y + 2) || '年' WHEN 2 THEN y || '年' ELSE 'no_requirement' END AS suggested_value, CASE WHEN t < 3 THEN y END AS min_years, CASE t WHEN 1 THEN y + 2 WHEN 2 THEN y END AS max_years,
CASE t WHEN 2 THEN 'medium' ELSE 'high' END AS confidence, CASE t WHEN 0 THEN 5 WHEN 3 THEN 3 ELSE 3 END AS evidence_start, CASE t WHEN 0 THEN 5 + length(y::VARCHAR) + 3 WHEN 1 THEN 3 + length(y::VARCHAR) + 1 + length((y + 2)::VARCHAR) + 1 WHEN 2 THEN 3 + length(y::VARCHAR) + 1 ELSE 7 END AS evidence_end FROM x""")
def stated_experience(spark, sf_dir):
    """Years of experience as Chinese requirements state them, one form a supplier's number, the years from the quantity."""
    y, t = c("l_quantity").cast("int").cast("string"), c("l_suppkey") % 4
    more = (c("l_quantity").cast("int") + 2).cast("string")
    text = F.when(t == 0, F.concat(F.lit("1. 要求"), y, F.lit("年以上测试经验；熟悉软件"))).when(t == 1, F.concat(F.lit("要求："), y, F.lit("-"), more, F.lit("年经验"))).when(t == 2, F.concat(F.lit("需要有"), y, F.lit("年相关经验"))).otherwise(F.lit("本岗位经验不限"))
    jobs = read(spark, sf_dir, "lineitem").select(F.lit("p").alias("platform"), F.concat_ws("-", "l_orderkey", "l_linenumber", "l_partkey").alias("job_id"), F.lit("").alias("experience"), text.alias("requirements"), F.lit("").alias("description"))
    return evidence.experience_evidence(jobs).select("job_id", "pattern_name", "suggested_value", "min_years", "max_years", "confidence", "evidence_start", "evidence_end")


_DEGREES = """x AS (SELECT o_orderkey, o_custkey % 5 AS t FROM orders)"""


@query(f"""WITH {_DEGREES} SELECT o_orderkey::VARCHAR AS job_id, CASE t WHEN 0 THEN 'bachelor_plus;major_required' WHEN 1 THEN 'master_plus' WHEN 2 THEN 'no_requirement' WHEN 3 THEN 'bachelor_plus;preferred_only' END AS pattern_name,
CASE t WHEN 0 THEN 'bachelor_plus;计算机相关专业' WHEN 1 THEN 'master_plus' WHEN 2 THEN 'no_requirement' WHEN 3 THEN 'bachelor_plus' END AS barrier, CASE t WHEN 3 THEN '硕士' ELSE '' END AS preferred, CASE t WHEN 3 THEN 'medium' ELSE 'high' END AS confidence FROM x WHERE t < 4""")
def stated_education(spark, sf_dir):
    """Degrees and majors as Chinese requirements state them, one form a customer's number; the last form states none."""
    t = c("o_custkey") % 5
    text = F.when(t == 0, "本科及以上学历，计算机相关专业").when(t == 1, "硕士以上学历；熟悉测试").when(t == 2, "学历不限").when(t == 3, "大学本科及以上，硕士优先").otherwise("沟通良好")
    jobs = read(spark, sf_dir, "orders").select(F.lit("p").alias("platform"), c("o_orderkey").cast("string").alias("job_id"), F.lit("").alias("education"), text.alias("requirements"), F.lit("").alias("description"))
    return evidence.education_evidence(jobs).select("job_id", "pattern_name", "barrier", "preferred", "confidence")
