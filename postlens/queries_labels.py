"""Queries of the label rules over Chinese postings, put together from parts by each document's number.

Their SQL knows the parts by number and writes down what the rules say of each and how labels follow from that.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .functions import text as X
from .operators import classify, clean, report, trends
from .operators.ontology import EDUCATION, SKILLS
from .queries import c, query, read

TITLES = ("大模型测试开发工程师", "AI产品经理", "资深软件测试工程师", "评测算法工程师", "测试实习生", "质量保障专家", "用户运营", "芯片测试工程师", "后端开发工程师", "模型评测工程师")
BODIES = ("负责模型能力评测体系的建设；负责评测集构建", "负责测试用例自动生成平台的落地；参与回归测试", "负责AI产品的质量保障与测试执行", "了解大模型相关知识；负责功能测试", "负责日常沟通；负责数据分析")
ASKED = ("本科及以上；熟悉 Python 和 SQL", "六年以上测试经验", "具备团队管理和梯队建设经验", "")
PLACES = ("深圳市", "北京市/上海市", "广东省深圳市", "深圳市除外", "Hong Kong", " ", "杭州、广州")


def chinese_postings(spark, sf_dir) -> DataFrame:
    pick = lambda parts, n: F.element_at(F.array(*[F.lit(x) for x in parts]), (n % len(parts) + 1).cast("int"))
    n = c("doc_id")
    return read(spark, sf_dir, "documents").select("doc_id", n.cast("string").alias("job_id"), c("source").alias("platform"), F.concat(F.lit("c"), n % 3).alias("company"), pick(TITLES, n).alias("title"), pick(BODIES, F.floor(n / 10)).alias("description"), pick(ASKED, F.floor(n / 50)).alias("requirements"), pick(PLACES, n).alias("location"))


#: Numbers of title, body and requirements; level, by the fit rules; whether any text names AI.
PARTS = """k AS (SELECT doc_id, source, doc_id % 10 AS t, (doc_id // 10) % 5 AS b, (doc_id // 50) % 4 AS r FROM documents),
lv AS (SELECT *, CASE WHEN t = 4 THEN 'intern' WHEN t = 5 OR r = 2 THEN 'expert_lead' WHEN t = 2 OR r = 1 THEN 'senior' ELSE 'regular' END AS level, t IN (0, 1) OR b IN (2, 3) AS ai FROM k)"""
_ROLE = "CASE WHEN t IN (0, 5) THEN 'quality_engineering' WHEN t = 1 THEN 'product' WHEN t IN (2, 4, 7) THEN 'qa_test' WHEN t = 3 THEN 'algorithm_research' WHEN t = 6 THEN 'operations' WHEN t = 8 THEN 'development' ELSE 'evaluation_engineering' END"


@query(f"WITH {PARTS} SELECT doc_id, {_ROLE} AS role_family, CASE t WHEN 1 THEN 'role_product' WHEN 3 THEN 'role_algorithm_or_research' WHEN 6 THEN 'role_operations' WHEN 8 THEN 'role_general_rnd' END AS reason FROM k")
def title_roles(spark, sf_dir):
    family, reason = classify.title_role(c("title"))
    return chinese_postings(spark, sf_dir).select("doc_id", family.alias("role_family"), reason.alias("reason"))


@query(f"WITH {PARTS} SELECT doc_id, level AS seniority_level FROM lv")
def seniority_levels(spark, sf_dir):
    return chinese_postings(spark, sf_dir).select("doc_id", classify.seniority(c("title"), c("description"), c("requirements")).alias("seniority_level"))


#: Fit rules: hardware first, then measuring roles, then other roles, then what duties and titles show.
FIT_SQL = f"""{PARTS}, f AS (SELECT *, {_ROLE} AS role, CASE WHEN t = 7 THEN CASE WHEN ai THEN 'ai_context_only' ELSE 'none' END WHEN t IN (3, 9) THEN CASE WHEN ai THEN 'core_ai_evaluation' ELSE 'none' END
WHEN t IN (1, 6, 8) THEN CASE WHEN b = 0 THEN 'core_ai_evaluation' WHEN b = 1 THEN 'ai_for_testing' WHEN ai THEN 'ai_context_only' ELSE 'none' END
WHEN t = 0 AND b < 4 THEN 'ai_product_quality' WHEN b = 1 THEN 'ai_for_testing' WHEN b = 2 THEN 'ai_product_quality' WHEN ai THEN 'ai_context_only' ELSE 'none' END AS rel FROM lv),
g AS (SELECT *, CASE WHEN t = 7 THEN 'domain_hardware' WHEN t = 1 THEN 'role_product' WHEN t = 6 THEN 'role_operations' WHEN t = 8 THEN 'role_general_rnd' WHEN level = 'intern' THEN 'level_intern' WHEN t = 3 AND rel <> 'core_ai_evaluation' THEN 'role_algorithm_or_research'
WHEN rel IN ('ai_context_only', 'none') THEN 'ai_not_primary_duty' WHEN level = 'expert_lead' THEN 'level_expert_lead' WHEN t = 3 THEN 'role_algorithm_or_research' ELSE '' END AS reason FROM f),
h AS (SELECT *, CASE WHEN t IN (7, 1, 6, 8) OR level = 'intern' OR (t = 3 AND rel <> 'core_ai_evaluation') OR rel IN ('ai_context_only', 'none') THEN 'X' WHEN level = 'expert_lead' THEN 'REF' WHEN role IN ('qa_test', 'quality_engineering') THEN 'P1' ELSE 'P2' END AS pool FROM g)"""


def _fit(spark, sf_dir) -> DataFrame:
    return classify.add_fit(chinese_postings(spark, sf_dir))


@query(f"WITH {FIT_SQL} SELECT doc_id, role AS role_family, rel AS ai_relation, level AS seniority_level, pool AS career_pool, reason AS reason_codes, role || '_' || rel || '_' || lower(pool) AS rule_id FROM h")
def fit_labels(spark, sf_dir):
    return _fit(spark, sf_dir).select("doc_id", "fit.role_family", "fit.ai_relation", "fit.seniority_level", "fit.career_pool", F.array_join("fit.reason_codes", ",").alias("reason_codes"), "fit.rule_id")


@query(f"WITH {FIT_SQL}, e AS (SELECT doc_id, pool <> 'X' AND doc_id % 4 <> 0 AS selected, CASE WHEN doc_id % 4 = 0 THEN 'outside_config_scope' || CASE WHEN reason <> '' THEN ',' || reason ELSE '' END ELSE reason END AS codes FROM h) SELECT doc_id, selected, CASE WHEN NOT selected THEN codes END AS exclusion_codes FROM e")
def explanations(spark, sf_dir):
    rows = classify.explain(_fit(spark, sf_dir), c("doc_id") % 4 != 0)
    return rows.select("doc_id", "selected", F.when(~c("selected"), F.array_join("exclusion_codes", ",")).alias("exclusion_codes"))


#: Market rules: in scope are owned evaluation beside AI, and quality work on AI products of those whose title says testing.
MARKET_SQL = f"""{PARTS}, m AS (SELECT *, (t = 0 AND b < 4) OR (t = 1 AND b = 0) OR (t IN (2, 5, 7) AND b = 2) AS inside, {_ROLE} AS role FROM lv)"""


@query(f"""WITH {MARKET_SQL} SELECT doc_id, inside AS in_scope, CASE WHEN inside THEN 'core' END AS market_relevance, CASE WHEN inside THEN role END AS role_family, CASE WHEN inside THEN CASE WHEN b = 0 THEN 'core_ai_evaluation' ELSE 'ai_product_quality' END END AS ai_relation,
level AS seniority_level, CASE WHEN inside AND b = 0 THEN 'evaluation_engineering' ELSE '' END AS secondary FROM m""")
def market_labels(spark, sf_dir):
    m = classify.add_market(chinese_postings(spark, sf_dir))
    return m.select("doc_id", "market.in_scope", "market.market_relevance", "market.role_family", "market.ai_relation", "market.seniority_level", F.array_join("market.secondary_role_families", ",").alias("secondary"))


_TAGS = "[CASE WHEN b = 0 THEN '评测体系与指标设计' END, CASE WHEN r = 0 THEN 'Python' END, CASE WHEN b = 4 THEN '数据分析与处理' END, CASE WHEN b = 0 THEN 'Benchmark与评测集' END, CASE WHEN t = 0 OR b = 3 THEN '大语言模型/LLM' END, CASE WHEN t IN (2, 5) OR b IN (1, 2, 3) THEN '测试与质量保障' END, CASE WHEN r = 0 THEN 'SQL' END]"


@query(f"WITH {PARTS} SELECT doc_id, array_to_string(list_filter({_TAGS}, lambda x: x IS NOT NULL), ',') AS skills FROM k")
def skill_labels(spark, sf_dir):
    return classify.add_skills(chinese_postings(spark, sf_dir)).select("doc_id", F.array_join("skill_tags", ",").alias("skills"))


@query(f"WITH {PARTS}, x AS (SELECT unnest(list_filter({_TAGS}, lambda x: x IS NOT NULL)) AS name FROM k) SELECT name, count(*) AS n, count(*)::DOUBLE / (SELECT count(*) FROM k) AS share FROM x GROUP BY name")
def skill_ranking(spark, sf_dir):
    rows = chinese_postings(spark, sf_dir).withColumn("text", F.concat_ws("\n", "title", "description", "requirements"))
    return report.ranking(rows.withColumn("tags", X.tags(c("text"), SKILLS)), "tags", order="job_id").select("name", "n", "share")


@query(f"WITH {PARTS} SELECT doc_id, '本科及以上' AS education FROM k WHERE r = 0")
def education_tags(spark, sf_dir):
    rows = chinese_postings(spark, sf_dir).withColumn("tags", X.tags(c("requirements"), EDUCATION))
    return rows.where(F.size("tags") > 0).select("doc_id", F.array_join("tags", ",").alias("education"))


@query(f"""WITH {PARTS}, x AS (SELECT doc_id, unnest(CASE b WHEN 0 THEN ['负责模型能力评测体系的建设', '负责评测集构建'] WHEN 1 THEN ['负责测试用例自动生成平台的落地', '参与回归测试'] WHEN 2 THEN ['负责AI产品的质量保障与测试执行'] WHEN 3 THEN ['了解大模型相关知识', '负责功能测试'] ELSE ['负责日常沟通', '负责数据分析'] END) AS clause FROM k)
SELECT doc_id, clause, starts_with(clause, '负责') AS owned FROM x""")
def owned_clauses(spark, sf_dir):
    rows = chinese_postings(spark, sf_dir).select("doc_id", F.explode(X.clauses(c("description"))).alias("clause"))
    return rows.select("doc_id", "clause", classify.owned(c("clause")).alias("owned"))


#: Only 市 ends a city that no alias names, so a province before it stays.
_PLACES = "[['深圳'], ['北京', '上海'], ['广东省深圳'], [], [], [], ['杭州', '广州']]"


@query("SELECT doc_id, doc_id % 7 IN (0, 2) AS matches, doc_id % 7 = 3 AS negated FROM documents")
def workplaces(spark, sf_dir):
    rows = classify.workplace_match(chinese_postings(spark, sf_dir))
    return rows.select("doc_id", "workplace.matches", (F.size("workplace.negative_fields") > 0).alias("negated"))


@query(f"WITH {FIT_SQL} SELECT doc_id FROM h WHERE pool IN ('P1', 'P2') AND doc_id % 7 IN (0, 2)")
def chosen_candidates(spark, sf_dir):
    rows = _fit(spark, sf_dir).withColumn("career_pool", c("fit.career_pool"))
    return classify.select_candidates(rows).select("doc_id")


def _days(spark, sf_dir) -> DataFrame:
    """Four days of each posting; the detail page of one day in four fails, by number."""
    days = chinese_postings(spark, sf_dir).withColumn("day", F.explode(F.sequence(F.lit(0), F.lit(3)))).withColumn("failed", (c("doc_id") + c("day")) % 4 == 3)
    return days.select(
        F.date_add(F.lit("2024-01-01").cast("date"), c("day")).alias("snapshot_date"), "platform", "job_id", "company", "title", F.when(c("failed"), "").otherwise(c("description")).alias("description"),
        F.when(c("failed"), "").otherwise(c("requirements")).alias("requirements"), F.lit("u").alias("url"), (~c("failed")).alias("content_reliable"), F.when(c("failed"), F.array(F.lit("DETAIL_FAILED_JOB_ID"))).otherwise(F.array().cast("array<string>")).alias("health_reasons"),
    )


DAYS = f"""{MARKET_SQL}, d AS (SELECT m.*, day, (doc_id + day) % 4 = 3 AS failed FROM m, range(4) AS x(day)),
s AS (SELECT *, CASE WHEN NOT failed THEN CASE WHEN inside THEN 'fresh' END WHEN inside AND day > 0 THEN 'carried_forward' ELSE 'review_required' END AS status FROM d)"""


@query(f"WITH {DAYS} SELECT CAST(DATE '2024-01-01' + day::INT AS DATE) AS snapshot_date, CAST(doc_id AS VARCHAR) AS job_id, status AS classification_status, CASE WHEN status <> 'review_required' THEN true END AS in_scope, CASE WHEN status <> 'review_required' THEN role END AS role_family FROM s WHERE status IS NOT NULL")
def carried_labels(spark, sf_dir):
    """A failed detail page inherits the day before's label; without one, the posting is unknown."""
    rows = classify.classify_snapshots(_days(spark, sf_dir), "m", "f", "s")
    return rows.select("snapshot_date", "job_id", "classification_status", "in_scope", "role_family")


@query(f"WITH {DAYS} SELECT CAST(DATE '2024-01-01' + day::INT AS DATE) AS snapshot_date, source AS platform, count(*) AS n FROM s WHERE status IN ('fresh', 'carried_forward') GROUP BY 1, 2")
def usable_labels(spark, sf_dir):
    rows = classify.classify_snapshots(_days(spark, sf_dir), "m", "f", "s")
    return rows.where(c("in_scope") & trends.usable(c("classification_status"), c("reason_codes.market"), c("career_pool"))).groupBy("snapshot_date", "platform").agg(F.count("*").alias("n"))


@query(f"SELECT doc_id, array_to_string({_PLACES}[(doc_id % 7 + 1)::INT], ',') AS cities FROM documents")
def location_cities(spark, sf_dir):
    return clean.normalize_locations(chinese_postings(spark, sf_dir)).select("doc_id", F.array_join("city_norm", ",").alias("cities"))
