import inspect
import re

from pyspark.sql import functions as F

from postlens.operators import classify
from tests import golden_cases as golden

INPUT = "case_id string, title string, description string, requirements string"


def frame(spark, rows):
    return spark.createDataFrame([tuple(str(c.get(k) or "") for k in ("case_id", "title", "description", "requirements")) for c in rows], INPUT)


def made(spark, rows):
    return spark.createDataFrame([(str(n), *r[:3]) for n, r in enumerate(rows)], INPUT)


def test_fit_golden_cases(spark):
    got = {int(r.case_id): r.fit for r in classify.add_fit(made(spark, golden.FIT)).collect()}
    told = {n: (f.role_family, f.ai_relation, f.seniority_level, f.career_pool, f.triggered_rules[0]) for n, f in got.items()}
    assert {n: (golden.FIT[n][:2], t) for n, t in told.items() if t != golden.FIT[n][3:]} == {}
    rules = set(re.findall(r'^ +\(.*, "([a-z_]+)"\),$', inspect.getsource(classify.relation), re.M)) | {"no_ai_relation"}
    assert {t[4] for t in told.values()} == rules and len(rules) == 16


def test_market_golden_cases(spark):
    out = classify.add_market(made(spark, golden.MARKET))
    got = {int(r.case_id): r.market for r in out.collect()}
    told = {n: (m.in_scope, m.market_relevance, m.role_family, m.ai_relation, m.secondary_role_families) for n, m in got.items()}
    assert {n: (golden.MARKET[n][:2], t) for n, t in told.items() if t != golden.MARKET[n][3:]} == {}
    assert classify.invalid_market(out).count() == 0


def test_labels_do_not_depend_on_who_else_is_there(spark):
    """Each posting alone, and in another order with other fields, has the labels that it has among all."""
    rows = made(spark, golden.FIT + [r[:3] for r in golden.MARKET])
    both = lambda df: {r.case_id: (r.fit, r.market) for r in classify.add_fit(classify.add_market(df)).collect()}
    want = both(rows)
    assert both(rows.orderBy(F.desc("case_id")).withColumns({"company": F.lit("x"), "job_id": F.col("case_id"), "platform": F.lit("p")})) == want
    assert both(rows.where("case_id = '3'")) == {"3": want["3"]}


def test_blank_posting(spark):
    r = classify.add_skills(classify.add_fit(classify.add_market(spark.createDataFrame([("1", None, None, "")], INPUT)))).first()
    assert (r.market.in_scope, r.market.role_family, r.market.reason_codes, r.fit.career_pool, r.skill_tags) == (False, None, ["AI_EVALUATION_NOT_ESTABLISHED"], "X", [])


def test_carry_forward(spark):
    day = "2024-01-0"
    text = "负责大模型评测体系建设；负责AI产品质量保障与测试执行"
    rows = [(f"{day}1", text, True, []), (f"{day}2", "", False, ["DETAIL_FAILED_JOB_ID"]), (f"{day}3", "", False, ["DETAIL_FAILED_JOB_ID"]), (f"{day}4", "普通", True, []), (f"{day}5", "", False, ["PROBABLE_DETAIL_FAILURE"])]
    jobs = spark.createDataFrame([(d, "p", "1", "c", "大模型测试开发工程师", b, "", "u", ok, why) for d, b, ok, why in rows], "snapshot_date string, platform string, job_id string, company string, title string, description string, requirements string, url string, content_reliable boolean, health_reasons array<string>")
    got = {r.snapshot_date[-1]: r for r in classify.classify_snapshots(jobs, "m", "f", "s").collect()}
    assert got["1"].classification_status == "fresh" and got["1"].in_scope
    for d in "23":
        assert got[d].classification_status == "carried_forward" and got[d].content_sha256 == got["1"].content_sha256
        assert got[d].reason_codes.market[-1] == "CONTENT_CARRIED_FORWARD"
    assert "4" not in got  # out of scope, and reliably so: nothing to inherit from here on
    assert got["5"].in_scope is None and got["5"].reason_codes.market == ["CONTENT_CLASSIFICATION_UNKNOWN"]


def test_workplace(spark):
    rows = [("深圳市", "x", None, True), ("北京", "深圳大学合作测试", None, False), ("深圳除外", "深圳", None, False), ("广东省深圳", "北京测试", None, True), ("", "不招深圳", None, False)]
    got = classify.workplace_match(spark.createDataFrame([r[:2] for r in rows], "location string, title string")).collect()
    assert [r.workplace.matches for r in got] == [r[3] for r in rows]
    assert got[3].workplace.location_conflict and got[2].workplace.needs_verification


def test_explanations(spark):
    rows = frame(spark, [{"case_id": "1", "title": "产品经理"}])
    r = classify.explain(classify.add_fit(rows), F.lit(False)).first()
    assert r.exclusion_codes == ["outside_config_scope", "role_product"] and r.exclusion_reason.endswith("。")


def test_words_allow_every_pattern_that_occurs(spark):
    """Labels by way of the words are those without; letters that a pattern without case takes for others count, and patterns without any word are not tried."""
    more = [("测试工程师", "负责ÅI AGENT质量保障；使用ſQL与Kubernetes，PytHon和LLM测试用例生成", "五年测试开发经验"), ("plain", "no such word", ""), (None, None, None), ("QA", "aıgc ragı RAG benchmarKing", "")]
    rows = frame(spark, [dict(zip(("case_id", "title", "description", "requirements"), (i, *r[:3]))) for i, r in enumerate([*golden.FIT, *golden.MARKET, *more])])
    key = lambda df: {r.case_id: (r.market, r.fit, r.skill_tags) for r in df.collect()}
    assert key(classify.add_labels(rows)) == key(classify.add_skills(classify.add_fit(classify.add_market(rows))))
    assert classify.needed(r"(?:AI|大模型).{0,9}(?:测试|质量)|\bQA\b") == ("qa", "测试", "质量") and classify.needed(r"\d?.*") == ()
    assert all(classify.needed(p) for d in (classify.MARKET, classify.MARKET_CASES, classify.FIT, classify.EVIDENCE, dict(classify.SKILLS)) for p in d.values())
