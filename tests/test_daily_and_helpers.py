"""Daily health from manifests and postings, configurations, split regression, and the small parts around them."""

import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from postlens.functions import text
from postlens.operators import classify, clean, evidence, ops, report, scoring, trends
from postlens.plans import daily
from postlens.sources import files, postings
from postlens.streaming import observations
from tests.test_health_and_lifecycle import COLUMNS, manifest

D = dt.date(2024, 1, 5)
LIMIT = "id string, platform string, status string, allowed_reasons array<string>, review_after string"
RUN = "status string, crawl string, clean string, analysis string"


def day_of(spark, **changes):
    """A day of three postings, whose source is as told."""
    jobs = spark.createDataFrame([(D, "p", str(i), "co", "测试", "x" * 20 if i or "gap" not in changes else "", "y" if i or "gap" not in changes else "") for i in range(3)], "snapshot_date date, platform string, job_id string, company string, title string, description string, requirements string")
    meta = changes.pop("metadata", None)
    changes.pop("gap", None)
    row = manifest(**{**dict(snapshot_date=D, jobs_in_scope=3, jobs_mapped=3, records_fetched=3, source_total=3, details_fetched=3), **changes})
    m = spark.createDataFrame([row], COLUMNS).withColumns({"job_count": F.lit(3).cast("long"), "metadata": F.lit(None if meta is None else json.dumps(meta)).cast("string")})
    return m, jobs


def document(spark, limits=(), day="2024-01-05", run="SUCCESS", tolerance=(0, 0.0), **changes):
    m, jobs = day_of(spark, **changes)
    rows, status = daily.health_document(spark.createDataFrame([(run, "SUCCESS", "SUCCESS", "SUCCESS")], RUN), m, jobs, spark.createDataFrame(list(limits), LIMIT), day, *tolerance)
    r, s = rows.first(), status.first()
    return (r.interpretation, r.limitation_id, r.governance_reasons, r.completeness), (s.technical, s.ops_status)


def test_health_of_a_day(spark):
    assert document(spark) == (("NORMAL", None, [], "COMPLETE"), ("SUCCESS", "OK"))
    assert document(spark, run="FAILED")[1] == ("FAILED", "FAILED")
    short = dict(status="partial", complete=False, stopped_by="unique_deficit", source_total=4, failed_companies=[])
    none = ("NEW_REGRESSION", None, ["NO_ACTIVE_KNOWN_LIMITATION_MATCH"], "PARTIAL")
    assert document(spark, **short) == (none, ("SUCCESS", "ACTION_REQUIRED"))
    meta = {"pagination_mode": "offset_dynamic", "stable_snapshot_mechanism": False, "list_complete": False, "list_error": False, "completeness_reasons": ["unique_deficit"]}
    limit = [("l", "p", "active", ["unique_deficit"], "2024-06-01")]
    assert document(spark, limit, metadata=meta, **short) == (("KNOWN_LIMITATION", "l", [], "PARTIAL"), ("SUCCESS", "OK_WITH_LIMITATIONS"))
    assert document(spark, [(*limit[0][:4], "2024-01-05")], metadata=meta, **short)[0] == ("NEW_REGRESSION", "l", ["KNOWN_LIMITATION_REVIEW_DUE"], "PARTIAL")
    for key, other in (("pagination_mode", "page"), ("stable_snapshot_mechanism", True), ("list_complete", True), ("completeness_reasons", ["other"]), ("completeness_reasons", [])):
        assert document(spark, limit, metadata={**meta, key: other}, **short)[0] == none, key
    assert document(spark, [(*limit[0][:2], "retired", *limit[0][3:])], metadata=meta, **short)[0] == none


def test_tolerated_gap_of_a_day(spark):
    gap = dict(status="partial", complete=False, stopped_by="detail_errors", detail_failed=1, details_fetched=2, detail_failed_job_ids=["0"], failed_companies=[], gap=True)
    assert document(spark, **gap)[0] == ("NEW_REGRESSION", None, ["NO_ACTIVE_KNOWN_LIMITATION_MATCH"], "PARTIAL")
    assert document(spark, tolerance=(1, 0.5), **gap) == (("NORMAL", None, ["TOLERATED_DETAIL_GAP"], "PARTIAL"), ("SUCCESS", "OK"))
    assert document(spark, tolerance=(1, 0.1), **gap)[0][0] == "NEW_REGRESSION"


# configurations


def test_config_shapes(tmp_path):
    fine = {"platforms": {"a": {"enabled": True, "companies": [{"name": "x"}], "detail_url": "u"}}, "cities": ["深圳"]}
    assert files.config_problems(fine, files.MAIN) == []
    assert files.config_problems({"platforms": {"a": {"enabled": "yes"}}, "cities": []}, files.MAIN) == ["$.platforms.a.enabled: bool is needed", "$.cities: a list of one or more is needed"]
    assert files.config_problems({"cities": ["x"]}, files.MAIN) == ["$.platforms: missing"] and files.config_problems([], files.MAIN) == ["$: a mapping is needed"]
    versions = {"market_classifier_version": "m", "fit_classifier_version": " ", "skill_ontology_version": "s", "trend": {"window_days": 8, "removal_confirmation_runs": True, "odd": 1}}
    assert files.config_problems(versions, files.VERSIONS) == ["$.fit_classifier_version: str is needed", "$.trend.window_days: one of ['7'] is needed", "$.trend.removal_confirmation_runs: int is needed", "$.trend.odd: unknown key"]
    entry = {"id": "l", "platform": "p", "status": "open", "category": "c", "allowed_reasons": ["r"], "review_after": "2024-01-01", "review_cadence_days": 30, "reference": {"doc": "x"}}
    assert files.config_problems({"version": 1, "limitations": [entry]}, files.LIMITATIONS) == ["$.limitations[0].status: one of ['active', 'retired'] is needed"]
    assert files.config_problems({"version": True, "limitations": []}, files.LIMITATIONS) == ["$.version: one of ['1'] is needed", "$.limitations: a list of one or more is needed"]
    (tmp_path / "t.yaml").write_text("max_failed_details: 3\nmax_failed_rate: 0.01\n")
    assert files.load_config(str(tmp_path / "t.yaml"), files.TOLERANCE) == {"max_failed_details": 3, "max_failed_rate": 0.01}
    (tmp_path / "t.yaml").write_text("max_failed_details: x\n")
    with pytest.raises(ValueError, match="max_failed_rate: missing; .*max_failed_details: int is needed"):
        files.load_config(str(tmp_path / "t.yaml"), files.TOLERANCE)


# regression


def test_split_regression(spark):
    rows = [("a", "大模型测试开发工程师", "负责AI产品质量保障", ""), ("b", "招聘专员", "负责人才招聘", ""), ("c", "软件测试工程师", "负责利用AI提升测试效率", "")]
    labelled = classify.add_fit(classify.add_market(spark.createDataFrame(rows, "case_id string, title string, description string, requirements string")))
    fields = "case_id string, in_scope boolean, role_family string, ai_relation string, seniority_level string, career_pool string, fit_reason_codes array<string>"
    right = [("a", True, "quality_engineering", "ai_product_quality", "regular", "P1", []), ("b", False, None, None, "regular", "P1", []), ("c", True, "qa_test", "core_ai_evaluation", "regular", "X", ["ai_not_primary_duty"])]
    total, wrong = scoring.split_regression(labelled, spark.createDataFrame(right, fields))
    assert {r.suite: (r.total, r.passed, r.failed) for r in total.collect()} == {"market": (3, 2, 1), "fit": (2, 2, 0)}  # b is no case of fit's
    assert [tuple(r) for r in wrong.collect()] == [("market", "c", "ai_relation", "core_ai_evaluation", "ai_for_testing")]
    assert [r.suite for r in scoring.split_regression(labelled, spark.createDataFrame(right, fields), "fit")[0].collect()] == ["fit"]
    with pytest.raises(ValueError, match="COVER_THE_CASES: c"):
        scoring.split_regression(labelled, spark.createDataFrame(right[:2], fields))
    with pytest.raises(ValueError, match="unknown suite"):
        scoring.split_regression(labelled, spark.createDataFrame(right, fields), "x")


def test_scores_and_cases(spark):
    sets = spark.createDataFrame([(["a", "b"], ["a"]), (["c"], ["c", "d"])], "expected array<string>, predicted array<string>")
    r = scoring.micro_sets(sets, "expected", "predicted").first()
    assert (r.tp, r.fp, r.fn, r.precision, r.recall) == (2, 1, 1, 2 / 3, 2 / 3)
    rates = scoring.pass_rates(spark.createDataFrame([(["x", "y"], True), (["x"], False)], "tags array<string>, ok boolean"), "tags", F.col("ok"))
    assert {r.tag: (r.cases, r.passed, r.rate) for r in rates.collect()} == {"x": (2, 1, 0.5), "y": (1, 1, 1.0)}
    cases = spark.createDataFrame([("a", "h", "old"), ("b", "h2", "old")], "case_id string, content_sha256 string, role string")
    new = spark.createDataFrame([("a", "h", "new"), ("b", "other", "new")], "case_id string, content_sha256 string, role string")
    assert {r.case_id: r.role for r in scoring.migrated(cases, new, ["role"]).collect()} == {"a": "new", "b": "old"}
    quoted = "case_id string, platform string, job_id string, title string, description string, requirements string, evidence struct<title: array<string>, description: array<string>, requirements: array<string>>"
    rows = [("a", "p", "1", "t", "text", "", (["t"], ["ex"], [])), ("a", "p", "2", "t", "text", "", ([], ["none"], [""]))]
    assert {tuple(r) for r in scoring.case_problems(spark.createDataFrame(rows, quoted), 2).collect()} == {("CASE_COUNT_OR_DUPLICATE", None), ("EVIDENCE_NOT_IN_TEXT", "a")}


# small parts


def one(spark, *columns):
    return tuple(spark.range(1).select(*columns).first())


def test_parts_of_cleaning(spark):
    jobs = spark.createDataFrame([("本科", " 3-5年 ", "d", "r"), ("", "", "硕士以上", "")], "education string, experience string, description string, requirements string")
    got = jobs.select(clean.education_values(jobs).alias("e"), clean.experience_values().alias("x")).collect()
    assert got[0].e and got[0].x and got[1].x == []
    assert one(spark, clean.text_list(F.array(F.lit(" a "), F.lit("a"), F.lit(""), F.lit("b"))))[0] == ["a", "b"]
    rows = text.classifier_input(spark.createDataFrame([(" t ", None, "r", "co")], "title string, description string, requirements string, company string"))
    assert rows.columns == list(text.CONTENT_FIELDS) and set(rows.first()) == {"t", "", "r"}


def test_parts_of_reading(spark, tmp_path):
    of = lambda x: one(spark, postings.coerce_text(F.parse_json(F.lit(json.dumps(x)))))[0]
    assert [of(x) for x in ("a", ["a", {"name": "b"}], {"name": "n"}, {"value": "v"}, None)] == ["a", "a, b", "n", "v", ""]
    listed = spark.createDataFrame([("p", "2", 1, 1, "t"), ("p", "1", 1, 0, None), ("p", "", 1, 2, "t")], "platform string, job_id string, page int, position int, title string")
    assert [r.job_id for r in postings.detail_queue(listed).collect()] == ["1", "2"] and postings.detail_queue(listed, 1).count() == 1
    assert {r.job_id: r.title for r in postings.placeholders(listed, {"title": "-"}).collect()} == {"2": "t", "1": "-", "": "t"}
    errors = spark.createDataFrame([("a",), ("a",), ("b",), (None,)], "error_type string")
    assert [tuple(r) for r in postings.error_histogram(errors).collect()] == [("a", 2), ("b", 1)]
    ledger = spark.createDataFrame([("x", 1, 5), ("x", 2, 7), ("x", 3, 6)], "city string, page int, total int")
    assert tuple(postings.city_totals(ledger).first()) == ("x", 5, 6, 5, 7)
    (tmp_path / "2024-01-05_manifest.json").write_text(json.dumps({"job_count": 3, "cities": ["b", "a"], "complete": True, "platforms": [{"platform": "p", "status": "success"}, {"platform": "q", "status": "error"}]}))
    got = files.read_manifests(spark, str(tmp_path)).orderBy("platform").collect()
    assert [(r.snapshot_date, r.platform, r.status, r.job_count, r.cities) for r in got] == [(D, "p", "success", 3, ["a", "b"]), (D, "q", "error", 3, ["a", "b"])]


def test_parts_of_reports(spark):
    rows = spark.createDataFrame([("本科", "要求本科", "h1"), ("硕士", "x", "h1"), ("", "x", "h2")], "education string, body string, content_sha256 string")
    found, values = report.field_coverage(rows, "education", F.col("body"))
    assert tuple(found.first()) == (2, 1) and {r.value for r in values.collect()} == {"本科", "硕士"}
    assert {r.key: r.n for r in trends.value_counts(rows, "body").collect()} == {"要求本科": 1, "x": 2}
    assert trends.content_versions(rows.withColumn("snapshot_date", F.lit(D))).first().unique_content_versions == 2
    hits = spark.createDataFrame([("p", "a"), ("p", "a"), ("q", "b")], "platform string, pattern_name string")
    assert {tuple(r) for r in evidence.evidence_counts(hits).collect()} == {("p", "a", 2), ("q", "b", 1)}
    assert one(spark, classify.evidence_terms(F.lit("负责AI和大模型"), "context"))[0] == ["AI", "大模型"]
    inherited = F.array(F.lit("CONTENT_CARRIED_FORWARD"))
    assert one(spark, classify.market_reliable(F.lit("review_required"), inherited, F.array(F.lit("REPLAY_REQUIRED"))), classify.market_reliable(F.lit("review_required"), inherited, F.array(F.lit("x"))), classify.market_reliable(F.lit("fresh"), inherited, inherited)) == (True, False, True)


def test_audit_of_a_day(spark):
    raw = spark.createDataFrame([(1, "p", "1", "co", "t", "深圳", "", "", "", "本科及以上学历；3年以上测试经验" + "x" * 40, "", "https://a/", "", "2024-01-05T01:00:00")], "row_number long, platform string, job_id string, title string, company string, location string, department string, experience string, education string, description string, requirements string, url string, salary string, scraped_at string")
    m = spark.createDataFrame([manifest(snapshot_date=D)], COLUMNS)
    got = daily.audit_day(raw, m, 1, {"education": (["本科"], [""], []), "experience": (["3年"], [""], [])})
    assert {r.pattern_name for r in got["education_evidence"].collect()} == {"bachelor_plus"} and {r.pattern_name for r in got["experience_evidence"].collect()} == {"min_years"}
    assert all(df.count() >= 0 for df in got.values())
    jobs = spark.createDataFrame([(D, "feishu", "c0")], "snapshot_date date, platform string, company string")
    scopes = spark.createDataFrame([manifest(snapshot_date=D, platform="feishu", attempted_companies=["c0", "c1"])], COLUMNS)
    assert [r.company for r in daily.scope_gaps(scopes, jobs).collect()] == ["c1"]


def test_registry_and_repeated_events(spark):
    rows = [("a", "p", "active", ["r"], "2024-01-01"), ("a", "p", "active", ["r"], "2024-01-01"), ("b", "p", "odd", ["r"], "2024-01-01"), ("c", "p", "active", [], "2024-01-01"), ("d", "p", "active", ["r"], "soon"), ("", "p", "active", ["r"], "2024-01-01"), ("e", "p", "retired", ["r"], "2024-01-01")]
    assert {tuple(r) for r in ops.registry_problems(spark.createDataFrame(rows, LIMIT)).collect()} == {("a", "DUPLICATE_ID"), ("b", "INVALID_STATUS"), ("c", "MISSING_REASONS"), ("d", "INVALID_REVIEW_DATE"), ("", "MISSING_ID")}
    events = spark.createDataFrame([(D, "p", "1", "NEW"), (D, "p", "1", "UPDATED"), (D, "p", "2", "MISSING"), (D, "p", "2", "MISSING")], "event_date date, platform string, job_id string, event_type string")
    trends.refuse_duplicate_events(events)
    with pytest.raises(ValueError, match="DUPLICATE_LIFECYCLE_EVENT: 2024-01-05 p 1 NEW x2"):
        trends.refuse_duplicate_events(events.union(events.limit(1)))


def test_sessions_of_a_stream(spark, tmp_path):
    at = lambda h, m: dt.datetime(2024, 1, 5, h, m)
    rows = spark.createDataFrame([("u", at(1, 0)), ("u", at(1, 20)), ("u", at(3, 0)), ("v", at(9, 0))], "user string, ts timestamp")
    rows.coalesce(1).write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(rows.schema).parquet(str(tmp_path / "in"))
    q = observations.sessions(stream, "ts", ["user"]).writeStream.format("parquet").option("path", str(tmp_path / "out")).option("checkpointLocation", str(tmp_path / "c")).outputMode("append").trigger(availableNow=True).start()
    assert q.awaitTermination(90)
    assert sorted((r.user, r.n) for r in spark.read.parquet(str(tmp_path / "out")).collect()) == [("u", 1), ("u", 2)]  # the last one is still open
