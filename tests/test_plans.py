import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from postlens.operators import trends
from postlens.plans import daily, replay
from tests.test_health_and_lifecycle import COLUMNS, manifest

D = [dt.date(2024, 1, d) for d in (1, 2, 3)]
POSTING = "snapshot_date date, platform string, job_id string, company string, title string, location string, description string, requirements string, url string, education string, experience string"
GOOD = "负责大模型评测体系建设；负责AI产品质量保障与测试执行"


def post(day, i, text=GOOD, title="大模型测试开发工程师"):
    return (day, "p", str(i), "co", title, "深圳市", text, "本科", "https://a/", "", "")


@pytest.fixture(scope="module")
def found(spark):
    rows = [post(D[0], 1), post(D[0], 2), post(D[1], 1, GOOD + "；补充"), post(D[1], 3), post(D[2], 3, "", "大模型测试开发工程师"), post(D[2], 4)]
    jobs = spark.createDataFrame(rows, POSTING)
    days = [manifest(snapshot_date=d) for d in D[:2]] + [manifest(snapshot_date=D[2], detail_failed=1, details_fetched=1, detail_failed_job_ids=["3"], status="partial", complete=False, stopped_by="detail_errors")]
    m = spark.createDataFrame(days, COLUMNS).withColumns({"job_count": F.lit(2).cast("long"), "cities": F.array(F.lit("深圳"))})
    return replay.replay(jobs, m)


def test_replay_events(found):
    got = sorted(((r.event_date - D[0]).days, r.job_id, r.event_type, r.event_status) for r in found.events.collect())
    assert got == [
        (0, "1", "FIRST_SEEN", "provisional"), (0, "2", "FIRST_SEEN", "provisional"), (1, "1", "UPDATED", "confirmed"), (1, "2", "MISSING", "provisional"), (1, "3", "NEW", "confirmed"),
        (2, "1", "MISSING", "provisional"), (2, "2", "REMOVED", "confirmed"), (2, "4", "NEW", "confirmed"),
    ]


def test_replay_labels_and_snapshots(spark, found):
    status = {((r.snapshot_date - D[0]).days, r.job_id): r.classification_status for r in found.classified.collect()}
    assert status == {(0, "1"): "fresh", (0, "2"): "fresh", (1, "1"): "fresh", (1, "3"): "fresh", (2, "3"): "carried_forward", (2, "4"): "fresh"}
    active = {(r.snapshot_date - D[0]).days: r.n for r in found.snapshots.where("dimension = 'active_jobs'").collect()}
    assert active == {0: 2, 1: 2, 2: 2}
    assert trends.broken_snapshots(found.snapshots).count() == 0
    rows = replay.compare_days(found, "2024-01-01", "2024-01-02")
    assert trends.broken_comparison(rows).count() == 0
    one = rows.where("dimension = 'active_jobs'").first()
    assert (one.from_n, one.to_n, one.delta, one.comparable) == (2, 2, 0, True)
    assert daily.weekly(found.snapshots, "2024-01-01", "2024-01-03")[0].count() > 0
    with pytest.raises(ValueError):
        daily.weekly(found.snapshots, "2024-01-01", "2024-01-09")


def test_candidate_report(found):
    day = F.col("snapshot_date") == F.lit(D[1])
    out = daily.candidate_report(found.classified.where(day).drop("snapshot_date"), found.postings.where(day).drop("snapshot_date"))
    assert out["problems"].count() == 0 and out["workplace"].count() == 2
    assert {r.company: (r.matched, r.in_scope) for r in out["companies"].collect()} == {"co": (2, 2)}


def test_explore(spark):
    jobs = spark.createDataFrame([post(D[0], 1), post(D[0], 2, title="产品经理"), ("2024-01-01", "q", *post(D[0], 3)[2:])][:2], POSTING)
    out = daily.explore(jobs, spark.createDataFrame([("p", None)], "platform string, companies array<string>"))
    assert out["selected"].count() == 1 and {r.reason for r in out["excluded"].collect()} == {"role_product"}


def test_collect_and_clean(spark, tmp_path):
    page = json.dumps({"data": {"list": [{"id": 1, "name": "a", "workPlaceNameList": ["深圳"]}, {"id": 2, "name": "b", "workPlaceNameList": ["北京"]}]}})
    pages = spark.createDataFrame([("netease", 1, page), ("baidu", 1, "broken")], "platform string, page int, payload string")
    rows, m = daily.collect(pages, ["netease", "baidu"], ["深圳"])
    assert [r.job_id for r in rows.collect()] == ["1"]
    assert {r.platform: (r.status, r.jobs_in_scope, r.outside_city_scope) for r in m.collect()} == {"netease": ("success", 1, 1), "baidu": ("error", 0, 0)}
    tracker, group = spark.sparkContext.statusTracker(), "clean-day"
    spark.sparkContext.setJobGroup(group, "one job")
    assert daily.clean_day(rows, str(tmp_path / "clean"), "2024-01-01") == {"job_count": 1, "city_count": 1, "province_only_count": 0}
    writes = [j for j in tracker.getJobIdsForGroup(group)]
    spark.sparkContext.setJobGroup("other", "")
    assert writes and daily.clean.clean_report(daily.resolve_day(spark, str(tmp_path / "clean"), "2024-01-01")).first().job_count == 1
    with pytest.raises(ValueError):
        daily.clean_day(rows.limit(0), str(tmp_path / "clean"), "2024-01-01")
    assert daily.resolve_day(spark, str(tmp_path / "clean"), "2024-01-01").first().city_norm == ["深圳"]


def test_completeness_of_a_collection(spark):
    def page(p, n, ids, total):
        return (p, n, json.dumps({"data": {"total": total, "list": [{"id": i, "name": "x", "workPlaceNameList": ["深圳"]} for i in ids]}}))

    rows = [page("netease", 1, [1, 2], 3), page("netease", 2, [3], 3), page("baidu", 1, [], 4), page("xiaohongshu", 1, [], 0)]
    lists = lambda *rows: spark.createDataFrame(list(rows), "platform string, page int, payload string")
    state = lambda pages, *names: {r.platform: (r.status, r.complete, r.stopped_by, r.source_total, r.expected_pages, r.pages_fetched) for r in daily.collect(pages, list(names), ["深圳"])[1].collect()}
    assert state(lists(*rows), "netease")["netease"] == ("success", True, "source_total_reached", 3, 2, 2)
    assert state(lists(rows[0]), "netease")["netease"] == ("partial", False, "incomplete_list", 3, 2, 1)
    assert state(lists(rows[0], page("netease", 3, [3], 3)), "netease")["netease"] == ("partial", False, "incomplete_list", 3, 3, 2)
    assert state(lists(page("netease", 1, [1, 2], 4), page("netease", 2, [3], 4)), "netease")["netease"][:3] == ("partial", False, "empty_page")
    assert state(lists(page("netease", 1, [1, None], 2)), "netease")["netease"][:3] == ("partial", False, "incomplete_list")


def test_merge_of_one_platform(spark, tmp_path):
    path = str(tmp_path / "days")
    rows = spark.createDataFrame([("p", "1"), ("q", "2")], "platform string, job_id string")
    daily.files.write_day(rows.withColumn("snapshot_date", F.lit("2024-01-01").cast("date")), path)
    manifest = lambda *m: spark.createDataFrame(list(m), "platform string, status string, complete boolean")
    new = spark.createDataFrame([("p", "7"), ("p", "8")], "platform string, job_id string")
    for bad, day in (([("p", "partial", False)], "2024-01-01"), ([], "2024-01-01"), ([("p", "success", True)], "2024-01-02")):
        with pytest.raises(ValueError):
            daily.merge_platform(new, manifest(*bad), path, day, "p")
    with pytest.raises(ValueError):
        daily.merge_platform(new.limit(0), manifest(("p", "success", True)), path, "2024-01-01", "p")
    daily.merge_platform(new, manifest(("p", "success", True), ("q", "error", False)), path, "2024-01-01", "p")
    assert sorted(r.job_id for r in spark.read.parquet(path).collect()) == ["2", "7", "8"]
    at = lambda t: spark.range(1).select(daily.default_day(F.lit(t).cast("timestamp_ntz")).alias("d")).first().d.isoformat()
    assert (at("2024-01-01 15:59:59"), at("2024-01-01 16:00:00")) == ("2024-01-01", "2024-01-02")


def test_trend_of_a_replay(spark, found):
    kinds = {(r.event_date.day, r.job_id, r.event_type): r.flow for r in found.trend.flows.collect()}
    assert kinds[(2, "1", "UPDATED")] == "counted" and kinds[(2, "3", "NEW")] == "counted" and kinds[(3, "2", "REMOVED")] == "counted" and kinds[(3, "1", "MISSING")] == "diagnostic"
    parts = replay.compare_snapshots(found, "2024-01-01", "2024-01-02")
    assert all(r.comparable for r in parts["comparability"].where("family = 'inventory'").collect())
    moved = {r.key: (r.from_n, r.to_n) for r in parts["lifecycle"].collect()}
    assert moved["new_jobs"] == (0, 1) and moved["updated_jobs"] == (0, 1)
    with pytest.raises(ValueError):
        replay.compare_snapshots(found, "2024-01-02", "2024-01-01")


def test_provenance(spark):
    from postlens.operators import ops

    t = lambda h: dt.datetime(2024, 1, 1, h)
    manifest = spark.createDataFrame([("p", 2, "run", t(1), t(3)), ("q", 1, "other", t(1), t(9)), ("r", 1, "run", t(2), t(3))], "platform string, jobs_in_scope long, invocation_id string, started_at timestamp, finished_at timestamp")
    raw = spark.createDataFrame([("p", "1", t(2)), ("p", "2", t(5)), ("q", "3", t(2))], "platform string, job_id string, scraped_at timestamp")
    clean = raw.drop("scraped_at").where("job_id <> '2'")
    classified = spark.createDataFrame([("p", "1"), ("p", "1"), ("z", "9")], "platform string, job_id string")
    got = {tuple(r) for r in ops.provenance_problems(manifest, raw, clean, classified, F.lit(t(0)), F.lit(t(8)), F.lit("run")).collect()}
    assert got == {("raw", "q", "INVOCATION_MISMATCH", 1), ("raw", "r", "COUNT_MISMATCH", 1), ("raw", "q", "WINDOW_INVALID", 1), ("raw", "p", "SCRAPED_OUTSIDE_WINDOW", 1), ("clean", "p", "IDENTITIES_DIFFER", 1), ("analysis", "z", "IDENTITY_UNKNOWN", 1), ("analysis", "p", "IDENTITY_REPEATED", 1)}


def test_frozen_regression(spark):
    from postlens.operators import ontology, quality, scoring

    cases = spark.createDataFrame([("a", "t", "x", "x"), ("b", "t", "x", "y"), ("c", "t", None, None), ("d", "u", "x", "x"), ("e", "t", "x", "x"), ("e", "t", "x", "x")], "case_id string, title string, expected_role string, actual_role string")
    sha = lambda x: __import__("hashlib").sha256(json.dumps([x]).encode()).hexdigest()
    frozen = spark.createDataFrame([(k, sha("t")) for k in "abcdez"], "case_id string, content_sha256 string")
    assert {(r.case_id, r.problem) for r in scoring.regression_problems(cases, frozen, ["role"], ["title"]).collect()} == {("c", "EXPECTATION_MISSING"), ("d", "CASE_TEXT_CHANGED"), ("e", "CASE_REPEATED"), ("z", "CASE_MISSING")}
    assert [tuple(r) for r in scoring.label_diff(cases, ["role"]).collect()] == [("b", "role", "x", "y")]
    known = spark.createDataFrame([("REG-1", "job-77", "https://a/1", "某公司")], "case_id string, job_id string, url string, company string")
    rules = [*ontology.MARKET.values(), *ontology.FIT.values(), *ontology.MARKET_CASES.values(), *ontology.EVIDENCE.values()]
    assert scoring.fixture_identities(rules, known).count() == 0
    assert scoring.fixture_identities([*rules, "job-77|x"], known).first().value == "job-77"
    row = quality.failure_health(spark, ("education", "experience"), "INPUT_NOT_AN_ARRAY").first()
    assert row.blocking and row.blocking_reason == "INPUT_NOT_AN_ARRAY" and row.known == 0


def test_daily_health(spark):
    fields = "platform string, status string, complete boolean, stopped_by string, error string, failed_companies array<string>, detail_failed long, detail_failed_job_ids array<string>, pagination_mode string, stable_snapshot boolean, list_complete boolean, list_error boolean, completeness_reasons array<string>, presence_reliable boolean, content_reliable boolean, reason_codes array<string>"
    fine = ("a", "success", True, "source_total_reached", "", [], 0, [], None, None, None, None, [], True, True, [])
    known = ("b", "partial", False, "unique_deficit", "", [], 0, [], "offset_dynamic", False, False, False, ["unique_deficit"], False, True, ["LIST_RECORDS_INCOMPLETE", "SOURCE_INCOMPLETE"])
    sources = spark.createDataFrame([fine, known, ("c", *known[1:])], fields)
    limits = spark.createDataFrame([("l", "b", "active", ["unique_deficit"], "2024-06-01")], "id string, platform string, status string, allowed_reasons array<string>, review_after string")
    run = spark.createDataFrame([("SUCCESS", "DEGRADED", "SUCCESS", "SUCCESS")], "status string, crawl string, clean string, analysis string")
    rows, status = daily.daily_health(run, sources, limits, "2024-01-01")
    assert {r.platform: (r.interpretation, r.limitation_id) for r in rows.collect()} == {"a": ("NORMAL", None), "b": ("KNOWN_LIMITATION", "l"), "c": ("NEW_REGRESSION", None)}
    assert status.first().ops_status == "ACTION_REQUIRED"
    late, _ = daily.daily_health(run, sources, limits, "2024-07-01")
    assert late.where("platform = 'b'").first().interpretation == "NEW_REGRESSION"


def test_gating(spark):
    events = spark.createDataFrame([("p", "1", "NEW", "confirmed", None, "x"), ("p", "2", "NEW", "confirmed", None, "x"), ("p", "3", "NEW", "confirmed", None, "x"), ("p", "1", "UPDATED", "confirmed", "w", "x"), ("p", "1", "MISSING", "provisional", "x", None)], "platform string, job_id string, event_type string, event_status string, previous_sha256 string, current_sha256 string")
    labels = spark.createDataFrame([("p", "1", True, "fresh", "x")], "platform string, job_id string, version_ok boolean, status string, content_sha256 string")
    postings = spark.createDataFrame([("p", "1", False, True, True), ("p", "2", True, True, True), ("p", "3", False, True, True)], "platform string, job_id string, out_of_scope boolean, presence_reliable boolean, content_reliable boolean")
    got = {(r.job_id, r.event_type): r.flow for r in trends.gate_events(events, labels, postings).collect()}
    assert got == {("1", "NEW"): "counted", ("2", "NEW"): "out_of_scope", ("3", "NEW"): "unknown", ("1", "UPDATED"): "counted", ("1", "MISSING"): "diagnostic"}


def test_window_labels(spark):
    classified = spark.createDataFrame([(D[0], "p", "1", True, "a"), (D[0], "p", "2", True, "b"), (D[1], "p", "2", False, "z")], "snapshot_date date, platform string, job_id string, reliable boolean, label string")
    events = spark.createDataFrame([(D[2], "p", "2", "MISSING")], "event_date date, platform string, job_id string, event_type string")
    got = {((r.snapshot_date - D[0]).days, r.job_id): r.label for r in trends.window_labels(classified, events, spark.createDataFrame([(d,) for d in D], "snapshot_date date")).collect()}
    assert got == {(0, "1"): "a", (0, "2"): "b", (1, "2"): "b", (2, "2"): "b"}


def test_tag_changes(spark):
    rows = lambda *x: spark.createDataFrame([(t, co) for t, co in x], "skill_tags array<string>, company string")
    now, old = rows((["a"], "x"), (["a", "b"], "y")), rows((["a"], "x"), ([], "y"))
    got = {r.tag: (r.mentions, r.change, r.rising) for r in trends.tag_changes(now, old, True).collect()}
    assert got == {"a": (2, 1, True), "b": (1, 1, False)}
    assert all(r.change is None for r in trends.tag_changes(now, old, False).collect())


def test_window_reasons(spark):
    days = spark.createDataFrame([(dt.date(2024, 1, d), "c", True, True, True, "v") for d in range(1, 9)], "snapshot_date date, cities string, has_manifest boolean, reliable boolean, reviewed boolean, versions string")
    at = lambda d: trends.window_reasons(days, F.lit(d).cast("date")).first()
    assert at("2024-01-08").comparable
    assert at("2024-01-07").reason_codes == ["INSUFFICIENT_WINDOW_HISTORY", "OBSERVATION_GAPS"]
    assert [r.expected.day for r in trends.window_gaps(days, F.lit("2024-01-10").cast("date")).orderBy("expected").collect()] == [9, 10]


def test_diagnostics_compute_no_other_table(spark, sf, monkeypatch):
    from postlens import queries_trend as Q

    whole = Q._trend(spark, sf)
    want = sorted(map(tuple, whole.diagnostics.collect()))
    whole.drop()
    monkeypatch.setattr(Q.trend, "cut", lambda df: pytest.fail("a working table is written"))
    assert sorted(map(tuple, Q.trend_diagnostics(spark, sf).collect())) == want != []


def test_a_trend_of_two_days_has_the_rows_of_the_whole_one(spark, sf):
    """Labels come from days that are not asked for; every event is checked; sightings and days are not computed again for each reader."""
    from postlens import queries as B
    from postlens import queries_trend as Q
    from postlens.plans import trend
    from postlens.plans.cut import cut

    s = cut(B._sightings(spark, sf))
    observed, classified, scopes, manifests = Q._parts(s)
    events = B._events(spark, sf, s)
    assert not any("events.parquet" in f for f in events.inputFiles())
    assert not any("events.parquet" in f for f in B._events(spark, sf).inputFiles())
    days = ["2024-01-11", "2024-01-25"]
    at = lambda df, day: [r for r in map(str, df.collect()) if any(f"{day}=datetime.date({int(d[:4])}, {int(d[5:7])}, {int(d[8:])})" in r for d in days)]
    whole = Q._trend(spark, sf)
    part = trend.trend_of_days(observed, classified, events, scopes, manifests, days)
    for name, day in (("metrics", "snapshot_date"), ("companies", "snapshot_date"), ("reliability", "snapshot_date"), ("flows", "event_date"), ("diagnostics", "snapshot_date")):
        found, wanted = list(map(str, getattr(part, name).collect())), at(getattr(whole, name), day)
        assert wanted and sorted(found) == sorted(wanted)
    with pytest.raises(ValueError, match="DUPLICATE_LIFECYCLE_EVENT"):
        trend.trend_of_days(observed, classified, events.unionByName(events.where("event_type = 'NEW' AND event_date < '2024-01-11'")), scopes, manifests, days)
