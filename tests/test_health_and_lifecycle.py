import datetime as dt
import random

import pytest
from postlens.operators import health, lifecycle

DAY = dt.date(2024, 1, 1)
COLUMNS = (
    "snapshot_date date, platform string, status string, complete boolean, stopped_by string, error string, source_total long, expected_pages long, pages_fetched long, records_fetched long, jobs_mapped long, "
    "jobs_in_scope long, outside_city_scope long, duplicate_records long, missing_job_id long, details_fetched long, detail_failed long, failed_companies array<string>, attempted_companies array<string>, detail_failed_job_ids array<string>"
)


def manifest(**over):
    row = dict(snapshot_date=DAY, platform="p", status="success", complete=True, stopped_by="source_total_reached", error="", source_total=2, expected_pages=1, pages_fetched=1, records_fetched=2, jobs_mapped=2, jobs_in_scope=2, outside_city_scope=0, duplicate_records=0, missing_job_id=0, details_fetched=2, detail_failed=0, failed_companies=None, attempted_companies=None, detail_failed_job_ids=None)
    return tuple((row | over).values())


def posting(i, platform="p", company="c", title="t", description="d", requirements="r"):
    return (DAY, platform, str(i), company, title, description, requirements)


def resolved(spark, manifests, postings, count=None):
    jobs = spark.createDataFrame(postings, "snapshot_date date, platform string, job_id string, company string, title string, description string, requirements string")
    m = spark.createDataFrame(manifests, COLUMNS)
    total = spark.createDataFrame([(DAY, len(postings) if count is None else count)], "snapshot_date date, job_count long")
    context = health.context(m, jobs, total)
    scopes = health.resolve_scopes(context, jobs)
    return context, jobs, scopes


def scope(spark, manifests, postings, count=None):
    _, _, scopes = resolved(spark, manifests, postings, count)
    return {(r.platform, r.company): (r.presence_reliable, r.content_reliable, r.reason_codes) for r in scopes.collect()}


def test_reliable(spark):
    assert scope(spark, [manifest()], [posting(1), posting(2)]) == {("p", ""): (True, True, [])}


@pytest.mark.parametrize(
    "over, want",
    [
        (dict(source_total=None), (False, False, ["MANIFEST_COUNTERS_INVALID"])),
        (dict(detail_failed=-1), (False, False, ["MANIFEST_COUNTERS_INVALID"])),
        (dict(jobs_in_scope=1), (False, True, ["SNAPSHOT_COUNT_MISMATCH"])),
        (dict(status="error", complete=False, error="x", stopped_by="request"), (False, False, ["SOURCE_ERROR", "SOURCE_INCOMPLETE", "UNVERIFIED_STOP_REASON"])),
        (dict(pages_fetched=0, records_fetched=1, stopped_by="empty_page", complete=False, status="partial"), (False, True, ["LIST_PAGES_INCOMPLETE", "LIST_RECORDS_INCOMPLETE", "LIST_INCOMPLETE", "SOURCE_INCOMPLETE", "UNVERIFIED_STOP_REASON"])),
        (dict(jobs_mapped=1, missing_job_id=1), (False, True, ["MISSING_JOB_IDS", "MAPPING_INCOMPLETE"])),
        (dict(stopped_by="detail_errors", complete=False, status="partial"), (True, True, [])),
    ],
)
def test_codes_in_order(spark, over, want):
    assert scope(spark, [manifest(**over)], [posting(1), posting(2)])[("p", "")] == want


def test_platform_without_manifest(spark):
    found = scope(spark, [manifest()], [posting(1), posting(2), posting(3, "q")])
    assert found[("q", "")] == (False, False, ["MANIFEST_SCOPE_MISSING"])


def test_companies_of_one_platform(spark):
    listed = manifest(platform="feishu", status="partial", complete=False, stopped_by="company_error", error="bad: timeout", attempted_companies=["ok", "bad"], failed_companies=["bad"], pages_fetched=0)
    old = manifest(platform="feishu", status="partial", complete=False, stopped_by="company_error", error="bad: timeout; worse: no", attempted_companies=["ok", "bad", "worse"])
    jobs = [posting(1, "feishu", "ok"), posting(2, "feishu", "ok")]
    assert scope(spark, [listed], jobs) == {("feishu", "ok"): (True, True, []), ("feishu", "bad"): (False, True, ["COMPANY_ERROR"])}
    found = scope(spark, [old], jobs)
    assert found[("feishu", "ok")] == (True, True, ["LEGACY_COMPANY_ERROR_PARSED"])  # told after presence was settled
    assert found[("feishu", "worse")] == (False, True, ["COMPANY_ERROR", "LEGACY_COMPANY_ERROR_PARSED"])


def test_postings(spark):
    m = manifest(status="partial", complete=False, stopped_by="detail_errors", detail_failed=1, details_fetched=3, source_total=4, records_fetched=4, jobs_mapped=4, jobs_in_scope=4, failed_companies=[], detail_failed_job_ids=["2"])
    context, jobs, scopes = resolved(spark, [m], [posting(1), posting(2), posting(3, description="", requirements=" "), posting(4, title="")])
    rows = health.resolve_jobs(jobs, scopes)
    assert {r.job_id: (r.presence_reliable, r.content_reliable, r.health_reasons) for r in rows.collect()} == {
        "1": (True, True, []),
        "2": (True, False, ["DETAIL_FAILED_JOB_ID"]),
        "3": (True, False, ["PROBABLE_DETAIL_FAILURE", "INSUFFICIENT_CONTENT"]),
        "4": (True, False, ["INSUFFICIENT_CONTENT"]),
    }
    assert health.tolerated_gaps(context, rows, 5, 0.5).first().tolerated is False  # 3 and 4 fail unnamed
    context, jobs, scopes = resolved(spark, [m], [posting(i) for i in range(1, 5)])
    assert health.tolerated_gaps(context, health.resolve_jobs(jobs, scopes), 5, 0.5).first().tolerated is True
    assert health.tolerated_gaps(context, health.resolve_jobs(jobs, scopes), 5, 0.1).first().tolerated is False


def fold(days, sightings, n=2):
    """The same state machine one day after the other. days: [(reliable, city)]; sightings: {id: {day: sha}}."""
    out, state = [], {}
    for d, (reliable, city) in enumerate(days):
        changed = d > 0 and city != days[d - 1][1]
        for i in sorted(sightings):
            if d in sightings[i]:
                sha = sightings[i][d]
                if i not in state:
                    sure = d > 0 and not changed and days[d - 1][0] and reliable
                    out.append((d, i, "NEW" if sure else "FIRST_SEEN", sure))
                    state[i] = dict(sha=sha, city=city, streak=0, missing=False, removed=False)
                    continue
                s = state[i]
                if s["missing"]:
                    out.append((d, i, "REAPPEARED", reliable and not changed))
                if sha and s["sha"] and sha != s["sha"]:
                    out.append((d, i, "UPDATED", True))
                s.update(sha=sha or s["sha"], city=city, streak=0, missing=False, removed=False)
            elif i in state and not state[i]["removed"]:
                s = state[i]
                s["missing"] = True
                if reliable and not changed and s["city"] == city:
                    s["streak"] += 1
                    s["removed"] = s["streak"] >= n
                    out.append((d, i, "REMOVED" if s["removed"] else "MISSING", s["removed"]))
                else:
                    out.append((d, i, "MISSING", False))
    return sorted(out)


def test_lifecycle_is_the_daily_fold(spark):
    r = random.Random(3)
    days = [(r.random() < 0.75, "a" if d < 12 or d > 17 else "b") for d in range(25)]
    sightings = {str(i): {d: r.choice(["x", "y", None]) for d in range(25) if r.random() < r.choice([0.3, 0.6, 0.9])} for i in range(60)}
    date = lambda d: DAY + dt.timedelta(d)
    presence = spark.createDataFrame([(date(d), "p", i, "c", "t", s) for i, x in sightings.items() for d, s in x.items()], "snapshot_date date, platform string, job_id string, company string, title string, sha string")
    table = spark.createDataFrame([(date(d), "p", None, ok, [city], []) for d, (ok, city) in enumerate(days)], "snapshot_date date, platform string, company string, presence_reliable boolean, cities array<string>, reason_codes array<string>")
    got = sorted(((r.event_date - DAY).days, r.job_id, r.event_type, r.event_status == "confirmed") for r in lifecycle.lifecycle(presence, table).collect())
    assert got == fold(days, sightings)


def test_identity_conflicts(spark):
    rows = [("p", "1", "a"), ("p", "1", "a"), ("p", "2", "a"), ("p", "2", "b"), ("", "3", "a")]
    found = lifecycle.index_conflicts(spark.createDataFrame(rows, "platform string, job_id string, title string"))
    assert {(r.platform, r.job_id) for r in found.collect()} == {("p", "2"), ("", "3")}


def test_roll_up(spark):
    rows = [(DAY, "p", "a", True, True, []), (DAY, "p", "b", False, True, ["X"])]
    r = health.roll_up(spark.createDataFrame(rows, "snapshot_date date, platform string, company string, presence_reliable boolean, content_reliable boolean, reason_codes array<string>")).first()
    assert (r.presence_reliable, r.content_reliable, r.reason_codes, r.scopes) == (False, True, ["X"], 2)
