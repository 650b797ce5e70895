"""Days one at a time with stored state give what all days in one plan give."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from postlens.operators import lifecycle
from postlens.plans import incremental, replay
from tests.test_health_and_lifecycle import COLUMNS, manifest
from tests.test_plans import GOOD, POSTING, post

D = [dt.date(2024, 1, d) for d in range(1, 9)]
#: Postings by day; None: the day's detail page failed. The fourth day is not stored, the sixth's source is not whole.
SEEN = [{1: GOOD, 2: GOOD}, {1: GOOD + "；补充", 3: GOOD}, {3: None, 4: GOOD}, {}, {3: GOOD, 4: GOOD, 5: "负责仓库"}, {4: None}, {2: GOOD, 4: GOOD}, {2: GOOD + "；二", 5: GOOD}]


def rows():
    return [post(day, i, text or "") for day, seen in zip(D, SEEN) for i, text in seen.items()]


def manifests():
    out = []
    for day, seen in zip(D, SEEN):
        if day == D[3]:
            continue
        failed = [str(i) for i, text in seen.items() if text is None]
        broken = dict(status="partial", complete=False, stopped_by="detail_errors") if failed else {}
        if day == D[5]:
            broken = dict(status="partial", complete=False, stopped_by="incomplete_list")
        out.append(manifest(snapshot_date=day, detail_failed=len(failed), detail_failed_job_ids=failed, jobs_in_scope=len(seen), jobs_mapped=len(seen), records_fetched=len(seen), source_total=len(seen), details_fetched=len(seen) - len(failed), **broken))
    return out


def tables(spark):
    m = spark.createDataFrame(manifests(), COLUMNS).withColumn("cities", F.array(F.when(F.col("snapshot_date") < F.lit(D[6]), "深圳").otherwise("广州")))
    return spark.createDataFrame(rows(), POSTING), m.withColumn("job_count", F.col("jobs_in_scope").cast("long"))


def stores(root):
    return incremental.Stores(*[f"{root}/{n}" for n in ("postings", "manifests", "state", "results")])


def store(spark, s, days):
    jobs, m = tables(spark)
    for df, path in ((jobs, s.postings), (m, s.manifests)):
        df.where(F.col("snapshot_date").isin(*days)).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("snapshot_date").parquet(path)


PARTS = ("classified", "events", "scope_health", "metrics", "companies", "reliability", "flows", "diagnostics", "snapshots")


def same(spark, s, whole, days):
    """Every result of the days, row for row."""
    want = dict(zip(PARTS, (whole.classified, whole.events, whole.scope_health, whole.trend.metrics, whole.trend.companies, whole.trend.reliability, whole.trend.flows, whole.trend.diagnostics, whole.snapshots)))
    for name in PARTS:
        got = incremental.result(spark, s, name)
        date = "event_date" if name in ("events", "flows") else "snapshot_date"
        columns = [k for k in want[name].columns]
        keep = F.col(date).isin(*days)
        show = lambda df: sorted(map(repr, df.where(keep).select(*columns).collect()))  # noqa: B023, E731
        assert show(got) == show(want[name]), name
        assert show(got) or name == "diagnostics"


@pytest.fixture(scope="module")
def whole(spark):
    jobs, m = tables(spark)
    found = replay.replay(jobs.where(F.col("snapshot_date") != F.lit(D[3])), m)
    yield found
    found.drop()


def test_days_one_at_a_time(spark, tmp_path, whole):
    s = stores(tmp_path)
    store(spark, s, D)
    day = lambda n: D[n].isoformat()
    told = {r.snapshot_date: (r.outcome, r.reason_codes, r.missing) for r in incremental.replay_range(spark, s, day(1), day(4)).collect()}
    assert told == {D[0]: ("warmed", [], []), D[1]: ("written", [], []), D[2]: ("written", [], []), D[3]: ("incomplete", ["HISTORICAL_SOURCE_INCOMPLETE"], ["postings", "manifests"]), D[4]: ("written", [], [])}
    rest = {r.snapshot_date: r.outcome for r in incremental.replay_range(spark, s, day(5), day(7)).collect()}
    assert rest == {D[5]: "written", D[6]: "written", D[7]: "written"}  # from the state of the fifth day
    same(spark, s, whole, [D[1], D[2], D[4], D[5], D[6], D[7]])
    assert incremental.partition_values(spark, s.results + "/events", "snapshot_date") == [day(n) for n in (1, 2, 4, 5, 6, 7)]
    parts = incremental.compare_with_previous(spark, s, day(2))
    want = replay.compare_snapshots(whole, day(1), day(2))
    for name, df in parts.items():
        assert sorted(map(repr, df.collect())) == sorted(map(repr, want[name].select(*df.columns).collect())), name
    assert incremental.compare_with_previous(spark, s, day(1)) is None


def test_a_late_day_starts_again_before_it(spark, tmp_path, whole):
    s = stores(tmp_path)
    store(spark, s, [D[0], D[2]])
    incremental.replay_range(spark, s, D[0].isoformat(), D[2].isoformat())
    store(spark, s, [D[1]])
    told = [(r.snapshot_date, r.outcome) for r in incremental.replay_range(spark, s, D[2].isoformat(), D[2].isoformat()).collect()]
    assert told == [(D[1], "warmed"), (D[2], "written")]  # the first day's state still holds
    same(spark, s, whole, [D[2]])


def test_a_day_reads_its_own_partition(spark, tmp_path):
    s = stores(tmp_path)
    store(spark, s, D)
    for path in (s.postings, s.manifests):
        files = incremental._day(spark, path, D[2].isoformat()).inputFiles()
        assert files and all(f"snapshot_date={D[2]}" in f for f in files)


def test_refusals(spark, tmp_path):
    s = stores(tmp_path)
    with pytest.raises(ValueError, match="from date"):
        incremental.replay_range(spark, s, "2024-01-02", "2024-01-01")
    with pytest.raises(ValueError, match="OVERLAP"):
        incremental.replay_range(spark, incremental.Stores("/a/p", "/a/m", "/a/s", "/a/p/out"), "2024-01-01", "2024-01-01")
    jobs = spark.createDataFrame([post(D[0], 1), post(D[0], 1)], POSTING)
    assert incremental.checked(jobs).count() == 1
    with pytest.raises(ValueError, match="CLEAN_IDENTITY_CONFLICT"):
        incremental.checked(jobs.union(spark.createDataFrame([post(D[0], 1, "x")], POSTING)))


def test_all_sources_unreliable(spark, tmp_path):
    s = stores(tmp_path)
    jobs, m = tables(spark)
    store(spark, s, D[:1])
    bad = spark.createDataFrame([manifest(snapshot_date=D[1], status="error", complete=False)], COLUMNS).withColumns({"cities": F.array(F.lit("深圳")), "job_count": F.lit(0).cast("long")})
    bad.write.mode("append").partitionBy("snapshot_date").parquet(s.manifests)
    jobs.limit(0).drop("snapshot_date").write.parquet(f"{s.postings}/snapshot_date={D[1]}")
    got = {r.snapshot_date: (r.outcome, r.reason_codes) for r in incremental.replay_range(spark, s, D[0].isoformat(), D[1].isoformat()).collect()}
    assert got[D[1]] == ("preserved", ["ALL_SOURCES_UNRELIABLE", "OUTPUT_PRESERVED"])
    assert incremental.partition_values(spark, s.results + "/events", "snapshot_date") == [D[0].isoformat()]
    state = spark.read.parquet(f"{s.state_of(D[1].isoformat())}/identities")
    assert {(r.job_id, r.missing, r.streak) for r in state.collect()} == {("1", True, 0), ("2", True, 0)}


def test_advance_needs_two_runs(spark):
    with pytest.raises(ValueError):
        lifecycle.advance(None, None, None, None, "2024-01-01", None, confirmation_runs=1)


def _observed(spark):
    """Twelve days of two platforms, one with a scope a company; unreliable days, a day without a scope, other cities from the eighth day, rows without a date."""
    pick, days = random.Random(5), [dt.date(2024, 1, d) for d in range(1, 13)]
    seen = [(d, p, str(i), pick.choice(["x", "y"]) if p == "many" else "co", f"t{pick.randint(1, 2)}", pick.choice([None, "s1", "s2"])) for d in [*days, None] for p in ("one", "many") for i in range(12) if pick.random() < 0.45]
    health = [(d, p, who, pick.random() < 0.7, ["b"] if d and d.day >= 8 else ["a"], pick.choice([[], ["R"]])) for d in [*days, None] for p, who in (("one", None), ("many", "x"), ("many", "y")) if (p, who, d) != ("many", "y", days[4])]
    presence = spark.createDataFrame(seen, "snapshot_date date, platform string, job_id string, company string, title string, sha string")
    return presence, spark.createDataFrame(health, "snapshot_date date, platform string, company string, presence_reliable boolean, cities array<string>, reason_codes array<string>")


def test_a_day_at_a_time_tells_all_of_every_event(spark):
    presence, days = _observed(spark)
    dated = [df.where("snapshot_date IS NOT NULL") for df in (presence, days)]
    want = lifecycle.lifecycle(*dated)
    got = incremental.lifecycle_days(presence, days)
    assert got.schema.simpleString() == want.schema.simpleString()
    assert sorted(map(repr, got.collect())) == sorted(map(repr, want.collect()))
    assert {r.event_type for r in got.select("event_type").distinct().collect()} == {"FIRST_SEEN", "NEW", "UPDATED", "MISSING", "REMOVED", "REAPPEARED"}
    assert incremental.lifecycle_days(presence, days.limit(0)).count() == 0


def test_days_share_their_generated_code(spark):
    """A day's number in the code would have each day compiled anew; the events are compiled too, not evaluated by a lambda's fallback."""
    presence, days = _observed(spark)
    state = spark.createDataFrame([], lifecycle.STATE.replace("last_seen date", "last_seen string"))
    codes, adaptive = [], spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        for day in ("2024-01-02", "2024-01-03"):
            plan = lifecycle.advance(state, presence.drop("snapshot_date"), days, days, day, ["a"], ["a"], as_text=True)._jdf.queryExecution()
            parts = plan.debug().codegenToSeq()
            codes.append(sorted(parts.apply(i)._2() for i in range(parts.size())))
            assert "lambda" not in plan.optimizedPlan().toString()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", adaptive)
    assert codes[0] == codes[1] and codes[0]
