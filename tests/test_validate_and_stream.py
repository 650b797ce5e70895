"""Lifecycle and trend results against sequential computations, and the lifecycle as a stream."""

import datetime as dt
import random
import time

import pytest
from pyspark.sql import functions as F

from postlens.operators import lifecycle
from postlens.plans import replay, validate
from postlens.streaming import lifecycle as stream
from tests.test_incremental import D, tables

PRESENCE = "snapshot_date date, platform string, job_id string, company string, title string, sha string"
DAYS = "snapshot_date date, platform string, company string, presence_reliable boolean, cities array<string>, reason_codes array<string>"


def made(seed=3, days=9, ids=25):
    r = random.Random(seed)
    dates = [dt.date(2024, 3, 1) + dt.timedelta(n) for n in range(days)]
    seen, scopes = [], []
    for n, d in enumerate(dates):
        cities = ["a"] if n < 6 else ["a", "b"]
        scopes.append((d, "p", None, r.random() < 0.7, cities, ["X"] if n % 2 else []))
        scopes += [(d, "feishu", co, r.random() < 0.7, cities, [co]) for co in ("c0", "c1") if r.random() < 0.9]
        for i in range(ids):
            if r.random() < 0.6:
                seen.append((d, "p", str(i), "co", f"t{i % 3}", r.choice(["s1", "s2", None])))
            if r.random() < 0.6:
                seen.append((d, "feishu", str(i), f"c{i % 2}", "t", r.choice(["s1", "s2", None])))
    return seen, scopes


@pytest.fixture(scope="module")
def case(spark):
    seen, scopes = made()
    presence, days = spark.createDataFrame(seen, PRESENCE), spark.createDataFrame(scopes, DAYS)
    events = lifecycle.lifecycle(presence, days)
    return presence, days, spark.createDataFrame(events.collect(), events.schema)


def test_the_fold_agrees(case):
    presence, days, events = case
    assert events.count() > 150 and {r.event_type for r in events.select("event_type").distinct().collect()} == {"FIRST_SEEN", "NEW", "UPDATED", "MISSING", "REMOVED", "REAPPEARED"}
    assert validate.event_problems(events, validate.lifecycle_by_fold(presence, days, identities=7)).collect() == []


def test_injected_faults_are_named(spark, case):
    presence, days, events = case
    want = validate.lifecycle_by_fold(presence, days)
    one = events.orderBy("event_date", "platform", "job_id").first()
    at = (F.col("event_date") == F.lit(one.event_date)) & (F.col("platform") == one.platform) & (F.col("job_id") == one.job_id)
    told = lambda df: [(r.rule, r.platform, r.job_id, r.at, r.detail) for r in validate.event_problems(df, want).collect()]
    name = (one.platform, one.job_id, one.event_date, one.event_type)
    assert told(events.where(~at)) == [("EVENT_LACKING", *name)]
    assert told(events.union(events.where(at))) == [("EVENT_REPEATED", *name)]
    assert told(events.withColumn("event_status", F.when(at, "odd").otherwise(F.col("event_status")))) == [("EVENT_DIFFERS:event_status", *name)]
    assert told(events.union(events.where(at).withColumn("job_id", F.lit("none")))) == [("EVENT_UNEXPECTED", name[0], "none", *name[2:])]


def test_a_replay_is_valid_and_faults_are_found(spark):
    jobs, m = tables(spark)
    found = replay.replay(jobs.where(F.col("snapshot_date") != F.lit(D[3])), m)
    presence, days = replay.lifecycle_input(found.postings, found.scope_health, m.select("snapshot_date", "cities").distinct())
    assert validate.replay_problems(found, presence, days).collect() == []
    first = found.classified.where("classification_status = 'fresh'").orderBy("snapshot_date", "job_id").first()
    at = (F.col("snapshot_date") == F.lit(first.snapshot_date)) & (F.col("job_id") == first.job_id)
    rules = lambda df: {(r.rule, r.job_id) for r in df.collect()}
    bad = lambda df: rules(validate.classification_problems(found.postings, df))
    assert bad(found.classified.union(found.classified.where(at))) == {("CLASSIFIED_TWICE", first.job_id)}
    assert bad(found.classified.withColumn("job_id", F.when(at, "zz").otherwise(F.col("job_id")))) >= {("CLASSIFIED_WITHOUT_POSTING", "zz")}
    assert ("CONTENT_HASH_DIFFERS", first.job_id) in bad(found.classified.withColumn("content_sha256", F.when(at, "0").otherwise(F.col("content_sha256"))))
    assert ("INVALID_MARKET_ENUM", first.job_id) in bad(found.classified.withColumn("role_family", F.when(at, "odd").otherwise(F.col("role_family"))))
    expected = validate.flows_by_fold(found.postings, found.classified, found.events)
    lost = found.trend.flows.where("flow = 'counted'").first()
    kept = found.trend.flows.where(~((F.col("job_id") == lost.job_id) & (F.col("event_type") == lost.event_type) & (F.col("event_date") == F.lit(lost.event_date))))
    assert rules(validate.flow_problems(kept, expected)) == {("FLOW_LACKING", lost.job_id)}
    wrong = found.snapshots.withColumn("n", F.when(F.col("dimension") == "active_jobs", F.col("n") + 1).otherwise(F.col("n")))
    assert {r.rule for r in validate.snapshot_problems(wrong, found.classified).collect()} == {"SNAPSHOT_COUNT_DIFFERS"}
    found.drop()


# the stream


@pytest.fixture()
def rocks(spark):
    name = "spark.sql.streaming.stateStore.providerClass"
    spark.conf.set(name, "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    yield spark
    spark.conf.unset(name)


def write(spark, path, seen, scopes, dates):
    """Rows of some days, as one more file of each folder."""
    for kind, rows, schema in (("seen", seen, PRESENCE), ("scopes", scopes, DAYS)):
        spark.createDataFrame([r for r in rows if r[0] in dates], schema).coalesce(1).write.mode("append").parquet(f"{path}/{kind}")


def run(spark, path, idle=None, seconds=None):
    """All rows that are there, from where the last run stopped; with ``seconds``, until the idle days closed."""
    read = lambda kind, schema: spark.readStream.schema(schema).parquet(f"{path}/{kind}")
    out = stream.lifecycle_stream(stream.feed(read("seen", PRESENCE), read("scopes", DAYS), buckets=2), idle=idle)
    writer = out.writeStream.format("parquet").option("path", f"{path}/out").option("checkpointLocation", f"{path}/checkpoint")
    if seconds is None:
        assert writer.trigger(availableNow=True).start().awaitTermination(120)
        return
    query = writer.trigger(processingTime="1 second").start()
    end = time.time() + seconds
    while time.time() < end and query.isActive and spark.read.schema(out.schema).parquet(f"{path}/out").where("event_type = 'MISSING'").count() == 0:
        time.sleep(1)
    query.stop()


def test_stream_over_a_restart(rocks, tmp_path, case):
    spark, path = rocks, str(tmp_path)
    presence, days, events = case
    seen, scopes = made()
    dates = sorted({r[0] for r in scopes})
    write(spark, path, seen, scopes, dates[:5])
    run(spark, path)
    first = spark.read.parquet(f"{path}/out").agg(F.max("event_date").alias("d")).first().d
    assert first == dates[3]  # the fifth day is still open
    write(spark, path, seen, scopes, dates[5:])
    last = dates[-1] + dt.timedelta(1)
    write(spark, path, [], [(last, p, None if p == "p" else "c0", True, ["a", "b"], []) for p in ("p", "feishu")], [last])
    run(spark, path)  # a new query, from the checkpoint
    got = spark.read.parquet(f"{path}/out")
    assert validate.event_problems(got, events).collect() == []
    write(spark, path, [(dates[2], "p", "1", "co", "t", "s")], [], [dates[2]])
    with pytest.raises(Exception, match="OBSERVATIONS_MUST_BE_STRICTLY_CHRONOLOGICAL"):
        run(spark, path)


def test_the_last_day_closes_when_idle(rocks, tmp_path):
    spark, path = rocks, str(tmp_path)
    d = [dt.date(2024, 3, n) for n in (1, 2)]
    scopes = [(x, "p", None, True, ["a"], []) for x in d]
    write(spark, path, [(d[0], "p", "1", "co", "t", "s")], scopes, d)
    (tmp_path / "out").mkdir()
    run(spark, path, idle=dt.timedelta(seconds=2), seconds=90)
    assert [(r.event_date, r.event_type) for r in spark.read.parquet(f"{path}/out").orderBy("event_date").collect()] == [(d[0], "FIRST_SEEN"), (d[1], "MISSING")]
