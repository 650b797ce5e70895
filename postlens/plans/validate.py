"""Replay validators: results of the plans against a second computation, identity by identity, and what must hold of them.

Every check gives rows ``rule, platform, job_id, at, detail``; no rows, no problem. The second computation is the
sequential one of ``operators.fold``: identities in groups of bounded number (a platform of many is many
groups), each group with its platform's days.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import content_sha256
from ..operators import classify, fold, trends

c = F.col
KEYS = ["platform", "job_id"]
#: Identities that a group of the sequential computation has, about.
IDENTITIES = 5000


def lifecycle_by_fold(presence: DataFrame, days: DataFrame, confirmation_runs: int = 2, identities: int = IDENTITIES) -> DataFrame:
    """The events of ``lifecycle.lifecycle``, computed sequentially from the same input."""
    counts = presence.groupBy("platform").agg(F.greatest(F.lit(1), F.ceil(F.approx_count_distinct("job_id") / identities)).cast("int").alias("_groups"))
    seen = presence.join(counts, "platform").withColumn("_group", F.pmod(F.xxhash64("job_id"), c("_groups")).cast("int")).drop("_groups")
    dates = days.groupBy("snapshot_date").agg(F.first("cities").alias("cities"))
    # a platform has every date, also those on which it has no scope
    every = counts.crossJoin(F.broadcast(dates)).join(days.select("snapshot_date", "platform", "company", "presence_reliable", "reason_codes", F.lit(True).alias("_told")), ["snapshot_date", "platform"], "left")
    told = every.withColumn("presence_reliable", F.when(c("_told"), F.coalesce("presence_reliable", F.lit(False)))).withColumn("_group", F.explode(F.sequence(F.lit(0), c("_groups") - 1))).drop("_groups", "_told")

    def one(key: tuple, rows: pd.DataFrame, scopes: pd.DataFrame) -> pd.DataFrame:
        order = fold.days_of(scopes.astype(object).where(scopes.notna(), None))
        out = []
        rows = rows.astype(object).where(rows.notna(), None)
        for job_id, mine in rows.groupby("job_id"):
            by_day = {r.snapshot_date: (r.company, r.title, r.sha) for r in mine.itertuples()}
            held, before = None, None
            for day in order:
                held, events = fold.step(held, by_day.get(day.date), day, before, confirmation_runs)
                out += [(e[0], key[0], job_id, *e[1:]) for e in events]
                before = day
        return fold.events_frame(out)

    keys = ["platform", "_group"]
    seen, told = (df.select(*[c(k).alias(k) for k in df.columns]) for df in (seen, told))  # both sides hold the same counts
    return seen.groupBy(*keys).cogroup(told.groupBy(*keys)).applyInPandas(one, fold.EVENT)


def _problem(rule: Column | str, at: str | Column, detail: Column) -> list[Column]:
    name = F.lit(rule) if isinstance(rule, str) else rule
    return [name.alias("rule"), c("platform"), c("job_id"), (c(at) if isinstance(at, str) else at).cast("date").alias("at"), detail.cast("string").alias("detail")]


def event_problems(events: DataFrame, expected: DataFrame) -> DataFrame:
    """Where two sets of events differ as multisets: an event is lacking, extra or repeated, or which of its fields differ."""
    key = ["event_date", *KEYS, "event_type"]
    fields = ["company", "title", "event_status", "previous_sha256", "current_sha256", "reason_codes"]
    side = lambda df, name: df.groupBy(*key).agg(F.count("*").alias(f"{name}_n"), F.min(F.struct(*fields)).alias(name))
    both = side(events, "got").join(side(expected, "want"), key, "full_outer")
    wrong = F.array_compact(F.array(*[F.when(~c(f"got.{f}").eqNullSafe(c(f"want.{f}")), f) for f in fields]))
    rule = (
        F.when(c("got_n").isNull(), "EVENT_LACKING").when(c("want_n").isNull(), "EVENT_UNEXPECTED").when(c("got_n") != c("want_n"), "EVENT_REPEATED").when(F.size(wrong) > 0, F.concat(F.lit("EVENT_DIFFERS:"), F.array_join(wrong, ",")))
    )
    return both.select(*_problem(rule, "event_date", c("event_type"))).where("rule IS NOT NULL")


def lifecycle_problems(presence: DataFrame, days: DataFrame, events: DataFrame, confirmation_runs: int = 2) -> DataFrame:
    """``events`` against the sequential computation of the same input."""
    return event_problems(events, lifecycle_by_fold(presence, days, confirmation_runs))


def classification_problems(postings: DataFrame, classified: DataFrame) -> DataFrame:
    """Classification rows that no posting has, or twice; a fresh row with another text's hash, a carried one that no earlier fresh row explains."""
    day = ["snapshot_date", *KEYS]
    rows = classified.select(*day, "classification_status", "content_sha256", "in_scope", "market_relevance", "role_family", "ai_relation", "secondary_role_families")
    stray = rows.join(postings.select(*day).distinct(), day, "left_anti").select(*_problem("CLASSIFIED_WITHOUT_POSTING", "snapshot_date", F.lit(None)))
    twice = rows.groupBy(*day).agg(F.count("*").alias("n")).where("n > 1").select(*_problem("CLASSIFIED_TWICE", "snapshot_date", c("n")))
    text = postings.select(*day, content_sha256().alias("_sha"))
    fresh = rows.where("classification_status = 'fresh'").join(text, day).where(~c("content_sha256").eqNullSafe(c("_sha"))).select(*_problem("CONTENT_HASH_DIFFERS", "snapshot_date", c("content_sha256")))
    known = rows.where("classification_status = 'fresh'").select(c("snapshot_date").alias("_d"), *[c(k).alias(f"_{k}") for k in KEYS], c("content_sha256").alias("_sha"))
    earlier = (c("_platform") == c("platform")) & (c("_job_id") == c("job_id")) & (c("_d") < c("snapshot_date")) & (c("_sha") == c("content_sha256"))
    carried = rows.where("classification_status = 'carried_forward'").join(known, earlier, "left_anti").select(*_problem("CARRIED_FROM_NOWHERE", "snapshot_date", c("content_sha256")))
    shape = classify.invalid_market(classified.where("in_scope IS NOT NULL").withColumn("market", F.struct("in_scope", "market_relevance", "role_family", "ai_relation", "secondary_role_families", c("reason_codes.market").alias("reason_codes"))))
    return stray.unionByName(twice).unionByName(fresh).unionByName(carried).unionByName(shape.select(*_problem(c("broken"), "snapshot_date", F.lit(None))))


def flows_by_fold(postings: DataFrame, classified: DataFrame, events: DataFrame, versions: str | None = None) -> DataFrame:
    """``event_date, platform, job_id, event_type, company``: the events that count as flows, by going along each identity's days.

    A sighting replaces the label held before; the label that holds on an event's day is the flow's. Scope health is
    not looked at: these are the events that health alone may still exclude.
    """
    good = c("in_scope") & trends.usable(c("classification_status"), c("reason_codes.market"), c("career_pool"))
    label = classified.select("snapshot_date", *KEYS, F.when(F.coalesce(good, F.lit(False)), F.struct(c("company").alias("label_company"), c("classification_status").alias("status"), c("content_sha256").alias("sha"))).alias("label"))
    seen = postings.select("snapshot_date", *KEYS).join(label, ["snapshot_date", *KEYS], "left").select(c("snapshot_date").alias("at"), *KEYS, F.lit(0).alias("what"), "label.label_company", "label.status", c("label.sha").alias("sha"), F.lit(None).cast("string").alias("event_type"), F.lit(None).cast("string").alias("previous"), F.lit(None).cast("string").alias("current"))
    sure = events.where((c("event_status") == "confirmed") & c("event_type").isin(*trends.FLOWS))
    moves = sure.select(c("event_date").alias("at"), *KEYS, F.lit(1).alias("what"), *[F.lit(None).cast("string").alias(k) for k in ("label_company", "status", "sha")], "event_type", c("previous_sha256").alias("previous"), c("current_sha256").alias("current"))

    def one(rows: pd.DataFrame) -> pd.DataFrame:
        out, held = [], None
        for r in rows.astype(object).where(rows.notna(), None).sort_values(["at", "what"]).itertuples():
            if not r.what:
                held = r if r.status is not None else None
            elif held is not None and (r.event_type != "UPDATED" or (held.status == "fresh" and r.previous and r.previous != r.current and r.current == held.sha)):
                out.append((r.at, r.platform, r.job_id, r.event_type, held.label_company))
        return pd.DataFrame(out, columns=["event_date", "platform", "job_id", "event_type", "company"])

    return seen.unionByName(moves).groupBy(*KEYS).applyInPandas(one, "event_date date, platform string, job_id string, event_type string, company string")


def flow_problems(flows: DataFrame, expected: DataFrame) -> DataFrame:
    """Counted flows against ``flows_by_fold``: one that it lacks, or one that it has and health does not excuse."""
    key = ["event_date", *KEYS, "event_type"]
    counted = flows.where("flow = 'counted'").select(*key, "company", F.lit(True).alias("_got"))
    extra = counted.join(expected, [*key, "company"], "left_anti").select(*_problem("FLOW_UNEXPECTED", "event_date", c("event_type")))
    excused = flows.where("flow = 'UNRELIABLE_CANONICAL_EVENT_EXCLUDED'").select(*key)
    lacking = expected.join(counted, [*key, "company"], "left_anti").join(excused, key, "left_anti").select(*_problem("FLOW_LACKING", "event_date", c("event_type")))
    return extra.unionByName(lacking)


def snapshot_problems(snapshots: DataFrame, classified: DataFrame) -> DataFrame:
    """``rule, platform, job_id (null), at, detail`` of snapshot counts that a plain recount of each dimension does not give."""
    good = classified.where(c("in_scope") & trends.usable(c("classification_status"), c("reason_codes.market"), c("career_pool")))
    day = ["snapshot_date", "platform"]
    parts = [good.groupBy(*day, c(field).alias("key")).agg(F.count("*").alias("want")).where("key IS NOT NULL").select(*day, F.lit(name).alias("dimension"), "key", "want") for name, field in (*trends.ADDITIVE.items(), ("by_company", "company"))]
    parts.append(good.groupBy(*day).agg(F.count("*").alias("want")).select(*day, F.lit("active_jobs").alias("dimension"), F.lit("all").alias("key"), "want"))
    want = parts[0]
    for p in parts[1:]:
        want = want.unionByName(p)
    names = [*trends.ADDITIVE, "by_company", "active_jobs"]
    both = snapshots.where(c("dimension").isin(*names)).join(want, [*day, "dimension", "key"], "full_outer")
    wrong = F.coalesce("n", F.lit(0)) != F.coalesce("want", F.lit(0))
    return both.where(wrong).withColumn("job_id", F.lit(None).cast("string")).select(*_problem("SNAPSHOT_COUNT_DIFFERS", "snapshot_date", F.concat_ws(" ", "dimension", "key", F.coalesce(c("n").cast("string"), F.lit("-")), F.coalesce(c("want").cast("string"), F.lit("-")))))


def replay_problems(found, presence: DataFrame, days: DataFrame, confirmation_runs: int = 2) -> DataFrame:
    """All checks of a replay; presence and days: what its lifecycle was made from."""
    flows = flows_by_fold(found.postings, found.classified, found.events)
    return (
        lifecycle_problems(presence, days, found.events, confirmation_runs)
        .unionByName(classification_problems(found.postings, found.classified))
        .unionByName(flow_problems(found.trend.flows, flows))
        .unionByName(snapshot_problems(found.snapshots, found.classified))
    )
