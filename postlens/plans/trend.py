"""Daily trend snapshots of all stored days in one plan, comparisons of two, and the seven-day report.

Days are a column: labels hold from a posting's sighting to its next one, events
meet the label of their day in one join, and every metric is one aggregation over
``snapshot_date, platform``.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators import classify, health, trends
from .cut import cut, drop

c = F.col
KEYS = ["platform", "job_id"]


@dataclass
class Trend:
    """metrics: ``snapshot_date, platform, dimension, key, n``; companies: a row a day, platform and company;
    reliability: ``snapshot_date, platform, family, reliable, reason_codes``; flows: events with what became of each."""

    metrics: DataFrame
    companies: DataFrame
    reliability: DataFrame
    flows: DataFrame
    diagnostics: DataFrame

    def drop(self) -> None:
        """Delete the working tables; nothing of this can be read after."""
        drop(self.metrics, self.companies, self.reliability, self.flows)


def sightings(observed: DataFrame, classified: DataFrame, versions: Column | None = None) -> DataFrame:
    """Each observed posting's label of the day and the days it holds for (``snapshot_date`` to before ``until``).

    observed: ``snapshot_date, platform, job_id, content_reliable``. ``status`` is null without a usable label in
    scope; ``out_of_scope``: known not to be in the market; ``version_ok``: of the versions asked for.
    """
    good = c("in_scope") & trends.usable(c("classification_status"), c("reason_codes.market"), c("career_pool"))
    same = F.lit(True) if versions is None else c("versions") == versions
    rows = classified.select("snapshot_date", *KEYS, F.coalesce(good, F.lit(False)).alias("_good"), "in_scope", c("company").alias("_company"), c("classification_status").alias("_status"), c("content_sha256").alias("_sha"), same.alias("_same"))
    both = observed.select("snapshot_date", *KEYS, "content_reliable").join(rows, ["snapshot_date", *KEYS], "left")
    only = lambda k: F.when(c("_good"), c(k))
    outside = F.coalesce(~c("in_scope"), F.lit(False)) | (c("_good").isNull() & c("content_reliable"))
    out = both.select("snapshot_date", *KEYS, outside.alias("out_of_scope"), only("_company").alias("label_company"), only("_status").alias("status"), only("_sha").alias("content_sha256"), only("_same").alias("version_ok"))
    return trends.label_intervals(out, KEYS)


def labelled_events(events: DataFrame, seen: DataFrame, observed: DataFrame, scopes: DataFrame) -> DataFrame:
    """Events with ``company`` (the label's, else the event's), the label of their day and ``flow``, what becomes of them."""
    held = seen.select(*[c(k).alias(f"_{k}") for k in ("snapshot_date", "until", *KEYS)], "out_of_scope", "label_company", "status", "content_sha256", "version_ok")
    at = (events["platform"] == c("_platform")) & (events["job_id"] == c("_job_id")) & (events["event_date"] >= c("_snapshot_date")) & (c("_until").isNull() | (events["event_date"] < c("_until")))
    rows = events.join(held, at, "left").drop("_snapshot_date", "_until", "_platform", "_job_id").withColumn("company", F.coalesce("label_company", "company", F.lit(""))).drop("label_company")
    many = c("platform").isin(*health.MANY_COMPANIES)
    rows = rows.withColumn("_scope", F.when(many, c("company")).otherwise(""))
    told = scopes.select(c("snapshot_date").alias("event_date"), "platform", c("company").alias("_scope"), "presence_reliable", c("content_reliable").alias("_scope_content"))
    today = observed.select(c("snapshot_date").alias("event_date"), *KEYS, c("content_reliable").alias("_own_content"))
    rows = rows.join(told, ["event_date", "platform", "_scope"], "left").join(today, ["event_date", *KEYS], "left")
    rows = rows.withColumn("content_reliable", F.coalesce("_own_content", "_scope_content"))
    return rows.withColumn("flow", trends.flow_of()).drop("_scope", "_scope_content", "_own_content")


def _flows(observed: DataFrame, classified: DataFrame, events: DataFrame, scopes: DataFrame, versions: Column | None = None, held: tuple[DataFrame, DataFrame] | None = None) -> DataFrame:
    columns = ("snapshot_date", *KEYS, "content_reliable"), ("snapshot_date", *KEYS, "in_scope", "classification_status", "reason_codes", "career_pool", "company", "content_sha256", "versions")
    all_seen = (df.select(*k) if more is None else df.select(*k).unionByName(more.select(*k)) for df, more, k in zip((observed, classified), held or (None, None), columns))
    seen = sightings(*all_seen, versions)
    trends.refuse_duplicate_events(events)
    return labelled_events(events, seen, observed, scopes)


def diagnostics(observed: DataFrame, classified: DataFrame, events: DataFrame, scopes: DataFrame) -> DataFrame:
    """The diagnostics of ``trend`` alone: no other of its tables is computed."""
    return _diagnostics(_flows(observed, classified, events, scopes), classified)


def trend(observed: DataFrame, classified: DataFrame, events: DataFrame, scopes: DataFrame, manifests: DataFrame, versions: Column | None = None, held: tuple[DataFrame, DataFrame] | None = None) -> Trend:
    """observed: postings of all days with their health; the rest as ``replay`` gives it; manifests: ``snapshot_date, platform, detail_failed``.

    held: earlier sightings and their classification rows, whose labels still hold but whose days are not asked for. A flow
    that repeats within a day for one identity is an error.
    """
    flows = cut(_flows(observed, classified, events, scopes, versions, held))
    day = ["snapshot_date", "platform"]
    good = classified.where(c("in_scope") & trends.usable(c("classification_status"), c("reason_codes.market"), c("career_pool")))
    moved = flows.where(c("flow").isin("counted", "unknown")).withColumnRenamed("event_date", "snapshot_date").withColumn("known", c("flow") == "counted")
    moved = moved.groupBy(*day, "company", "event_type", "known").agg(F.count("*").alias("n"))
    name = F.concat(F.when(c("known"), "").otherwise("unknown_"), F.lower("event_type"), F.lit("_jobs"))
    by_flow = moved.groupBy(*day, name.alias("key")).agg(F.sum("n").alias("n")).select(*day, F.lit("flow").alias("dimension"), "key", "n")
    label = classified.select("snapshot_date", *KEYS, (classify.classification_unknown(c("classification_status"), c("reason_codes.market"))).alias("_unknown"))
    judged = observed.select("snapshot_date", *KEYS, "content_reliable").join(label, ["snapshot_date", *KEYS], "left").withColumn("unknown", F.coalesce("_unknown", F.lit(True)))
    unknown = trends.unknown_counts(manifests, judged, day).withColumnsRenamed({"n": "_n"})
    inventory = trends.inventory(good)
    active = inventory.where("dimension = 'active_jobs'").select(*day, c("n").alias("_active"))
    counts = unknown.join(active, day, "full_outer").select(*day, F.coalesce("_n", F.lit(0)).alias("_n"), F.coalesce("_active", F.lit(0)).alias("_active"))
    pair = lambda d, n: F.struct(F.lit(d).alias("dimension"), F.lit("all").alias("key"), n.cast("long").alias("n"))
    observed_counts = counts.select(*day, F.inline(F.array(pair("unknown_classification_count", c("_n")), pair("observed_inventory_count", c("_n") + c("_active")))))
    # small, and read many times by comparisons
    return Trend(
        cut(inventory.unionByName(by_flow).unionByName(observed_counts)),
        cut(trends.company_metrics(good, moved, day)),
        cut(_reliability(scopes, classified, observed, flows, versions)),
        flows,
        _diagnostics(flows, classified),
    )


def trend_of_days(observed: DataFrame, classified: DataFrame, events: DataFrame, scopes: DataFrame, manifests: DataFrame, days: list[str], versions: Column | None = None) -> Trend:
    """``trend``'s rows of some days alone: labels come from all sightings, and all events are checked, but only these days' are computed."""
    trends.refuse_duplicate_events(events)
    asked = lambda df, day="snapshot_date": df.where(c(day).isin(*[F.lit(d).cast("date") for d in days]))
    other = lambda df: df.where(~F.coalesce(c("snapshot_date").isin(*[F.lit(d).cast("date") for d in days]), F.lit(False)))
    return trend(asked(observed), asked(classified), asked(events, "event_date"), asked(scopes), asked(manifests), versions, (other(observed), other(classified)))


def _reliability(scopes: DataFrame, classified: DataFrame, observed: DataFrame, flows: DataFrame, versions: Column | None) -> DataFrame:
    """Reliability of the three metric families: scope health, classification, and what gating excluded."""
    day = ["snapshot_date", "platform"]
    base = trends.family_reliability(scopes, flows.withColumnRenamed("event_date", "snapshot_date"), day)
    usable = trends.usable(c("classification_status"), c("reason_codes.market"), c("career_pool"))
    review = ~usable & ~classify.classification_unknown(c("classification_status"), c("reason_codes.market"))
    other = F.lit(False) if versions is None else c("in_scope") & usable & (c("versions") != versions)
    marks = classified.groupBy(*day).agg(F.bool_or(review).alias("_review"), F.bool_or(F.coalesce(other, F.lit(False))).alias("_other"))
    empty = scopes.select("snapshot_date").distinct().join(observed.select("snapshot_date").distinct(), "snapshot_date", "left_anti").withColumn("_empty", F.lit(True))
    bad_text = scopes.groupBy(*day).agg((~F.bool_and("content_reliable")).alias("_bad_text"))
    rows = base.join(marks, day, "left").join(empty, "snapshot_date", "left").join(bad_text, day, "left")
    stock = c("family") == "inventory"
    none = F.array().cast("array<string>")
    code = lambda when, *names: F.when(F.coalesce(stock & when, F.lit(False)), F.array(*[F.lit(x) for x in names])).otherwise(none)
    more = F.concat(code(c("_review"), "CLASSIFICATION_REVIEW_REQUIRED"), code(c("_other"), "CLASSIFIER_VERSION_MISMATCH", "REPLAY_REQUIRED"), code(c("_empty") & c("_bad_text"), "CLASSIFICATION_COVERAGE_UNVERIFIED"))
    codes = F.array_sort(F.array_union("reason_codes", more))
    return rows.select(*day, "family", codes.alias("reason_codes")).withColumn("reliable", F.size("reason_codes") == 0)


def _diagnostics(flows: DataFrame, classified: DataFrame) -> DataFrame:
    """``snapshot_date, name, n`` of what metrics leave out."""
    kind = F.lower("event_type")
    name = (
        F.when(c("flow") == "diagnostic", F.concat(kind, F.lit("_diagnostic_events")))
        .when(c("flow") == "out_of_scope", "out_of_scope_flow_events")
        .when(c("status").isNull(), "unclassified_flow_events")
        .when(c("flow") == "UNRELIABLE_CANONICAL_EVENT_EXCLUDED", F.concat(F.lit("excluded_"), kind, F.lit("_events")))
    )
    told = flows.select(c("event_date").alias("snapshot_date"), name.alias("name"))
    usable = trends.usable(c("classification_status"), c("reason_codes.market"), c("career_pool"))
    left = classified.where(~usable & ~classify.classification_unknown(c("classification_status"), c("reason_codes.market"))).select("snapshot_date", F.lit("excluded_classification_identities").alias("name"))
    return told.unionByName(left).where("name IS NOT NULL").groupBy("snapshot_date", "name").agg(F.count("*").alias("n"))


def compare(found: Trend, scopes: DataFrame, before: str, after: str) -> dict[str, DataFrame]:
    """The comparison document of two days, by part: ``comparability`` (a row a family and platform), ``inventory``,
    ``lifecycle`` and ``companies``, each count over the platforms that its family can be compared on, null without any."""
    if before >= after:
        raise ValueError("COMPARISON_DATES_MUST_INCREASE")
    at = lambda df, d: df.where(c("snapshot_date") == F.lit(d).cast("date")).drop("snapshot_date")
    scope = scopes.groupBy("snapshot_date", "platform").agg(F.concat_ws(",", F.sort_array(F.collect_set("company"))).alias("scope"))
    side = lambda d: at(found.reliability, d).join(at(scope, d), "platform", "left").select("family", "platform", "reliable", "reason_codes", F.coalesce("scope", F.lit("")).alias("scope"), F.lit("").alias("versions"))
    comparability = trends.comparability(side(before), side(after))
    of = lambda family: comparability.where((c("family") == family) & c("comparable")).select("platform")
    a, b = at(found.metrics, before), at(found.metrics, after)
    stock = lambda df: df.where("dimension <> 'flow'")
    is_flow = c("dimension") == "flow"
    moves = lambda df, content: df.where(is_flow & (c("key").isin("updated_jobs", "unknown_updated_jobs") == F.lit(content)))
    lifecycle = trends.compare(moves(a, False), moves(b, False), of("presence_flow")).unionByName(trends.compare(moves(a, True), moves(b, True), of("content_flow")))
    long = lambda df: df.unpivot(["platform", "company"], [k for k in df.columns if k not in ("platform", "company")], "key", "n").withColumnRenamed("company", "dimension")
    parts = []
    ca, cb = long(at(found.companies, before)), long(at(found.companies, after))
    for name, keys in trends.COMPANY_FIELDS.items():
        parts.append(trends.compare(ca.where(c("key").isin(*keys)), cb.where(c("key").isin(*keys)), of(name)))
    companies = parts[0].unionByName(parts[1]).unionByName(parts[2]).withColumnRenamed("dimension", "company")
    return {"comparability": comparability, "inventory": trends.compare(stock(a), stock(b), of("inventory")), "lifecycle": lifecycle, "companies": companies}


def incomplete_days(wanted: DataFrame, parts: dict[str, DataFrame]) -> DataFrame:
    """``snapshot_date, reason_codes, missing``: days asked for that lack a part (each a table with ``snapshot_date``)."""
    rows = wanted.select("snapshot_date").distinct()
    for name, df in parts.items():
        rows = rows.join(df.select("snapshot_date").distinct().withColumn(name, F.lit(True)), "snapshot_date", "left")
    missing = F.array_compact(F.array(*[F.when(c(name).isNull(), name) for name in parts]))
    return rows.select("snapshot_date", F.array(F.lit("HISTORICAL_SOURCE_INCOMPLETE")).alias("reason_codes"), missing.alias("missing")).where(F.size("missing") > 0)


def weekly_report(classified: DataFrame, events: DataFrame, days: DataFrame, scopes: DataFrame, as_of: str, length: int = 7) -> dict[str, DataFrame]:
    """The seven-day report that ends on ``as_of``: ``coverage``, ``blocked`` scopes, ``totals`` of the market and its bridge
    pool with their flows (null unless comparable), and ``skills`` with rising and newly observed ones.

    days: as ``trends.window_reasons`` takes them; scopes: scope health; classified: rows with ``reliable`` and the
    label fields (``career_pool, company, skill_tags, versions``).
    """
    end = F.lit(as_of).cast("date")
    start = F.date_sub(end, length)
    coverage = trends.window_reasons(days, end, length)
    within = scopes.where((c("snapshot_date") >= start) & (c("snapshot_date") <= end) & ~(c("presence_reliable") & c("content_reliable")))
    codes = F.when(c("content_reliable"), c("reason_codes")).otherwise(F.array_union("reason_codes", F.array(F.lit("SOURCE_CONTENT_UNRELIABLE"))))
    blocked = within.groupBy("platform", "company").agg(F.array_sort(F.array_distinct(F.flatten(F.collect_set(codes)))).alias("reason_codes"))
    inside = events.where((c("event_date") > start) & (c("event_date") <= end) & (c("event_status") == "confirmed") & c("event_type").isin("NEW", "REMOVED"))
    label = trends.window_labels(classified.select("snapshot_date", *KEYS, "reliable", c("career_pool").alias("label")), events, days)
    told = inside.join(label.withColumnRenamed("snapshot_date", "event_date"), ["event_date", *KEYS])
    allowed = coverage.first()["comparable"]
    now, old = (classified.where(c("reliable") & (c("snapshot_date") == d)) for d in (end, start))
    part = lambda df, name: df.agg(F.lit(name).alias("part"), F.count("*").alias("active_jobs"), F.count_distinct("company").alias("companies"))
    flow = lambda df, name: df.agg(F.lit(name).alias("part"), F.when(F.lit(allowed), F.count_if(c("event_type") == "NEW")).alias("new_7d"), F.when(F.lit(allowed), F.count_if(c("event_type") == "REMOVED")).alias("removed_7d"))
    stock = part(now, "market").unionByName(part(now.where("career_pool = 'P1'"), "qa_bridge"))
    moved = flow(told, "market").unionByName(flow(told.where("label = 'P1'"), "qa_bridge"))
    skills = trends.tag_changes(now, old, allowed)
    before = classified.where(c("snapshot_date") < end).select(F.explode("skill_tags").alias("tag")).distinct().withColumn("_old", F.lit(True))
    skills = skills.join(before, "tag", "left").withColumn("newly_observed", c("_old").isNull()).drop("_old")
    return {"coverage": coverage, "blocked": blocked, "totals": stock.join(moved, "part"), "skills": skills}
