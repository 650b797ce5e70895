"""Daily snapshots in long form, and comparisons that are null unless both sides are comparable.

A snapshot is rows ``snapshot_date, platform, dimension, key, n``. Platforms hold
disjoint identities, so additive counts sum over them; tags and role families of
one posting overlap and never sum over keys.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import share

c = F.col
ADDITIVE = {"by_market_relevance": "market_relevance", "by_role_family": "role_family", "by_ai_relation": "ai_relation", "by_career_pool": "career_pool"}
#: Keys that a snapshot shows even at 0.
ALWAYS = {"by_market_relevance": ("core", "adjacent"), "by_career_pool": ("P1", "P2", "REF", "X")}
FLOWS = {"NEW": "presence_flow", "REMOVED": "presence_flow", "REAPPEARED": "presence_flow", "UPDATED": "content_flow"}
#: A company's counts, by the family that says where they can be compared.
COMPANY_FIELDS = {
    "inventory": ("active_jobs", "core", "adjacent", "P1"),
    **{family: tuple(p + f"{k.lower()}_jobs" for k, f in FLOWS.items() if f == family for p in ("", "unknown_")) for family in ("presence_flow", "content_flow")},
}


def value_counts(rows: DataFrame, field: str) -> DataFrame:
    return rows.groupBy(c(field).alias("key")).agg(F.count("*").alias("n"))


def tag_breadth(rows: DataFrame, tags: str = "skill_tags", company: str = "company") -> DataFrame:
    """``tag, mentions, companies``."""
    return rows.select(F.explode(F.array_distinct(tags)).alias("tag"), company).groupBy("tag").agg(F.count("*").alias("mentions"), F.count_distinct(company).alias("companies"))


def usable(status: Column, market_codes: Column, pool: Column) -> Column:
    carried = (status == "carried_forward") & F.array_contains(market_codes, "CONTENT_CARRIED_FORWARD") & pool.isin("P1", "P2", "REF", "X")
    return F.coalesce((status == "fresh") | carried, F.lit(False))


def inventory(rows: DataFrame, by: tuple[str, ...] = ("snapshot_date", "platform")) -> DataFrame:
    """``by, dimension, key, n`` of usable rows in scope: additive dimensions, role families of any rank, tags, companies, totals."""
    pair = lambda d, k: F.struct(F.lit(d).alias("dimension"), k.alias("key"))
    one = [pair(d, c(f)) for d, f in ADDITIVE.items()] + [pair("by_company", c("company")), pair("active_jobs", F.lit("all")), pair("hybrid_roles", F.when(F.size("secondary_role_families") > 0, "all"))]
    many = F.concat(
        F.transform(F.array_distinct(F.concat(F.array("role_family"), "secondary_role_families")), lambda x: pair("by_role_family_any", x)),
        F.transform(F.array_distinct("skill_tags"), lambda x: pair("by_skill_tag", x)),
    )
    flat = rows.select(*by, F.explode(F.concat(F.array(*one), many)).alias("x")).where("x.key IS NOT NULL")
    counts = flat.groupBy(*by, "x.dimension", "x.key").agg(F.count("*").alias("n"))
    spark = rows.sparkSession
    zero = spark.createDataFrame([(d, k, 0) for d, keys in ALWAYS.items() for k in keys], "dimension string, key string, n long")
    zeros = rows.select(*by).distinct().join(F.broadcast(zero))  # a handful of fixed keys for each group
    return counts.unionByName(zeros.select(*by, "dimension", "key", "n")).groupBy(*by, "dimension", "key").agg(F.sum("n").alias("n"))


def content_versions(rows: DataFrame, by: tuple[str, ...] = ("snapshot_date",)) -> DataFrame:
    return rows.groupBy(*by).agg(F.count_distinct("content_sha256").alias("unique_content_versions"))


def with_shares(snapshot: DataFrame, by: tuple[str, ...] = ("snapshot_date", "platform")) -> DataFrame:
    """Adds ``denominator`` (the group's active postings) and ``share``, null where there are none."""
    total = snapshot.where("dimension = 'active_jobs'").select(*by, c("n").alias("denominator"))
    return snapshot.join(total, [*by], "left").withColumn("denominator", F.coalesce("denominator", F.lit(0))).withColumn("share", share(c("n"), c("denominator")))


def platform_and_total(rows: DataFrame, keys: list[str], measures: dict[str, Column], platform: str = "platform") -> DataFrame:
    """Measures by platform and over all of them in one pass; the total's platform is null."""
    named = {k: c(k) for k in [*keys, platform]}
    flat = rows.select(*[v.alias(k) for k, v in named.items()], *[m.alias(k) for k, m in measures.items()])
    return flat.groupingSets([[*keys, platform], [*keys]], *keys, platform).agg(*[F.sum(k).alias(k) for k in measures])


def asof_labels(sightings: DataFrame, dates: DataFrame, keys: list[str], label: str, date: str = "snapshot_date") -> DataFrame:
    """Each identity's label on each date: that of its latest sighting up to then, null if that had none.

    A sighting holds from its day to the next one; only the dates asked for within are made, each a row of the result.
    """
    every = Window.orderBy(date)  # a row a date
    spine = dates.select(date).distinct().where(c(date).isNotNull()).withColumn("_n", F.row_number().over(every))
    # of each day that something was seen on, the number of the first date asked for from there on
    days = sightings.select(date).distinct().join(spine, date, "full_outer")
    days = days.withColumn("_from", F.min("_n").over(every.rowsBetween(0, Window.unboundedFollowing)))
    end = F.coalesce(F.max("_n").over(Window.partitionBy()), F.lit(0)) + 1
    days = days.select(date, F.coalesce("_from", end).alias("_from"), end.alias("_end"))
    held = Window.partitionBy(*keys).orderBy(date)
    rows = sightings.select(*keys, date, label).join(days, date).withColumn("_to", F.coalesce(F.lead("_from").over(held), "_end"))
    inside = rows.where(c("_from") < c("_to")).select(*keys, label, F.explode(F.sequence("_from", c("_to") - 1)).alias("_n"))
    return inside.join(spine, "_n").select(*keys, date, label)


def label_intervals(sightings: DataFrame, keys: list[str], date: str = "snapshot_date") -> DataFrame:
    """``sightings`` with ``until``, the day of the identity's next one (null: none): what holds on a day d has date <= d < until."""
    return sightings.withColumn("until", F.lead(date).over(Window.partitionBy(*keys).orderBy(date)))


def flows(events: DataFrame, labels: DataFrame) -> DataFrame:
    """``event_date, platform, company, event_type, known, n``: confirmed events, by whether the posting has a label."""
    sure = events.where((c("event_status") == "confirmed") & c("event_type").isin(*FLOWS))
    rows = sure.join(labels.select(c("snapshot_date").alias("event_date"), "platform", "job_id", F.lit(True).alias("known")), ["event_date", "platform", "job_id"], "left")
    return rows.groupBy("event_date", "platform", "company", "event_type", F.coalesce("known", F.lit(False)).alias("known")).agg(F.count("*").alias("n"))


def duplicate_events(events: DataFrame) -> DataFrame:
    return events.where(c("event_type").isin(*FLOWS)).groupBy("event_date", "platform", "job_id", "event_type").agg(F.count("*").alias("n")).where("n > 1")


def refuse_duplicate_events(events: DataFrame) -> None:
    """An identity has each flow at most once a day: fails on the first that repeats."""
    found = duplicate_events(events).orderBy("event_date", "platform", "job_id").first()
    if found is not None:
        raise ValueError(f"DUPLICATE_LIFECYCLE_EVENT: {found.event_date} {found.platform} {found.job_id} {found.event_type} x{found.n}")


def company_metrics(rows: DataFrame, flow: DataFrame, by: list[str] | None = None) -> DataFrame:
    """``by, company``, its active, core, adjacent and P1 postings, and its flows; companies of either side."""
    keys = [*(by or []), "company"]
    held = rows.groupBy(*keys).agg(F.count("*").alias("active_jobs"), F.count_if(c("market_relevance") == "core").alias("core"), F.count_if(c("market_relevance") == "adjacent").alias("adjacent"), F.count_if(c("career_pool") == "P1").alias("P1"))
    moved = flow.groupBy(*keys).agg(*[F.sum(F.when((c("event_type") == k) & (c("known") == known), c("n")).otherwise(0)).alias(("" if known else "unknown_") + f"{k.lower()}_jobs") for k in FLOWS for known in (True, False)])
    both = held.join(moved, keys, "full_outer")
    return both.select(*keys, *[F.coalesce(k, F.lit(0)).alias(k) for k in both.columns if k not in keys])


def unknown_counts(manifest: DataFrame, jobs: DataFrame, by: list[str] | None = None) -> DataFrame:
    """``by, n``: postings without a trusted label, and failures that a manifest counts without naming them.

    jobs: ``by, content_reliable, unknown`` (no label, or one that says unknown); ``by``: platform, if nothing else is said.
    """
    keys = by or ["platform"]
    found = jobs.groupBy(*keys).agg(F.count_if(~c("content_reliable")).alias("failures"), F.count_if(~c("content_reliable") & c("unknown")).alias("unknowns"))
    both = manifest.select(*keys, "detail_failed").join(found, keys, "full_outer")
    zero = lambda k: F.coalesce(k, F.lit(0))
    return both.select(*keys, (zero("unknowns") + F.greatest(zero("detail_failed") - zero("failures"), F.lit(0))).alias("n"))


def broken_snapshots(snapshot: DataFrame, by: tuple[str, ...] = ("snapshot_date", "platform")) -> DataFrame:
    """Groups whose additive dimensions (or companies) don't sum to their active postings."""
    sums = snapshot.where(c("dimension").isin(*ADDITIVE, "by_company")).groupBy(*by, "dimension").agg(F.sum("n").alias("n"))
    total = snapshot.where("dimension = 'active_jobs'").select(*by, c("n").alias("active"))
    return sums.join(total, [*by], "left").where(c("n") != F.coalesce("active", F.lit(0)))


def comparability(before: DataFrame, after: DataFrame) -> DataFrame:
    """``family, platform, comparable, reason_codes``: a platform counts if both days observe it reliably in the same scope.

    before, after: ``family, platform, reliable, reason_codes, scope, versions``.
    """
    a, b = (df.select("family", "platform", *[c(k).alias(f"{s}_{k}") for k in ("reliable", "reason_codes", "scope", "versions")]) for df, s in ((before, "a"), (after, "b")))
    both = a.join(b, ["family", "platform"], "full_outer")
    none = F.array().cast("array<string>")
    code = lambda when, *names: F.when(F.coalesce(when, F.lit(False)), F.array(*[F.lit(x) for x in names])).otherwise(none)
    one_side = c("a_reliable").isNull() | c("b_reliable").isNull()
    reasons = F.concat(
        code(one_side, "PLATFORM_NOT_OBSERVED_BOTH_DAYS"),
        F.when(one_side, none).otherwise(F.concat(F.coalesce("a_reason_codes", none), F.coalesce("b_reason_codes", none))),
        code(~one_side & ~(c("a_reliable") & c("b_reliable")), "METRIC_SOURCE_UNRELIABLE"),
        code(~one_side & (c("a_scope") != c("b_scope")), "SOURCE_SCOPE_CHANGED"),
        code(~one_side & (c("a_versions") != c("b_versions")), "CLASSIFIER_VERSION_MISMATCH", "REPLAY_REQUIRED"),
    )
    return both.select("family", "platform", F.array_sort(F.array_distinct(reasons)).alias("reason_codes")).withColumn("comparable", F.size("reason_codes") == 0)


def change(a: Column, b: Column, comparable: Column) -> dict[str, Column]:
    """from, to, delta and pct_change: null unless comparable, the last also over a base of 0."""
    only = lambda x: F.when(comparable, x)
    return {"from_n": only(a), "to_n": only(b), "delta": only(b - a), "pct_change": only(F.try_divide(b - a, a))}


def compare(before: DataFrame, after: DataFrame, platforms: DataFrame) -> DataFrame:
    """``dimension, key`` and the change of ``n`` over the comparable platforms (``platform``); nulls if there are none.

    before, after: snapshots of one date: ``platform, dimension, key, n``. Keys of either whole snapshot appear.
    """
    sums = lambda df, name: df.join(platforms, "platform", "left_semi").groupBy("dimension", "key").agg(F.sum("n").alias(name))
    keys = before.select("dimension", "key").union(after.select("dimension", "key")).distinct()
    valid = F.lit(platforms.limit(1).count() > 0)
    both = keys.join(sums(before, "a"), ["dimension", "key"], "left").join(sums(after, "b"), ["dimension", "key"], "left")
    a, b = F.coalesce("a", F.lit(0)), F.coalesce("b", F.lit(0))
    return both.select("dimension", "key", *[x.alias(k) for k, x in change(a, b, valid).items()], valid.alias("comparable"))


def broken_comparison(rows: DataFrame) -> DataFrame:
    """Rows whose values break their comparability: a value although not comparable, or a delta that isn't the difference."""
    given = c("from_n").isNotNull() | c("to_n").isNotNull() | c("delta").isNotNull() | c("pct_change").isNotNull()
    wrong = c("comparable") & ~c("delta").eqNullSafe(c("to_n") - c("from_n"))
    return rows.where((~c("comparable") & given) | wrong | (c("comparable") & (c("from_n") == 0) & c("pct_change").isNotNull()))


def window_totals(events: DataFrame, as_of: Column, days: int = 7) -> DataFrame:
    """``event_type, n`` of confirmed NEW and REMOVED events in the days up to ``as_of``, its baseline day left out."""
    inside = (c("event_date") > F.date_sub(as_of, days)) & (c("event_date") <= as_of)
    return events.where(inside & (c("event_status") == "confirmed") & c("event_type").isin("NEW", "REMOVED")).groupBy("event_type").agg(F.count("*").alias("n"))


def window_gaps(dates: DataFrame, as_of: Column, days: int = 7) -> DataFrame:
    """``expected``: the days of the window (baseline included) without an observation."""
    spine = dates.sparkSession.range(1).select(F.explode(F.sequence(F.date_sub(as_of, days), as_of)).alias("expected"))
    return spine.join(dates.select(c("snapshot_date").alias("expected")).distinct(), "expected", "left_anti")


def anomalies(before: DataFrame, after: DataFrame, least: int = 3, rate: float = 0.25) -> DataFrame:
    """``dimension, key, previous, current, delta`` of counts that moved by at least ``least`` and ``rate``."""
    both = before.select("dimension", "key", c("n").alias("previous")).join(after.select("dimension", "key", c("n").alias("current")), ["dimension", "key"], "full_outer")
    both = both.withColumns({"previous": F.coalesce("previous", F.lit(0)), "current": F.coalesce("current", F.lit(0))}).withColumn("delta", c("current") - c("previous"))
    return both.where((F.abs("delta") >= least) & (F.abs("delta") / F.greatest("previous", F.lit(1)) >= rate))


def window_labels(classified: DataFrame, events: DataFrame, dates: DataFrame) -> DataFrame:
    """Labels of the seven-day report: ``snapshot_date, platform, job_id, label``.

    Unlike ``asof_labels``, a label lives on only through days that classify its
    posting (reliably or not) or tell it MISSING or REMOVED; any other day ends
    it. classified: ``snapshot_date, platform, job_id, reliable, label``.
    """
    keys = ["platform", "job_id"]
    told = events.where(c("event_type").isin("MISSING", "REMOVED")).select(c("event_date").alias("snapshot_date"), *keys, F.lit(True).alias("_told")).distinct()
    numbered = dates.select("snapshot_date").distinct().withColumn("_n", F.row_number().over(Window.orderBy("snapshot_date")))  # a row a date
    # a posting's days that keep a label are those of either table; a gap between them is a day that ends it
    rows = classified.join(told, ["snapshot_date", *keys], "full_outer").join(numbered, "snapshot_date")
    upto = Window.partitionBy(*keys).orderBy("_n")
    rows = rows.withColumn("_gap", F.coalesce(c("_n") - F.lag("_n").over(upto) > 1, F.lit(False)).cast("int"))
    rows = rows.withColumn("_life", F.sum("_gap").over(upto))
    life = Window.partitionBy(*keys, "_life").orderBy("_n")
    label = F.last(F.when(c("reliable"), c("label")), ignorenulls=True).over(life)
    return rows.select("snapshot_date", *keys, label.alias("label")).where("label IS NOT NULL")


def window_reasons(days: DataFrame, as_of: Column, length: int = 7) -> DataFrame:
    """One row ``reason_codes, comparable`` for a window that ends on ``as_of``.

    days: ``snapshot_date, cities, has_manifest, reliable, reviewed, versions``, a row a day.
    """
    inside = days.where((c("snapshot_date") >= F.date_sub(as_of, length)) & (c("snapshot_date") <= as_of))
    none = F.array().cast("array<string>")
    sums = inside.agg(
        F.count_distinct("snapshot_date").alias("n"), F.coalesce(F.bool_or(c("snapshot_date") == F.date_sub(as_of, length)), F.lit(False)).alias("base"), F.count_distinct("cities").alias("scopes"),
        F.coalesce(F.bool_and("has_manifest"), F.lit(False)).alias("known"), F.coalesce(F.bool_and("reliable"), F.lit(False)).alias("fine"), F.coalesce(F.bool_and("reviewed"), F.lit(False)).alias("reviewed"), F.count_distinct("versions").alias("versions"),
    )
    code = lambda when, *names: F.when(when, F.array(*[F.lit(x) for x in names])).otherwise(none)
    reasons = F.concat(
        code(c("n") < length + 1, "OBSERVATION_GAPS"), code(~c("base"), "INSUFFICIENT_WINDOW_HISTORY"), code(~c("known"), "MANIFEST_SCOPE_MISSING"), code(c("scopes") > 1, "SOURCE_SCOPE_CHANGED"),
        code(~c("fine"), "SOURCE_COVERAGE_INCOMPARABLE"), code(~c("reviewed"), "CLASSIFICATION_REVIEW_REQUIRED"), code(c("versions") > 1, "CLASSIFIER_VERSION_MISMATCH", "REPLAY_REQUIRED"),
    )
    return sums.select(F.array_sort(reasons).alias("reason_codes")).withColumn("comparable", F.size("reason_codes") == 0)


def tag_changes(current: DataFrame, baseline: DataFrame, comparable: bool, tags: str = "skill_tags") -> DataFrame:
    """``tag, mentions, mention_share, companies`` now and their changes since the baseline day, null unless comparable; ``rising``."""
    totals = [df.agg(F.count("*").alias(k)) for df, k in ((current, "_all"), (baseline, "_all_old"))]
    now = tag_breadth(current, tags).join(F.broadcast(totals[0]))
    old = tag_breadth(baseline, tags).select("tag", c("mentions").alias("_m"), c("companies").alias("_c"))
    rows = now.join(old, "tag", "left").join(F.broadcast(totals[1])).withColumns({"_m": F.coalesce("_m", F.lit(0)), "_c": F.coalesce("_c", F.lit(0))})
    part = lambda a, b: F.coalesce(F.try_divide(a, b), F.lit(0.0))
    only = lambda x: F.when(F.lit(comparable), x)
    rows = rows.withColumns({"mention_share": part("mentions", "_all"), "change": only(c("mentions") - c("_m")), "share_change": only(part("mentions", "_all") - part("_m", "_all_old")), "companies_change": only(c("companies") - c("_c"))})
    rising = F.coalesce((c("change") > 0) & (c("share_change") > 0) & (c("companies_change") > 0) & (c("companies") > 1), F.lit(False))
    return rows.select("tag", "mentions", "mention_share", "companies", "change", "share_change", "companies_change", rising.alias("rising"))


def flow_of() -> Column:
    """What becomes of an event: counted, unknown, diagnostic, out_of_scope, or why it is not counted.

    Reads ``event_type, event_status, previous_sha256, current_sha256``, the label as of the event's day (``status``,
    null without one, ``version_ok, content_sha256``) and ``out_of_scope, presence_reliable, content_reliable``.
    An UPDATED event counts for a fresh row only, whose text is the event's and another than before.
    """
    content = c("event_type") == "UPDATED"
    trusted = F.coalesce(F.when(content, c("content_reliable")).otherwise(c("presence_reliable")), F.lit(False))
    changed = (c("previous_sha256") != c("current_sha256")) & (c("current_sha256") == c("content_sha256"))
    whole = ~content | ((c("status") == "fresh") & F.coalesce(changed, F.lit(False)))
    return (
        F.when((c("event_status") != "confirmed") | ~c("event_type").isin(*FLOWS), "diagnostic")
        .when(c("status").isNull() & F.coalesce("out_of_scope", F.lit(False)), "out_of_scope")
        .when(c("status").isNull() & trusted, "unknown")
        .when(c("status").isNull(), "UNRELIABLE_CANONICAL_EVENT_EXCLUDED")
        .when(~c("version_ok"), "CLASSIFIER_VERSION_MISMATCH")
        .when(~trusted | ~whole, "UNRELIABLE_CANONICAL_EVENT_EXCLUDED")
        .otherwise("counted")
    )


def gate_events(events: DataFrame, labels: DataFrame, postings: DataFrame) -> DataFrame:
    """One day's events with ``flow``.

    labels: ``platform, job_id, version_ok, status, content_sha256`` as of the day;
    postings: ``platform, job_id, out_of_scope, presence_reliable, content_reliable``.
    """
    keys = ["platform", "job_id"]
    rows = events.join(labels, keys, "left").join(postings, keys, "left")
    return rows.select(*[events[k] for k in events.columns], flow_of().alias("flow"))


def family_reliability(scopes: DataFrame, gated: DataFrame, by: list[str] | None = None) -> DataFrame:
    """``by, family, reliable, reason_codes`` from scope health and what gating excluded; ``by``: platform, if nothing else is said."""
    keys, none = by or ["platform"], F.array().cast("array<string>")
    each = scopes.groupBy(*keys).agg(F.bool_and("presence_reliable").alias("p"), F.bool_and("content_reliable").alias("t"), F.array_sort(F.array_distinct(F.flatten(F.collect_set(F.when(~c("presence_reliable"), c("reason_codes")))))).alias("codes"))
    listed = F.when(~c("p"), F.array_union(F.array(F.lit("SOURCE_PRESENCE_UNRELIABLE")), "codes")).otherwise(none)
    texts = F.when(~c("t"), F.array(F.lit("SOURCE_CONTENT_UNRELIABLE"))).otherwise(none)
    by_family = each.select(*keys, F.explode(F.array(*[F.struct(F.lit(f).alias("family"), r.alias("codes")) for f, r in (("inventory", listed), ("presence_flow", listed), ("content_flow", texts))])).alias("x")).select(*keys, "x.*")
    family = F.when(c("event_type") == "UPDATED", "content_flow").otherwise("presence_flow")
    excluded = gated.where(c("flow").isin("UNRELIABLE_CANONICAL_EVENT_EXCLUDED", "CLASSIFIER_VERSION_MISMATCH"))
    codes = F.when(c("flow") == "CLASSIFIER_VERSION_MISMATCH", F.array(c("flow"), F.lit("REPLAY_REQUIRED"))).otherwise(F.array("flow"))
    cut = excluded.groupBy(*keys, family.alias("family")).agg(F.array_distinct(F.flatten(F.collect_set(codes))).alias("more"))
    rows = by_family.join(cut, [*keys, "family"], "left")
    return rows.select(*keys, "family", F.array_sort(F.array_union("codes", F.coalesce("more", none))).alias("reason_codes")).withColumn("reliable", F.size("reason_codes") == 0)
