"""Whether an observation can be trusted, by scope and by posting.

A scope is a platform, or one of its companies for platforms that list many.
Presence (the posting is listed) and content (its text is whole) are judged
apart; the codes that tell why come in a fixed order, each once.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import text_of

NORMAL_STOPS = ("source_total_reached", "all_city_totals_reached", "all_companies_complete", "all_partitions_complete")
LIST_STOPS = ("empty_page", "incomplete_list", "repeated_page", "company_error")
COUNTERS = ("source_total", "expected_pages", "pages_fetched", "records_fetched", "jobs_mapped", "jobs_in_scope", "detail_failed")
MANY_COMPANIES = ("feishu",)

c = F.col
_none = F.array


def _code(when: Column, name: str) -> Column:
    return F.when(F.coalesce(when, F.lit(False)), name)


def _flag(column: str) -> Column:
    return F.coalesce(c(column), F.lit(False))


def context(manifest: DataFrame, jobs: DataFrame, job_count: DataFrame) -> DataFrame:
    """The manifest's rows with each platform's posting count, and whether the day's total is another than stated.

    manifest: ``snapshot_date, platform`` and counters; job_count: ``snapshot_date, job_count``.
    """
    counts = jobs.groupBy("snapshot_date", "platform").agg(F.count("*").alias("rows"))
    totals = jobs.groupBy("snapshot_date").agg(F.count("*").alias("total"))
    day = job_count.join(totals, "snapshot_date", "left").select("snapshot_date", (~c("job_count").eqNullSafe(F.coalesce("total", F.lit(0)))).alias("total_differs"))
    out = manifest.join(counts, ["snapshot_date", "platform"], "left").join(day, "snapshot_date", "left")
    return out.withColumns({"rows": F.coalesce("rows", F.lit(0)), "total_differs": F.coalesce("total_differs", F.lit(True))})


def failed_companies(manifest: DataFrame) -> Column:
    """Companies that failed: as listed, or (old manifests) parsed from ``company: error; company: error``, if all parts parse."""
    chunks = F.split(F.coalesce("error", F.lit("")), "; ")
    shape = r"^([^:;\n/]{1,80}):\s+.+"
    parsed = F.when(F.forall(chunks, lambda x: x.rlike(shape)), F.transform(chunks, lambda x: F.regexp_extract(x, shape, 1)))
    old = c("platform").isin(*MANY_COMPANIES) & (c("stopped_by") == "company_error")
    return F.coalesce("failed_companies", F.when(old, parsed), F.array().cast("array<string>"))


def scopes(manifest: DataFrame, jobs: DataFrame) -> DataFrame:
    """``snapshot_date, platform, company``: one scope a platform (company ''), or one a company; observed platforms without manifest too."""
    many = c("platform").isin(*MANY_COMPANIES)
    single = manifest.where(~many).select("snapshot_date", "platform", F.lit("").alias("company"))
    listed = manifest.where(many).select("snapshot_date", "platform", F.explode_outer(F.array_union(F.coalesce("attempted_companies", F.array().cast("array<string>")), failed_companies(manifest))).alias("company"))
    observed = jobs.select("snapshot_date", "platform", F.coalesce("company", F.lit("")).alias("company")).distinct()
    known = manifest.select("snapshot_date", "platform")
    seen = observed.where(many).join(known, ["snapshot_date", "platform"], "left_semi")
    by_company = listed.union(seen).where("company IS NOT NULL").distinct()
    bare = known.where(many).join(by_company, ["snapshot_date", "platform"], "left_anti").withColumn("company", F.lit(""))
    unlisted = observed.join(known, ["snapshot_date", "platform"], "left_anti").select("snapshot_date", "platform", F.lit("").alias("company")).distinct()
    return single.union(by_company).union(bare).union(unlisted)


def _resolved(rows: DataFrame) -> DataFrame:
    """Adds ``presence_reliable, content_reliable, reason_codes`` of the scope; rows hold a scope and its manifest (``known``)."""
    bad = F.lit(False)
    for k in COUNTERS:
        bad = bad | c(k).isNull() | (c(k) < 0)
    many = c("platform").isin(*MANY_COMPANIES)
    partial = many & (c("stopped_by") == "company_error") & (F.size("failed") > 0)
    partial = F.coalesce(partial, F.lit(False))
    stop = F.coalesce("stopped_by", F.lit(""))
    whole = lambda when: ~partial & when
    presence = F.array_compact(
        F.array(
            _code(c("total_differs") | (c("rows") != c("jobs_in_scope")), "SNAPSHOT_COUNT_MISMATCH"),
            _code(~F.coalesce("status", F.lit("")).isin("success", "partial"), "SOURCE_ERROR"),
            _code(F.coalesce("missing_job_id", F.lit(0)) != 0, "MISSING_JOB_IDS"),
            _code((c("jobs_mapped") < c("jobs_in_scope")) | (c("jobs_mapped") + F.coalesce("duplicate_records", F.lit(0)) < c("records_fetched")), "MAPPING_INCOMPLETE"),
            _code(many & ~_flag("observed"), "COMPANY_SCOPE_UNOBSERVED"),
            _code(partial & F.array_contains("failed", c("company")), "COMPANY_ERROR"),
            _code(whole(c("pages_fetched") < c("expected_pages")), "LIST_PAGES_INCOMPLETE"),
            _code(whole(c("records_fetched") < c("source_total")), "LIST_RECORDS_INCOMPLETE"),
            _code(whole(stop.isin(*LIST_STOPS)), "LIST_INCOMPLETE"),
            _code(whole(~_flag("complete") & (stop != "detail_errors")), "SOURCE_INCOMPLETE"),
            _code(whole(F.coalesce("error", F.lit("")) != ""), "SOURCE_ERROR"),
            _code(whole(~stop.isin(*NORMAL_STOPS, "detail_errors")), "UNVERIFIED_STOP_REASON"),
        )
    )
    legacy = F.array_compact(F.array(_code(partial & c("failed_companies").isNull(), "LEGACY_COMPANY_ERROR_PARSED")))
    none = F.array().cast("array<string>")
    rows = rows.withColumns({"_bad": bad, "_codes": F.array_distinct(presence), "_legacy": legacy})
    missing = ~_flag("known")
    codes = F.when(missing, F.array(F.lit("MANIFEST_SCOPE_MISSING"))).when(c("_bad"), F.array(F.lit("MANIFEST_COUNTERS_INVALID"))).otherwise(F.array_union("_codes", "_legacy"))
    usable = ~missing & ~c("_bad")
    # presence is settled before the codes that only tell of parsing or of texts
    rows = rows.withColumns({"presence_reliable": usable & (F.size(F.coalesce("_codes", none)) == 0), "content_reliable": usable & c("status").isin("success", "partial"), "reason_codes": codes})
    return rows.withColumn("content_reliable", F.coalesce("content_reliable", F.lit(False))).drop("_bad", "_codes", "_legacy")


def resolve_scopes(context_rows: DataFrame, jobs: DataFrame) -> DataFrame:
    """Health of each scope: ``snapshot_date, platform, company, presence_reliable, content_reliable, reason_codes``."""
    keys = ["snapshot_date", "platform"]
    observed = jobs.where(c("platform").isin(*MANY_COMPANIES)).select(*keys, F.coalesce("company", F.lit("")).alias("company")).distinct().withColumn("_seen", F.lit(True))
    manifest = context_rows.withColumns({"known": F.lit(True), "failed": failed_companies(context_rows)})
    rows = scopes(context_rows, jobs).join(manifest, keys, "left").join(observed, [*keys, "company"], "left")
    attempted = F.coalesce("attempted_companies", F.array().cast("array<string>"))
    rows = rows.withColumn("observed", F.coalesce("_seen", F.lit(False)) | F.array_contains(attempted, c("company")))
    return _resolved(rows).select(*keys, "company", "presence_reliable", "content_reliable", "reason_codes", "detail_failed", "stopped_by", "detail_failed_job_ids")


def resolve_jobs(jobs: DataFrame, scope_health: DataFrame) -> DataFrame:
    """Adds ``presence_reliable, content_reliable, health_reasons`` to each posting: its scope's, and what its own text says."""
    many = c("platform").isin(*MANY_COMPANIES)
    keyed = jobs.withColumn("_scope", F.when(many, F.coalesce("company", F.lit(""))).otherwise(""))
    health = scope_health.select(c("snapshot_date").alias("_d"), c("platform").alias("_p"), c("company").alias("_c"), "presence_reliable", c("content_reliable").alias("_content"), c("reason_codes").alias("_codes"), "detail_failed", "stopped_by", "detail_failed_job_ids")
    # manifests hold lists of failed ids, so how large their side is the planner has to see for itself
    rows = keyed.join(health, (keyed["snapshot_date"] == c("_d")) & (keyed["platform"] == c("_p")) & (keyed["_scope"] == c("_c")), "left")
    title, body, req = (text_of(c(k)) for k in ("title", "description", "requirements"))
    listed = F.coalesce(F.array_contains("detail_failed_job_ids", c("job_id")), F.lit(False))
    probable = ~listed & (title != "") & (body == "") & (req == "") & ((c("detail_failed") > 0) | (c("stopped_by") == "detail_errors"))
    thin = (title == "") | ((body == "") & (req == ""))
    known = c("_codes").isNotNull() & ~F.arrays_overlap("_codes", F.array(F.lit("MANIFEST_SCOPE_MISSING"), F.lit("MANIFEST_COUNTERS_INVALID")))
    own = F.array_compact(F.array(_code(listed, "DETAIL_FAILED_JOB_ID"), _code(probable, "PROBABLE_DETAIL_FAILURE"), _code(thin, "INSUFFICIENT_CONTENT")))
    codes = F.when(known, F.array_union("_codes", own)).otherwise(F.coalesce("_codes", F.array(F.lit("MANIFEST_SCOPE_MISSING"))))
    return rows.withColumns(
        {"presence_reliable": F.coalesce("presence_reliable", F.lit(False)), "content_reliable": F.coalesce("_content", F.lit(False)) & known & (F.size(own) == 0), "health_reasons": codes}
    ).drop("_scope", "_d", "_p", "_c", "_content", "_codes", "detail_failed", "stopped_by", "detail_failed_job_ids")


def tolerated_gaps(context_rows: DataFrame, resolved_jobs: DataFrame, max_failed: int, max_rate: float) -> DataFrame:
    """``snapshot_date, platform, tolerated``: whether a few failed detail pages are all that is wrong.

    For operations only; it changes no posting's health.
    """
    keys = ["snapshot_date", "platform"]
    failed, total = c("detail_failed"), c("jobs_in_scope")
    ids = F.coalesce("detail_failed_job_ids", F.array().cast("array<string>"))
    jobs = resolved_jobs.join(context_rows.select(*keys, ids.alias("_ids")), keys, "left")
    mine = F.coalesce(F.array_contains("_ids", c("job_id")), F.lit(False))
    sums = jobs.groupBy(*keys).agg(F.count_distinct("job_id").alias("ids"), F.count_distinct(F.when(mine, c("job_id"))).alias("found"), F.bool_and("presence_reliable").alias("present"), F.bool_and(c("content_reliable") | mine).alias("whole"))
    counters = F.lit(True)
    for k in (*COUNTERS, "details_fetched", "duplicate_records", "outside_city_scope", "missing_job_id"):
        counters = counters & c(k).isNotNull() & (c(k) >= 0)
    shape = (c("status") == "partial") & ~_flag("complete") & (c("stopped_by") == "detail_errors") & (c("error") == "") & (F.size(F.coalesce("failed_companies", F.array(F.lit("?")))) == 0)
    sizes = (failed > 0) & (failed <= max_failed) & (total > 0) & (F.try_divide(failed, total) <= max_rate)
    sums_up = (
        (c("expected_pages") > 0) & (c("pages_fetched") >= c("expected_pages")) & (c("records_fetched") == c("source_total")) & (c("missing_job_id") == 0)
        & (c("jobs_mapped") + c("duplicate_records") == c("records_fetched")) & (c("jobs_mapped") == total + c("outside_city_scope")) & (c("details_fetched") + failed == total)
    )
    named = (F.size(ids) == failed) & (F.size(F.array_distinct(ids)) == failed) & F.forall(ids, lambda x: x.isNotNull() & (x != ""))
    rows = context_rows.join(sums, keys, "left")
    ok = shape & counters & sizes & sums_up & named & (c("ids") == total) & (c("found") == failed) & c("present") & c("whole")
    return rows.select(*keys, F.coalesce(ok, F.lit(False)).alias("tolerated"))


def roll_up(scope_health: DataFrame) -> DataFrame:
    """A platform's health: reliable if all its scopes are; the codes of all."""
    each = scope_health.groupBy("snapshot_date", "platform").agg(F.bool_and("presence_reliable").alias("presence_reliable"), F.bool_and("content_reliable").alias("content_reliable"), F.array_sort(F.array_distinct(F.flatten(F.collect_set("reason_codes")))).alias("reason_codes"), F.count("*").alias("scopes"))
    return each
