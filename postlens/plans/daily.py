"""Jobs of one day: collect, clean, audit, analyse, report. Each reads stored days and replaces its own day's partition."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..operators import classify, clean, evidence, health, ops, quality, report
from ..sources import files, postings


def collect(pages: DataFrame, platforms: list[str], cities: list[str], include_unknown: bool = False) -> tuple[DataFrame, DataFrame]:
    """Postings in scope of all platforms, and a manifest row for each.

    A platform without a readable page is an error row, no more. One is ``complete`` only if all pages and records that its
    pages state were fetched and none lacked its id; else it is ``partial``, and ``stopped_by`` says what fell short.
    """
    listed = postings.read_all(pages, platforms)
    kept = postings.distinct_postings(listed).where(clean.location_wanted(F.col("location"), cities, include_unknown))
    counters = postings.manifest_counters(listed, cities, include_unknown)
    spark = pages.sparkSession
    wanted = spark.createDataFrame([(p,) for p in platforms], "platform string")
    rows = wanted.join(postings.stated_totals(pages, platforms), "platform", "left").join(counters, "platform", "left").withColumn("_broken", F.col("records_fetched").isNull())
    numbers = [k for k, t in rows.dtypes if t == "bigint"]
    rows = rows.na.fill(0, numbers)
    c = F.col
    stopped = (
        F.when(c("_broken"), "error")
        .when(c("pages_fetched") < c("expected_pages"), "incomplete_list")
        .when(c("records_fetched") < c("source_total"), F.when(c("list_end"), "empty_page").otherwise("incomplete_list"))
        .when(c("missing_job_id") > 0, "incomplete_list")
        .otherwise("source_total_reached")
    )
    rows = rows.withColumn("stopped_by", stopped).withColumn("complete", c("stopped_by") == "source_total_reached")
    rows = rows.withColumns({"status": F.when(c("_broken"), "error").when(c("complete"), "success").otherwise("partial"), "error": F.when(c("_broken"), "no readable page").otherwise("")})
    return kept.drop("page", "position"), rows.drop("_broken", "list_end")


def default_day(now: Column | None = None) -> Column:
    """The day of a run that names none: today in China, from a UTC timestamp."""
    return F.to_date(F.from_utc_timestamp(now if now is not None else F.to_utc_timestamp(F.current_timestamp(), F.current_timezone()), "Asia/Shanghai"))


def merge_platform(rows: DataFrame, manifest: DataFrame, path: str, day: str, platform: str) -> None:
    """Replace one platform's partition of a stored day by a retry; one that is not complete, or found nothing, replaces nothing."""
    mine = manifest.where(F.col("platform") == platform)
    state = mine.agg(F.count("*").alias("n"), F.bool_and(F.coalesce("complete", F.lit(False)) & (F.col("status") == "success")).alias("fine")).first()
    if state.n != 1:
        raise ValueError(f"MERGE_NEEDS_ONE_MANIFEST: {state.n} of {platform}")
    if not state.fine:
        raise ValueError(f"INCOMPLETE_RETRY_REFUSED: {platform}")
    stored = rows.sparkSession.read.parquet(path).where(F.col("snapshot_date").cast("string") == day)
    if not stored.limit(1).count():
        raise ValueError(f"NO_STORED_DAY: {day}")
    new = rows.where(F.col("platform") == platform).withColumn("snapshot_date", F.lit(day).cast(stored.schema["snapshot_date"].dataType))
    files.write_day(new, path)


def clean_day(raw: DataFrame, out: str, day: str) -> dict[str, int]:
    """Normalise locations, write the day, return its report: counters are taken while it is written, in the same job.

    Raw columns and rows stay as they are. A day without rows replaces nothing.
    """
    seen = Observation("clean")
    rows = clean.normalize_locations(raw).withColumn("snapshot_date", F.lit(day).cast("date")).observe(seen, *clean.report_counters())
    # the folders that the rows name are replaced when the job commits; without rows none is
    rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("snapshot_date", "platform").parquet(out)
    report = seen.get
    if not report["job_count"]:
        raise ValueError("no rows: the stored partitions stay as they are")
    return report


def audit_day(raw: DataFrame, manifest: DataFrame, job_count: int | None, enums: quality.Enums) -> dict[str, DataFrame]:
    """All audits of a day by name."""
    return {
        "quality": quality.quality_report(raw, manifest, job_count),
        "enum_health": quality.enum_health(raw, enums),
        "enum_exceptions": quality.enum_exceptions(raw, enums),
        "education_evidence": evidence.education_evidence(raw),
        "experience_evidence": evidence.experience_evidence(raw),
        "unknown_patterns": evidence.unknown_patterns(raw),
    }


def candidate_report(classified: DataFrame, jobs: DataFrame) -> dict[str, DataFrame]:
    """The day's candidates by pool and company, grouped by text; problems of the link between rows and postings first."""
    found = report.candidates(classified.drop("company", "title", "url", "city_norm"), jobs)
    chosen = found.where(F.col("career_pool").isin("P1", "P2"))
    return {
        "problems": report.link_problems(classified, jobs),
        "groups": report.content_groups(chosen),
        "companies": report.company_table(chosen, found),
        "skills": report.ranking(chosen, "skill_tags", order="job_id"),
        "workplace": classify.select_candidates(chosen),
    }


def explore(jobs: DataFrame, scope: DataFrame) -> dict[str, DataFrame]:
    """Selection and exclusion of unclassified postings, with rankings; ``labels`` is kept in memory until it is unpersisted."""
    keys = clean.in_scope(jobs, scope).select("platform", "job_id").distinct().withColumn("_in", F.lit(True))
    # labels are wide expressions that four results read: kept once
    labels = classify.add_skills(classify.add_fit(jobs.join(keys, ["platform", "job_id"], "left"))).persist()
    rows = classify.explain(labels, F.coalesce("_in", F.lit(False))).drop("_in")
    chosen = rows.where("selected")
    return {"selected": chosen, "excluded": report.exclusion_breakdown(rows.where("exclusion_codes IS NOT NULL")), "skills": report.ranking(chosen, "skill_tags", order="job_id"), "counters": report.counters(rows), "labels": labels}


def day_sources(manifest: DataFrame, jobs: DataFrame) -> DataFrame:
    """One day's sources as ``ops.interpretation`` takes them, resolved from its manifest and postings.

    manifest: a row a platform with ``job_count`` and, as JSON, ``metadata`` (how its list was read); jobs: the day's postings.
    """
    day = manifest.select("snapshot_date", "job_count").dropDuplicates(["snapshot_date"])
    context = health.context(manifest, jobs, day)
    rolled = health.roll_up(health.resolve_scopes(context, jobs)).drop("scopes")
    c, none = F.col, F.array().cast("array<string>")
    meta = F.try_parse_json("metadata") if "metadata" in manifest.columns else F.lit(None).cast("variant")
    told = lambda key, kind: F.try_variant_get(c("_meta"), f"$.{key}", kind)
    rows = context.withColumn("_meta", meta).join(rolled, ["snapshot_date", "platform"])
    return rows.select(
        "snapshot_date", "platform", "status", "complete", "stopped_by", F.coalesce("error", F.lit("")).alias("error"), F.coalesce("failed_companies", none).alias("failed_companies"), "detail_failed",
        F.coalesce("detail_failed_job_ids", none).alias("detail_failed_job_ids"), told("pagination_mode", "string").alias("pagination_mode"), told("stable_snapshot_mechanism", "boolean").alias("stable_snapshot"),
        told("list_complete", "boolean").alias("list_complete"), told("list_error", "boolean").alias("list_error"), F.coalesce(told("completeness_reasons", "array<string>"), none).alias("completeness_reasons"),
        "presence_reliable", "content_reliable", "reason_codes",
    )


def daily_health(run: DataFrame, sources: DataFrame, limitations: DataFrame, run_date: str) -> tuple[DataFrame, DataFrame]:
    """Sources with their interpretation, and the day's one status row."""
    rows = ops.interpretation(sources, limitations, run_date)
    return rows, ops.daily_status(run, rows)


def health_document(run: DataFrame, manifest: DataFrame, jobs: DataFrame, limitations: DataFrame, run_date: str, max_failed: int = 0, max_rate: float = 0.0) -> tuple[DataFrame, DataFrame]:
    """The day's health from its own manifest and postings: sources with ``completeness, interpretation, governance_reasons``, and the status row.

    A few failed detail pages within the tolerance need nobody: NORMAL, though the source stays what it is.
    """
    c = F.col
    day = F.lit(run_date).cast("date")
    manifest, jobs = (df.where(c("snapshot_date") == day) for df in (manifest, jobs))
    context = health.context(manifest, jobs, manifest.select("snapshot_date", "job_count").dropDuplicates(["snapshot_date"]))
    resolved = health.resolve_jobs(jobs, health.resolve_scopes(context, jobs))
    tolerated = health.tolerated_gaps(context, resolved, max_failed, max_rate).select("platform", c("tolerated").alias("_gap"))
    rows = ops.interpretation(day_sources(manifest, jobs), limitations, run_date).join(tolerated, "platform", "left")
    gap = F.coalesce("_gap", F.lit(False)) & (c("stopped_by") == "detail_errors") & c("presence_reliable") & c("content_reliable") & (F.size("reason_codes") == 0)
    why = F.when(gap, "TOLERATED_DETAIL_GAP").when((c("interpretation") == "NEW_REGRESSION") & c("limitation_id").isNotNull(), "KNOWN_LIMITATION_REVIEW_DUE").when(c("interpretation") == "NEW_REGRESSION", "NO_ACTIVE_KNOWN_LIMITATION_MATCH")
    rows = rows.withColumns({"governance_reasons": F.array_compact(F.array(why)), "completeness": ops.completeness(c("status"), c("complete")), "limitation_id": F.when(~gap, c("limitation_id")), "interpretation": F.when(gap, "NORMAL").otherwise(c("interpretation"))}).drop("_gap")
    return rows, ops.daily_status(run, rows)


def weekly(snapshots: DataFrame, from_date: str, to_date: str) -> tuple[DataFrame, DataFrame]:
    """Exactly the two days asked for; a day without a snapshot is an error, not replaced by a neighbour."""
    at = lambda d: snapshots.where(F.col("snapshot_date") == F.lit(d).cast("date"))
    for d in (from_date, to_date):
        if not at(d).limit(1).count():
            raise ValueError(f"no snapshot of {d}")
    return at(from_date), at(to_date)


def resolve_day(spark: SparkSession, path: str, day: str) -> DataFrame:
    """One day's rows of a store partitioned by ``snapshot_date``: the scan reads that partition alone."""
    return spark.read.parquet(path).where(F.col("snapshot_date") == F.lit(day).cast("date"))


def scope_gaps(manifest: DataFrame, jobs: DataFrame) -> DataFrame:
    """Scopes that the manifest names and the day's postings don't show."""
    seen = jobs.select("snapshot_date", "platform", F.coalesce("company", F.lit("")).alias("company")).distinct()
    return health.scopes(manifest, jobs).where("company <> ''").join(seen, ["snapshot_date", "platform", "company"], "left_anti")
