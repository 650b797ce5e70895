"""Run health, incidents, notifications, provenance and coverage as tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

c = F.col
#: Windows that every task holds; more of them are merged with the postings.
MAX_WINDOWS = 100_000


def technical_health(run: DataFrame) -> Column:
    """SUCCESS if the runner ended well or degraded, with crawl likewise and clean and analysis well."""
    fine = c("status").isin("SUCCESS", "DEGRADED") & c("crawl").isin("SUCCESS", "DEGRADED") & (c("clean") == "SUCCESS") & (c("analysis") == "SUCCESS")
    return F.when(F.coalesce(fine, F.lit(False)), "SUCCESS").otherwise("FAILED")


def completeness(status: Column, complete: Column) -> Column:
    """COMPLETE, PARTIAL or UNKNOWN; any other pair is an error."""
    pair = F.when((status == "success") & complete, "COMPLETE").when((status == "partial") & ~complete, "PARTIAL").when((status == "error") & ~complete, "UNKNOWN")
    return pair.otherwise(F.raise_error(F.concat(F.lit("SOURCE_STATUS_COMPLETE_MISMATCH: "), F.coalesce(status, F.lit("null")), F.lit("/"), F.coalesce(complete.cast("string"), F.lit("null")))).cast("string"))


def interpretation(sources: DataFrame, limitations: DataFrame, run_date: str) -> DataFrame:
    """Adds ``interpretation`` and ``limitation_id``: a source that is whole is NORMAL, one whose faults an active
    known limitation explains is KNOWN_LIMITATION until its review is due, any other a NEW_REGRESSION.

    sources: ``platform, status, complete, stopped_by, error, failed_companies, detail_failed, detail_failed_job_ids,
    pagination_mode, stable_snapshot, list_complete, list_error, completeness_reasons, presence_reliable,
    content_reliable, reason_codes``; limitations: ``id, platform, status, allowed_reasons, review_after``.
    """
    explained = F.array(*[F.lit(x) for x in ("LIST_INCOMPLETE", "SOURCE_INCOMPLETE", "UNVERIFIED_STOP_REASON", "LIST_RECORDS_INCOMPLETE")])
    s, k = sources.alias("s"), limitations.where(c("status") == "active").alias("k")
    reasons, allowed = c("s.completeness_reasons"), c("k.allowed_reasons")
    matches = (
        (c("s.platform") == c("k.platform")) & (c("s.status") == "partial") & ~c("s.complete") & (c("s.error") == "") & F.array_contains(allowed, c("s.stopped_by"))
        & (F.size("s.failed_companies") == 0) & (c("s.detail_failed") == 0) & (F.size("s.detail_failed_job_ids") == 0)
        & (c("s.pagination_mode") == "offset_dynamic") & ~c("s.stable_snapshot") & ~c("s.list_complete") & ~c("s.list_error")
        & (F.size(reasons) > 0) & (F.size(F.array_distinct(reasons)) == F.size(reasons)) & (F.size(F.array_except(reasons, allowed)) == 0) & F.array_contains(reasons, c("s.stopped_by"))
        & c("s.content_reliable") & (F.size(F.array_except("s.reason_codes", explained)) == 0)
        & (~F.array_contains("s.reason_codes", F.lit("LIST_RECORDS_INCOMPLETE")) | F.array_contains(reasons, F.lit("unique_deficit")))
    )
    found = s.join(k, matches, "left").groupBy(*[c(f"s.{x}").alias(x) for x in sources.columns]).agg(F.min(c("k.id")).alias("limitation_id"), F.count(c("k.id")).alias("_n"), F.min(c("k.review_after")).alias("_due"))
    whole = (c("status") == "success") & c("complete") & c("presence_reliable") & c("content_reliable")
    meaning = F.when(c("_n") > 1, F.raise_error(F.concat(F.lit("DUPLICATE_LIMITATION_MATCH: "), c("platform"))).cast("string")).when((c("_n") == 1) & (F.lit(run_date) >= c("_due")), "NEW_REGRESSION").when(c("_n") == 1, "KNOWN_LIMITATION").when(whole, "NORMAL").otherwise("NEW_REGRESSION")
    return found.withColumn("interpretation", meaning).drop("_n", "_due")


def daily_status(run: DataFrame, interpreted: DataFrame) -> DataFrame:
    """``technical, needs_action, ops_status`` and how many sources are of each kind."""
    kinds = interpreted.agg(*[F.count_if(c("interpretation") == k).alias(k.lower()) for k in ("NORMAL", "KNOWN_LIMITATION", "NEW_REGRESSION")])
    both = run.select(technical_health(run).alias("technical")).limit(1).join(F.broadcast(kinds))
    action = (c("technical") == "FAILED") | (c("new_regression") > 0)
    return both.withColumns({"needs_action": action, "ops_status": F.when(c("technical") == "FAILED", "FAILED").when(action, "ACTION_REQUIRED").when(c("known_limitation") > 0, "OK_WITH_LIMITATIONS").otherwise("OK")})


def outcome(technical: Column, ops_status: Column) -> Column:
    return F.when(technical == "FAILED", "failed").when(ops_status == "ACTION_REQUIRED", "check").otherwise("fine")


def latest(rows: DataFrame, by: str, n: int) -> DataFrame:
    """The n newest rows."""
    return rows.orderBy(F.desc(by)).limit(n)


def upsert(table: DataFrame, new: DataFrame, keys: list[str]) -> DataFrame:
    """The table with new rows in place of those of the same keys."""
    return table.join(new.select(*keys).distinct(), keys, "left_anti").unionByName(new, allowMissingColumns=True)


def queue(table: DataFrame, new: DataFrame, keys: tuple[str, ...] = ("run_date", "kind")) -> DataFrame:
    """Insert or ignore; older waiting rows of a kind are superseded by a newer date."""
    fresh = new.join(table.select(*keys), list(keys), "left_anti").withColumns({"state": F.lit("pending"), "attempts": F.lit(0)})
    both = table.unionByName(fresh, allowMissingColumns=True)
    newest = both.groupBy("kind").agg(F.max("run_date").alias("_newest"))
    old = (c("state") == "pending") & (c("run_date") < c("_newest"))
    return both.join(newest, "kind").withColumn("state", F.when(old, "superseded").otherwise(c("state"))).drop("_newest")


def due(table: DataFrame, now: Column, retries: int = 3, limit: int = 3) -> DataFrame:
    """What to send next: waiting, with tries left, oldest first, a few a run."""
    return table.where((c("state") == "pending") & (c("attempts") < retries) & (F.coalesce("next_attempt_at", now) <= now)).orderBy("run_date", "kind").limit(limit)


def recovery_candidates(runs: DataFrame, incidents: DataFrame, current: str) -> DataFrame:
    """Earlier runs with an open incident."""
    open_ = incidents.where(c("status") == "open").select("run_date").distinct()
    return runs.where(c("run_date") < current).join(open_, "run_date", "left_semi")


def digest(columns: list[str]) -> Column:
    """SHA-256 of a row's canonical JSON: keys in order, nulls kept."""
    return F.sha2(F.to_json(F.struct(*sorted(columns)), {"ignoreNullFields": "false"}), 256)


def outside_windows(jobs: DataFrame, windows: DataFrame) -> DataFrame:
    """Postings scraped outside their platform's collection (``platform, started_at, finished_at``).

    Up to ``MAX_WINDOWS`` windows, counted, go to the postings, which then need no shuffle by platform: a platform can have most of them.
    """
    few = windows.limit(MAX_WINDOWS + 1).count() <= MAX_WINDOWS
    w = (F.broadcast(windows) if few else windows).alias("w")
    inside = (c("j.platform") == c("w.platform")) & (c("j.scraped_at") >= c("w.started_at")) & (c("j.scraped_at") <= c("w.finished_at"))
    return jobs.alias("j").join(w, inside, "left_anti")


def nested_windows(platforms: DataFrame, run_start: Column, run_end: Column, days: int = 2) -> DataFrame:
    """Platform windows that leave the run's, run backwards, or last longer than ``days``."""
    bad = (c("started_at") < run_start) | (c("finished_at") > run_end) | (c("finished_at") < c("started_at")) | (c("finished_at") - c("started_at") > F.make_dt_interval(F.lit(days)))
    return platforms.where(F.coalesce(bad, F.lit(True)))


def multiset_difference(left: DataFrame, right: DataFrame) -> DataFrame:
    """``side`` and the rows one side has more often; empty if both are the same multiset."""
    return left.exceptAll(right).withColumn("side", F.lit("left")).unionByName(right.exceptAll(left).withColumn("side", F.lit("right")))


def provenance_problems(manifest: DataFrame, raw: DataFrame, clean: DataFrame, classified: DataFrame, run_start: Column, run_end: Column, invocation: Column) -> DataFrame:
    """``gate, platform, code, n`` of what keeps a day's raw, clean and analysed rows from being one run's; empty if all gates pass.

    raw: the manifest's own id, its counts by platform, and its windows, which hold all scraping times; clean: the same
    identities, as often as raw has them; analysis: no identity that clean lacks, and none twice. manifest: ``platform,
    jobs_in_scope, invocation_id, started_at, finished_at``; raw and clean: ``platform, job_id`` (raw: ``scraped_at``).
    """
    out = lambda df, gate, code, n=F.lit(1): df.groupBy("platform").agg(F.sum(n).cast("long").alias("n")).select(F.lit(gate).alias("gate"), "platform", F.lit(code).alias("code"), "n")
    counted = raw.groupBy("platform").agg(F.count("*").alias("_rows")).join(manifest.select("platform", "jobs_in_scope"), "platform", "full_outer")
    differ = counted.where(F.coalesce("_rows", F.lit(0)) != F.coalesce("jobs_in_scope", F.lit(0)))
    keys = ["platform", "job_id"]
    moved = multiset_difference(raw.select(*keys), clean.select(*keys))
    return (
        out(manifest.where(~c("invocation_id").eqNullSafe(invocation)), "raw", "INVOCATION_MISMATCH")
        .unionByName(out(differ, "raw", "COUNT_MISMATCH"))
        .unionByName(out(nested_windows(manifest, run_start, run_end), "raw", "WINDOW_INVALID"))
        .unionByName(out(outside_windows(raw, manifest.select("platform", "started_at", "finished_at")), "raw", "SCRAPED_OUTSIDE_WINDOW"))
        .unionByName(out(moved, "clean", "IDENTITIES_DIFFER"))
        .unionByName(out(classified.join(clean.select(*keys).distinct(), keys, "left_anti"), "analysis", "IDENTITY_UNKNOWN"))
        .unionByName(out(classified.groupBy(*keys).agg(F.count("*").alias("_n")).where("_n > 1"), "analysis", "IDENTITY_REPEATED"))
    )


def coverage(artifacts: DataFrame) -> DataFrame:
    """``date`` and for each artifact (rows ``artifact, date``) whether it is there."""
    return artifacts.groupBy("date").pivot("artifact").agg(F.count(F.lit(1)) > 0).na.fill(False)


def observation_gaps(dates: DataFrame, date: str = "date", keys: tuple[str, ...] = ()) -> DataFrame:
    """``after, before, missing_days`` where dates are more than a day apart, with ``keys`` for each of their values."""
    order = Window.partitionBy(*keys).orderBy(date) if keys else Window.orderBy(date)  # a row a date
    rows = dates.select(*keys, c(date)).distinct().withColumn("after", F.lag(date).over(order))
    return rows.withColumn("missing_days", F.datediff(date, "after") - 1).where("missing_days > 0").select(*keys, "after", c(date).alias("before"), "missing_days")


def registry_problems(limitations: DataFrame) -> DataFrame:
    """``id, problem`` of entries that break the registry's schema."""
    again = Window.partitionBy("id")
    rows = limitations.withColumn("_n", F.count("*").over(again))
    problem = F.when(c("id").isNull() | (c("id") == ""), "MISSING_ID").when(c("_n") > 1, "DUPLICATE_ID").when(~F.coalesce(c("status").isin("active", "retired"), F.lit(False)), "INVALID_STATUS").when(F.coalesce(F.size("allowed_reasons"), F.lit(0)) <= 0, "MISSING_REASONS").when(F.try_to_timestamp(c("review_after").cast("string")).isNull(), "INVALID_REVIEW_DATE")
    return rows.withColumn("problem", problem).where("problem IS NOT NULL").select("id", "problem")
