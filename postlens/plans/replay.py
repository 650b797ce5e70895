"""The whole analysis over stored days, as one set of DataFrames.

What several steps read is computed once, in the checkpoint folder. Days are a column, not a loop: health, labels, events and
snapshots of all days come out of one plan each.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import content_sha256
from ..operators import classify, clean, health, lifecycle, trends
from . import trend
from .cut import cut, drop


@dataclass(frozen=True)
class Versions:
    market: str = "market_v1"
    fit: str = "fit_v1"
    skills: str = "skills_v1"


@dataclass
class Replay:
    postings: DataFrame
    scope_health: DataFrame
    classified: DataFrame
    events: DataFrame
    snapshots: DataFrame
    trend: trend.Trend

    def drop(self) -> None:
        """Delete the working tables; nothing of this can be read after."""
        drop(self.postings, self.scope_health, self.classified, self.events)
        self.trend.drop()


def lifecycle_input(postings: DataFrame, scopes: DataFrame, day: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Presence and days as ``lifecycle`` takes them; day: ``snapshot_date, cities``."""
    presence = postings.select("snapshot_date", "platform", "job_id", "company", "title", F.when(F.col("content_reliable"), content_sha256()).alias("sha"))
    company = F.when(F.col("platform").isin(*health.MANY_COMPANIES), F.col("company")).alias("company")
    return presence, scopes.join(day.select("snapshot_date", "cities"), "snapshot_date").select("snapshot_date", "platform", company, "presence_reliable", "cities", "reason_codes")


def replay(jobs: DataFrame, manifests: DataFrame, versions: Versions = Versions(), confirmation_runs: int = 2) -> Replay:
    """jobs: postings with ``snapshot_date``; manifests: a row a platform and day with ``job_count`` and ``cities``."""
    day = manifests.select("snapshot_date", "job_count", "cities").dropDuplicates(["snapshot_date"])
    context = health.context(manifests, jobs, day)
    scopes = health.resolve_scopes(context, jobs)
    postings = health.resolve_jobs(clean.normalize_locations(jobs), scopes)
    postings, scopes = cut(postings), cut(scopes)  # read by labels, events and trends
    classified = cut(classify.classify_snapshots(postings, versions.market, versions.fit, versions.skills))  # by snapshots and reports
    presence, days = lifecycle_input(postings, scopes, day)
    events = cut(lifecycle.lifecycle(presence, days, confirmation_runs))
    counted = classified.where(F.col("in_scope") & trends.usable(F.col("classification_status"), F.col("reason_codes.market"), F.col("career_pool")))
    now = F.struct(F.lit(versions.market).alias("market"), F.lit(versions.fit).alias("fit"), F.lit(versions.skills).alias("skills"))
    return Replay(postings, scopes, classified, events, trends.inventory(counted), trend.trend(postings, classified, events, scopes, manifests, now))


def compare_snapshots(found: Replay, before: str, after: str) -> dict[str, DataFrame]:
    """The whole comparison of two days: platforms and reasons, inventory, flows and companies."""
    return trend.compare(found.trend, found.scope_health, before, after)


def compare_days(found: Replay, before: str, after: str) -> DataFrame:
    """The change between two days over the platforms that both observe reliably."""
    at = lambda d: found.snapshots.where(F.col("snapshot_date") == F.lit(d).cast("date")).drop("snapshot_date")
    side = lambda d: health.roll_up(found.scope_health).where(F.col("snapshot_date") == F.lit(d).cast("date")).select(F.lit("inventory").alias("family"), "platform", F.col("presence_reliable").alias("reliable"), "reason_codes", F.col("scopes").cast("string").alias("scope"), F.lit("").alias("versions"))
    platforms = trends.comparability(side(before), side(after)).where("comparable").select("platform")
    return trends.compare(at(before), at(after), platforms)
