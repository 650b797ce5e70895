"""Replay of a range of days with stored state: each day reads the state of the day before and its own rows alone.

Stores are folders. Postings and manifests are partitioned by ``snapshot_date``. The state has a folder
for each day folded so far, ``as_of=...``: a row an identity (first to last what ``lifecycle`` keeps of it, what a failed
detail page may inherit, and its last sighting with the label that holds since), the day's scopes, and the
chain of days it rests on. A state is used only if its chain is what the stores now hold up to its day, so a
day filled in late makes every state after it stale, and the replay starts again before it.

Results are tables partitioned by ``snapshot_date``: ``postings``, ``classified``, ``events``, ``scope_health``,
``metrics``, ``companies``, ``reliability``, ``flows``, ``diagnostics`` and ``snapshots``. Days before the range are folded
without results. A day is done when its state is: state is written last, under another name, and then
moved, so a run that broke off repeats its last day and replaces that day's rows.
"""

from __future__ import annotations

import datetime as dt
import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import content_sha256
from ..operators import classify, clean, health, lifecycle, trends
from . import trend
from .cut import cut, delete, drop, exists, move, partition_values, shared_folder
from .replay import Versions

c = F.col
KEYS = ["platform", "job_id"]
RESULTS = ("postings", "classified", "events", "scope_health", "metrics", "companies", "reliability", "flows", "diagnostics", "snapshots")
LEDGER = "snapshot_date date, outcome string, reason_codes array<string>, missing array<string>"


@dataclass(frozen=True)
class Stores:
    postings: str
    manifests: str
    state: str
    results: str

    def state_of(self, day: str) -> str:
        return f"{self.state}/as_of={day}"


def range_of(start: str, end: str) -> list[str]:
    first, last = dt.date.fromisoformat(start), dt.date.fromisoformat(end)
    if first > last:
        raise ValueError("from date must be <= to date")
    return [(first + dt.timedelta(n)).isoformat() for n in range((last - first).days + 1)]


def usable_state(spark: SparkSession, stores: Stores, days: list[str], before: str) -> str | None:
    """The newest state that rests on exactly the days which the stores hold up to it, of those before the day."""
    for day in reversed([d for d in partition_values(spark, stores.state, "as_of") if d < before]):
        chain = spark.read.parquet(f"{stores.state_of(day)}/chain").first().days
        if chain == [d for d in days if d <= day]:
            return day
    return None


def _day(spark: SparkSession, path: str, day: str) -> DataFrame:
    """One day's rows; the scan opens that partition alone."""
    rows = spark.read.option("basePath", path).parquet(f"{path}/snapshot_date={day}")
    return rows.withColumn("snapshot_date", F.lit(day).cast("date"))


def _single(scopes: DataFrame) -> DataFrame:
    """Scope health as ``lifecycle.advance`` takes it."""
    many = c("platform").isin(*health.MANY_COMPANIES)
    return scopes.select("platform", F.when(many, c("company")).alias("company"), "presence_reliable", "reason_codes")


def checked(jobs: DataFrame) -> DataFrame:
    """Equal rows once; identities that are blank, or whose rows differ, are an error."""
    once = jobs.dropDuplicates([k for k, t in jobs.dtypes if not t.startswith(("map", "variant"))])
    bad = lifecycle.index_conflicts(once).first()
    if bad is not None:
        raise ValueError(f"CLEAN_IDENTITY_CONFLICT: {bad.asDict()}")
    return once


def fold_day(spark: SparkSession, stores: Stores, day: str, last: str | None, chain: list[str], versions: Versions, confirmation_runs: int, wanted: bool) -> tuple[str, list[str]]:
    """Fold one day into the state of ``last``; its results are written if ``wanted``. Returns the ledger's outcome and codes."""
    jobs, manifest = checked(_day(spark, stores.postings, day)), _day(spark, stores.manifests, day)
    told = manifest.select("snapshot_date", "job_count", "cities").dropDuplicates(["snapshot_date"])
    cities = told.first().cities
    scopes = cut(health.resolve_scopes(health.context(manifest, jobs, told), jobs))
    postings = cut(health.resolve_jobs(clean.normalize_locations(jobs), scopes))
    labels = cut(classify.labelled(postings))
    read = lambda name: spark.read.parquet(f"{stores.state_of(last)}/{name}") if last else None
    old, before = read("identities"), read("scopes")
    kinds = {f.name: f.dataType for f in labels.schema.fields}
    held = old.where("anchor IS NOT NULL").select(*KEYS, c("anchor").alias("held")) if last else None
    rows = labels.join(held, KEYS, "left") if last else labels.withColumn("held", F.lit(None).cast(kinds["anchor"]))
    classified = cut(classify.carried(rows, versions.market, versions.fit, versions.skills))
    presence = postings.select(*KEYS, "company", "title", F.when(c("content_reliable"), content_sha256()).alias("sha"))
    state = old.drop("anchor", "sighting") if last else spark.createDataFrame([], lifecycle.STATE)
    moved = cut(lifecycle.advance(state, presence, _single(scopes), _single(before) if last else None, day, cities, before.first().cities if last else None, confirmation_runs))
    events = moved.select(F.inline("events"))
    sighting = _sightings(postings, classified)
    kept = moved.drop("events").join(labels.select(*KEYS, c("anchor").alias("_anchor")), KEYS, "left").join(sighting, KEYS, "left")
    if last:
        kept = kept.join(old.select(*KEYS, c("anchor").alias("_held"), c("sighting").alias("_sighting")), KEYS, "left")
        kept = kept.withColumns({"_anchor": F.coalesce("_anchor", "_held"), "sighting": F.coalesce("sighting", "_sighting")})
    identities = kept.select(*state.columns, c("_anchor").alias("anchor"), "sighting")
    reliable = scopes.where("presence_reliable").limit(1).count() > 0
    outcome, codes = ("warmed", []) if not wanted else ("written", [])
    if wanted and not reliable and not postings.limit(1).count():
        outcome, codes = "preserved", ["ALL_SOURCES_UNRELIABLE", "OUTPUT_PRESERVED"]
    if outcome == "written":
        _write(stores, day, postings, classified, events, scopes, manifest, versions, old)
    staged = f"{stores.state}/_staged-{day}"
    delete(spark, staged)
    identities.write.parquet(f"{staged}/identities")
    scopes.withColumn("cities", F.lit(cities).cast("array<string>") if cities is None else F.array(*[F.lit(x) for x in cities]).cast("array<string>")).write.parquet(f"{staged}/scopes")
    spark.createDataFrame([(chain,)], "days array<string>").coalesce(1).write.parquet(f"{staged}/chain")
    if exists(spark, stores.state_of(day)):  # one that a late day made stale
        delete(spark, stores.state_of(day))
    move(spark, staged, stores.state_of(day))
    drop(scopes, postings, labels, classified, moved)
    return outcome, codes


#: What the trend needs of a posting's last sighting and of the label it had then.
_SEEN = ("in_scope", "classification_status", "reason_codes", "career_pool", "company", "content_sha256", "versions")


def _sightings(postings: DataFrame, classified: DataFrame) -> DataFrame:
    label = classified.select(*KEYS, F.struct(*_SEEN).alias("_label"))
    both = postings.select("snapshot_date", *KEYS, "content_reliable").join(label, KEYS, "left")
    return both.select(*KEYS, F.struct("snapshot_date", "content_reliable", c("_label").alias("label")).alias("sighting"))


def _write(stores: Stores, day: str, postings: DataFrame, classified: DataFrame, events: DataFrame, scopes: DataFrame, manifest: DataFrame, versions: Versions, old: DataFrame | None) -> None:
    held = None
    if old is not None:
        at = old.select(c("sighting.snapshot_date").alias("snapshot_date"), *KEYS, c("sighting.content_reliable").alias("content_reliable"), c("sighting.label").alias("label"))
        held = at.drop("label"), at.where("label IS NOT NULL").select("snapshot_date", *KEYS, *[c(f"label.{k}").alias(k) for k in _SEEN])
    now = F.struct(F.lit(versions.market).alias("market"), F.lit(versions.fit).alias("fit"), F.lit(versions.skills).alias("skills"))
    found = trend.trend(postings, classified, events, scopes, manifest, now, held)
    counted = classified.where(c("in_scope") & trends.usable(c("classification_status"), c("reason_codes.market"), c("career_pool")))
    parts = {
        "postings": postings, "classified": classified, "events": events.withColumn("snapshot_date", c("event_date")), "scope_health": scopes,
        "metrics": found.metrics, "companies": found.companies, "reliability": found.reliability, "flows": found.flows.withColumn("snapshot_date", c("event_date")), "diagnostics": found.diagnostics, "snapshots": trends.inventory(counted),
    }
    for name, df in parts.items():
        df.drop("snapshot_date").write.mode("overwrite").parquet(f"{stores.results}/{name}/snapshot_date={day}")
    found.drop()


def replay_range(spark: SparkSession, stores: Stores, start: str, end: str, versions: Versions = Versions(), confirmation_runs: int = 2) -> DataFrame:
    """Replay ``start`` to ``end``; earlier days that the state lacks are folded first. Returns the ledger, a row a day looked at:
    ``outcome`` written, warmed, preserved (no posting and no reliable source) or incomplete (a day asked for lacks a part)."""
    wanted = range_of(start, end)
    for path in (stores.postings, stores.manifests):
        if stores.results.startswith(path) or stores.state.startswith(path):
            raise ValueError("OUTPUT_MUST_NOT_OVERLAP_SOURCE_DATA")
    held = {name: set(partition_values(spark, path, "snapshot_date")) for name, path in (("postings", stores.postings), ("manifests", stores.manifests))}
    days = sorted(d for d in held["postings"] & held["manifests"] if d <= end)
    last = usable_state(spark, stores, days, start)
    ledger = [(dt.date.fromisoformat(d), "incomplete", ["HISTORICAL_SOURCE_INCOMPLETE"], [n for n, has in held.items() if d not in has]) for d in wanted if d not in days]
    for day in [d for d in days if last is None or d > last]:
        outcome, codes = fold_day(spark, stores, day, last, [d for d in days if d <= day], versions, confirmation_runs, day >= start)
        ledger.append((dt.date.fromisoformat(day), outcome, codes, []))
        last = day
    return spark.createDataFrame(sorted(ledger), LEDGER)


def result(spark: SparkSession, stores: Stores, name: str) -> DataFrame:
    """A table of results, all days; a filter on ``snapshot_date`` opens those days alone."""
    return spark.read.parquet(f"{stores.results}/{name}").withColumn("snapshot_date", c("snapshot_date").cast("date"))


def compare_stored(spark: SparkSession, stores: Stores, before: str, after: str) -> dict[str, DataFrame]:
    """The comparison of two replayed days, from their stored results."""
    of = lambda name: result(spark, stores, name)
    return trend.compare(trend.Trend(*[of(n) for n in ("metrics", "companies", "reliability", "flows", "diagnostics")]), of("scope_health"), before, after)


def compare_with_previous(spark: SparkSession, stores: Stores, day: str) -> dict[str, DataFrame] | None:
    """The comparison with the last replayed day before; none for the first one."""
    earlier = [d for d in partition_values(spark, f"{stores.results}/metrics", "snapshot_date") if d < day]
    return compare_stored(spark, stores, earlier[-1], day) if earlier else None


#: How many days' states are kept before their events are written to a table of their own.
KEPT = 5


def lifecycle_days(presence: DataFrame, days: DataFrame, confirmation_runs: int = 2) -> DataFrame:
    """The events of ``lifecycle.lifecycle`` with the same input, a day at a time: each step reads the last one's state and its own day.

    They are tables of their own; the input is not read again.
    """
    spark = presence.sparkSession
    presence, days = presence.where("snapshot_date IS NOT NULL"), days.where("snapshot_date IS NOT NULL")
    dates = [(r.day, r.cities) for r in days.groupBy(c("snapshot_date").cast("string").alias("day")).agg(F.first("cities").alias("cities")).orderBy("day").collect()]  # a row a day
    if not dates:
        return cut(lifecycle.lifecycle(presence, days, confirmation_runs))  # without events; like them it reads nothing of its input later
    store = f"{shared_folder(spark)}/postlens/days-{uuid.uuid4().hex[:12]}"
    for name, df in (("presence", presence), ("scopes", days)):
        df.repartition("snapshot_date").write.partitionBy("snapshot_date").parquet(f"{store}/{name}")
    kinds = {"presence": presence.drop("snapshot_date").schema, "scopes": days.drop("snapshot_date").schema}
    of = lambda name, day: spark.read.schema(kinds[name]).parquet(f"{store}/{name}/snapshot_date={day}")
    none = spark.createDataFrame([], kinds["presence"])
    seen = set(partition_values(spark, f"{store}/presence", "snapshot_date"))
    state, before, last = spark.createDataFrame([], lifecycle.STATE).withColumn("last_seen", c("last_seen").cast("string")), None, None
    kept: list[DataFrame] = []
    spent: list[DataFrame] = []
    out: list[DataFrame] = []
    for day, cities in dates:
        scopes = of("scopes", day)
        moved = cut(lifecycle.advance(state, of("presence", day) if day in seen else none, scopes, before, day, cities, last, confirmation_runs, as_text=True))
        drop(*spent)
        kept, spent = [*kept, moved], []
        state, before, last = moved.drop("events"), scopes, cities
        if len(kept) == KEPT or day == dates[-1][0]:
            out.append(cut(_whole([df.select(F.inline("events")).withColumn("event_date", c("event_date").cast("date")) for df in kept])))
            drop(*kept[:-1])
            kept, spent = [], [moved]
    drop(*spent)
    delete(spark, store)
    return _whole(out)


def _whole(parts: list[DataFrame]) -> DataFrame:
    whole = parts[0]
    for df in parts[1:]:
        whole = whole.unionByName(df)
    return whole
