"""First seen, new, updated, missing, removed, reappeared: a state machine in joins and windows.

Windows run over sightings alone. An absence, the days between a sighting and the
next one, ends with the day that confirms removal, which two small tables tell:
how many days of a scope have counted towards removal up to a day, and which day
is the k-th. So the work follows sightings and events, not identities times days.
Absence counts towards removal only on days whose scope is reliable and whose
cities are those of the last sighting; other absence neither advances nor resets
the count.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

c = F.col
KEYS = ("platform", "job_id")


def index_conflicts(jobs: DataFrame) -> DataFrame:
    """Identities that are blank or have rows that differ; equal rows count once."""
    blank = F.col("platform").isNull() | (F.col("platform") == "") | F.col("job_id").isNull() | (F.col("job_id") == "")
    keys = ["snapshot_date", *KEYS] if "snapshot_date" in jobs.columns else [*KEYS]
    once = jobs.dropDuplicates()
    return once.groupBy(*keys).agg(F.count("*").alias("versions")).where((F.col("versions") > 1) | blank)


def _scopes(days: DataFrame, dates: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Each day of each scope (``platform, scope, n, reliable, reason_codes``), and platforms of one scope (``platform``).

    A platform's one scope is '', whatever companies its postings have.
    """
    single = days.where("company IS NULL").select("platform").distinct()
    rows = days.select("snapshot_date", "platform", F.coalesce("company", F.lit("")).alias("scope"), F.coalesce("presence_reliable", F.lit(False)).alias("reliable"), "reason_codes")
    return rows.join(dates.select("snapshot_date", "n"), "snapshot_date").drop("snapshot_date"), single


def lifecycle(presence: DataFrame, days: DataFrame, confirmation_runs: int = 2) -> DataFrame:
    """Events of all identities over all observation days.

    presence: ``snapshot_date, platform, job_id, company, title, sha`` (null: content not reliable).
    days: a row for each date and scope: ``snapshot_date, platform, company``
    (null: the platform's one scope), ``presence_reliable, cities, reason_codes``;
    a date's ``cities`` are the same in all its rows. Sightings on other dates do not count.
    """
    if confirmation_runs < 2:
        raise ValueError("removal needs at least two runs")
    order = Window.orderBy("snapshot_date")  # a row a date
    dates = days.groupBy("snapshot_date").agg(F.first("cities").alias("cities")).withColumns({"n": F.row_number().over(order), "before": F.lag("cities").over(order)})
    dates = dates.withColumn("changed", F.coalesce(c("cities") != c("before"), F.lit(False))).drop("before")
    scoped, single = _scopes(days, dates)
    # days that count towards removal, by scope and cities, in their order
    by_n = Window.partitionBy("platform", "scope", "cities").orderBy("n")
    counting = scoped.where("reliable").join(dates.where("NOT changed").select("n", "cities"), "n").select("platform", "scope", "cities", "n").distinct().withColumn("k", F.row_number().over(by_n))
    # and how many there were up to each day that some posting may have been last seen on
    end = dates.agg(F.max("n").alias("end"))  # one row
    seen_on = scoped.select("platform", "scope").distinct().crossJoin(F.broadcast(end)).withColumn("n", F.explode(F.sequence(F.lit(1), "end"))).drop("end").join(dates.select("n", "cities"), "n")
    upto = seen_on.join(counting, ["platform", "scope", "cities", "n"], "left").withColumn("base", F.count("k").over(by_n)).select("platform", "scope", c("n").alias("at"), "base")

    mine = Window.partitionBy(*KEYS).orderBy("n")
    earlier = mine.rowsBetween(Window.unboundedPreceding, -1)
    last = lambda col, w: F.last(col, ignorenulls=True).over(w)
    rows = presence.join(F.broadcast(dates), "snapshot_date").withColumns(
        {"who": last("company", mine), "named": last("title", mine), "old_who": last("company", earlier), "old_title": last("title", earlier), "prev_sha": last("sha", earlier), "last_sha": last("sha", mine), "was_at": F.lag("n").over(mine), "next": F.lead("n").over(mine)}
    )
    of_one = single.withColumn("one", F.lit(True))
    rows = rows.join(of_one, "platform", "left").withColumn("scope", F.when(c("one"), "").otherwise(F.coalesce("who", F.lit("")))).drop("one")
    none, code = F.lit(None).cast("string"), lambda *x: F.array(*[F.lit(y) for y in x])
    event = lambda when, kind, sure, old, new, why: F.when(when, F.struct(kind.alias("event_type"), F.when(sure, "confirmed").otherwise("provisional").alias("event_status"), old.alias("previous_sha256"), new.alias("current_sha256"), why.alias("reason_codes")))

    # days on which a posting is there
    was = scoped.select("platform", "scope", (c("n") + 1).alias("n"), c("reliable").alias("was_reliable"))
    there = rows.join(scoped.drop("reason_codes"), ["platform", "scope", "n"], "left").join(was, ["platform", "scope", "n"], "left")
    reliable, first = F.coalesce("reliable", F.lit(False)), c("was_at").isNull()
    new = F.coalesce("was_reliable", F.lit(False)) & ~c("changed") & reliable
    shown = F.array(
        event(first, F.when(new, "NEW").otherwise("FIRST_SEEN"), new, none, c("sha"), F.when(new, code("RELIABLE_ABSENCE_TO_PRESENCE")).otherwise(code("NO_COMPARABLE_PRIOR_ABSENCE"))),
        event(c("was_at") < c("n") - 1, F.lit("REAPPEARED"), reliable & ~c("changed"), c("prev_sha"), c("sha"), code("PREVIOUSLY_MISSING")),
        event(~first & F.coalesce(c("sha") != c("prev_sha"), F.lit(False)), F.lit("UPDATED"), F.lit(True), c("prev_sha"), c("sha"), code("RELIABLE_CONTENT_CHANGED")),
    )
    # a reappearing posting is told under the company and title it was last seen with
    out = [c("snapshot_date").alias("event_date"), *KEYS, "company", "title", "event.*"]
    told = there.select("snapshot_date", *KEYS, F.coalesce("old_who", "who").alias("company"), F.coalesce("old_title", "named").alias("title"), F.explode(F.array_compact(shown)).alias("event"))

    # days on which it is not, up to the next sighting or to the one that confirms its removal
    gone = rows.where(c("next").isNull() | (c("next") > c("n") + 1)).select(*KEYS, "scope", "cities", "who", "named", "last_sha", c("n").alias("at"), "next")
    gone = gone.join(upto, ["platform", "scope", "at"], "left").withColumn("kth", F.coalesce("base", F.lit(0)) + confirmation_runs)
    removal = counting.select("platform", "scope", "cities", c("k").alias("kth"), c("n").alias("removed"))
    gone = gone.join(removal, ["platform", "scope", "cities", "kth"], "left").crossJoin(F.broadcast(end))
    until = F.least(F.coalesce("removed", "end"), F.coalesce(c("next") - 1, c("end")))
    absent = gone.where(until > c("at")).withColumn("n", F.explode(F.sequence(c("at") + 1, until)))
    absent = absent.join(scoped, ["platform", "scope", "n"], "left").join(F.broadcast(dates.select("n", "snapshot_date", c("cities").alias("now"), "changed")), "n")
    moved = c("changed") | ~c("cities").eqNullSafe(c("now"))
    counts, sure = F.coalesce("reliable", F.lit(False)) & ~moved, F.coalesce(c("n") == c("removed"), F.lit(False))
    unsure = F.concat(code("SOURCE_UNRELIABLE"), F.coalesce("reason_codes", code("MANIFEST_SCOPE_MISSING")), F.when(moved, code("SOURCE_SCOPE_CHANGED")).otherwise(F.array().cast("array<string>")))
    missing = event(F.lit(True), F.when(sure, "REMOVED").otherwise("MISSING"), sure, c("last_sha"), none, F.when(counts, code("RELIABLE_ABSENCE")).otherwise(unsure))
    lost = absent.select("snapshot_date", *KEYS, c("who").alias("company"), c("named").alias("title"), missing.alias("event"))
    return told.select(*out).unionByName(lost.select(*out))


#: What is kept of an identity between days. missing: absent on the last day; streak: how many of its absent days counted towards removal.
STATE = "platform string, job_id string, company string, title string, sha string, cities array<string>, streak int, missing boolean, removed boolean, last_seen date"


def advance(state: DataFrame, presence: DataFrame, scopes: DataFrame, before: DataFrame | None, day: str, cities: list[str] | None, cities_before: list[str] | None = None, confirmation_runs: int = 2, as_text: bool = False) -> DataFrame:
    """One more day: every identity's new state (``STATE``) with ``events``, what the day adds to ``lifecycle``'s rows (null: nothing).

    state: that of the last observation day; presence: the day's ``platform, job_id, company, title, sha``; scopes and
    before: the day's and the last day's ``platform, company`` (null: the platform's one scope), ``presence_reliable,
    reason_codes`` (before: null on the first day), a row each. One join by identity: the work follows identities, whatever the days so far.
    as_text: ``last_seen`` (the state's too) and ``event_date`` are text; a date would stand as a number in the code that Spark
    generates and compiles, and each day would have code of its own.
    """
    if confirmation_runs < 2:
        raise ValueError("removal needs at least two runs")
    text = lambda *x: F.array(*[F.lit(v) for v in x]).cast("array<string>")
    today = F.lit(day) if as_text else F.lit(day).cast("date")
    here = F.lit(cities).cast("array<string>") if cities is None else text(*cities)
    changed = F.lit(cities_before is not None and cities is not None and cities != cities_before)
    old, new = (df.select(*KEYS, F.struct(*[k for k in df.columns if k not in KEYS]).alias(name)) for df, name in ((state, "old"), (presence.select(*KEYS, "company", "title", "sha"), "new")))
    rows = old.join(new, [*KEYS], "full_outer")
    present, known = c("new").isNotNull(), c("old").isNotNull()
    rows = rows.withColumns({"who": F.coalesce("new.company", "old.company"), "named": F.coalesce("new.title", "old.title")})
    single = scopes.where("company IS NULL").select("platform", F.lit(True).alias("one"))
    rows = rows.join(single, "platform", "left").withColumn("scope", F.when(c("one"), "").otherwise(F.coalesce("who", F.lit(""))))
    told = scopes.select("platform", F.coalesce("company", F.lit("")).alias("scope"), c("presence_reliable").alias("reliable"), c("reason_codes").alias("codes"))
    rows = rows.join(told, ["platform", "scope"], "left")
    if before is None:
        rows = rows.withColumn("was_reliable", F.lit(False))
    else:
        rows = rows.join(before.select("platform", F.coalesce("company", F.lit("")).alias("scope"), c("presence_reliable").alias("was_reliable")), ["platform", "scope"], "left")
    # each layer's columns are computed once; no array_compact, for which Spark would not compile the events
    reliable = F.coalesce("reliable", F.lit(False))
    rows = rows.withColumns(
        {"fresh": F.coalesce("was_reliable", F.lit(False)) & ~changed & reliable, "first": present & ~known, "back": present & known & c("old.missing"), "updated": present & known & F.coalesce(c("new.sha") != c("old.sha"), F.lit(False)),
         "gone": ~present & ~F.coalesce("old.removed", F.lit(False)), "moved": changed | ~c("old.cities").eqNullSafe(here)}
    )
    rows = rows.withColumns({"counts": c("gone") & reliable & ~c("moved"), "shown": c("first") | c("back") | c("gone")})
    streak = F.when(present, 0).otherwise(c("old.streak") + F.when(c("counts"), 1).otherwise(0)).cast("int")
    lost = c("counts") & (c("old.streak") + 1 >= confirmation_runs)
    unsure = F.concat(text("SOURCE_UNRELIABLE"), F.coalesce("codes", text("MANIFEST_SCOPE_MISSING")), F.when(c("moved"), text("SOURCE_SCOPE_CHANGED")).otherwise(text()))
    by = lambda first, back, gone: F.when(c("first"), first).when(c("back"), back).otherwise(gone)
    event = lambda kind, sure, company, title, previous, current, why: F.struct(today.alias("event_date"), *KEYS, company.alias("company"), title.alias("title"), kind.alias("event_type"), F.when(sure, "confirmed").otherwise("provisional").alias("event_status"), previous.alias("previous_sha256"), current.alias("current_sha256"), why.alias("reason_codes"))
    then_who, then_named = F.coalesce("old.company", "who"), F.coalesce("old.title", "named")
    kind = by(F.when(c("fresh"), "NEW").otherwise("FIRST_SEEN"), F.lit("REAPPEARED"), F.when(lost, "REMOVED").otherwise("MISSING"))
    why = by(F.when(c("fresh"), text("RELIABLE_ABSENCE_TO_PRESENCE")).otherwise(text("NO_COMPARABLE_PRIOR_ABSENCE")), text("PREVIOUSLY_MISSING"), F.when(c("counts"), text("RELIABLE_ABSENCE")).otherwise(unsure))
    shown = event(kind, by(c("fresh"), reliable & ~changed, lost), F.when(c("back"), then_who).otherwise(c("who")), F.when(c("back"), then_named).otherwise(c("named")), c("old.sha"), c("new.sha"), why)
    update = event(F.lit("UPDATED"), F.lit(True), then_who, then_named, c("old.sha"), c("new.sha"), text("RELIABLE_CONTENT_CHANGED"))
    rows = rows.withColumns({"_shown": F.when(c("shown"), shown), "_update": F.when(c("updated"), update)})
    events = F.when(c("shown") & c("updated"), F.array("_shown", "_update")).when(c("shown"), F.array("_shown")).when(c("updated"), F.array("_update"))
    return rows.select(
        *KEYS, c("who").alias("company"), c("named").alias("title"), F.coalesce("new.sha", "old.sha").alias("sha"), F.when(present, here).otherwise(c("old.cities")).alias("cities"), streak.alias("streak"),
        (~present).alias("missing"), F.when(present, False).otherwise(c("old.removed") | lost).alias("removed"), F.when(present, today).otherwise(c("old.last_seen")).alias("last_seen"), events.alias("events"),
    )


def daily_counts(events: DataFrame) -> DataFrame:
    return events.groupBy("event_date", "event_type", "event_status").agg(F.count("*").alias("n"))
