"""The lifecycle as a stream: days arrive as rows, and absence is told as each day closes.

Two kinds of rows come in one stream, as collectors write them: sightings (``platform, job_id, company, title, sha``)
and the day's scopes (``company, presence_reliable, cities, reason_codes``). Identities are dealt into buckets,
and every bucket of a platform gets its scopes. A bucket's open day closes when a row of a later day arrives, or, on the
last day, when nothing has come for a while (a timer). Then all its identities take one step:
REAPPEARED, UPDATED and new ones for those that were seen, MISSING and REMOVED for those that were not. A
row of a day that has closed is an error that names it: days must arrive in order, and a day filled in late
needs the replay of stored days (``plans.incremental``).
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from ..operators import fold

c = F.col
BUCKETS = 64
_HELD = "company string, title string, sha string, cities array<string>, streak int, missing boolean, removed boolean"
_SCOPE = "scope string, single boolean, reliable boolean, codes array<string>"


def feed(sightings: DataFrame, scopes: DataFrame, buckets: int = BUCKETS) -> DataFrame:
    """One stream of both; sightings by identity to a bucket, scopes to all buckets.

    sightings: ``snapshot_date, platform, job_id, company, title, sha``; scopes: ``snapshot_date, platform, company, presence_reliable, cities, reason_codes``.
    """
    text = lambda *names: [F.lit(None).cast("string").alias(n) for n in names]
    many = F.lit(None).cast("array<string>")
    seen = sightings.select("snapshot_date", "platform", F.pmod(F.xxhash64("job_id"), F.lit(buckets)).cast("int").alias("bucket"), "job_id", "company", "title", "sha", F.lit(None).cast("boolean").alias("presence_reliable"), many.alias("cities"), many.alias("reason_codes"))
    told = scopes.select("snapshot_date", "platform", F.explode(F.sequence(F.lit(0), F.lit(buckets - 1))).alias("bucket"), *text("job_id"), "company", *text("title", "sha"), F.coalesce("presence_reliable", F.lit(False)).alias("presence_reliable"), "cities", "reason_codes")
    return seen.unionByName(told)


class Lifecycle(StatefulProcessor):
    """State of a bucket: its identities, the open day's sightings and scopes, the closed day's scopes, and the two days themselves."""

    def __init__(self, runs: int, idle_ms: int):
        self.runs, self.idle_ms = runs, idle_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.days = handle.getValueState("days", "open date, open_cities array<string>, closed date, closed_cities array<string>")
        self.held = handle.getMapState("held", "job_id string", _HELD)
        self.seen = handle.getMapState("seen", "job_id string", "company string, title string, sha string")
        self.scopes = handle.getListState("scopes", _SCOPE)
        self.before = handle.getListState("before", _SCOPE)

    def _days(self) -> tuple:
        return tuple(self.days.get()) if self.days.exists() else (None, None, None, None)

    @staticmethod
    def _day(date: dt.date, cities, rows) -> fold.Day:
        rows = list(rows)
        scopes = {r[0]: (r[2], tuple(r[3]) if r[3] is not None else ("MANIFEST_SCOPE_MISSING",)) for r in rows}
        return fold.Day(date, None if cities is None else tuple(cities), scopes, any(r[1] for r in rows))

    def _close(self, platform: str) -> list[tuple]:
        open_, cities, closed, closed_cities = self._days()
        rows = list(self.scopes.get())
        day = self._day(open_, cities, rows)
        before = None if closed is None else self._day(closed, closed_cities, self.before.get())
        held = {k[0]: v for k, v in self.held.iterator()}
        seen = {k[0]: tuple(v) for k, v in self.seen.iterator()}
        out = []
        for job_id in sorted(held.keys() | seen.keys()):
            old = held.get(job_id)
            was = None if old is None else fold.Held(old[0], old[1], old[2], None if old[3] is None else tuple(old[3]), *old[4:])
            now, events = fold.step(was, seen.get(job_id), day, before, self.runs)
            out += [(e[0], platform, job_id, *e[1:]) for e in events]
            if now != was:
                self.held.updateValue((job_id,), (now.company, now.title, now.sha, None if now.cities is None else list(now.cities), now.streak, now.missing, now.removed))
        self.seen.clear()
        self.before.put([tuple(r) for r in rows]) if rows else self.before.clear()
        self.scopes.clear()
        self.days.update((None, None, open_, cities))
        return out

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        told = pd.concat(list(rows))
        told = told.astype(object).where(told.notna(), None).sort_values("snapshot_date", kind="stable")
        out: list[tuple] = []
        for date, mine in told.groupby("snapshot_date", sort=True):
            open_, cities, closed, closed_cities = self._days()
            if (closed is not None and date <= closed) or (open_ is not None and date < open_):
                raise ValueError(f"OBSERVATIONS_MUST_BE_STRICTLY_CHRONOLOGICAL: {key[0]} {date} after {closed if closed is not None and date <= closed else open_}")
            if open_ is not None and date > open_:
                out += self._close(key[0])
                open_, cities, closed, closed_cities = self._days()
            for r in mine.itertuples():
                if r.job_id is not None:
                    self.seen.updateValue((r.job_id,), (r.company, r.title, r.sha))
                else:
                    cities = None if r.cities is None else list(r.cities)
                    self.scopes.appendValue((r.company or "", r.company is None, bool(r.presence_reliable), None if r.reason_codes is None else list(r.reason_codes)))
            self.days.update((date, cities, closed, closed_cities))
        if self.idle_ms:
            for timer in list(self.handle.listTimers()):
                self.handle.deleteTimer(timer)
            self.handle.registerTimer(timerValues.getCurrentProcessingTimeInMs() + self.idle_ms)
        yield fold.events_frame(out)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        yield fold.events_frame(self._close(key[0]) if self._days()[0] is not None else [])

    def close(self) -> None:
        pass


def lifecycle_stream(rows: DataFrame, confirmation_runs: int = 2, idle: dt.timedelta | None = None) -> DataFrame:
    """Events of the days of ``rows`` (as ``feed`` makes them) as they close; idle: how long the last day waits (none: for the next day's rows).

    Needs the session's RocksDB state store, as all processors with several state variables do.
    """
    if confirmation_runs < 2:
        raise ValueError("removal needs at least two runs")
    processor = Lifecycle(confirmation_runs, 0 if idle is None else int(idle.total_seconds() * 1000))
    return rows.groupBy("platform", "bucket").transformWithStateInPandas(statefulProcessor=processor, outputStructType=fold.EVENT, outputMode="Append", timeMode="None" if idle is None else "ProcessingTime")
