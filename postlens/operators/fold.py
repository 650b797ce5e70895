"""The lifecycle of one identity, a day at a time: what streams keep as state, and what validators compute a second time.

``lifecycle.lifecycle`` and ``lifecycle.advance`` say the same as windows and joins; nothing here is shared with them.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass, field, replace

import pandas as pd

EVENT = "event_date date, platform string, job_id string, company string, title string, event_type string, event_status string, previous_sha256 string, current_sha256 string, reason_codes array<string>"


@dataclass
class Day:
    """What is known of a platform's day: its scopes' health by company ('': the platform's one scope)."""

    date: dt.date
    cities: tuple[str, ...] | None
    scopes: dict[str, tuple[bool, tuple[str, ...]]] = field(default_factory=dict)
    single: bool = False

    def scope(self, company: str | None) -> tuple[bool, tuple[str, ...]]:
        return self.scopes.get("" if self.single else company or "", (False, ("MANIFEST_SCOPE_MISSING",)))


@dataclass(frozen=True)
class Held:
    """An identity between days."""

    company: str | None
    title: str | None
    sha: str | None
    cities: tuple[str, ...] | None
    streak: int = 0
    missing: bool = False
    removed: bool = False


def step(old: Held | None, seen: tuple[str | None, str | None, str | None] | None, day: Day, before: Day | None, runs: int) -> tuple[Held | None, list[tuple]]:
    """The identity after the day, and the day's events without its key. seen: ``company, title, sha``, null if it was absent."""
    changed = before is not None and None not in (before.cities, day.cities) and before.cities != day.cities
    if seen is None:
        if old is None or old.removed:
            return old, []
        reliable, codes = day.scope(old.company)
        moved = changed or old.cities != day.cities
        counts = reliable and not moved
        streak = old.streak + counts
        removed = counts and streak >= runs
        why = ["RELIABLE_ABSENCE"] if counts else ["SOURCE_UNRELIABLE", *codes, *(["SOURCE_SCOPE_CHANGED"] if moved else [])]
        return replace(old, streak=streak, missing=True, removed=removed), [(day.date, old.company, old.title, "REMOVED" if removed else "MISSING", _sure(removed), old.sha, None, why)]
    company, title, sha = seen
    now = Held(company if company is not None or old is None else old.company, title if title is not None or old is None else old.title, sha if sha is not None or old is None else old.sha, day.cities)
    reliable = day.scope(now.company)[0]
    if old is None:
        new = reliable and not changed and before is not None and before.scope(now.company)[0]
        return now, [(day.date, now.company, now.title, "NEW" if new else "FIRST_SEEN", _sure(new), None, sha, ["RELIABLE_ABSENCE_TO_PRESENCE" if new else "NO_COMPARABLE_PRIOR_ABSENCE"])]
    told = (old.company if old.company is not None else now.company, old.title if old.title is not None else now.title)
    out = []
    if old.missing:
        out.append((day.date, *told, "REAPPEARED", _sure(reliable and not changed), old.sha, sha, ["PREVIOUSLY_MISSING"]))
    if None not in (sha, old.sha) and sha != old.sha:
        out.append((day.date, *told, "UPDATED", "confirmed", old.sha, sha, ["RELIABLE_CONTENT_CHANGED"]))
    return now, out


def _sure(x: bool) -> str:
    return "confirmed" if x else "provisional"


def days_of(rows: pd.DataFrame) -> list[Day]:
    """Scope rows of one platform (``snapshot_date, company, presence_reliable, cities, reason_codes``) as days, in order."""
    found: dict[dt.date, Day] = {}
    for r in rows.itertuples():
        day = found.setdefault(r.snapshot_date, Day(r.snapshot_date, None if r.cities is None else tuple(r.cities)))
        if r.presence_reliable is not None or r.reason_codes is not None:
            day.single |= r.company is None
            codes = ("MANIFEST_SCOPE_MISSING",) if r.reason_codes is None else tuple(r.reason_codes)
            day.scopes[r.company or ""] = (bool(r.presence_reliable), codes)
    single = any(d.single for d in found.values())
    for d in found.values():
        d.single = single
    return [found[k] for k in sorted(found)]


def events_frame(rows: list[tuple]) -> pd.DataFrame:
    return pd.DataFrame(rows, columns=[x.split()[0] for x in EVENT.split(", ")])
