"""Observations as a stream: late rows are bounded by a watermark, windows close behind it."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout


def sightings(events: DataFrame, time: str, keys: list[str], late: str = "2 days", every: str = "1 day") -> DataFrame:
    """Rows by key and window; a window is final once the watermark passed it."""
    return events.withWatermark(time, late).groupBy(F.window(time, every).alias("window"), *keys).agg(F.count("*").alias("n"))


def sessions(events: DataFrame, time: str, keys: list[str], gap: str = "30 minutes", late: str = "1 hour") -> DataFrame:
    return events.withWatermark(time, late).groupBy(F.session_window(time, gap).alias("session"), *keys).agg(F.count("*").alias("n"))


def once(events: DataFrame, keys: list[str], time: str, late: str = "2 days") -> DataFrame:
    """The first row of each key within the watermark."""
    return events.withWatermark(time, late).dropDuplicatesWithinWatermark(keys)


def content_changes(events: DataFrame, sha: Column) -> DataFrame:
    """``platform, job_id, event_type`` as sightings arrive: FIRST_SEEN, then UPDATED when the text's hash changes.

    The state of an identity is its last hash. Rows of one micro-batch are taken
    in the order of ``snapshot_date``.
    """
    rows = events.select("platform", "job_id", "snapshot_date", sha.alias("sha"))

    def step(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        last = state.get[0] if state.exists else None
        out = []
        for row in pd.concat(batches).sort_values("snapshot_date").itertuples():
            if last is None:
                out.append((*key, "FIRST_SEEN"))
            elif row.sha is not None and row.sha != last:
                out.append((*key, "UPDATED"))
            last = row.sha if row.sha is not None else last
        state.update((last,))
        yield pd.DataFrame(out, columns=["platform", "job_id", "event_type"])

    return rows.groupBy("platform", "job_id").applyInPandasWithState(step, "platform string, job_id string, event_type string", "sha string", "append", GroupStateTimeout.NoTimeout)
