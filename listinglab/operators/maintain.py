"""Incremental merge, retention and cascade.

The source ran these as SQL ``DELETE`` statements inside one transaction.
Here each step is a DataFrame plan producing the surviving rows; the
cleanup writes every table's new version before switching a pointer, so a
reader sees all the new tables or none.
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..schemas import SCHEDULE_KEY
from .joins import orphans, semi
from .ordering import dedupe


def merge_distinct(old: DataFrame, new: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """Append new rows, then drop the re-appended duplicates.

    With ``cols`` (a key) only new keys are inserted (left-anti on the key);
    otherwise whole-row distinct over the union.
    """
    if cols:
        keys = [F.col(f"`{c}`") for c in cols]
        fresh = new.dropDuplicates(list(cols)).join(old.select(*keys), list(cols), "left_anti")
        return old.unionByName(fresh)
    return dedupe(old.unionByName(new))


def cutoff(now: _dt.datetime | str, months: int = 3):
    """The retention cutoff: ``now`` minus calendar months (time kept, day
    clipped to month end), as a literal timestamp_ntz column."""
    if isinstance(now, str):
        now = _dt.datetime.fromisoformat(now)
    y, m = now.year, now.month - months
    while m <= 0:
        y, m = y - 1, m + 12
    import calendar

    d = min(now.day, calendar.monthrange(y, m)[1])
    return now.replace(year=y, month=m, day=d)


def retain(df: DataFrame, col: str, months: int, now: _dt.datetime | str) -> DataFrame:
    """Keep rows scraped after ``now - months`` (the boundary is deleted);
    NULL scrape times are kept (a SQL DELETE does not match them)."""
    cut = cutoff(now, months)
    c = F.col(f"`{col}`")
    return df.where(c.isNull() | (c > F.lit(cut).cast("timestamp_ntz")))


def expired(df: DataFrame, col: str, months: int, now: _dt.datetime | str) -> DataFrame:
    """The rows the retention step deletes."""
    cut = cutoff(now, months)
    return df.where(F.col(f"`{col}`") <= F.lit(cut).cast("timestamp_ntz"))


def drop_orphans(schedules: DataFrame, tickets: DataFrame, keys: list[str] = SCHEDULE_KEY) -> DataFrame:
    """I4: schedules still referenced by a ticket (left semi on 3 keys)."""
    return semi(schedules, tickets, keys)


def orphan_schedules(schedules: DataFrame, tickets: DataFrame, keys: list[str] = SCHEDULE_KEY) -> DataFrame:
    """I4: schedules the cascade deletes (left anti)."""
    return orphans(schedules, tickets, keys)


def cleanup(tables: dict[str, DataFrame], months: int, now: _dt.datetime | str) -> dict[str, DataFrame]:
    """I3 + I4 + W1 as one unit: tickets retained, orphan schedules dropped,
    dimensions de-duplicated. Persist with :func:`listinglab.sinks.files.commit_version`."""
    tickets = retain(tables["ticket"], "Scrape Time", months, now)
    out = dict(tables)
    out["ticket"] = tickets
    out["flight_schedule"] = drop_orphans(tables["flight_schedule"], tickets)
    for dim in ("airport", "airline", "refund_policy"):
        if dim in tables:
            out[dim] = dedupe(tables[dim])
    return out
