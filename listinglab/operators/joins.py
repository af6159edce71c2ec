"""Fact/dimension joins.

NULL join keys never match in SQL; the source (pandas) matched them. For the
inner joins we drop NULL keys first and report how many were dropped, so
the count is visible instead of silently differing.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..schemas import POLICY_KEY, SCHEDULE_KEY


def _q(c: str):
    return F.col(f"`{c}`")


def _not_null(df: DataFrame, keys: Iterable[str]) -> DataFrame:
    cond = None
    for k in keys:
        c = _q(k).isNotNull()
        cond = c if cond is None else cond & c
    return df.where(cond)


def ticket_schedule(tickets: DataFrame, schedules: DataFrame, keys: list[str] = SCHEDULE_KEY) -> DataFrame:
    """Inner equi-join on (Departure Time, Flight Code, Departure Location Code).

    Both sides are large; Catalyst plans a sort-merge join (AQE splits
    skewed key partitions), and the NULL-key filter is pushed below it.
    """
    return _not_null(tickets, keys).join(_not_null(schedules, keys), keys, "inner")


def ticket_policy(df: DataFrame, policies: DataFrame, keys: list[str] = POLICY_KEY) -> DataFrame:
    """Inner equi-join on (Airline_id, Fare Class); policies fan out.

    REFUND_POLICY is one row per (airline, fare, policy); AQE broadcasts it
    when its measured size is below the adaptive threshold.
    """
    return _not_null(df, keys).join(_not_null(policies, keys), keys, "inner")


def null_key_count(df: DataFrame, keys: Iterable[str]) -> DataFrame:
    """Rows an inner join drops because a key is NULL (the audit number)."""
    cond = None
    for k in keys:
        c = _q(k).isNull()
        cond = c if cond is None else cond | c
    return df.select(F.count(F.when(cond, 1)).alias("null_key_rows"))


def semi(df: DataFrame, other: DataFrame, keys: list[str]) -> DataFrame:
    """J4 survivors: rows of ``df`` with at least one match (EXISTS)."""
    return df.join(other.select(*[_q(k) for k in keys]), keys, "left_semi")


def orphans(df: DataFrame, other: DataFrame, keys: list[str]) -> DataFrame:
    """Rows of ``df`` with no match (NOT EXISTS) — the ones to delete."""
    return df.join(other.select(*[_q(k) for k in keys]), keys, "left_anti")


def outer_hist(left: DataFrame, right: DataFrame, key: str, lname: str, rname: str) -> DataFrame:
    """Full outer join of two (key, count) histograms, missing -> 0."""
    l2 = left.withColumnRenamed("count", lname)
    r2 = right.withColumnRenamed("count", rname)
    j = l2.join(r2, key, "full_outer")
    return j.select(key, F.coalesce(lname, F.lit(0)).cast("bigint").alias(lname),
                    F.coalesce(rname, F.lit(0)).cast("bigint").alias(rname))
