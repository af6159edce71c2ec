"""Counted aggregates that take deltas (A1, A2, A7-A9 kept up to date after I2 and I3).

Choices, fares and ranges are answers about the rows that are stored now. Kept
as a count for each value they can follow inserts and deletes without the rows:
a delta is the count of each value in the rows that came (+) or went (-), and a
value whose count reaches zero is gone. The table of counts has one row for
each (group, column, value), whatever the number of rows behind it; a minimum
or maximum is the first or last value that is left.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SCHEMA = "column_name string, group_key string, value string, number double, n long"
NO_GROUP = ""


def _q(c: str) -> Column:
    return F.col(f"`{c}`")


def value_counts(rows: DataFrame, columns: Sequence[str], group: str | None = None) -> DataFrame:
    """(column_name, group_key, value, number, n): how often each value of each column occurs (in each group). Null values are left out.

    ``number`` is the value of a numeric column, to order by."""
    numeric = {f.name for f in rows.schema.fields if f.dataType.typeName() in ("byte", "short", "integer", "long", "float", "double", "decimal")}
    key = F.coalesce(_q(group).cast("string"), F.lit(NO_GROUP)) if group else F.lit(NO_GROUP)
    each = [F.struct(F.lit(c).alias("column_name"), _q(c).cast("string").alias("value"),
                     (_q(c).cast("double") if c in numeric else F.lit(None).cast("double")).alias("number")) for c in columns]
    long = rows.select(key.alias("group_key"), F.explode(F.array(*each)).alias("v")).select("group_key", "v.*").where("value IS NOT NULL")
    return long.groupBy("column_name", "group_key", "value", "number").agg(F.count(F.lit(1)).alias("n"))


def apply_delta(counts: DataFrame, added: DataFrame | None = None, removed: DataFrame | None = None) -> DataFrame:
    """The counts after rows came and went; values that nothing holds any more are gone."""
    parts = counts
    if added is not None:
        parts = parts.unionByName(added)
    if removed is not None:
        parts = parts.unionByName(removed.withColumn("n", -F.col("n")))
    out = parts.groupBy("column_name", "group_key", "value", "number").agg(F.sum("n").alias("n"))
    # A count below zero says that rows went which never came: the delta does not belong to these counts.
    wrong = F.raise_error(F.concat(F.lit("more rows removed than counted: "), "column_name", F.lit("="), "value"))
    return out.withColumn("n", F.when(F.col("n") < 0, wrong.cast("long")).otherwise(F.col("n"))).where("n > 0")


def choices(counts: DataFrame, column: str) -> DataFrame:
    """A1: (group_key, value) that are left, each once."""
    return counts.where(F.col("column_name") == column).select("group_key", "value").distinct()


def choice_lists(counts: DataFrame, column: str) -> DataFrame:
    """A1/A2: (group_key, values): the sorted values of each group."""
    return choices(counts, column).groupBy("group_key").agg(F.array_sort(F.collect_set("value")).alias("values"))


def ranges(counts: DataFrame, column: str) -> DataFrame:
    """(group_key, low, high, mean, n) of a numeric column from its counts."""
    of = counts.where((F.col("column_name") == column) & F.col("number").isNotNull())
    return of.groupBy("group_key").agg(F.min("number").alias("low"), F.max("number").alias("high"),
                                       (F.sum(F.col("number") * F.col("n")) / F.sum("n")).alias("mean"), F.sum("n").alias("n"))
