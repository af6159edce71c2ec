"""Mergeable day sketches (A12, A14 for any range of days).

A distinct count or a quantile over a range of days needs all its rows, or a
summary of each day that can be merged. One row is stored for each (day,
column): a HyperLogLog sketch of its values, and for a numeric column a KLL
sketch, built in one pass with map-side combine. Any range is then a merge of
its days' rows, without the data.

Errors. A HyperLogLog sketch with ``lg_k`` = 12 has a relative standard error
of 1.04 / sqrt(4096) = 1.6 %, and is exact for a few values. A KLL sketch with
k = 200 answers a quantile whose rank is off by 1.33 % of the rows (single-sided,
at 99 % confidence), and is exact below k rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

LG_K = 12
#: Errors that the sketches promise: three standard errors of a distinct count, and ranks of a quantile.
DISTINCT_ERROR, RANK_ERROR = 3 * 1.04 / 64, 0.0165


def _q(c: str) -> Column:
    return F.col(f"`{c}`")


def day_sketches(rows: DataFrame, day: Column, columns: Sequence[str]) -> DataFrame:
    """(day, column_name, n, distinct_sketch, quantile_sketch): one row for each day and column; null values are not counted."""
    numeric = {f.name for f in rows.schema.fields if f.dataType.typeName() in ("byte", "short", "integer", "long", "float", "double", "decimal")}
    each = [F.struct(F.lit(c).alias("column_name"), _q(c).cast("string").alias("value"),
                     (_q(c).cast("double") if c in numeric else F.lit(None).cast("double")).alias("number")) for c in columns]
    long = rows.select(day.alias("day"), F.explode(F.array(*each)).alias("v")).select("day", "v.*").where("value IS NOT NULL")
    return long.groupBy("day", "column_name").agg(
        F.count(F.lit(1)).alias("n"), F.hll_sketch_agg("value", F.lit(LG_K)).alias("distinct_sketch"), F.kll_sketch_agg_double("number").alias("quantile_sketch"))


def merged(sketches: DataFrame) -> DataFrame:
    """(column_name, n, distinct_sketch, quantile_sketch) of all days in ``sketches``."""
    return sketches.groupBy("column_name").agg(
        F.sum("n").alias("n"), F.hll_union_agg("distinct_sketch").alias("distinct_sketch"), F.kll_merge_agg_double("quantile_sketch").alias("quantile_sketch"))


def distinct_counts(sketches: DataFrame, first=None, last=None) -> DataFrame:
    """A12 over days: (column_name, n, distinct_values), the latter with the error stated above."""
    return merged(_between(sketches, first, last)).select("column_name", "n", F.hll_sketch_estimate("distinct_sketch").alias("distinct_values"))


def quantiles(sketches: DataFrame, shares: Sequence[float], first=None, last=None) -> DataFrame:
    """A14 over days: (column_name, share, value) of the numeric columns."""
    m = merged(_between(sketches, first, last)).where(F.kll_sketch_get_n_double("quantile_sketch") > 0)
    each = F.array(*[F.struct(F.lit(float(s)).alias("share"), F.kll_sketch_get_quantile_double("quantile_sketch", F.lit(float(s))).alias("value")) for s in shares])
    return m.select("column_name", F.explode(each).alias("q")).select("column_name", "q.*")


def _between(sketches: DataFrame, first, last) -> DataFrame:
    if first is not None:
        sketches = sketches.where(F.col("day") >= F.lit(first))
    return sketches if last is None else sketches.where(F.col("day") <= F.lit(last))
