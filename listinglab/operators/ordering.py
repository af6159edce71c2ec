"""Dedupe, sort, top-n (W1-W4) and reshaping."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _q(c: str) -> Column:
    return F.col(f"`{c}`")


def dedupe(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """``ROW_NUMBER() OVER (PARTITION BY <all cols>) ... rn > 1`` deleted.

    The partition covers every column, so this is a plain distinct: a hash
    aggregate with map-side combine, no sort. NULLs group together.
    """
    return df.dropDuplicates(list(cols)) if cols else df.distinct()


def sort_by(df: DataFrame, col: str, ascending: bool = True, tie: Sequence[str] = ()) -> DataFrame:
    """Sort by a date with NULLs last in both directions (+ tie keys)."""
    key = _q(col).asc_nulls_last() if ascending else _q(col).desc_nulls_last()
    return df.orderBy(key, *[_q(t).asc_nulls_last() for t in tie])


def top_n(df: DataFrame, col: str, n: int = 5, ascending: bool = True, tie: Sequence[str] = ()) -> DataFrame:
    """First n rows after the sort (a TakeOrderedAndProject: each task
    keeps only its n best rows). Fewer rows than n is fine."""
    return sort_by(df, col, ascending, tie).limit(n)


def top_n_per_group(df: DataFrame, group: str, col: str, n: int = 5, ascending: bool = True,
                    tie: Sequence[str] = ()) -> DataFrame:
    """W3 for every group at once (e.g. latest reviews of every airline)."""
    from pyspark.sql import Window

    key = _q(col).asc_nulls_last() if ascending else _q(col).desc_nulls_last()
    w = Window.partitionBy(_q(group)).orderBy(key, *[_q(t).asc_nulls_last() for t in tie])
    return df.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= n)


def best_model(results: DataFrame, by: str = "mean_r2") -> DataFrame:
    """Best row by (R² desc, RMSE asc) or (RMSE asc, R² desc)."""
    if by == "mean_r2":
        order = [F.desc("mean_r2"), F.asc("mean_rmse")]
    elif by == "mean_rmse":
        order = [F.asc("mean_rmse"), F.desc("mean_r2")]
    else:
        raise ValueError("by must be 'mean_r2' or 'mean_rmse'")
    return results.orderBy(*order, F.asc("model_name")).limit(1)


def union_all(*frames: DataFrame) -> DataFrame:
    """UNION ALL by name; columns missing on one side become NULL."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def union_distinct(*frames: DataFrame) -> DataFrame:
    """U3."""
    return union_all(*frames).distinct()


def distinct_rows(df: DataFrame) -> DataFrame:
    """U4."""
    return df.distinct()


def melt(df: DataFrame, ids: Sequence[str], values: Sequence[str], var: str = "Type",
         value: str = "Count") -> DataFrame:
    """Wide -> long."""
    return df.unpivot(list(ids), list(values), var, value)


def indicators(df: DataFrame, col: str, categories: Sequence[str], prefix: str | None = None) -> DataFrame:
    """Long -> indicator columns ``<col>_<value>`` for a known category list."""
    p = prefix if prefix is not None else col
    return df.withColumns({f"{p}_{v}": (_q(col) == F.lit(v)).cast("tinyint") for v in categories})
