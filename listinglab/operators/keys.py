"""Distributed consecutive numbering of distinct keys.

``row_number() OVER (ORDER BY k)`` without a partition moves every row into
one task. Here the keys are range-partitioned on the sort order, numbered
inside each partition, and shifted by the row count of all earlier
partitions. The offset table has one row per partition (bounded by the
partition count, not by the data), so broadcasting it is safe.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def consecutive_index(df: DataFrame, order: Sequence[Column], out: str, start: int = 1,
                      partitions: int | None = None) -> DataFrame:
    """Number rows of ``df`` 1..n (or from ``start``) in ``order``.

    The numbered rows are checkpointed once, so counts and ids always agree;
    ties on the ordering get an arbitrary order within a partition.
    """
    from pyspark import StorageLevel

    from ..session import cut_lineage

    spark = df.sparkSession
    n = partitions or int(spark.conf.get("spark.sql.shuffle.partitions", "200"))
    # The range exchange samples its input before shuffling it: keep the
    # input, unless the caller does, so the upstream plan runs once.
    mine = not (df.storageLevel.useMemory or df.storageLevel.useDisk)
    if mine:
        df = df.persist(StorageLevel.MEMORY_AND_DISK)
    # The id holds the partition's number (upper 31 bits) and the row's place in it. The numbered rows
    # are materialised once (reliable checkpoint in the shared folder): counts and ids must come from
    # the same range partitioning, which a re-execution need not reproduce.
    local = cut_lineage(df.repartitionByRange(n, *order).sortWithinPartitions(*order)
                        .withColumn("_id", F.monotonically_increasing_id()))
    if mine:
        df.unpersist()
    local = local.withColumns({"_pid": F.shiftright("_id", 33), "_local": F.col("_id").bitwiseAND(F.lit((1 << 33) - 1)) + 1})
    counts = local.groupBy("_pid").agg(F.max("_local").alias("_cnt"))
    offsets = counts.select(
        "_pid",
        (F.coalesce(F.sum("_cnt").over(Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
         ).alias("_off"),
    )
    return (local.join(F.broadcast(offsets), "_pid")
            .withColumn(out, (F.col("_off") + F.col("_local") + F.lit(start - 1)).cast("bigint"))
            .drop("_pid", "_local", "_off", "_id"))
