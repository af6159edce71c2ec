"""Stored tables laid out for what reads them.

* ``write_bucketed``: tables bucketed and sorted by their join key. Two tables
  of the same key and number of buckets join without moving a row: the training
  frame of stored tables shuffles neither tickets nor schedules.
* ``write_lookup``: rows clustered by a look-up column, with Parquet Bloom
  filters for it and for further columns. An equality look-up reads the row
  groups whose range and filter can hold the value, however many there are.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import own_shuffles, work_path


def write_bucketed(df: DataFrame, key: Sequence[str], buckets: int, path: str | None = None) -> DataFrame:
    """Write as a bucketed table (its files under ``path``) and read it back with its layout known to the planner."""
    spark = df.sparkSession
    name = f"bucketed_{uuid.uuid4().hex[:12]}"
    path = path or work_path(spark, "bucketed")
    # Rows are dealt by the bucket's own hash, so each bucket is one file and is read by one task.
    rows = df.repartition(buckets, *[F.col(f"`{c}`") for c in key])
    with own_shuffles(spark):
        rows.write.format("parquet").option("path", path).bucketBy(buckets, key[0], *key[1:]).sortBy(key[0], *key[1:]).saveAsTable(name)
    return spark.table(name)


def write_lookup(df: DataFrame, path: str, cluster_by: str, also: Sequence[str] = (), files: int | None = None, row_group_bytes: int | None = None) -> DataFrame:
    """Write clustered by one column, with Bloom filters on it and on ``also``; read it back."""
    spark = df.sparkSession
    column = F.col(f"`{cluster_by}`")
    rows = (df.repartitionByRange(files, column) if files else df.repartitionByRange(column)).sortWithinPartitions(column)
    writer = rows.write.option("parquet.bloom.filter.enabled", "false")
    for c in (cluster_by, *also):
        writer = writer.option(f"parquet.bloom.filter.enabled#{c}", "true")
    if row_group_bytes:
        writer = writer.option("parquet.block.size", str(row_group_bytes))
    with own_shuffles(spark):
        writer.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
