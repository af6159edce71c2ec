"""Sinks (K1-K7): parallel file writes, versioned replace, length limits."""

from __future__ import annotations

import uuid
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import own_shuffles

_MODES = {"append": "append", "replace": "overwrite", "fail": "errorifexists", "ignore": "ignore"}


def _csv_safe(df: DataFrame) -> DataFrame:
    """CSV has no nested types: arrays/maps/structs become JSON text."""
    cols = []
    for f in df.schema.fields:
        if isinstance(f.dataType, (T.ArrayType, T.MapType, T.StructType)):
            cols.append(F.to_json(F.col(f"`{f.name}`")).alias(f.name))
        else:
            cols.append(F.col(f"`{f.name}`"))
    return df.select(*cols)


def write_table(df: DataFrame, path: str, fmt: str = "parquet", mode: str = "replace",
                partition_by: Sequence[str] = ()) -> str:
    """K1-K4: write one table. ``mode`` is append / replace / fail."""
    w = (_csv_safe(df) if fmt == "csv" else df).write.mode(_MODES[mode])
    if partition_by:
        w = w.partitionBy(*partition_by)
    with own_shuffles(df.sparkSession):
        if fmt == "csv":
            w.option("header", True).option("timestampNTZFormat", "yyyy-MM-dd HH:mm:ss").option("compression", "gzip").csv(path)
        else:
            w.format(fmt).save(path)
    return path


def write_tables(tables: Mapping[str, DataFrame], root: str, fmt: str = "parquet", mode: str = "replace") -> dict:
    """K1: every table under ``root/<name>``."""
    return {name: write_table(df, f"{root.rstrip('/')}/{name}", fmt, mode) for name, df in tables.items()}


def replace_from_self(df: DataFrame, root: str, fmt: str = "parquet") -> str:
    """K3 when the source is also the target: write a new version folder and
    return it (never overwrite the files being read)."""
    path = f"{root.rstrip('/')}/v-{uuid.uuid4().hex[:12]}"
    write_table(df, path, fmt, "fail")
    return path


def append_raw(df: DataFrame, root: str, partition_by: Sequence[str] = ("day", "route")) -> str:
    """K5: append raw rows under ``day=/route=`` folders, CSV with one header
    per part file, gzipped. Rows are rebalanced by folder: Spark splits a hot
    day/route over several writers by its measured bytes and joins small ones,
    so no file grows with the folder, and readers need not split one."""
    df = df.hint("rebalance", *[F.col(c) for c in partition_by])
    with own_shuffles(df.sparkSession):
        df.write.mode("append").partitionBy(*partition_by).option("header", True).option("compression", "gzip").csv(root)
    return root


def with_length_limits(df: DataFrame, limits: Mapping[str, int]) -> tuple[DataFrame, DataFrame]:
    """K6: cut text columns to a length (NVARCHAR(n) semantics) and count the
    cut values per column. Returns (limited frame, counts)."""
    limited = df.withColumns({c: F.left(F.col(f"`{c}`"), F.lit(n)) for c, n in limits.items()})
    counts = df.select(*[F.count(F.when(F.length(F.col(f"`{c}`")) > n, 1)).alias(c) for c, n in limits.items()])
    counts = counts.unpivot([], list(limits), "column_name", "truncated")
    return limited, counts


def jdbc_options(limits: Mapping[str, int]) -> dict:
    """K6 for JDBC sinks: ``createTableColumnTypes`` from the limits."""
    return {"createTableColumnTypes": ", ".join(f"`{c}` NVARCHAR({n})" for c, n in limits.items())}


def write_options(options: DataFrame, path: str) -> str:
    """K7: save the options JSON document (one line)."""
    options.select(F.col("options").alias("value")).coalesce(1).write.mode("overwrite").text(path)
    return path


def commit_version(spark: SparkSession, tables: Mapping[str, DataFrame], root: str, fmt: str = "parquet") -> str:
    """Write every table of a new version, then its pointer.

    Pointers are ``_CURRENT-<n>`` folders and none is ever changed: the one
    with the highest number and Spark's ``_SUCCESS`` mark holds the version.
    So readers see the previous complete version until the new one is whole,
    and of two writers of the same number the second fails.
    """
    root = root.rstrip("/")
    base = f"{root}/v-{uuid.uuid4().hex[:12]}"
    for name, df in tables.items():
        write_table(df, f"{base}/{name}", fmt, "fail")
    number = max(_pointers(spark, root), default=0) + 1
    spark.createDataFrame([(base.rsplit("/", 1)[1],)], "value string").coalesce(1).write.mode("errorifexists").text(f"{root}/_CURRENT-{number}")
    return base


def _pointers(spark: SparkSession, root: str) -> dict[int, str]:
    """Complete pointers by number."""
    jvm = spark.sparkContext._jvm
    pattern = jvm.org.apache.hadoop.fs.Path(f"{root}/_CURRENT-*/_SUCCESS")
    found = pattern.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).globStatus(pattern) or []
    folders = [str(x.getPath().getParent()) for x in found]
    return {int(f.rsplit("-", 1)[1]): f for f in folders}


def current_version(spark: SparkSession, root: str) -> str:
    """Resolve the committed version folder of :func:`commit_version`."""
    root = root.rstrip("/")
    pointers = _pointers(spark, root)
    # Folders whose names begin with an underscore are hidden to a listing of their parent, not to a read by name.
    return f"{root}/{spark.read.text(pointers[max(pointers)] + '/part-*').first()[0]}"


def read_tables(spark: SparkSession, base: str, names: Sequence[str], fmt: str = "parquet") -> dict[str, DataFrame]:
    return {n: spark.read.format(fmt).load(f"{base}/{n}") for n in names}


def exists(spark: SparkSession, path: str) -> bool:
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p)
