"""Helpers shared by the operators of this package.

* ``save``: write a table to the shared work folder and read it back. This is
  how the operators cut lineage: the files survive a lost executor, and the
  reread table carries file statistics, so Spark itself chooses between a
  broadcast and a shuffle from measured bytes.
* ``texts``: id and text as UTF-8 bytes, the only columns an operator reads.
* ``packed`` / ``unpacked``: carry a whole document row through joins as one
  struct, so that extra columns can have any name without clashing.
"""

from __future__ import annotations

import hashlib
import string
import tempfile
import zipfile
from collections.abc import Iterable, Iterator
from pathlib import Path

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from listinglab.session import table, work_path

__all__ = [
    "BATCH_ROWS", "ascii_lower", "bucket", "drop", "packed", "save", "ship", "slices", "table", "texts", "unpacked",
]

UPPER, LOWER = string.ascii_uppercase, string.ascii_lowercase
#: Rows that a Python worker holds at a time (an Arrow batch may be larger).
BATCH_ROWS = 256
BATCH_BYTES = 8 << 20


def save(df: DataFrame, name: str, **options: str) -> DataFrame:
    """Write ``df`` to a fresh folder of the shared work area and read it back. ``options``: of the Parquet writer."""
    spark = df.sparkSession
    path = work_path(spark, f"llm-{name}")
    df.write.options(**options).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def drop(df: DataFrame) -> None:
    """Delete the files of a table made by ``save`` that nothing reads any more."""
    spark = df.sparkSession
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    for folder in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
        if "/listinglab-work/llm-" in folder:
            path = jvm.org.apache.hadoop.fs.Path(folder)
            path.getFileSystem(conf).delete(path, True)


def ascii_lower(text: Column) -> Column:
    """Lower-case A-Z only; null counts as the empty text."""
    return F.translate(F.coalesce(text, F.lit("")), UPPER, LOWER)


def bucket(key: str, n: int) -> Column:
    """``crc32(key as text) mod n``: the fold of a row. A null key counts as ''."""
    return (F.crc32(F.coalesce(F.col(key).cast("string"), F.lit("")).cast("binary")) % n).cast("int")


def ship(spark: SparkSession) -> None:
    """Send this package's code to the Python workers, as ``--py-files`` would, once for each context.

    Arrow batches are held to ``BATCH_BYTES``, unless the session has a limit of its own: texts can be long."""
    if spark.conf.get("spark.sql.execution.arrow.maxBytesPerBatch", None) is None:
        spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    sc = spark.sparkContext
    if getattr(sc, "_llm_shipped", False):
        return
    package = Path(__file__).resolve().parents[1]
    archive = Path(tempfile.mkdtemp()) / f"{package.name}_code.zip"
    with zipfile.ZipFile(archive, "w") as out:
        for source in sorted(package.rglob("*.py")):
            out.write(source, source.relative_to(package.parent))
    sc.addPyFile(str(archive))
    sc._llm_shipped = True


def texts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", *more: Column) -> DataFrame:
    """(doc_id, body): the id, and the text as bytes (null counts as empty)."""
    ship(docs.sparkSession)
    body = F.coalesce(F.col(text_col).cast("binary"), F.lit(b""))
    return docs.select(F.col(id_col).alias("doc_id"), body.alias("body"), *more)


def slices(batches: Iterable[pa.RecordBatch], rows: int = BATCH_ROWS) -> Iterator[pa.RecordBatch]:
    """Cut Arrow batches so that a worker turns few rows into Python objects at a time."""
    for batch in batches:
        for start in range(0, batch.num_rows, rows):
            yield batch.slice(start, rows)


def packed(docs: DataFrame, id_col: str, tag: Column) -> DataFrame:
    """(key, tag, row): the id, a hash of the text that tells rows of one id apart, and the whole row as one struct."""
    return docs.select(F.col(id_col).alias("key"), tag.alias("tag"), F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))


def unpacked(rows: DataFrame, columns: list[str]) -> DataFrame:
    """The columns of the documents that ``packed`` put into ``row``."""
    return rows.select(*[F.col("row").getField(c).alias(c) for c in columns])


def sha256_hex(text: str) -> str:
    return hashlib.sha256(text.encode("utf-8")).hexdigest()
