"""Multi-line CSV files read in many tasks a file.

Spark's reader takes a file with ``multiLine`` in one task, as a line break
may stand inside a quoted field. Whether a byte is inside quotes follows from
the number of quotes before it: a doubled quote counts two. So two passes over
the lines of ordinary splits find the records:

1. the parity of the quotes of each split (one small row a split), and its
   prefix sum over the splits of a file: the state in which a split begins;
2. with these states each task cuts its lines into records. Records within one
   split are whole; what a split has of records that reach over its ends are
   pieces, at most two a split, put together by file and place.

``from_csv`` then reads the fields of whole records, natively.

The states travel as one 64-bit hash for each split that begins inside quotes:
the driver, which holds the list of all splits to run the scan at all, sends a
fraction of that list. A record must fit a worker's memory, as it must for the
plain reader; nothing else is bounded by the size of a file.

The rows are those of the plain reader for files in the usual form: fields
with line breaks or quotes are quoted, quotes inside are doubled. A quote
inside an unquoted field is outside that form. Lines end with ``\\n`` or
``\\r\\n`` (then line breaks inside fields are read as ``\\n``, but in a last
record without its line end); empty lines between records are skipped; each file has a header;
a byte-order mark is skipped; a quote that is never closed reaches to the end
of its file (without the last line end). Encodings must keep ASCII bytes (UTF-8 does).
"""

from __future__ import annotations

import hashlib
from bisect import bisect_left
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import ship_code

WHOLE, HEAD, TAIL = 0, 1, 2
#: Rows that leave a worker together.
ROWS = 512

_PIECE = "path string, start long, kind int, first boolean, record string"


def _lines(spark: SparkSession, path: str) -> DataFrame:
    """(path, start, line): each line with the split that it begins in."""
    lines = spark.read.option("recursiveFileLookup", True).option("lineSep", "\n").text(path)
    return lines.select(F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("start"), F.col("value").alias("line"))


def _split_hash(path: str, start: int) -> int:
    return int.from_bytes(hashlib.blake2b(f"{path}\n{start}".encode(), digest_size=8).digest(), "little")


def split_states(lines: DataFrame) -> DataFrame:
    """(path, start, quotes, inside): the quotes of each split, and whether it begins inside a quoted field."""
    quotes = F.length("line") - F.length(F.replace(F.col("line"), F.lit('"'), F.lit("")))
    each = lines.groupBy("path", "start").agg(F.sum(quotes).alias("quotes"))
    before = Window.partitionBy("path").orderBy("start").rowsBetween(Window.unboundedPreceding, -1)
    return each.withColumn("inside", F.coalesce(F.sum("quotes").over(before), F.lit(0)) % 2 == 1)


def _cut(inside: list[int]):
    """Cuts the lines of a task's splits into records and pieces of records."""
    def state_of(path: str, start: int) -> bool:
        key = _split_hash(path, start)
        k = bisect_left(inside, key)
        return k < len(inside) and inside[k] == key

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[tuple[str, int, int, bool, str]] = []
        at: tuple[str, int] | None = None
        #: Lines of the record that is open, whether it began in an earlier split, and whether it is the file's first.
        held: list[str] = []
        head = first = open_ = False

        def emit(kind: int) -> None:
            out.append((*at, kind, first, "\n".join(held)))
            held.clear()

        def end_split() -> None:
            if held:
                # Still inside quotes: what began here is a tail, what did not is all of this split.
                emit(HEAD if head else TAIL)

        for batch in batches:
            for path, start, line in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if (path, start) != at:
                    end_split()
                    at = (path, start)
                    open_ = head = state_of(path, start)
                    first = start == 0
                    if first:
                        line = line.removeprefix("﻿")
                if not held and not open_:
                    if not line.strip("\r"):
                        continue
                    head = False
                held.append(line)
                open_ ^= line.count('"') % 2 == 1
                if not open_:
                    emit(HEAD if head else WHOLE)
                    head = first = False
            while len(out) >= ROWS:
                yield _batch(out[:ROWS])
                del out[:ROWS]
        end_split()
        if out:
            yield _batch(out)

    return run


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    types = [pa.string(), pa.int64(), pa.int32(), pa.bool_(), pa.string()]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)], ["path", "start", "kind", "first", "record"])


def records(spark: SparkSession, path: str) -> DataFrame:
    """(path, record): the text of every record but the headers."""
    ship_code(spark)
    lines = _lines(spark, path)
    inside = split_states(lines).where("inside").select("path", "start")
    states = sorted(_split_hash(r.path, r.start) for r in inside.toLocalIterator())
    cut = lines.mapInArrow(_cut(states), _PIECE)
    if not states:
        return _read_ends(cut)
    pieces = cut.where(F.col("kind") != WHOLE)
    # A tail begins a record, the heads after it go on with it.
    in_order = Window.partitionBy("path").orderBy("start", "kind")
    tails = F.sum((F.col("kind") == TAIL).cast("int")).over(in_order)
    joined = pieces.withColumn("of", tails).groupBy("path", "of").agg(
        F.array_sort(F.collect_list(F.struct("start", "kind", "record"))).alias("parts"), F.max("first").alias("first"))
    whole = joined.select("path", F.array_join("parts.record", "\n").alias("record"), "first")
    return _read_ends(cut.where(F.col("kind") == WHOLE).select("path", "record", "first").unionByName(whole))


def _read_ends(cut: DataFrame) -> DataFrame:
    """Without headers; where a record ends with ``\\r\\n``, its line breaks are read as ``\\n``, as the plain reader does."""
    text = F.col("record")
    read = F.when(F.endswith(text, F.lit("\r")), F.replace(F.left(text, F.length(text) - 1), F.lit("\r\n"), F.lit("\n"))).otherwise(text)
    return cut.where(~F.col("first")).select("path", read.alias("record"))


def read_csv_records(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """The rows of multi-line CSV files, as the plain reader gives them, and ``_path``."""
    options = {"quote": '"', "escape": '"', "multiLine": "true", "mode": "PERMISSIVE"}
    row = F.from_csv("record", _ddl(schema), options)
    return records(spark, path).select(row.alias("row"), F.col("path").alias("_path")).select("row.*", "_path")


def _ddl(schema: T.StructType) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
