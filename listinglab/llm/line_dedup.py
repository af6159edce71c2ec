"""Operator 5: line deduplication by content-defined chunks.

Units. A text is a sequence of lines; a line of over ``LONG_LINE`` words (a
paragraph on one line) counts as a line for each sentence, and a sentence of
as many words as one for each piece between words that their hash chooses.
Blank lines belong to the line before.

Chunks. From each line on, the shortest run of ``MIN_LINES`` lines and
``MIN_WORDS`` words or more is a chunk, and so is the shortest such run up to
each line. Chunks overlap, and each follows from its own lines alone: a
passage gives the same chunks wherever it stands, and those of its lines that
are whole units on both sides are covered to the first and last one. Text that
shares a unit with its neighbours (a passage that starts within a sentence)
is not compared up to that sentence's end.

Removal. A chunk that occurs more than once in the corpus stays where it
occurs first (smallest id, then smallest place) and is cut out everywhere
else, after comparison of its bytes. What overlapping chunks cut is cut once;
the first occurrence of each line in the corpus is in no chunk that goes.

Plan. One scan counts 64-bit chunk hashes, combined before the shuffle, and
leaves those that occur again. They set bits in a filter sized from their
number (``CHUNK_BITS`` each, so one chunk in 16 passes by chance, up to 64 MB,
its bound at any input size), which goes to the second scan: it
emits the places of the chunks whose hash is in the filter, each with the
hashes of its lines, and the bytes of each line once. A group-by on line hash
and bytes is the comparison: where no hash has two contents, chunks of the
same line hashes are the same; otherwise the chunks are scanned once more and
grouped by their whole bytes. Chunks that passed the filter by chance occur
once and go, so a filter that is too full for its input costs bytes moved,
never results. The places to cut are joined to the documents by id and text
hash, the only shuffle of whole texts, and the cut itself is a native
expression.

Edge cases. Null and empty texts and texts of one line stay as they are. A
null id counts as smaller than any other. Repeated rows (same id and text)
are the same occurrence and share its fate. An empty table stays empty. All
columns are kept; a text that repeats others in full becomes empty, its row
stays.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from listinglab.llm.common import drop, save, slices, texts

LONG_LINE, MIN_LINES, MIN_WORDS = 50, 2, 10
#: A sentence of over LONG_LINE words is cut at one word in CUT.
CUT = 8
#: The filter: bits for each repeated chunk, and the exponents of the least and the greatest size (8 KB to 64 MB).
CHUNK_BITS, LEAST_BITS, MOST_BITS = 16, 16, 29

_MIX = np.uint64(0x9E3779B97F4A7C15)
_UNMIX = np.uint64(pow(int(_MIX), -1, 1 << 64))
_SENTENCE = re.compile(rb"(?<=[.!?]) ")


def lines(body: bytes) -> list[bytes]:
    """The units of a text with their ends; joined they are the text."""
    out: list[bytes] = []
    for line in body.splitlines(keepends=True):
        if out and not line.strip():
            out[-1] += line
        elif line.count(b" ") < LONG_LINE:
            out.append(line)
        else:
            parts = _SENTENCE.split(line)
            for part in [*[p + b" " for p in parts[:-1]], parts[-1]]:
                out.extend([part] if part.count(b" ") <= LONG_LINE else _pieces(part))
    return out


def _pieces(sentence: bytes) -> list[bytes]:
    """A very long sentence, cut behind words that their own hash chooses."""
    out, held = [], []
    for word in sentence.split(b" "):
        held.append(word)
        if xxhash.xxh64_intdigest(word) % CUT == 0:
            out.append(b" ".join(held) + b" ")
            held = []
    out.append(b" ".join(held))
    if not out[-1]:
        out.pop()
    return out if b"".join(out) == sentence else [*out[:-1], out[-1].removesuffix(b" ")]


def _runs(bare: list[bytes], sizes: list[int]) -> tuple[np.ndarray, np.ndarray]:
    """First unit and unit after the last of each chunk, in order. ``sizes``: units of each text."""
    stop = np.cumsum(sizes)
    begin = stop - sizes
    owner = np.repeat(np.arange(len(sizes)), sizes)
    words = np.concatenate([[0], np.cumsum([x.count(b" ") + 1 for x in bare])]).astype(np.int64)
    unit = np.arange(len(bare))
    ends = np.maximum(np.searchsorted(words, words[:-1] + MIN_WORDS), unit + MIN_LINES)
    starts = np.minimum(np.searchsorted(words, words[1:] - MIN_WORDS, "right") - 1, unit + 1 - MIN_LINES)
    on, back = ends <= stop[owner], starts >= begin[owner]
    wide = len(bare) + 1
    both = np.unique(np.concatenate([unit[on] * wide + ends[on], starts[back] * wide + unit[back] + 1]))
    return both // wide, both % wide


def chunks(body: bytes) -> list[tuple[int, int, bytes]]:
    """(start, end, content) of the chunks that may be removed, by place; byte offsets. Neither starts nor ends decrease."""
    own = lines(body)
    bare = [x.rstrip() for x in own]
    places = np.concatenate([[0], np.cumsum([len(x) for x in own])]).astype(np.int64).tolist()
    first, last = _runs(bare, [len(own)])
    return [(places[a], places[b], b"\n".join(bare[a:b])) for a, b in zip(first.tolist(), last.tolist(), strict=True)]


class _Batch:
    """The chunks of many texts: ``first`` and ``last`` among all units, ``hashes`` of chunks and ``u`` of units (their upper ``unit_bits``)."""

    def __init__(self, bodies: list[bytes], unit_bits: int):
        split = [lines(b) for b in bodies]
        own = [x for part in split for x in part]
        self.sizes = [len(part) for part in split]
        self.bare = [x.rstrip() for x in own]
        self.places = np.concatenate([[0], np.cumsum([len(x) for x in own])]).astype(np.int64)
        self.first, self.last = _runs(self.bare, self.sizes)
        digest = xxhash.xxh64_intdigest
        self.u = np.array([digest(x) for x in self.bare], np.uint64) >> np.uint64(64 - unit_bits)
        power = np.cumprod(np.full(len(own) + 1, _MIX))
        sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum((self.u * np.uint64(2) + np.uint64(1)) * power[:-1])])
        h = (sums[self.last] - sums[self.first]) * np.cumprod(np.full(len(own) + 1, _UNMIX))[self.first]
        h = (h ^ (h >> np.uint64(31))) * _MIX
        self.hashes = (h ^ (h >> np.uint64(29))) * _MIX


def _again(docs: DataFrame, unit_bits: int) -> DataFrame:
    """Chunk hashes that occur more than once."""
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            yield pa.RecordBatch.from_arrays([pa.array(_Batch(batch.column("body").to_pylist(), unit_bits).hashes.view(np.int64))], names=["h"])

    return docs.select("body").mapInArrow(run, "h long").groupBy("h").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("h")


def _filter(hashes: DataFrame, bits: int) -> np.ndarray:
    """A set of ``2 ** bits`` bits, one for each hash's upper bits; put together by words in Spark."""
    place = f"shiftrightunsigned(h, {64 - bits})"
    words = hashes.groupBy(F.expr(f"{place} div 64").alias("word")).agg(
        F.expr(f"bit_or(shiftleft(1L, cast({place} & 63 as int)))").alias("bits"))
    out = np.zeros(1 << (bits - 6), np.int64)
    for row in words.toLocalIterator():
        out[row.word] = row.bits
    return out.view(np.uint64)


_FRESH = T.ArrayType(T.StructType([T.StructField("u", T.LongType()), T.StructField("unit", T.BinaryType())]))


def _places(docs: DataFrame, held, bits: int, unit_bits: int, whole: bool) -> DataFrame:
    """(doc_id, tag, start, end, key, fresh) of the chunks whose hash is in the filter.

    ``key``: the hashes of its lines, or with ``whole`` its bytes. ``fresh``: hash and bytes of those of its lines
    that are in no chunk before it."""
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = np.frombuffer(held.value, np.uint64)
        for batch in slices(batches):
            b = _Batch(batch.column("body").to_pylist(), unit_bits)
            place = b.hashes >> np.uint64(64 - bits)
            stay = np.flatnonzero((words[place >> np.uint64(6)] >> (place & np.uint64(63))) & np.uint64(1))
            if not len(stay):
                continue
            first, last = b.first[stay], b.last[stay]
            owner = np.repeat(np.arange(len(b.sizes)), b.sizes)[first]
            zero = b.places[np.cumsum(b.sizes) - b.sizes][owner]
            spans = list(zip(first.tolist(), last.tolist(), strict=True))
            codes = b.u.tobytes()
            key = [b"\n".join(b.bare[x:y]) for x, y in spans] if whole else [codes[8 * x:8 * y] for x, y in spans]
            new = np.zeros(len(spans), np.int64) if whole else last - np.maximum(first, np.concatenate([[0], last[:-1]]))
            units = np.repeat(last - np.cumsum(new), new) + np.arange(new.sum())
            pairs = pa.StructArray.from_arrays([pa.array(b.u[units].view(np.int64)), pa.array([b.bare[x] for x in units.tolist()], pa.binary())], names=["u", "unit"])
            fresh = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(new)]).astype(np.int32)), pairs)
            at = pa.array(owner)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id").take(at), batch.column("tag").take(at), pa.array((b.places[first] - zero).astype(np.int32)),
                 pa.array((b.places[last] - zero).astype(np.int32)), pa.array(key, pa.binary()), fresh], names=["doc_id", "tag", "start", "end", "key", "fresh"])

    schema = T.StructType([docs.schema["doc_id"], T.StructField("tag", T.LongType()), T.StructField("start", T.IntegerType()),
                           T.StructField("end", T.IntegerType()), T.StructField("key", T.BinaryType()), T.StructField("fresh", _FRESH)])
    return docs.mapInArrow(run, schema)


def removals(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", bits: int | None = None, unit_bits: int = 64) -> DataFrame:
    """Per document with something to remove: doc_id, tag (hash of its text), chunks (their number), spans (start, end; bytes, in order, apart)."""
    spark = docs.sparkSession
    source = texts(docs, id_col, text_col)
    again = save(_again(source, unit_bits), "line-again")
    if bits is None:
        bits = min(MOST_BITS, max(LEAST_BITS, (CHUNK_BITS * max(1, again.count()) - 1).bit_length()))
    held = spark.sparkContext.broadcast(_filter(again, bits).tobytes())
    drop(again)
    tagged = source.withColumn("tag", F.xxhash64("body"))
    found = save(_places(tagged, held, bits, unit_bits, False), "line-places")
    units = found.select(F.explode("fresh").alias("f")).select("f.u", "f.unit").distinct()
    if units.groupBy("u").agg(F.count(F.lit(1)).alias("n")).where("n > 1").limit(1).count():
        found = save(_places(tagged, held, bits, unit_bits, True), "line-places")
    where = F.struct("doc_id", "tag", "start")
    every = found.groupBy("key").agg(F.count(F.lit(1)).alias("n"), F.min(where).alias("first")).where("n > 1").drop("n")
    cut = found.drop("fresh").join(save(every, "line-classes"), "key").where(~where.eqNullSafe(F.col("first")))
    spans = cut.groupBy("doc_id", "tag").agg(F.array_sort(F.collect_set(F.struct("start", "end"))).alias("spans"))
    return spans.select("doc_id", "tag", F.size("spans").alias("chunks"), _merged(F.col("spans")).alias("spans"))


def _merged(spans):
    """Chunks in order, none of them within a later one, as spans that neither meet nor overlap."""
    starts = F.filter(spans, lambda s, i: (i == 0) | (s["start"] > F.get(spans, i - 1)["end"]))
    ends = F.filter(spans, lambda s, i: (i == F.size(spans) - 1) | (s["end"] < F.get(spans, i + 1)["start"]))
    return F.zip_with(starts, ends, lambda a, b: F.struct(a["start"].alias("start"), b["end"].alias("end")))


def _without(body, spans):
    """What is left of a text, by native expressions: the parts between the spans."""
    none = F.array().cast("array<int>")
    starts = F.concat(F.array(F.lit(0)), F.coalesce(F.transform(spans, lambda s: s["end"]), none))
    ends = F.concat(F.coalesce(F.transform(spans, lambda s: s["start"]), none), F.array(F.octet_length(body)))
    parts = F.transform(F.arrays_zip(starts.alias("a"), ends.alias("b")),
                        lambda p: F.substring(body, p["a"] + 1, p["b"] - p["a"]).cast("string"))
    return F.array_join(parts, "")


def drop_repeated_chunks(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", bits: int | None = None,
                         counts: bool = False, unit_bits: int = 64) -> DataFrame:
    """The documents without repeated chunks; all columns. ``counts``: instead (doc_id, text, chunks_removed, bytes_removed)."""
    columns = docs.columns
    cut = removals(docs, id_col, text_col, bits, unit_bits)
    body = F.coalesce(F.col(text_col).cast("binary"), F.lit(b""))
    whole = docs.select(F.col(id_col).alias("key"), F.xxhash64(body).alias("text_tag"),
                        F.struct(*[F.col(f"`{c}`") for c in columns]).alias("row"))
    joined = whole.join(cut, whole["key"].eqNullSafe(cut["doc_id"]) & (whole["text_tag"] == cut["tag"]), "left")
    text = F.col("row").getField(text_col)
    clean = F.when(F.col("spans").isNull(), text).otherwise(_without(text.cast("binary"), F.col("spans")))
    if counts:
        gone = F.coalesce(F.aggregate("spans", F.lit(0), lambda a, s: a + s["end"] - s["start"]), F.lit(0))
        return joined.select(F.col("key").alias("doc_id"), clean.alias("text"),
                             F.coalesce("chunks", F.lit(0)).cast("long").alias("chunks_removed"), gone.cast("long").alias("bytes_removed"))
    return joined.select(*[clean.alias(c) if c == text_col else F.col("row").getField(c).alias(c) for c in columns])
