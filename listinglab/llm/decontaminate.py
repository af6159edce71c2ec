"""Operator 10: benchmark decontamination by word windows.

Texts are lower-cased (A-Z) and cut into words of ASCII letters, digits and
non-ASCII characters. Every run of ``n`` words of a benchmark item is a
window; an item with fewer words is one window of its own length.

Method. The windows become a hash set: each benchmark word gets a number, and
the rolling hash of a window is the sum of number powers. The set is packed
into one broadcast value per block of at most ``block_words`` benchmark words
(a proven bound: items are cut into blocks of that size before anything is
broadcast, a larger benchmark gives more blocks, each a scan of its own). A
scan of the documents maps words to numbers, hashes the token windows of a
text with numpy, looks them up in the sorted hashes, and verifies each hit by
comparing all words. Words that no item has get number 0, and no window with
such a word is looked up.

Edge cases. Null and empty texts have no words: nothing is hit, such items
have no windows. Equal windows of several items count for all of them. An item
with a null id marks words as hit, and counts under the id '' in the list.
Repeated item ids count once. Repeated document rows each get their row. Empty
tables: no rows, or no hits. Other columns are carried along unread.
"""

from __future__ import annotations

import pickle
import re
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from listinglab.llm.common import save, ship, slices, texts

WINDOW = 10
#: Benchmark words in one broadcast block; each takes some 500 bytes in a worker.
BLOCK_WORDS = 200_000

_SPACE = bytes(
    b if (0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A or b >= 0x80) else b + 32 if 0x41 <= b <= 0x5A else 0x20
    for b in range(256)
)


_WORD = re.compile(rb"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def words(body: bytes) -> list[bytes]:
    """Lower-cased words ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` of a text in UTF-8."""
    return body.translate(_SPACE).split()


def _mix(numbers: np.ndarray, length: int) -> np.ndarray:
    """Rolling hash of each run of ``length`` numbers."""
    runs = len(numbers) - length + 1
    total = np.zeros(runs, np.uint64)
    for k in range(length):
        total = total * np.uint64(0x9E3779B97F4A7C15) + numbers[k:k + runs].astype(np.uint64)
    return total


def _mix_rows(runs: np.ndarray) -> np.ndarray:
    """The same hash for one run per row."""
    total = np.zeros(len(runs), np.uint64)
    for column in runs.T:
        total = total * np.uint64(0x9E3779B97F4A7C15) + column.astype(np.uint64)
    return total


class WindowSet:
    """Windows of the items of one block, by length: sorted hashes, the words to verify, the items."""

    def __init__(self, items: list[tuple[str, bytes]], n: int):
        self.numbers: dict[bytes, int] = {}
        found: dict[int, dict[tuple[int, ...], set[str]]] = {}
        for item, body in items:
            own = [self.numbers.setdefault(w, len(self.numbers) + 1) for w in words(body)]
            if not own:
                continue
            size = min(n, len(own))
            at = found.setdefault(size, {})
            for i in range(len(own) - size + 1):
                at.setdefault(tuple(own[i:i + size]), set()).add(item)
        self.by_length = []
        for size, at in sorted(found.items()):
            runs = np.array(list(at), np.int64).reshape(len(at), size)
            hashes = _mix_rows(runs)
            order = np.argsort(hashes, kind="stable")
            owners = list(at.values())
            self.by_length.append((size, hashes[order], runs[order], [owners[i] for i in order]))

    def scan(self, own: list[bytes]) -> tuple[np.ndarray, set[str]]:
        """Which words are hit, and the items whose windows occur."""
        hit, items = np.zeros(len(own), bool), set()
        get = self.numbers.get
        numbers = np.fromiter((get(w, 0) for w in own), np.int64, len(own))
        known = np.concatenate([[0], np.cumsum(numbers > 0)])
        for size, hashes, runs, owners in self.by_length:
            if len(own) < size:
                continue
            starts = np.flatnonzero(known[size:] - known[:-size] == size)
            if not len(starts):
                continue
            mixed = _mix(numbers, size)[starts]
            left, right = np.searchsorted(hashes, mixed), np.searchsorted(hashes, mixed, side="right")
            while len(at := np.flatnonzero(left < right)):  # equal hashes stand side by side: try each
                same = (runs[left[at]] == numbers[starts[at][:, None] + np.arange(size)]).all(axis=1)
                for k in at[same]:
                    hit[starts[k]:starts[k] + size] = True
                    items.update(owners[left[k]])
                left[at] += 1
        return hit, items


#: What a scan adds to each row.
_ADDED = [T.StructField("n_words", T.LongType()), T.StructField("n_hit", T.LongType()),
          T.StructField("runs", T.ArrayType(T.IntegerType())), T.StructField("items", T.ArrayType(T.StringType()))]
_ARROW = [pa.int64(), pa.int64(), pa.list_(pa.int32()), pa.list_(pa.string())]


def _runs(hit: np.ndarray) -> list[int]:
    """start, end, start, end ... of the hit words."""
    edge = np.flatnonzero(np.diff(np.concatenate([[0], hit.view(np.int8), [0]])))
    return edge.tolist()


def _blocks(bench: DataFrame, id_col: str, text_col: str, n: int, block_words: int) -> Iterator[list[tuple[str, bytes]]]:
    """Items in blocks of bounded size, streamed partition by partition from a written table."""
    rows = bench.select(F.coalesce(F.col(id_col).cast("string"), F.lit("")).alias("item"),
                        F.coalesce(F.col(text_col).cast("binary"), F.lit(b"")).alias("body"))
    block, size = [], 0
    for row in rows.toLocalIterator():
        own = words(bytes(row.body))
        # A long item is cut into pieces that overlap by n - 1 words: the same windows, in bounded blocks.
        step = max(1, block_words - n + 1)
        for start in range(0, max(1, len(own) - n + 1), step):
            piece = own[start:start + step + n - 1]
            if block and size + len(piece) > block_words:
                yield block
                block, size = [], 0
            block.append((row.item, b" ".join(piece)))
            size += len(piece)
    yield block


def _scans(rows: DataFrame, bench: DataFrame, scanner, item_col: str, n: int, block_words: int) -> DataFrame:
    """Apply ``scanner(windows, batch)`` for each block of windows in turn; the rows go from one to the next."""
    for number, block in enumerate(_blocks(bench, item_col, "text", n, block_words)):
        if number and number % 4 == 0:  # four blocks in Python workers at a time
            rows = save(rows, "windows")
        held = rows.sparkSession.sparkContext.broadcast(pickle.dumps(WindowSet(block, n)))

        def run(batches: Iterable[pa.RecordBatch], held=held) -> Iterator[pa.RecordBatch]:
            windows = pickle.loads(held.value)
            for batch in slices(batches):
                yield scanner(windows, batch)

        rows = rows.mapInArrow(run, rows.schema)
    return rows


def _find(windows: WindowSet, batch: pa.RecordBatch) -> pa.RecordBatch:
    out = []
    before = zip(batch.column("runs").to_pylist(), batch.column("items").to_pylist(), strict=True)
    for body, (runs, items) in zip(batch.column("body").to_pylist(), before, strict=True):
        own = words(body)
        hit, found = windows.scan(own)
        for start, end in zip(runs[::2], runs[1::2], strict=True):
            hit[start:end] = True
        out.append((len(own), int(hit.sum()), _runs(hit), sorted(found.union(items))))
    added = [pa.array(c, t) for c, t in zip(zip(*out, strict=True), _ARROW, strict=True)]
    return pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("body"), *added],
                                      names=["doc_id", "body", *[f.name for f in _ADDED]])


def scan(docs: DataFrame, bench: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id",
         n: int = WINDOW, block_words: int = BLOCK_WORDS) -> DataFrame:
    """Per row: doc_id, n_words, n_hit, runs (start, end of hit words, flat), items (ids, sorted as strings)."""
    empty = [F.lit(None if "n_" in f.name else []).cast(f.dataType).alias(f.name) for f in _ADDED]
    found = _scans(texts(docs, id_col, text_col, *empty), bench, _find, item_col, n, block_words)
    return found.drop("body")


def contamination(docs: DataFrame, bench: DataFrame, n: int = WINDOW, block_words: int = BLOCK_WORDS) -> DataFrame:
    """Per document: doc_id, n_words, n_hit, n_items, items_sha256, contaminated."""
    return scan(docs, bench, n=n, block_words=block_words).select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", "items"), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"))


def _cut(body: bytes, hit: np.ndarray) -> bytes:
    """The text without its hit runs; a line end stands where one was."""
    spans = [m.span() for m in _WORD.finditer(body)]
    out, at = [], 0
    for start, end in zip(*[iter(_runs(hit))] * 2, strict=True):
        out.append(body[at:spans[start][0]].rstrip(b" "))
        at = spans[end - 1][1]
    return b"\n".join([*out, body[at:].lstrip(b" ")])


def remove(docs: DataFrame, bench: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id",
           n: int = WINDOW, mode: str = "spans", block_words: int = BLOCK_WORDS) -> DataFrame:
    """The documents without benchmark passages; whole rows, all columns.

    ``spans`` cuts the hit words out of the text and drops a document of which no
    word is left; ``documents`` drops every document with a hit. Rows without a
    hit stay as they are, a null text included."""
    ship(docs.sparkSession)
    columns = docs.columns
    at = columns.index(text_col)

    def clean(windows: WindowSet, batch: pa.RecordBatch) -> pa.RecordBatch:
        bodies = batch.column(at).cast(pa.binary()).to_pylist()
        new = {}
        for k, body in enumerate(bodies):
            while body and (hit := windows.scan(words(body))[0]).any():  # again, as the parts that now meet may hit
                new[k] = body = b"" if mode == "documents" else _cut(body, hit)
        if not new:
            return batch
        stay = [k not in new or bool(words(new[k])) for k in range(len(bodies))]
        text = pa.array([new.get(k, b) for k, b in enumerate(bodies)], pa.binary()).cast(batch.schema.field(at).type)
        return batch.set_column(at, batch.schema.field(at), text).filter(pa.array(stay))

    plain = docs.toDF(*[f"c{i}" for i in range(len(columns))])
    return _scans(plain, bench, clean, item_col, n, block_words).toDF(*columns)
