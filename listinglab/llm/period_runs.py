"""Operator 12: periodic runs of words (maximal stretches that repeat with one period).

A run is a stretch of consecutive words with smallest period q and at least
``max(LEAST, TIMES * q)`` words that cannot be made longer at either end.

Method: seed and extend on diagonals, within each document.

* Seeds. In a run of period q the words at x and x + q are equal over a
  diagonal of ``max(LEAST, TIMES q) - q`` words or more, which is never under
  ``GRAM`` = 16: every run holds a 16-gram that occurs again q words later. The
  16-grams of a document are indexed by a hash (sorted by gram and place).
* Pairs. For lags of 2^t to 2^(t+1) - 1, from 16 on, a diagonal has 2q - 15 or
  more such grams in a row, more than 2^t: it is enough to look from every
  2^t-th place. So each doubling of the lag gives at most one pair a word
  however often a gram occurs, and no gram needs a cap. Lags below 16 are looked
  up from every place.
* Extension. Lags go up. The seeds of a lag are taken from left to right; each
  extends to both sides on the words themselves, and the end it reaches is the
  furthest covered place of that lag: seeds before it are skipped. Seeds inside
  a run whose period divides the lag are skipped too, as their stretch has that
  smaller period.

A hash that collides gives a seed that extends to nothing; no run is lost.

Plan. One scan, no shuffle: a task holds one document at a time, its words as
integers. Whole texts are read.

Edge cases. A null text counts as empty and has no run: zero runs, four nulls,
hashes of the empty string. Rows with a null id and repeated rows each get
their row. An empty table gives an empty result. Words are split at ASCII white
space alone. Other columns are not read.
"""

from __future__ import annotations

import bisect
import hashlib
from collections import defaultdict
from collections.abc import Callable, Iterable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from listinglab.llm.common import slices, texts

#: Least words of a run, and least repetitions of its period.
LEAST, TIMES = 24, 3
#: Least of max(LEAST, TIMES q) - q over all q: q = 8 gives 24 - 8 and 2 * 8.
GRAM = 16

_MIX = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB))
#: Odd multipliers, one for each doubling of the gram.
_STEP = tuple(np.uint64(k) for k in (0xD6E8FEB86659FD93, 0xA0761D6478BD642F, 0xE7037ED1A0B428DB, 0x8EBC6AF09C88C6E3))


class Run(NamedTuple):
    start: int
    length: int
    period: int


def _grams(codes: np.ndarray) -> np.ndarray:
    """A 64-bit hash of the 16 words from each place on."""
    h = (codes.astype(np.uint64) + np.uint64(1)) * _MIX[0]
    h = (h ^ (h >> np.uint64(30))) * _MIX[1]
    h = (h ^ (h >> np.uint64(27))) * _MIX[2]
    h ^= h >> np.uint64(31)
    width = 1
    for step in _STEP:
        h = h[:-width] * step + h[width:]
        h ^= h >> np.uint64(29)
        width *= 2
    return h


def _pairs(codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Lags and places of the seeds, by lag and then place."""
    n = len(codes)
    grams = _grams(codes)
    order = np.argsort(grams, kind="stable")
    sorted_grams = grams[order]
    new = np.empty(len(order), bool)
    new[:1] = True
    np.not_equal(sorted_grams[1:], sorted_grams[:-1], out=new[1:])
    if new.all():
        return np.empty(0, np.int64), np.empty(0, np.int64)
    name = np.cumsum(new) - 1
    #: Gram and place in one number, in sorted order; and the gram of each place.
    key = name * np.int64(n + 1) + order
    of = np.empty(len(order), np.int64)
    of[order] = name
    # A gram that occurs once has no pair.
    often = np.bincount(name)[of] > 1
    lags, places = [], []
    low = 1
    while low * TIMES <= n:
        if low < GRAM:
            least, most, stride = 1, GRAM - 1, 1
        else:
            least, most, stride = low, 2 * low - 1, low
        at = np.arange(0, len(of), stride)
        at = at[often[at]]
        base = of[at] * np.int64(n + 1) + at
        first = np.searchsorted(key, base + least)
        count = np.searchsorted(key, np.minimum(base + most, (of[at] + 1) * np.int64(n + 1) - 1), side="right") - first
        count = np.maximum(count, 0)
        total = int(count.sum())
        if total:
            begin = np.repeat(first - (np.cumsum(count) - count), count) + np.arange(total)
            from_ = np.repeat(at, count)
            lags.append(order[begin] - from_)
            places.append(from_)
        low = GRAM if low < GRAM else 2 * low
    if not lags:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    lag, place = np.concatenate(lags), np.concatenate(places)
    fits = lag * TIMES <= n
    lag, place = lag[fits], place[fits]
    by = np.lexsort((place, lag))
    return lag[by], place[by]


def _equal_ahead(a: np.ndarray, b: np.ndarray) -> int:
    """How many entries agree from the start on."""
    most, done, step = min(len(a), len(b)), 0, 32
    while done < most:
        end = min(most, done + step)
        differ = a[done:end] != b[done:end]
        where = int(differ.argmax())
        if differ[where]:
            return done + where
        done, step = end, step * 4
    return most


def find_runs(codes: np.ndarray) -> list[Run]:
    """All runs of a sequence of integers, by start and then period."""
    n = len(codes)
    if n < LEAST:
        return []
    lags, places = _pairs(codes)
    if not len(lags):
        return []
    found: dict[int, list[tuple[int, int]]] = {}
    cuts = np.flatnonzero(np.diff(lags)) + 1
    for own in np.split(np.arange(len(lags)), cuts):
        lag = int(lags[own[0]])
        seeds = places[own]
        divisors = [q for q in found if lag % q == 0]
        k, covered = 0, 0
        while k < len(seeds):
            i = int(seeds[k])
            past = 0
            for q in divisors:
                runs = found[q]
                r = bisect.bisect_right(runs, (i, n + 1)) - 1
                if r >= 0 and runs[r][1] >= i + lag:
                    past = max(past, runs[r][1] - lag + 1)
            if past > i:
                k += int(np.searchsorted(seeds[k:], past))
                continue
            ahead = _equal_ahead(codes[i:n - lag], codes[i + lag:])
            back = _equal_ahead(codes[covered:i][::-1], codes[covered + lag:i + lag][::-1])
            start, end = i - back, i + ahead
            if end - start + lag >= max(LEAST, TIMES * lag):
                found.setdefault(lag, []).append((start, end + lag))
            # Places up to the mismatch are settled for this lag.
            covered = end + 1 if ahead else covered
            k += max(1, int(np.searchsorted(seeds[k:], covered)))
    return sorted(Run(s, e - s, q) for q, runs in found.items() for s, e in runs)


def codes_of(words: list[bytes]) -> np.ndarray:
    """Words as integers, equal for equal words."""
    names: defaultdict[bytes, int] = defaultdict()
    names.default_factory = names.__len__
    return np.fromiter(map(names.__getitem__, words), np.int64, len(words))


def kept_words(words: list[bytes], runs: list[Run]) -> list[bytes]:
    """The words without those that a run holds after its first period."""
    if not runs:
        return words
    drop = np.zeros(len(words) + 1, np.int64)
    for start, length, period in runs:
        drop[start + period] += 1
        drop[start + length] -= 1
    return [words[k] for k in np.flatnonzero(np.cumsum(drop[:-1]) == 0).tolist()]


def strongest(runs: list[Run]) -> Run | None:
    """The run with the greatest length / period; of equal ones the first, then the shortest period."""
    best = None
    for run in runs:
        if best is None or run.length * best.period > best.length * run.period:
            best = run
    return best


RUN = T.StructType([T.StructField(c, T.LongType()) for c in Run._fields])


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", *, collapsed: bool = True,
         prepare: Callable[[object, list[bytes]], list[bytes]] | None = None) -> DataFrame:
    """(doc_id, runs, collapsed): every run of each text, and the text without repeated periods.

    ``prepare`` may change the words of a document (id, words) before the search."""
    rows = texts(docs, id_col, text_col)
    schema = T.StructType([T.StructField("doc_id", rows.schema["doc_id"].dataType), T.StructField("runs", T.ArrayType(RUN)),
                           *([T.StructField("collapsed", T.StringType())] if collapsed else [])])

    def search(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            runs, texts_out = [], []
            for key, body in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                words = body.as_py().split()
                if prepare:
                    words = prepare(key, words)
                own = find_runs(codes_of(words))
                runs.append([r._asdict() for r in own])
                if collapsed:
                    texts_out.append(b" ".join(kept_words(words, own)))
            yield _batch(batch.column(0), runs, texts_out if collapsed else None)

    return rows.mapInArrow(search, schema)


_ARROW_RUNS = pa.list_(pa.struct([(c, pa.int64()) for c in Run._fields]))


def _batch(ids: pa.Array, runs: list, collapsed: list[bytes] | None) -> pa.RecordBatch:
    arrays, names = [ids, pa.array(runs, _ARROW_RUNS)], ["doc_id", "runs"]
    if collapsed is not None:
        arrays.append(pa.array(collapsed, pa.binary()).cast(pa.string()))
        names.append("collapsed")
    return pa.RecordBatch.from_arrays(arrays, names)
