"""Operator 1: toxicity of texts after noisy-channel deobfuscation.

Restoring. A token that mixes letters with digits and symbols, repeats a
letter three times and more, or is a row of single characters between blanks
is read as the noisy form of a word. Its lattice holds, for each run of equal
characters, what may have been meant: the letters that a digit or symbol
stands for, one or two copies of a repeated letter, a separator left out or
taken for a word's end, each with a channel cost. Viterbi decoding over the
last two letters finds the path with the least channel cost plus negative
log-probability under a character trigram model. Tokens that merely double a
letter are decoded where their collapsed form speaks for toxicity.

Scoring. Features are the 4- to 6-grams of a text's plain and restored words
with their ends marked; a logistic regression on their presence gives the
score. Plain words are never taken away.

Learning. The character model counts the trigrams of all documents (28
symbols: at most 21,952 sums whatever the input). The classifier is fitted on
a bounded sample of labelled rows: at most ``FIT_ROWS``, half of each label,
by a hash of the id; its intercept is set back to the label's share among all
labelled rows. Document counts of the sample's grams are summed by Spark, the
``FEATURES`` grams of the highest G-square stay, and the regression on them is
fitted in numpy on the driver (at most FIT_ROWS rows of feature numbers).
Only text and label enter it.

Edge cases. Null and empty texts have no features and get the intercept's
score. Of repeated labels of an id the largest holds; null labels are left
out. Without a label of each kind the score is the share of label 1 (0 when
there is none). Rows with a null id have no label, are scored, and stay in
``drop_toxic`` as their score says. Repeated rows each get their row. Empty
tables give empty results.
"""

from __future__ import annotations

import pickle
import re
import unicodedata
from collections.abc import Iterable, Iterator
from itertools import groupby
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from listinglab.llm.chargrams import Grams, find, letter_runs
from listinglab.llm.common import bucket, save, ship, slices, texts

FIT_ROWS, FEATURES, SHORT, LONG = 6000, 20_000, 4, 6
#: Grams of fewer sample documents, or of a lower G-square, are no features.
MIN_DOCUMENTS, MIN_G2 = 3, 12.0
#: Different tokens that a worker holds.
HELD_TOKENS = 200_000

# What digits and symbols stand for in letters.
LEET = {"0": "o", "1": "il", "2": "z", "3": "e", "4": "a", "5": "s", "6": "bg", "7": "t", "8": "b", "9": "g", "@": "a", "$": "s",
        "!": "il", "|": "il", "+": "t", "(": "c", "<": "c", "€": "e", "£": "l", "§": "s", "µ": "u"}
SEPARATORS = " .-_*~'`·,:;/\\=^\"#%&"
# Channel costs in natural-log units.
COST_LEET, COST_REPEAT, COST_DROP, COST_JOIN, COST_END, COST_WILD, COST_FOLD = 1.0, 0.7, 4.0, 0.3, 2.0, 1.0, 1.0
# A symbol that can be a letter is seldom noise, a mask seldom a mere separator, and a letter written twice is mostly meant twice.
COST_LOST, COST_MASK, COST_SINGLE = 9.0, 5.0, 1.6

_SYMBOLS = 28
_CLASS = np.full(256, 27, np.uint8)
_CLASS[:128] = 0
_CLASS[97:123] = np.arange(1, 27)
_AROUND = ".,;:?)(\"'[]{}<>…«»“”’"
_TAIL = re.compile(r"(?:[^\w\s]{3,}|!+|\?+)$")
_THRICE = re.compile(r"([^\W\d_])\1\1")
_DOUBLE = re.compile(r"([^\W\d_])\1+")


def symbol(char: str) -> int:
    return ord(char) - 96 if "a" <= char <= "z" else 0 if char == " " else 27


class CharModel:
    """Negative log-probability of a symbol after two others; a word's end forgets what was before it."""

    def __init__(self, counts: np.ndarray):
        cells = counts.reshape(_SYMBOLS, _SYMBOLS, _SYMBOLS).astype(np.float64)
        pairs = cells.sum(axis=0) + 0.5
        short = pairs / pairs.sum(axis=1, keepdims=True)
        weight = 5.0
        self.cost = -np.log((cells + weight * short[None]) / (cells.sum(axis=2, keepdims=True) + weight))
        self.list = self.cost.tolist()


def char_counts(docs: DataFrame) -> np.ndarray:
    """Trigram counts of all texts, as one flat table."""
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros(_SYMBOLS ** 3, np.int64)
        for batch in slices(batches):
            body = np.frombuffer(b" ".join([b"", *batch.column("body").to_pylist(), b""]).lower(), np.uint8)
            s = _CLASS[body[(body & 0xC0) != 0x80]].astype(np.int32)
            if len(s) > 2:
                s = s[np.concatenate([[True], (s[1:] > 0) | (s[:-1] > 0)])]  # one end between words
                first = np.where(s[1:-1] > 0, s[:-2], 0)
                sums += np.bincount((first * _SYMBOLS + s[1:-1]) * _SYMBOLS + s[2:], minlength=_SYMBOLS ** 3)
        cells = np.flatnonzero(sums)
        yield pa.RecordBatch.from_arrays([pa.array(cells.astype(np.int32)), pa.array(sums[cells])], names=["cell", "n"])

    out = np.zeros(_SYMBOLS ** 3, np.int64)
    for row in docs.select("body").mapInArrow(run, "cell int, n long").groupBy("cell").agg(F.sum("n").alias("n")).collect():
        out[row.cell] = row.n
    return out


def _alternatives(char: str, times: int, spaced: bool) -> list[tuple[str, float]]:
    """What a run of a character may have been: (letters, cost)."""
    out: list[tuple[str, float]] = []
    if char.isalpha():
        base = unicodedata.normalize("NFKD", char)[0]
        for c, cost in ((char, 0.0), *(((base, COST_FOLD),) if base != char and "a" <= base <= "z" else ())):
            out.append((c, cost + (0.0, COST_SINGLE, COST_REPEAT)[min(times, 3) - 1]))
            if times > 1:
                out.append((c * 2, cost + (COST_REPEAT if times > 2 else 0)))
    for c in LEET.get(char, ""):
        out.append((c, COST_LEET))
        if times > 1:
            out.append((c * 2, COST_LEET))
    if char in SEPARATORS:
        out += [("", COST_MASK if char == "*" else COST_JOIN), (" ", COST_END)]
        if char == "*":
            out += [(chr(97 + k) * times, COST_WILD) for k in range(26)]
    elif not char.isalpha():
        lost = COST_LOST if char in LEET else COST_DROP
        out += [("", lost), (" ", lost)]
    if spaced:
        out += [(" " + s, cost + COST_END) for s, cost in out if s.strip()]
    return out


def decode(token: str, model: CharModel, spaced: bool = False) -> list[str]:
    """The words that a token most probably stands for."""
    best: dict[tuple[int, int], tuple[float, tuple]] = {(0, 0): (0.0, ())}
    cost_of = model.list
    # Masks next to each other are a letter each.
    for (char, _), run in groupby(enumerate(token), lambda e: (e[1], e[0] if e[1] == "*" else -1)):
        options = [(s, [symbol(c) for c in s], c) for s, c in _alternatives(char, sum(1 for _ in run), spaced)]
        after: dict[tuple[int, int], tuple[float, tuple]] = {}
        for (a, b), (cost, path) in best.items():
            for text, symbols, own in options:
                x, y, total = a, b, cost + own
                for s in symbols:
                    if not (s == y == 0):
                        total += cost_of[x][y][s]
                    x, y = (y if s else 0), s
                if total < after.get((x, y), _WORST)[0]:
                    after[x, y] = (total, (path, text))
        best = after
    end = min(best.items(), key=lambda e: (e[1][0] + (cost_of[e[0][0]][e[0][1]][0] if e[0][1] else 0), e[0]))
    parts, path = [], end[1][1]
    while path:
        path, text = path
        parts.append(text)
    return "".join(reversed(parts)).split()


_WORST = (float("inf"), ())


def suspicious(token: str) -> str | None:
    """The core of a token that may be a word in disguise."""
    core = _TAIL.sub("", token).strip(_AROUND)
    if core.isalpha():
        return core if _THRICE.search(core) else None
    letters = sum(map(str.isalpha, core))
    # A mask stands for a letter; in front of one, and behind none of the stripped noise.
    return core if letters and letters + sum(c in LEET or c == "*" for c in core) >= 3 else None


def plainer(token: str) -> str | None:
    """What a token looks like without doubled letters and accents, or read as symbols for letters; none when that is the token itself."""
    core = token.strip(_AROUND)
    if not any(map(str.isalpha, core)):
        told = len(core) >= 3 and not core.isdigit() and all(c in LEET for c in core)
        return "".join(LEET[c][0] for c in core) if told else None
    folded = core if core.isascii() else "".join(c for c in unicodedata.normalize("NFKD", core) if not unicodedata.combining(c))
    folded = _DOUBLE.sub(r"\1", folded)
    return folded if folded != core else None


class Model(NamedTuple):
    counts: np.ndarray
    features: np.ndarray
    weights: np.ndarray
    bias: float


class _Reader:
    """A worker's view: tokens to features, with the tokens it has seen kept (a bounded number)."""

    def __init__(self, chars: CharModel, features: np.ndarray | None, weights: np.ndarray | None = None):
        self.chars, self.features, self.weights = chars, features, weights
        self.known: dict[str, tuple[int, ...] | None] = {}

    @staticmethod
    def _tokens(body: bytes) -> list[str]:
        own = body.decode("utf-8", "replace").lower().split()
        if sum(map((1).__eq__, map(len, own))) >= 3:
            single = np.fromiter(map(len, own), np.int64, len(own)) == 1
            edge = np.flatnonzero(np.diff(np.concatenate([[0], single.view(np.int8), [0]])))
            own += ["\x00" + "".join(own[a:b]) for a, b in zip(edge[::2].tolist(), edge[1::2].tolist(), strict=True) if b - a >= 3]
        return own

    def _words(self, token: str) -> list[str]:
        if token.startswith("\x00"):
            return [*decode(token[1:], self.chars, spaced=True), *letter_runs(token[1:])]
        if token.isalpha() and not _THRICE.search(token):
            return [token]
        words = letter_runs(token)
        if core := suspicious(token):
            words += decode(core, self.chars)
        return words

    def _grams(self, words: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(word, feature) pairs; a feature is its hash where none are chosen yet."""
        g = Grams(words, LONG)
        for m in range(SHORT, LONG + 1):
            at = g.at(m)
            value = g.hash[m][at] + np.uint64(m)
            if self.features is None:
                yield g.owner[at], value
            else:
                place, is_one = find(self.features, value)
                yield g.owner[at[is_one]], place[is_one]

    def _pairs(self, words: list[list[str]]) -> tuple[np.ndarray, np.ndarray]:
        """(number of the list, feature) pairs of lists of words."""
        owner = np.repeat(np.arange(len(words)), [len(w) for w in words])
        flat = [w for own in words for w in own]
        if not flat:
            return np.empty(0, np.int64), np.empty(0, np.int64)
        found = list(self._grams(flat))
        return owner[np.concatenate([a for a, _ in found])], np.concatenate([b for _, b in found])

    def _learn(self, new: list[str]) -> None:
        words = [self._words(t) for t in new]
        at, feature = self._pairs(words)
        if self.weights is not None:
            # Doubled letters, accents and symbols alone: where the plainer word weighs more, the lattice decides.
            other = {k: p for k, t in enumerate(new) if not t.startswith("\x00") and (p := plainer(t))}
            double = list(other)
            plain = np.bincount(at, self.weights[feature], len(new))
            at2, feature2 = self._pairs([letter_runs(other[k]) for k in double])
            more = np.bincount(at2, self.weights[feature2], len(double)) - plain[double] if double else np.empty(0)
            if len(again := [double[k] for k in np.flatnonzero(more > 1)]):
                for k in again:
                    core = new[k].strip(_AROUND)
                    # Symbols alone hold no letter that could confirm another reading.
                    words[k] = words[k] + ([other[k]] if not any(map(str.isalpha, core)) else decode(core, self.chars))
                at, feature = self._pairs(words)
        self.known.update(dict.fromkeys(new))
        if not len(at):
            return
        order = np.lexsort((feature, at))
        at, feature = at[order], feature[order]
        tokens, cut = np.unique(at, return_index=True)
        for k, part in zip(tokens.tolist(), np.split(feature, cut[1:]), strict=True):
            self.known[new[k]] = tuple(dict.fromkeys(part.tolist()))

    def features_of(self, bodies: list[bytes]) -> list[np.ndarray]:
        """The different features of each text."""
        if len(self.known) > HELD_TOKENS:
            self.known.clear()
        own = [self._tokens(b) for b in bodies]
        new = list({t for tokens in own for t in tokens if t not in self.known})
        if new:
            self._learn(new)
        get = self.known.__getitem__
        kind = np.uint64 if self.features is None else np.int64
        return [np.array(sorted({f for found in set(map(get, tokens)) if found for f in found}), kind) for tokens in own]


def _sample(docs: DataFrame, labels: DataFrame, label: str, rows: int) -> tuple[DataFrame, float]:
    """(body, y) of the rows to fit on, and the share of label 1 among all labelled rows. ``labels``: (doc_id, label)."""
    each = labels.where(F.col("doc_id").isNotNull() & F.col(label).isNotNull()).groupBy("doc_id").agg(F.max(label).cast("int").alias("y"))
    shares = {r.y: r.n for r in each.groupBy("y").agg(F.count(F.lit(1)).alias("n")).collect()}
    if not all(shares.get(y) for y in (0, 1)):
        return docs.limit(0).select("body", F.lit(0).alias("y")), 1.0 if shares.get(1) else 0.0
    some = [each.where(F.col("y") == y).orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows // 2) for y in (0, 1)]
    chosen = F.broadcast(some[0].unionByName(some[1]))  # at most FIT_ROWS ids and labels
    found = docs.join(chosen, "doc_id").select("body", "y").limit(2 * rows)
    return found, shares[1] / (shares[0] + shares[1])


def _document_counts(sample: DataFrame, counts: np.ndarray) -> DataFrame:
    """(gram, one, zero): documents of each label that have the gram."""
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = _Reader(CharModel(counts), None)
        for batch in slices(batches):
            found = reader.features_of(batch.column("body").to_pylist())
            y = np.repeat(np.array(batch.column("y").to_pylist(), np.int64), [len(f) for f in found])
            gram, back = np.unique(np.concatenate(found), return_inverse=True)
            one = np.bincount(back, y, len(gram)).astype(np.int64)
            zero = np.bincount(back, 1 - y, len(gram)).astype(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(gram.view(np.int64)), pa.array(one), pa.array(zero)], names=["gram", "one", "zero"])

    return sample.mapInArrow(run, "gram long, one long, zero long").groupBy("gram").agg(F.sum("one").alias("one"), F.sum("zero").alias("zero"))


def _g_square(one: float, zero: float) -> Column:
    """How far a gram's documents depart from the labels' shares."""
    total = one + zero
    has = F.col("one") + F.col("zero")
    parts = [(F.col("one"), has * one / total), (F.col("zero"), has * zero / total),
             (F.lit(one) - F.col("one"), (F.lit(total) - has) * one / total), (F.lit(zero) - F.col("zero"), (F.lit(total) - has) * zero / total)]
    return 2 * sum((F.when(o > 0, o * F.log(o / e)).otherwise(0.0) for o, e in parts), F.lit(0.0))


def fit_logistic(rows: list[np.ndarray], y: np.ndarray, features: int, ridge: float = 1.0, steps: int = 300) -> tuple[np.ndarray, float]:
    """Weights and intercept of a ridge logistic regression on the presence of features (Adam on all rows)."""
    row = np.repeat(np.arange(len(rows)), [len(r) for r in rows])
    column = np.concatenate(rows) if rows else np.empty(0, np.int64)
    w = np.zeros(features + 1)
    w[-1] = np.log((y.sum() + 0.5) / (len(y) - y.sum() + 0.5))
    first, second = np.zeros_like(w), np.zeros_like(w)
    for step in range(1, steps + 1):
        p = 1 / (1 + np.exp(-np.clip(np.bincount(row, w[column], len(rows)) + w[-1], -30, 30)))
        slope = np.append(np.bincount(column, (p - y)[row], features) + ridge * w[:-1], (p - y).sum())
        first += 0.1 * (slope - first)
        second += 0.01 * (slope * slope - second)
        w -= 0.05 * (first / (1 - 0.9 ** step)) / (np.sqrt(second / (1 - 0.99 ** step)) + 1e-8)
    return w[:-1], float(w[-1])


def fit(docs: DataFrame, labels: DataFrame, label: str = "toxic", rows: int = FIT_ROWS, features: int = FEATURES) -> Model:
    """From docs (doc_id, body) and labels (doc_id, label), both without what is held out of the fit."""
    counts = char_counts(docs)
    found, share = _sample(docs, labels, label, rows)
    # A few thousand rows of one or two files: dealt over the cores, as reading them takes time.
    sample = save(found.repartition(max(1, docs.sparkSession.sparkContext.defaultParallelism)), "toxic-sample")
    sizes = {r.y: r.n for r in sample.groupBy("y").agg(F.count(F.lit(1)).alias("n")).collect()}
    if not all(sizes.get(y) for y in (0, 1)):
        return Model(counts, np.empty(0, np.uint64), np.empty(0), float(np.log(share / (1 - share))) if 0 < share < 1 else (-30.0, 30.0)[share >= 1])
    scored = _document_counts(sample, counts).where(F.col("one") + F.col("zero") >= MIN_DOCUMENTS).withColumn(
        "g2", _g_square(float(sizes[1]), float(sizes[0]))).where(F.col("g2") >= MIN_G2)
    grams = scored.orderBy(F.col("g2").desc(), "gram").limit(features).select("gram").toArrow()["gram"].to_numpy()
    chosen = np.sort(np.ascontiguousarray(grams).view(np.uint64))
    held = docs.sparkSession.sparkContext.broadcast(pickle.dumps((counts, chosen)))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chars, keys = pickle.loads(held.value)
        reader = _Reader(CharModel(chars), keys)
        for batch in slices(batches):
            ids = [f.tolist() for f in reader.features_of(batch.column("body").to_pylist())]
            yield pa.RecordBatch.from_arrays([batch.column("y"), pa.array(ids, pa.list_(pa.int32()))], names=["y", "ids"])

    got = sample.mapInArrow(run, "y int, ids array<int>").toArrow()
    rows_ = [np.array(x, np.int64) for x in got["ids"].to_pylist()]
    y = got["y"].to_numpy().astype(np.float64)
    weights, bias = fit_logistic(rows_, y, len(chosen))
    bias += float(np.log(share / (1 - share)) - np.log(sizes[1] / sizes[0]))
    return Model(counts, chosen, weights, bias)


def score(docs: DataFrame, model: Model) -> DataFrame:
    """From docs (body and any other columns), the other columns and score."""
    ship(docs.sparkSession)
    held = docs.sparkSession.sparkContext.broadcast(pickle.dumps(model))
    at = docs.columns.index("body")

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m: Model = pickle.loads(held.value)
        reader = _Reader(CharModel(m.counts), m.features, m.weights)
        for batch in slices(batches):
            found = reader.features_of(batch.column(at).to_pylist())
            z = np.array([m.weights[f].sum() + m.bias for f in found])
            yield batch.remove_column(at).append_column("score", pa.array(1 / (1 + np.exp(-np.clip(z, -30, 30)))))

    schema = T.StructType([*[f for f in docs.schema if f.name != "body"], T.StructField("score", T.DoubleType())])
    return docs.mapInArrow(run, schema)


def score_documents(docs: DataFrame, labels: DataFrame, held_out: Column, id_col: str = "doc_id", text_col: str = "text",
                    label: str = "toxic", rows: int = FIT_ROWS) -> DataFrame:
    """Per row: doc_id, held_out, score, predicted. Labels of held-out ids are not read."""
    source = texts(docs, id_col, text_col, held_out.alias("held_out"))
    mine = labels.withColumn("__out", held_out).where("NOT __out").select(F.col(id_col).alias("doc_id"), label)
    model = fit(source.select("doc_id", "body"), mine, label, rows)
    return score(source, model).select("doc_id", "held_out", "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def drop_toxic(docs: DataFrame, labels: DataFrame, held_out: Column, id_col: str = "doc_id", text_col: str = "text",
               label: str = "toxic", rows: int = FIT_ROWS, limit: float = 0.5) -> DataFrame:
    """The documents whose score is below ``limit``; whole rows, all columns."""
    source = texts(docs, id_col, text_col)
    mine = labels.withColumn("__out", held_out).where("NOT __out").select(F.col(id_col).alias("doc_id"), label)
    model = fit(source, mine, label, rows)
    columns = docs.columns
    plain = docs.toDF(*[f"c{k}" for k in range(len(columns))])
    body = F.coalesce(F.col(f"c{columns.index(text_col)}").cast("binary"), F.lit(b""))
    return score(plain.withColumn("body", body), model).where(F.col("score") < limit).drop("score").toDF(*columns)


def fold(id_col: str = "doc_id") -> Column:
    """Held out: crc32 of the id as text is 0 modulo 5."""
    return bucket(id_col, 5) == 0
