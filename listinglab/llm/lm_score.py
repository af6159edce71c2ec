"""Operator 2: language-model scoring with a log-bilinear model.

Tokens are the words of a text, A-Z lower-cased, then one end. The model
predicts the class of the next token: one of the ``SHORTLIST`` most frequent
words, "rare" for any other word, or the end. A context is the last shortlist
word before the token, or the start of the text, and whether rare words stand
between; it has a vector, as each class has, and a class's score is their
product plus the class's bias (log-bilinear). Rare words share their class's
probability by absolute discounting of their counts, and what the discount
frees goes to all unknown words together. So the probabilities of the known
words, the unknown word and the end add up to one in each context.

Training. All training texts count: Spark sums the words' counts, and the
counts of each (context, class) pair, combined in each task before the
shuffle; there are at most 2 (SHORTLIST + 1) (SHORTLIST + 2) pairs at any
input size. From these the vectors are fitted in numpy by noise-contrastive
estimation, with words of the unigram distribution as noise: the expected
loss over all data and noise pairs, a matrix product per step.

Scoring. A worker makes the normalised log-probabilities of all contexts from
the vectors by one batched matrix product, and looks the tokens up. Counts of
the ``HEAD`` most frequent words go along (a bound by count: the least count
at which at most so many words remain, but the shortlist at least). Other words leave the scan as rows
(row, word, number), meet the counts in a join on the word, and their sums
return by row. Nothing of unbounded size is collected or broadcast.

Edge cases. A null text counts as empty: one token, the end. With no training
text every count is zero and the model is uniform over its classes. Rows with
null ids take part in training under the id '', and each row, repeated ones
too, gets its own result. An empty table gives an empty result. Other columns
are not read.
"""

from __future__ import annotations

import pickle
from collections import Counter
from collections.abc import Iterable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from listinglab.llm.common import bucket, save, slices, texts

SHORTLIST, HEAD = 512, 1 << 17
DIMENSIONS, STEPS, NOISE, RATE, SEED = 24, 150, 10, 0.08, 7
#: Different words that a task holds before it hands its counts on.
HELD_WORDS = 400_000


class Model(NamedTuple):
    """``words`` by falling count; the first ``short`` have classes of their own."""
    words: list[bytes]
    counts: np.ndarray
    short: int
    contexts: np.ndarray
    classes: np.ndarray
    bias: np.ndarray
    #: Training tokens, different ones among them, end tokens, and the discount and sum of the rare words' counts.
    tokens: int
    types: int
    ends: int
    discount: float
    rare_tokens: int
    rare_types: int

    def table(self) -> np.ndarray:
        """log10 of the class probabilities, a row for each context."""
        scores = self.contexts @ self.classes.T + self.bias
        top = scores.max(axis=1, keepdims=True)
        return (scores - top - np.log(np.exp(scores - top).sum(axis=1, keepdims=True))) / np.log(10)

    def in_rare(self, counts: np.ndarray) -> np.ndarray:
        """log10 of the probability of a rare word, given that the token is one; count 0: any unknown word."""
        if not self.rare_tokens:
            return np.zeros(len(counts))
        free = max(self.discount * self.rare_types, 0.5) / self.rare_tokens
        known = np.maximum(counts - self.discount, 1e-9) / self.rare_tokens * (1 - free) / (1 - self.discount * self.rare_types / self.rare_tokens)
        return np.log10(np.where(counts > 0, known, free))


def words(body: bytes) -> list[bytes]:
    """``[^\\x20\\x09-\\x0D]+`` after lower-casing A-Z."""
    return body.lower().split()


def _counted(train: DataFrame) -> DataFrame:
    """(word, c) of all training texts."""
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter[bytes] = Counter()

        def out() -> pa.RecordBatch:
            batch = pa.RecordBatch.from_arrays([pa.array(list(held), pa.binary()), pa.array(list(held.values()), pa.int64())], names=["word", "c"])
            held.clear()
            return batch

        for batch in slices(batches):
            for body in batch.column("body").to_pylist():
                held.update(words(body))
            if len(held) > HELD_WORDS:
                yield out()
        if held:
            yield out()

    return train.select("body").mapInArrow(run, "word binary, c long").groupBy("word").agg(F.sum("c").alias("c"))


class _Ids:
    """Words to ranks, and a text's classes and contexts."""

    def __init__(self, vocabulary: list[bytes], short: int):
        self.rank = {w: k for k, w in enumerate(vocabulary)}
        self.short = short

    def ranks(self, own: list[bytes]) -> np.ndarray:
        get = self.rank.get
        return np.fromiter((get(w, -1) for w in own), np.int32, len(own))

    def cells(self, ranks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Context and class of each token, the end included."""
        k = self.short
        classes = np.append(np.where((ranks >= 0) & (ranks < k), ranks, k), k + 1)
        place = np.arange(len(ranks))
        last = np.maximum.accumulate(np.where(classes[:-1] < k, place, -1)) if len(ranks) else place
        last = np.concatenate([[-1], last])
        previous = np.where(last >= 0, classes[np.maximum(last, 0)], k)
        after_rare = np.concatenate([[False], classes[:-1] == k])
        return previous + (k + 1) * after_rare, classes


def _pairs(train: DataFrame, vocabulary: list[bytes], short: int) -> DataFrame:
    """(cell, n): how often each context and class meet."""
    held = train.sparkSession.sparkContext.broadcast(pickle.dumps(vocabulary[:short]))
    width = short + 2

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids = _Ids(pickle.loads(held.value), short)
        sums = np.zeros(2 * (short + 1) * width, np.int64)
        for batch in slices(batches):
            for body in batch.column("body").to_pylist():
                context, token = ids.cells(ids.ranks(words(body)))
                np.add.at(sums, context * width + token, 1)
        cells = np.flatnonzero(sums)
        yield pa.RecordBatch.from_arrays([pa.array(cells.astype(np.int32)), pa.array(sums[cells])], names=["cell", "n"])

    return train.select("body").mapInArrow(run, "cell int, n long").groupBy("cell").agg(F.sum("n").alias("n"))


def fit_nce(counts: np.ndarray, dimensions: int = DIMENSIONS, steps: int = STEPS, noise: int = NOISE, rate: float = RATE,
            seed: int = SEED) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Context vectors, class vectors and class biases from the counts of (context, class) pairs.

    Each pair of the data comes with ``noise`` words of the unigram distribution; the loss is that of telling them
    apart, in expectation, by the class's score against log(noise * unigram). Adam, on the whole table."""
    rng = np.random.default_rng(seed)
    rows, columns = counts.shape
    total = max(counts.sum(), 1)
    unigram = (counts.sum(axis=0) + 0.5) / (total + 0.5 * columns)
    data = (counts / total).astype(np.float32)
    fake = (noise * (counts.sum(axis=1, keepdims=True) / total) * unigram).astype(np.float32)
    odds = np.log(noise * unigram).astype(np.float32)
    values = [rng.normal(0, 0.1, (rows, dimensions)).astype(np.float32), rng.normal(0, 0.1, (columns, dimensions)).astype(np.float32),
              np.log(unigram).astype(np.float32)]
    first, second = [np.zeros_like(v) for v in values], [np.zeros_like(v) for v in values]
    for step in range(1, steps + 1):
        contexts, classes, bias = values
        real = 0.5 + 0.5 * np.tanh(0.5 * (contexts @ classes.T + bias - odds))
        slope = (fake + data) * real - data
        for k, g in enumerate((slope @ classes, slope.T @ contexts, slope.sum(axis=0))):
            g = g * np.float32(1e3)  # Adam divides it out, but for the smallest
            first[k] += 0.1 * (g - first[k])
            second[k] += 0.02 * (g * g - second[k])
            move = first[k] / (1 - 0.9 ** step) / (np.sqrt(second[k] / (1 - 0.98 ** step)) + 1e-6)
            values[k] = values[k] - np.float32(rate * min(1, 3 * (1 - step / (steps + 1)))) * move
    return tuple(v.astype(np.float64) for v in values)


def fit(train: DataFrame, short: int = SHORTLIST, head: int = HEAD) -> tuple[Model, DataFrame]:
    """The model, and the table of all words' counts (word, c). ``train``: (body)."""
    counted = save(_counted(train), "lm-words")
    ends = train.count()
    # How many words have each count: few rows, from which the least count of the head follows.
    spread = sorted(counted.groupBy("c").agg(F.count(F.lit(1)).alias("n")).collect(), reverse=True)
    least, held, single, double = 1 << 62, 0, 0, 0
    for row in spread:
        if held + row.n <= head and held >= 0:
            least, held = row.c, held + row.n
        else:
            held = -1
        single, double = (row.n, double) if row.c == 1 else (single, row.n if row.c == 2 else double)
    rows = counted.where(F.col("c") >= least).collect()
    if len(rows) < min(short, head):  # more words of one count than the head takes: the first of them in order
        tied = counted.where(F.col("c") < least).orderBy(F.desc("c"), "word").limit(min(short, head) - len(rows))
        rows += tied.collect()
    rows.sort(key=lambda r: (-r.c, bytes(r.word)))
    vocabulary, counts = [bytes(r.word) for r in rows], np.array([r.c for r in rows], np.int64)
    short = min(short, len(rows))
    table = np.zeros(2 * (short + 1) * (short + 2), np.int64)
    found = _pairs(train, vocabulary, short).toArrow()
    table[found["cell"].to_numpy()] = found["n"].to_numpy()
    contexts, classes, bias = fit_nce(table.reshape(2 * (short + 1), short + 2))
    total, types = sum(r.c * r.n for r in spread), sum(r.n for r in spread)
    discount = single / (single + 2 * double) if single + double else 0.5
    return Model(vocabulary, counts, short, contexts, classes, bias, total + ends, types + (ends > 0), ends,
                 min(max(discount, 0.1), 0.9), int(total - counts[:short].sum()), types - short), counted


_ROW = T.StructType([T.StructField(n, T.LongType()) for n in ("n_tokens", "head_known")] + [
    T.StructField("head_base", T.DoubleType()), T.StructField("head_score", T.DoubleType()),
    T.StructField("tail", T.ArrayType(T.StructType([T.StructField("word", T.BinaryType()), T.StructField("n", T.LongType())])))])
_TAIL = pa.list_(pa.struct([("word", pa.binary()), ("n", pa.int64())]))


def _scan(source: DataFrame, model: Model) -> DataFrame:
    """Per row: what classes and frequent words give, and the other words with their numbers."""
    held = source.sparkSession.sparkContext.broadcast(pickle.dumps(model))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m: Model = pickle.loads(held.value)
        ids, table = _Ids(m.words, m.short), m.table()
        scale = np.log10(m.tokens + m.types + 1)
        base = np.log10(m.counts + 1.0) - scale
        rare = np.concatenate([np.zeros(m.short), m.in_rare(m.counts[m.short:])])
        end = np.log10(m.ends + 1.0) - scale
        for batch in slices(batches):
            rows = []
            for body in batch.column("body").to_pylist():
                own = words(body)
                ranks = ids.ranks(own)
                context, token = ids.cells(ranks)
                known = ranks[ranks >= 0]
                tail = Counter(own[k] for k in np.flatnonzero(ranks < 0).tolist())
                rows.append((len(own) + 1, len(known) + (m.ends > 0), base[known].sum() + end, table[context, token].sum() + rare[known].sum(),
                             [{"word": w, "n": n} for w, n in tail.items()]))
            columns = [pa.array(c, t) for c, t in zip(zip(*rows, strict=True), (pa.int64(), pa.int64(), pa.float64(), pa.float64(), _TAIL), strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("held_out"), *columns],
                                             names=["doc_id", "held_out", *_ROW.fieldNames()])

    schema = T.StructType([source.schema["doc_id"], T.StructField("held_out", T.BooleanType()), *_ROW.fields])
    return source.select("doc_id", "body", "held_out").mapInArrow(run, schema).withColumn("row", F.monotonically_increasing_id())


def score(docs: DataFrame, held_out: Column, id_col: str = "doc_id", text_col: str = "text", short: int = SHORTLIST, head: int = HEAD) -> DataFrame:
    """Per row: doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score (log10 probabilities of the text)."""
    source = texts(docs, id_col, text_col, held_out.alias("held_out"))
    model, counted = fit(source.where("NOT held_out").select("body"), short, head)
    rows = save(_scan(source, model), "lm-rows")
    tail = rows.select("row", F.explode("tail").alias("t")).select("row", "t.word", "t.n")
    others = counted
    if model.words:  # by falling count, then in order
        least, last = int(model.counts[-1]), bytearray(model.words[-1])
        others = counted.where((F.col("c") < least) | ((F.col("c") == least) & (F.col("word") > F.lit(last))))
    c = F.coalesce("c", F.lit(0))
    base = F.log10(c + 1) - F.log10(F.lit(float(model.tokens + model.types + 1)))
    free, one = (float(x) for x in model.in_rare(np.array([0, 1])))
    known = F.log10(c - model.discount) + (one - float(np.log10(1 - model.discount)))
    sums = tail.join(others, "word", "left").groupBy("row").agg(
        F.sum(F.when(c > 0, F.col("n")).otherwise(0)).alias("tail_known"), F.sum(base * F.col("n")).alias("tail_base"),
        F.sum(F.when(c > 0, known).otherwise(free) * F.col("n")).alias("tail_score"))
    zero = F.lit(0)
    return rows.drop("tail").join(sums, "row", "left").select(
        "doc_id", "held_out", "n_tokens", (F.col("head_known") + F.coalesce("tail_known", zero)).cast("long").alias("n_known"),
        F.lit(model.tokens).cast("long").alias("train_tokens"), (F.col("head_base") + F.coalesce("tail_base", zero)).alias("base_score"),
        (F.col("head_score") + F.coalesce("tail_score", zero)).alias("score"))


def fold(id_col: str = "doc_id") -> Column:
    """Held out: crc32 of the id as text is 2 modulo 7."""
    return bucket(id_col, 7) == 2
