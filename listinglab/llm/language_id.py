"""Operator 6: language identification by Kneser-Ney character models.

Each language has an interpolated Kneser-Ney model of the characters of its
words, order ``ORDER``, each word with a blank before and after it. A text
gets the language with the lowest cross-entropy per character. The score is
the softmax of the negative cross-entropies under a temperature, and a text is
``accepted`` when its cross-entropy is at most the language's threshold; both
are calibrated on training rows.

Training. Each task counts the words of its texts by language, turns them to
weighted n-grams (rolling hashes, with the hashes of the gram's suffix and
context), and Spark sums the rows by language and gram. Spark also takes the
numbers of characters before a gram and of grams seen once and twice by
language and order (the discounts). Every gram of every language is in the
model: one entry (gram, language, log-probability) in arrays sorted by hash,
and one (context, language, log back-off weight).

Blocks. The model is cut by the two characters before the one that is
predicted, as these decide which entries a place of a text can need: grams and
contexts of three and more characters are in the block of a hash of that pair,
shorter ones in every block. A block has about ``BLOCK`` entries whatever the
number of languages. One block at a time is built on the driver, broadcast, and
met by a scan of the texts that adds up the places that belong to it; the sums
of the blocks are added by text. A model of one block, as most are, needs one
scan. So nothing is cut away, and more entries cost more scans.

Scoring. A worker keeps the scores of the character windows it has seen (a
bounded number of cells), so most places cost one look-up.

Calibration scores all training rows: the likelihoods of the temperatures are
averages over them, the thresholds exact quantiles.

Edge cases. A null text or one without a letter (Unicode L) is ``und`` with
score 0, and so is every text when there is nothing to learn from. Rows with a
null language are not learnt from. Ties go to the first language in string
order. Null ids take part under the id ''; repeated rows each count and each
get their row. An empty table gives an empty result. Other columns are not
read.
"""

from __future__ import annotations

import pickle
import uuid
from collections import Counter, defaultdict
from collections.abc import Iterable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from listinglab.llm.chargrams import Grams, find, letter_runs
from listinglab.llm.common import bucket, save, slices, texts
from listinglab.operators.aggregate import quantiles_of_counts

ORDER = 5
#: Entries (gram and language) of a block.
BLOCK = 1 << 20
#: Different words that a worker holds, and cells (window and language) of its window table.
HELD_WORDS, CELLS = 300_000, 1 << 22
#: Share of its own training texts that a language's threshold accepts.
ACCEPT = 0.999


def tokens(body: bytes) -> list[str]:
    return body.decode("utf-8", "replace").lower().split()


class Entries(NamedTuple):
    """Sorted hashes; the entries of hash k are ``start[k]`` to ``start[k + 1]`` of ``lang`` and ``value``."""

    keys: np.ndarray
    start: np.ndarray
    lang: np.ndarray
    value: np.ndarray

    def of(self, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(place in ``wanted``, language, value) of all entries of the wanted hashes."""
        at, known = find(self.keys, wanted)
        rows = np.flatnonzero(known)
        first = self.start[at[rows]]
        n = self.start[at[rows] + 1] - first
        entry = np.repeat(first - (np.cumsum(n) - n), n) + np.arange(n.sum())
        return np.repeat(rows, n), self.lang[entry], self.value[entry]


def _entries(keys: np.ndarray, lang: np.ndarray, value: np.ndarray) -> Entries:
    by = np.lexsort((lang, keys))
    names, start = np.unique(keys[by], return_index=True)
    return Entries(names, np.append(start, len(by)), lang[by].astype(np.int32), value[by])


class Model(NamedTuple):
    """A block: natural-log probabilities and back-off weights by order, and which places belong to it."""

    languages: list[str]
    #: Sorted characters, with a row of log-probabilities each; ``unseen``: of any other character.
    letters: tuple[np.ndarray, np.ndarray]
    unseen: np.ndarray
    #: By order, from 2 on.
    grams: list[Entries | None]
    contexts: list[Entries | None]
    #: This block and the number of blocks.
    block: int = 0
    blocks: int = 1

    def windows(self, g: Grams, place: np.ndarray) -> np.ndarray:
        """Log-probability of the character at each place in each language, by the longest gram known."""
        at, known = find(self.letters[0], g.hash[1][place])
        out = np.where(known[:, None], self.letters[1][at], self.unseen) if len(self.letters[0]) else np.tile(self.unseen, (len(place), 1))
        for m in range(2, ORDER + 1):
            can = np.flatnonzero(g.reach[place] >= m)
            row, lang, value = self.contexts[m].of(g.hash[m - 1][place[can] - 1])
            out[can[row], lang] += value
            row, lang, value = self.grams[m].of(g.hash[m][place[can]])
            out[can[row], lang] = value
        return out

    def own(self, g: Grams, place: np.ndarray) -> np.ndarray:
        """Which places belong to this block."""
        if self.blocks == 1:
            return np.ones(len(place), bool)
        short = g.reach[place] < 3
        return np.where(short, self.block == 0, spots(g, place) % self.blocks == self.block)


def spots(g: Grams, place: np.ndarray) -> np.ndarray:
    """A hash of the two characters before each place."""
    pair = g.hash[1][place - 2] * np.uint64(1 << 21) + g.hash[1][place - 1]
    return ((pair * _MIX) >> np.uint64(33)).astype(np.int64)


_MIX = np.uint64(0x9E3779B97F4A7C15)


def _of_language(hashes: np.ndarray, lang: np.ndarray) -> np.ndarray:
    """One hash for a hash and a language."""
    return (hashes ^ ((lang.astype(np.uint64) + np.uint64(1)) * np.uint64(0xBF58476D1CE4E5B9))) * _MIX


def _counted(train: DataFrame) -> DataFrame:
    """(lang, m, gram, suffix, context, starts, spot, c): counts of the grams of all training words."""
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, Counter[str]] = defaultdict(Counter)

        def out() -> Iterator[pa.RecordBatch]:
            for lang, counted in held.items():
                runs: Counter[str] = Counter()
                for token, n in counted.items():
                    for word in (token,) if token.isalpha() else letter_runs(token):
                        runs[word] += n
                if not runs:
                    continue
                g = Grams(runs, ORDER)
                weight = np.append(np.fromiter(runs.values(), np.int64, len(runs)), 0)
                for m in range(1, ORDER + 1):
                    at = g.at(m) if m > 1 else g.at(2)
                    # Grams that begin a word have no character before them: their counts stay counts.
                    gram, first, back = np.unique(g.hash[m][at], return_index=True, return_inverse=True)
                    at1 = at[first]
                    n = np.bincount(back, weight[g.owner[at]], len(gram)).astype(np.int64)
                    starts = (g.reach[at1] == m) & (m > 1)
                    suffix = g.hash[m - 1][at1] if m > 1 else np.zeros(len(gram), np.uint64)
                    context = g.hash[m - 1][at1 - 1] if m > 1 else np.zeros(len(gram), np.uint64)
                    spot = spots(g, at1) if m > 2 else np.full(len(gram), -1)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([lang] * len(gram), pa.string()), pa.array(np.full(len(gram), m, np.int32)), *[pa.array(x.view(np.int64)) for x in (gram, suffix, context)],
                         pa.array(starts), pa.array(spot), pa.array(n)], names=["lang", "m", "gram", "suffix", "context", "starts", "spot", "c"])
            held.clear()

        for batch in slices(batches):
            for lang, body in zip(batch.column("lang").to_pylist(), batch.column("body").to_pylist(), strict=True):
                held[lang].update(tokens(body))
            if sum(map(len, held.values())) > HELD_WORDS:
                yield from out()
        yield from out()

    schema = "lang string, m int, gram long, suffix long, context long, starts boolean, spot long, c long"
    return train.select("lang", "body").mapInArrow(run, schema).groupBy("lang", "m", "gram", "suffix", "context", "starts", "spot").agg(F.sum("c").alias("c"))


def _adjusted(counted: DataFrame) -> DataFrame:
    """With ``adjusted``: below the top order the number of different characters before the gram, unless it begins a word."""
    before = counted.where("m > 1").groupBy("lang", (F.col("m") - 1).alias("m"), F.col("suffix").alias("gram")).agg(F.count(F.lit(1)).alias("kinds"))
    own = F.when((F.col("m") == ORDER) | F.col("starts"), F.col("c")).otherwise(F.coalesce("kinds", F.lit(0)))
    return counted.join(before, ["lang", "m", "gram"], "left").withColumn("adjusted", own).drop("kinds")


class Statistics(NamedTuple):
    """Of all rows: different characters and one, and by order and language the grams with an adjusted count of one and of two."""
    alphabet: int
    once: np.ndarray
    twice: np.ndarray


def kneser_ney(rows: dict[str, np.ndarray], languages: list[str], exact: Statistics | None = None, block: int = 0, blocks: int = 1) -> Model:
    """The model from the counts of ``_counted``; ``lang`` holds places in ``languages``.

    With ``exact`` the rows are those of a block and have their ``adjusted`` count. All grams of a context, and a gram's suffix,
    are in one block, so totals and shorter grams are at hand."""
    wide = len(languages)
    lang, order = rows["lang"], rows["m"]
    alphabet = exact.alphabet if exact else len(np.unique(rows["gram"][order == 1])) + 1
    unseen, letters = np.full(wide, np.log(1.0 / alphabet)), (np.zeros(0, np.uint64), np.zeros((0, wide)))
    grams: list[Entries | None] = [None, None]
    contexts: list[Entries | None] = [None, None]
    lower = (np.zeros(0, np.uint64), np.zeros(0))
    for m in range(1, ORDER + 1):
        own = np.flatnonzero(order == m)
        gram, of_lang = rows["gram"][own], lang[own]
        key = _of_language(gram, of_lang)
        count = rows["adjusted" if exact else "c"][own].astype(float)
        if m < ORDER and not exact:  # below the top, the number of different characters before the gram, unless it begins a word
            above = order == m + 1
            seen, kinds = np.unique(_of_language(rows["suffix"][above], lang[above]), return_counts=True)
            at, known = find(seen, key)
            before = np.where(known, kinds[at] if len(kinds) else 0, 0)
            count = np.where(rows["starts"][own], count, before)
        if exact:
            once, twice = exact.once[m], exact.twice[m]
        else:
            once, twice = (np.bincount(of_lang[count == n], minlength=wide) for n in (1, 2))
        discount = np.clip(once / np.maximum(once + 2 * twice, 1), 0.1, 0.9)
        _, first, of = np.unique(_of_language(rows["context"][own], of_lang), return_index=True, return_inverse=True)
        total, kinds = np.bincount(of, count, len(first)), np.bincount(of, count > 0, len(first))
        # What the discounts free goes to the shorter context; a context that a language has not seen passes all.
        free = np.where(total > 0, discount[of_lang[first]] * kinds / np.maximum(total, 1), 1.0)
        shorter = np.full(len(own), 1.0 / alphabet)
        if m > 1:
            at, known = find(lower[0], _of_language(rows["suffix"][own], of_lang))
            shorter[known] = lower[1][at[known]]
        p = np.maximum(count - discount[of_lang], 0) / np.maximum(total, 1)[of] + free[of] * shorter
        by = np.argsort(key)
        lower = (key[by], p[by])
        if m == 1:
            if len(own):
                unseen[of_lang[first]] = np.log(np.maximum(free, 1e-12) / alphabet)
            names, back = np.unique(gram, return_inverse=True)
            table = np.tile(unseen, (len(names), 1))
            table[back, of_lang] = np.log(p)
            letters = (names, table)
        else:
            grams.append(_entries(gram, of_lang, np.log(p)))
            contexts.append(_entries(rows["context"][own][first], of_lang[first], np.log(np.maximum(free, 1e-12))))
    return Model(languages, letters, unseen, grams, contexts, block, blocks)


class _Places(dict):
    """Places of words: a word that is looked up for the first time gets the next place, and is kept in ``new``."""

    def __init__(self) -> None:
        super().__init__()
        self.new: list[str] = []

    def __missing__(self, word: str) -> int:
        self.new.append(word)
        place = self[word] = len(self)
        return place


class _Reader:
    """A worker's view of a block: sums of a text's words, with the words and the character windows it has seen kept (a bounded number)."""

    def __init__(self, model: Model):
        self.model = model
        self.wide = len(model.languages)
        self._clear()
        self.keys, self.scores = np.zeros(0, np.uint64), np.zeros((0, self.wide))

    def _clear(self) -> None:
        self.place = _Places()
        self.values = np.zeros((1 << 14, self.wide + 1))

    def words(self, words: list[str]) -> np.ndarray:
        """Of each word: the log-probability of the block's places in each language, and in the last column the number of characters."""
        out = np.zeros((len(words), self.wide + 1))
        if not words:
            return out
        g = Grams(words, ORDER)
        place = np.flatnonzero(g.reach >= 2)
        out[:, -1] = np.bincount(g.owner[place], minlength=len(words))
        place = place[self.model.own(g, place)]
        length = np.minimum(g.reach[place], ORDER)
        key = np.array(g.hash[1:])[length - 1, place] * np.uint64(8) + length.astype(np.uint64)
        names, first, back = np.unique(key, return_index=True, return_inverse=True)
        at, known = find(self.keys, names)
        scores = np.empty((len(names), self.wide))
        scores[known] = self.scores[at[known]]
        new = np.flatnonzero(~known)
        if len(new):
            scores[new] = self.model.windows(g, place[first[new]])
            if (len(self.keys) + len(new)) * self.wide > CELLS:
                self.keys, self.scores = names[new], scores[new]
            else:
                where = np.searchsorted(self.keys, names[new])
                self.keys, self.scores = np.insert(self.keys, where, names[new]), np.insert(self.scores, where, scores[new], axis=0)
        owner = g.owner[place]
        for k in range(self.wide):
            out[:, k] = np.bincount(owner, scores[back, k], len(words))
        return out

    def sums(self, bodies: list[bytes]) -> np.ndarray:
        """By text: log-probability per language, and the number of characters."""
        if len(self.place) > HELD_WORDS:
            self._clear()
        start, get = len(self.place), self.place.__getitem__
        # One look-up for a token: it finds the word's place or gives it one.
        places = [np.fromiter(map(get, own), np.int64, len(own)) for own in map(tokens, bodies)]
        new, self.place.new = self.place.new, []
        runs = [(t,) if t.isalpha() else letter_runs(t) for t in new]
        owner = np.repeat(np.arange(len(new)), [len(r) for r in runs])
        by_run = self.words([w for r in runs for w in r])
        while len(self.values) < start + len(new):
            self.values = np.concatenate([self.values, np.zeros_like(self.values)])
        for k in range(by_run.shape[1]):
            self.values[start:start + len(new), k] = np.bincount(owner, by_run[:, k], len(new))
        return np.array([self.values[own].sum(axis=0) for own in places])


#: The block that a worker reads now: tasks that follow find its tables warm, and the one before is let go.
_NOW: dict[str, _Reader] = {}


def _reader(name: str, held) -> _Reader:
    if name not in _NOW:
        _NOW.clear()
        _NOW[name] = _Reader(pickle.loads(held.value))
    return _NOW[name]


class Fitted(NamedTuple):
    """A trained model: the counts that its blocks are built from, one at a time, and the calibration."""

    languages: list[str]
    counted: DataFrame
    exact: Statistics
    blocks: int
    temperature: float = 30.0
    thresholds: tuple[float, ...] = ()

    def model(self, block: int) -> Model:
        rows = self.counted if self.blocks == 1 else self.counted.where((F.col("spot") < 0) | (F.col("spot") % self.blocks == block))
        rows = rows.select("lang", "m", "gram", "suffix", "context", "adjusted").toArrow()
        place = {x: k for k, x in enumerate(self.languages)}
        arrays = {"lang": np.array([place[x] for x in rows["lang"].to_pylist()], np.int64), "m": rows["m"].to_numpy(), "adjusted": rows["adjusted"].to_numpy()}
        arrays |= {k: np.ascontiguousarray(rows[k].to_numpy()).view(np.uint64) for k in ("gram", "suffix", "context")}
        return kneser_ney(arrays, self.languages, self.exact, block, self.blocks)


def _block_sums(source: DataFrame, model: Model, carry: tuple[str, ...]) -> DataFrame:
    """``carry``, tag (hash of the text), and the sums of a block (null: the text has no letter)."""
    held = source.sparkSession.sparkContext.broadcast(pickle.dumps(model))
    name = uuid.uuid4().hex

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = _reader(name, held)
        for batch in slices(batches):
            bodies = batch.column("body").to_pylist()
            sums = [s.tolist() if s[-1] else None for s in reader.sums(bodies)]
            for k, body in enumerate(bodies):  # numerals and the like are word characters, but no letters
                if sums[k] is not None and not any(map(str.isalpha, body.decode("utf-8", "replace"))):
                    sums[k] = None
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in carry], batch.column("tag"), pa.array(sums, pa.list_(pa.float64()))], names=[*carry, "tag", "sums"])

    schema = T.StructType([*[source.schema[c] for c in carry], T.StructField("tag", T.LongType()), T.StructField("sums", T.ArrayType(T.DoubleType()))])
    return source.select(*carry, F.xxhash64("body").alias("tag"), "body").mapInArrow(run, schema)


def _entropies(source: DataFrame, fitted: Fitted, *carry: str) -> DataFrame:
    """``carry`` columns, with bits per character in each language (null: no letter)."""
    wide = len(fitted.languages)
    found = _block_sums(source, fitted.model(0), carry)
    for block in range(1, fitted.blocks):
        # Written block by block: a broadcast is no longer needed when its scan is done.
        found = save(found, "lang-sums") if block == 1 else found
        found = found.unionByName(save(_block_sums(source, fitted.model(block), carry), "lang-sums"))
    if fitted.blocks > 1:
        # Rows of one text have one sum; as many come back as went in.
        each = [F.sum(F.get("sums", F.lit(k))).alias(f"s{k}") for k in range(wide + 1)]
        by = found.groupBy(*carry, "tag").agg(F.count(F.lit(1)).alias("n"), *each)
        sums = F.when(F.col("s0").isNotNull(), F.array(*[F.col(f"s{k}") for k in range(wide)], F.col(f"s{wide}") / fitted.blocks))
        found = by.select(*carry, sums.alias("sums"), F.explode(F.sequence(F.lit(1), F.expr(f"cast(n div {fitted.blocks} as int)"))))
    bits = F.transform(F.slice("sums", 1, wide), lambda s: -s / F.element_at("sums", -1) / float(np.log(2)))
    return found.select(*carry, (bits if wide else F.when(F.col("sums").isNotNull(), F.array().cast("array<double>"))).alias("bits"))


def _calibrated(fitted: Fitted, found: DataFrame) -> Fitted:
    """The temperature of the best likelihood of the languages of all rows (lang, bits), and each language's threshold."""
    names = F.array(*map(F.lit, fitted.languages))
    rows = found.where("bits IS NOT NULL").withColumn("own", F.get("bits", F.array_position(names, F.col("lang")).cast("int") - 1)).where("own IS NOT NULL")
    best = F.array_min("bits")
    steps = [float(t) for t in np.geomspace(1, 60, 25)]

    def loss(t: float) -> Column:
        return F.log(F.aggregate("bits", F.lit(0.0), lambda a, b: a + F.exp((best - b) * t))) + (F.col("own") - best) * t

    losses = list(rows.agg(*[F.avg(loss(t)) for t in steps]).first())
    counts = rows.groupBy(F.col("lang").alias("column_name"), F.col("own").alias("v")).agg(F.count(F.lit(1)).alias("n"))
    limits = {r["column_name"]: r["value"] * 1.05 for r in quantiles_of_counts(counts, [ACCEPT]).collect()}
    temperature = fitted.temperature if losses[0] is None else steps[int(np.argmin(losses))]
    return fitted._replace(temperature=temperature, thresholds=tuple(limits.get(x, float("inf")) for x in fitted.languages))


def fit(train: DataFrame, block: int = BLOCK, calibration: int | None = None) -> Fitted:
    """From (doc_id, body, lang) without null languages. All rows calibrate the model, unless the caller bounds their number."""
    counted = save(_adjusted(save(_counted(train), "lang-grams")), "lang-adjusted")
    orders = counted.groupBy("lang", "m").agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("adjusted") == 1).alias("one"), F.count_if(F.col("adjusted") == 2).alias("two")).collect()
    languages = sorted({r.lang for r in orders})
    place = {x: k for k, x in enumerate(languages)}
    once, twice = np.zeros((ORDER + 1, len(languages))), np.zeros((ORDER + 1, len(languages)))
    for r in orders:
        once[r.m, place[r.lang]], twice[r.m, place[r.lang]] = r.one, r.two
    exact = Statistics(counted.where("m = 1").select("gram").distinct().count() + 1, once, twice)
    long = sum(r.n for r in orders if r.m > 2)
    fitted = Fitted(languages, counted, exact, max(1, -(-long // block)))
    if not languages:
        return fitted
    rows = train if calibration is None else train.orderBy(F.xxhash64("doc_id")).limit(calibration)
    return _calibrated(fitted, save(_entropies(rows, fitted, "lang"), "lang-calibration"))


def identify(docs: DataFrame, held_out: Column, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
             block: int = BLOCK) -> DataFrame:
    """Per row: doc_id, held_out, lang_pred, score, accepted, bits (cross-entropy of the language)."""
    source = texts(docs, id_col, text_col, held_out.alias("held_out"), F.col(lang_col).alias("lang"))
    fitted = fit(source.where("NOT held_out AND lang IS NOT NULL"), block)
    if not fitted.languages:
        none = F.lit(None).cast("double")
        return source.select("doc_id", "held_out", F.lit("und").alias("lang_pred"), F.lit(0.0).alias("score"), F.lit(False).alias("accepted"), none.alias("bits"))
    found = _entropies(source, fitted, "doc_id", "held_out")
    none = F.col("bits").isNull()
    best = F.array_min("bits")
    at = F.array_position("bits", best).cast("int")
    languages, limits = F.array(*map(F.lit, fitted.languages)), F.array(*[F.lit(x) for x in fitted.thresholds])
    weights = F.aggregate("bits", F.lit(0.0), lambda a, b: a + F.exp((best - b) * fitted.temperature))
    return found.select(
        "doc_id", "held_out", F.when(none, "und").otherwise(F.element_at(languages, at)).alias("lang_pred"),
        F.when(none, 0.0).otherwise(1.0 / weights).alias("score"), F.when(none, False).otherwise(best <= F.element_at(limits, at)).alias("accepted"),
        best.alias("bits"))


def fold(id_col: str = "doc_id") -> Column:
    """Held out: crc32 of the id as text is 2 modulo 4."""
    return bucket(id_col, 4) == 2
