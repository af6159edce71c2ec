"""Operator 7: SimHash near-duplicates by tiled exact comparison.

Fingerprint. A-Z are lower-cased, words are runs of characters other than
blanks and controls 9-13, shingles are 4 words joined by one blank, repeats
included (fewer words: the whole sequence; none: fingerprint zero). A bit of
the 64 is set where it is set in over half of the shingles' XXH64 values
(seed 42). Documents link when their fingerprints differ in at most ``radius``
bits; a component is what links reach.

Comparison. Equal fingerprints are one row from the start (a group-by with a
map-side combine), so copies cost nothing further. Different fingerprints are
sorted into classes by the population counts of their two halves, and each
class is packed into tiles of at most ``TILE`` fingerprints. Since the counts
of two fingerprints within the radius differ by no more than the radius in
sum, a tile meets only tiles of classes that near: all other tile pairs are
skipped unread, and within a pair so are bands of 64 whose counts by quarters
differ too much. The tile pairs are an equi-join on the class, each tile row
stating the classes that it meets; a task takes a pair, compares the rest of
it with exclusive-or and bit counts, and returns links that span what it found
connected (never more than fingerprints in the pair, however dense a group of
near copies is). Nothing is sampled or capped: every pair of
different fingerprints within the radius is compared.

Components of the links come from ``components.py``. Memory in a task is two
tiles and one band of their comparison.

Edge cases. A null text counts as empty; all texts without words share the
fingerprint zero and so one component. A row with a null id gets the
component of its fingerprint, whose name is the smallest id that is not null
(null when there is none). Repeated rows each get their row. Empty tables
give empty results.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from listinglab.llm.common import packed, save, slices, texts, unpacked
from listinglab.llm.components import components

SHINGLE, RADIUS, SEED = 4, 4, 42
#: Fingerprints in a tile, and rows of it compared at a time.
TILE, BAND = 4096, 64


def fingerprint(body: bytes, size: int = SHINGLE) -> int:
    own = body.lower().split()  # bytes: A-Z only, and the blanks 9-13 and 32
    if not own:
        return 0
    joined = b" ".join(own)
    ends = (np.cumsum(np.fromiter(map(len, own), np.int64, len(own)) + 1) - 1).tolist()
    starts = [0, *[e + 1 for e in ends]]
    digest = xxhash.xxh64_intdigest
    values = np.array([digest(joined[a:b], SEED) for a, b in zip(starts, ends[min(size, len(own)) - 1:], strict=False)], np.uint64)
    counts = np.zeros(64, np.int64)
    for at in range(0, len(values), 4096):
        bits = np.unpackbits(values[at:at + 4096].view(np.uint8), bitorder="little").reshape(-1, 64)
        counts += np.add.reduce(bits, axis=0, dtype=np.uint16)
    return sum(1 << bit for bit in np.flatnonzero(2 * counts > len(values)).tolist())


def _tag(body: Column) -> Column:
    return F.xxhash64(body)


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = SHINGLE) -> DataFrame:
    """Per row: doc_id, fp (the 64 bits as a signed long), tag (hash of the text)."""
    source = texts(docs, id_col, text_col).withColumn("tag", _tag(F.col("body")))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            values = np.array([fingerprint(b, size) for b in batch.column("body").to_pylist()], np.uint64)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(values.view(np.int64)), batch.column("tag")], names=["doc_id", "fp", "tag"])

    return source.mapInArrow(run, T.StructType([source.schema["doc_id"], T.StructField("fp", T.LongType()), T.StructField("tag", T.LongType())]))


def _quarters(fps: np.ndarray) -> np.ndarray:
    """Population counts of the four quarters, one row per fingerprint."""
    return np.bitwise_count(fps.view(np.uint16).reshape(-1, 4)).astype(np.int16)


def _sorted(fps: np.ndarray) -> np.ndarray:
    return fps[np.lexsort((fps, *_quarters(fps).T))]


def _near_classes(radius: int) -> list[tuple[int, int]]:
    """Steps from a class to the classes that its tiles meet; of a step and its opposite only one."""
    side = range(-radius, radius + 1)
    return [(a, b) for a in side for b in side if abs(a) + abs(b) <= radius and (a, b) >= (0, 0)]


def _tiles(fps: DataFrame, salts: int) -> DataFrame:
    """(c0, c1, part, tile, body): classes cut into tiles, 8 bytes for each fingerprint.

    A class is dealt to ``salts`` tasks, which stream it: a task holds one open
    tile for each class. ``tile`` is a fingerprint of the tile, and so its name."""
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple[int, int], np.ndarray] = {}
        for batch in batches:
            own = batch.column("fp").to_numpy().view(np.uint64)
            halves = np.bitwise_count(own.view(np.uint32).reshape(-1, 2)).astype(np.int64)
            key = halves[:, 0] * 64 + halves[:, 1]
            order = np.argsort(key, kind="stable")
            full = []
            for part in np.split(own[order], np.flatnonzero(np.diff(key[order])) + 1):
                name = tuple(np.bitwise_count(part[:1].view(np.uint32)).tolist())
                part = np.concatenate([held.get(name, part[:0]), part])
                cut = len(part) // TILE * TILE
                full += [(name, part[at:at + TILE]) for at in range(0, cut, TILE)]
                held[name] = part[cut:]
            if full:
                yield _tile_rows(full)
        if rest := [(k, v) for k, v in held.items() if len(v)]:
            yield _tile_rows(rest)

    half = [F.bit_count(F.col("fp").bitwiseAND(F.lit(0xFFFFFFFF))), F.bit_count(F.shiftrightunsigned("fp", 32))]
    dealt = fps.select("fp").repartition(*half, F.pmod(F.xxhash64("fp"), F.lit(salts)))
    return dealt.mapInArrow(run, "c0 int, c1 int, tile long, body binary")


def _tile_rows(tiles: list[tuple[tuple[int, int], np.ndarray]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array([k[0] for k, _ in tiles], pa.int32()), pa.array([k[1] for k, _ in tiles], pa.int32()),
         pa.array([int(v[:1].view(np.int64)[0]) for _, v in tiles], pa.int64()),
         pa.array([_sorted(v).tobytes() for _, v in tiles], pa.binary())], names=["c0", "c1", "tile", "body"])


def _join_labels(labels: np.ndarray, u: np.ndarray, v: np.ndarray) -> None:
    """Put the sets of the nodes u[k] and v[k] together; labels point at the smallest node of a set."""
    while True:
        a, b = labels[u], labels[v]
        apart = a != b
        if not apart.any():
            return
        u, v, a, b = u[apart], v[apart], a[apart], b[apart]
        np.minimum.at(labels, np.maximum(a, b), np.minimum(a, b))
        while (labels[labels] != labels).any():
            labels[:] = labels[labels]


def spanning_links(one: np.ndarray, two: np.ndarray | None, radius: int) -> np.ndarray:
    """Links (pairs of fingerprints) that connect all that links within ``one``, or between ``one`` and ``two``, connect.

    Both are sorted by their quarters' population counts; bands of them whose counts differ by more than the
    radius in sum are skipped."""
    nodes = one if two is None else np.concatenate([one, two])
    other, shift = (one, 0) if two is None else (two, len(one))
    bounds = np.arange(0, len(other), BAND)
    counts = _quarters(other)
    low, high = np.minimum.reduceat(counts, bounds), np.maximum.reduceat(counts, bounds)
    labels = np.arange(len(nodes))
    for at in range(0, len(one), BAND):
        band = one[at:at + BAND]
        own = _quarters(band)
        gap = np.maximum(low - own.max(axis=0), 0) + np.maximum(own.min(axis=0) - high, 0)
        meet = gap.sum(axis=1) <= radius
        if two is None:
            meet[:at // BAND] = False
        columns = np.flatnonzero(np.repeat(meet, BAND)[:len(other)])
        left, right = np.nonzero(np.bitwise_count(band[:, None] ^ other[None, columns]) <= radius)
        if len(left):
            _join_labels(labels, left + at, columns[right] + shift)
    tied = np.flatnonzero(labels != np.arange(len(nodes)))
    return np.stack([nodes[tied], nodes[labels[tied]]], axis=1)


def links(fps: DataFrame, radius: int = RADIUS) -> DataFrame:
    """From a written table of different fingerprints (fp), links (u, v) that span every component."""
    salts = 1 + fps.count() // (256 * TILE)
    tiles = save(_tiles(fps, salts), "simhash-tiles")
    # A class with many tiles is met in parts, each part a join key of its own: its work spreads over tasks.
    parts = 1 + salts // 4
    part = F.pmod(F.xxhash64("tile"), F.lit(parts)).cast("int")
    steps = F.array(*[F.struct(F.lit(a).alias("a"), F.lit(b).alias("b")) for a, b in _near_classes(radius)])
    mine = tiles.withColumn("step", F.explode(steps)).withColumn(
        "part", F.explode(F.sequence(F.lit(0), F.lit(parts - 1)))).select(
        (F.col("c0") + F.col("step.a")).alias("c0"), (F.col("c1") + F.col("step.b")).alias("c1"), "part",
        F.col("tile").alias("mine"), F.col("body").alias("mine_body"),
        ((F.col("step.a") == 0) & (F.col("step.b") == 0)).alias("own"))
    pairs = mine.join(tiles.withColumn("part", part), ["c0", "c1", "part"]).where("NOT own OR mine <= tile")

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 16):
            found = [np.empty((0, 2), np.uint64)]
            for a, b, body_a, body_b in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                one = np.frombuffer(body_a, np.uint64)
                found.append(spanning_links(one, None if a == b else np.frombuffer(body_b, np.uint64), radius))
            both = np.ascontiguousarray(np.concatenate(found)).view(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(both[:, 0].copy()), pa.array(both[:, 1].copy())], names=["u", "v"])

    return pairs.select("mine", "tile", "mine_body", "body").mapInArrow(run, "u long, v long")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = SHINGLE,
                    radius: int = RADIUS) -> DataFrame:
    """Per row: doc_id, fp (long), component_id (smallest id that links reach), tag (hash of the text)."""
    rows = save(fingerprints(docs, id_col, text_col, size), "simhash-rows")
    groups = save(rows.groupBy("fp").agg(F.min("doc_id").alias("least")), "simhash-groups")
    stars = components(links(groups, radius), "simhash-links")
    # Every fingerprint with the first of its component, itself where it has no link.
    roots = groups.join(stars.select(F.col("u").alias("fp"), F.col("v").alias("star")), "fp", "left").select(
        "fp", "least", F.coalesce("star", "fp").alias("root"))
    roots = save(roots, "simhash-roots")
    names = save(roots.groupBy("root").agg(F.min("least").alias("component_id")), "simhash-names")
    named = save(roots.join(names, "root").select("fp", "component_id"), "simhash-named")
    return rows.join(named, "fp", "left").select("doc_id", "fp", "component_id", "tag")


def drop_near_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = SHINGLE,
                     radius: int = RADIUS) -> DataFrame:
    """One document of each component, that with its smallest id; whole rows, all columns. Rows without an id stay,
    and so does each text of an id that leads its component."""
    columns = docs.columns
    leads = near_duplicates(docs, id_col, text_col, size, radius).where("doc_id = component_id").select("doc_id", "tag").distinct()
    whole = packed(docs, id_col, _tag(F.coalesce(F.col(text_col).cast("binary"), F.lit(b""))))
    stay = whole.join(leads, (whole["key"] == leads["doc_id"]) & (whole["tag"] == leads["tag"]), "left_semi")
    return unpacked(stay.dropDuplicates(["key", "tag"]), columns).unionByName(docs.where(F.col(id_col).isNull()))
