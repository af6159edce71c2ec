"""Operator 13: whitening of embeddings by Golub-Kahan-Lanczos bidiagonalisation.

X is the table of centred vectors, one row each. Starting from a fixed unit
vector v, the method builds orthonormal v_1, v_2, ... (as long as a vector) and
u_1, u_2, ... (as long as the table) with

    X v_j = beta_(j-1) u_(j-1) + alpha_j u_j        X'u_j = alpha_j v_j + beta_j v_(j+1)

so X = U B V' with a small upper bidiagonal B. Its singular values s and right
vectors give the components V w and their variances s^2 / n.

Plan. Vectors become integers once, in blocks of ``BLOCK`` rows written to the
shared folder as bytes. Each step is one pass over the blocks: a task computes
u = X p for its rows, and adds up X'u, u'u and the products of u with all
earlier u; Spark sums these by position. No u is stored: every u_j lies in the
range of X, so it is X p_j with a p_j as long as a vector, and a block makes
its rows of all earlier u again as one matrix product. Steps therefore leave
nothing behind that could be lost, and need no disk.

Full reorthogonalisation. The product of a new u with an earlier u_i is known
before the pass (z_i = X'u_i is kept) and taken off; what the pass then still
measures is taken off again, and where that was more than rounding another pass
follows. The v are orthogonalised twice against all earlier ones. Where a step
breaks down (beta 0: an invariant subspace; alpha 0: a direction without
variance) the method goes on from a new vector orthogonal to all earlier ones,
so repeated eigenvalues are found as often as they occur.

Bounds. The driver holds a few square matrices of the vector length, never
rows. Sums of entries are exact integers. There are as many steps as the
vector has entries: only then is every component good to double precision, as
spectra of embeddings are often flat. ``steps`` stops earlier where fewer
digits do.

Edge cases. Rows whose vector is null, or holds a null or non-finite entry, or
has another length than most vectors have (of equally many the greater length),
are left out. Rows with a null or repeated id each count and are returned. An
entry beyond the range of a long takes the nearest long. Directions without
variance give no component, so equal vectors, a single vector, empty vectors
and an empty table give no rows. ``deviation`` is null where a long cannot hold
it. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from decimal import Decimal
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from listinglab.llm.common import drop, save, ship

#: Rows of a block.
BLOCK = 1024
#: Singular values and steps below this part of the greatest count as zero.
ZERO = 1e-10
#: What a pass may still measure of earlier directions before another one follows.
CLEAN = 1e-9
#: Integers up to this size are added up as machine integers.
SAFE = 1 << 40


class Fit(NamedTuple):
    n: int
    #: Sums of the integer entries, exact.
    sums: list[int]
    #: Unit vectors, one a column, by falling variance.
    components: np.ndarray
    variances: np.ndarray
    #: Sum of all variances.
    total: float


def _valid(vectors: DataFrame, id_col: str, vec_col: str) -> DataFrame:
    """(vec_id, x): long entries of the rows that count."""
    v = F.col(vec_col)
    fine = v.isNotNull() & F.forall(v, lambda c: c.isNotNull() & ~F.isnan(c.cast("double")) & (F.abs(c.cast("double")) < float("inf")))
    return vectors.where(fine).select(F.col(id_col).alias("vec_id"), v.cast("array<double>").alias("c"))


def _blocks(vectors: DataFrame, id_col: str, vec_col: str) -> tuple[DataFrame, int]:
    """Written blocks (ids, x as int64 bytes, row by row), and the length of a vector."""
    kept = _valid(vectors, id_col, vec_col)
    size = kept.groupBy(F.size("c").alias("d")).count().orderBy(F.desc("count"), F.desc("d")).first()
    d = size["d"] if size else 0
    id_type = kept.schema["vec_id"].dataType
    schema = T.StructType([T.StructField("ids", T.ArrayType(id_type)), T.StructField("x", T.BinaryType())])

    def cut(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, BLOCK):
                part = batch.slice(at, BLOCK)
                c = np.floor(part.column(1).flatten().to_numpy(zero_copy_only=False) * 1024)
                # The doubles next to the ends of a long.
                x = np.clip(c, -(2.0**63), 2.0**63 - 1024).astype(np.int64)
                x = np.where(np.abs(c) < 2.0**62, x + 100_000, x)
                ids = part.column(0)
                ids = pa.ListArray.from_arrays(pa.array([0, part.num_rows], pa.int32()), ids)
                yield pa.RecordBatch.from_arrays([ids, pa.array([x.astype("<i8").tobytes()], pa.binary())], ["ids", "x"])

    ship(vectors.sparkSession)
    return save(kept.where(F.size("c") == d).mapInArrow(cut, schema), "whitening"), d


def _rows(batches: Iterable[pa.RecordBatch], d: int, column: int) -> Iterator[np.ndarray]:
    for batch in batches:
        for body in batch.column(column):
            yield np.frombuffer(body.as_buffer(), "<i8").reshape(-1, d)


def _centred(x: np.ndarray, whole: np.ndarray, rest: np.ndarray) -> np.ndarray:
    """x - S/n: the whole part comes off as integers, so no digits are lost."""
    return (x - whole).astype(np.float64) - rest


def _statistics(blocks: DataFrame, d: int) -> tuple[int, list[int]]:
    schema = "i int, v decimal(38,0)"

    def add(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums, n = [0] * d, 0
        for x in _rows(batches, d, 0):
            n += len(x)
            small = not len(x) or (x.max() < SAFE and x.min() > -SAFE)
            part = x.sum(axis=0).tolist() if small else x.astype(object).sum(axis=0).tolist()
            sums = [a + b for a, b in zip(sums, part, strict=True)]
        if n:
            values = [Decimal(v) for v in [*sums, n]]
            yield pa.RecordBatch.from_arrays([pa.array(range(d + 1), pa.int32()), pa.array(values, pa.decimal128(38, 0))], ["i", "v"])

    found = {r["i"]: int(r["v"]) for r in blocks.select("x").mapInArrow(add, schema).groupBy("i").agg(F.sum("v").cast("decimal(38,0)").alias("v")).collect()}
    return found.get(d, 0), [found.get(k, 0) for k in range(d)]


def _pass(blocks: DataFrame, d: int, mean: tuple[np.ndarray, np.ndarray], size: int, measure) -> np.ndarray:
    """``measure(centred block)``, ``size`` numbers, added up over all blocks."""
    whole, rest = mean

    def add(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for x in _rows(batches, d, 0):
            part = measure(_centred(x, whole, rest))
            total = part if total is None else total + part
        if total is not None:
            yield pa.RecordBatch.from_arrays([pa.array(range(size), pa.int32()), pa.array(total)], ["i", "v"])

    out = np.zeros(size)
    for r in blocks.select("x").mapInArrow(add, "i int, v double").groupBy("i").agg(F.sum("v").alias("v")).collect():
        out[r["i"]] = r["v"]
    return out


def _against(vectors: list[np.ndarray], v: np.ndarray) -> np.ndarray:
    """``v`` without its part along the orthonormal ``vectors``; twice is enough."""
    if vectors:
        q = np.array(vectors)
        for _ in range(2):
            v = v - q.T @ (q @ v)
    return v


def _mean(n: int, sums: list[int]) -> tuple[np.ndarray, np.ndarray]:
    parts = [divmod(s, n) for s in sums]
    return np.array([q for q, _ in parts], np.int64), np.array([r / n for _, r in parts])


def _bidiagonalise(blocks: DataFrame, d: int, mean: tuple[np.ndarray, np.ndarray], steps: int, scale: float) -> tuple[np.ndarray, np.ndarray]:
    """(V, B): the orthonormal v as columns, and the bidiagonal matrix."""
    rng = np.random.default_rng(13)
    vs: list[np.ndarray] = []
    #: Of each u with variance: its p, and X'u.
    ps: list[np.ndarray] = []
    zs: list[np.ndarray] = []
    matrix = np.zeros((steps, steps))
    beta, before = 0.0, None
    v = rng.standard_normal(d)
    v /= np.linalg.norm(v)
    for j in range(steps):
        vs.append(v)
        if before is not None and beta:
            matrix[j - 1, j] = beta
        p = v - beta * before if before is not None and beta else v.copy()
        if zs:
            p = p - np.array(ps).T @ (np.array(zs) @ p)
        while True:
            earlier = np.array(ps).T if ps else np.zeros((d, 0))
            k = earlier.shape[1]

            def products(x: np.ndarray, p: np.ndarray = p, earlier: np.ndarray = earlier) -> np.ndarray:
                u = x @ p
                return np.concatenate([(x @ earlier).T @ u, x.T @ u, [u @ u]])

            got = _pass(blocks, d, mean, k + d + 1, products)
            c, z, square = got[:k], got[k:-1], got[-1]
            off = float(c @ c)
            if k:
                p = p - earlier @ c
                z = z - np.array(zs).T @ c
            alpha = float(np.sqrt(max(0.0, square - off)))
            if alpha <= ZERO * scale or off <= (CLEAN * alpha) ** 2:
                break
        if alpha <= ZERO * scale:
            # No variance along v: its column of B ends here.
            alpha, before = 0.0, None
            rest = np.zeros(d)
        else:
            matrix[j, j] = alpha
            ps.append(p / alpha)
            zs.append(z / alpha)
            before = ps[-1]
            rest = _against(vs, zs[-1] - alpha * v)
        beta = float(np.linalg.norm(rest))
        if beta <= ZERO * scale:
            beta, rest = 0.0, _against(vs, rng.standard_normal(d))
        norm = float(np.linalg.norm(rest))
        if j + 1 == d or not norm:
            break
        v = rest / norm
    k = len(vs)
    return np.array(vs).T, matrix[:k, :k]


def fit(blocks: DataFrame, d: int, components: int, steps: int | None = None) -> Fit | None:
    """Components of the vectors in ``blocks``; none without variance."""
    n, sums = _statistics(blocks, d) if d else (0, [])
    if not n:
        return None
    mean = _mean(n, sums)
    total = float(_pass(blocks, d, mean, 1, lambda x: np.array([np.einsum("ij,ij->", x, x)]))[0])
    if not total:
        return None
    v, b = _bidiagonalise(blocks, d, mean, min(d, steps or d), float(np.sqrt(total)))
    _, s, w = np.linalg.svd(b)
    keep = [k for k in range(len(s)) if s[k] > ZERO * s[0]][:components]
    found = v @ w[keep].T
    found /= np.linalg.norm(found, axis=0)
    # One sign for all rows: the greatest entry is positive.
    found *= np.sign(found[np.abs(found).argmax(axis=0), range(len(keep))])
    return Fit(n, sums, found, s[keep] ** 2 / n, total / n)


def _deviations(x: np.ndarray, n: int, sums: list[int]) -> list[int | None]:
    """Sum over dimensions of (n x - S)^2, exact; none beyond a long."""
    reach = [n * max(abs(int(x[:, k].max()) - sums[k] / n), abs(int(x[:, k].min()) - sums[k] / n)) for k in range(x.shape[1])]
    if sum(r * r for r in reach) < 2.0**62 and n * float(np.abs(x).max()) < 2.0**62:
        t = x * n - np.array(sums, np.int64)
        return (t * t).sum(axis=1).tolist()
    t = x.astype(object) * n - np.array(sums, object)
    return [v if v < 1 << 63 else None for v in (t * t).sum(axis=1).tolist()]


def whiten(vectors: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", components: int = 8, steps: int | None = None) -> DataFrame:
    """(vec_id, component, n, deviation, whitened, explained, identity_error): a row for each vector and component."""
    id_type = vectors.schema[id_col].dataType
    schema = T.StructType([
        T.StructField("vec_id", id_type), T.StructField("component", T.IntegerType()), T.StructField("n", T.LongType()),
        T.StructField("deviation", T.LongType()), T.StructField("whitened", T.DoubleType()), T.StructField("explained", T.DoubleType()),
        T.StructField("identity_error", T.DoubleType())])
    blocks, d = _blocks(vectors, id_col, vec_col)
    model = fit(blocks, d, components, steps)
    if model is None:
        drop(blocks)
        return vectors.sparkSession.createDataFrame([], schema)
    n, sums, k = model.n, model.sums, len(model.variances)
    mean = _mean(n, sums)
    project = model.components / np.sqrt(model.variances)

    def moments(x: np.ndarray) -> np.ndarray:
        y = x @ project
        return np.concatenate([(y.T @ y).ravel(), y.sum(axis=0)])

    got = _pass(blocks, d, mean, k * k + k, moments) / n
    error = float(np.abs(got[:k * k].reshape(k, k) - np.outer(got[k * k:], got[k * k:]) - np.eye(k)).max())
    explained = (model.variances / model.total).tolist()

    def rows(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(0)
            for r, x in enumerate(_rows([batch], d, 1)):
                y = _centred(x, *mean) @ project
                m = len(x)
                at = np.repeat(np.arange(m), k)
                yield pa.RecordBatch.from_arrays([
                    ids[r].values.take(pa.array(at)), pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), m)), pa.array(np.full(m * k, n, np.int64)),
                    pa.array(_deviations(x, n, sums), pa.int64()).take(pa.array(at)), pa.array(y.ravel()),
                    pa.array(np.tile(explained, m)), pa.array(np.full(m * k, error))], schema.names)

    return blocks.mapInArrow(rows, schema)
