"""Periodic runs and whitening, against brute force."""

import hashlib
import math
import random
import re
import zlib
from fractions import Fraction

import numpy as np
import pytest

from listinglab.llm import period_runs, whitening
from listinglab.llm.period_runs import Run
from listinglab.llm.registry import op12_period_runs, op13_whitening

from tests.llm.conftest import SMALL


def brute_runs(words):
    n, out = len(words), []
    for q in range(1, n // 3 + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            s = words[i:j + q]
            if j > i and len(s) >= max(24, 3 * q) and not any(q % d == 0 and s[d:] == s[:-d] for d in range(1, q)):
                out.append((i, len(s), q))
            i = j + 1
    return sorted(out)


def brute_row(doc_id, text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    n = len(words)
    h = zlib.crc32(str(doc_id).encode())
    if doc_id is not None and h % 10 == 0 and n:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    runs = brute_runs(words)
    gone = {k for s, length, q in runs for k in range(s + q, s + length)}
    best = max(runs, key=lambda r: (Fraction(r[1], r[2]), -r[0], -r[2]), default=(None, None, None))
    sha = [hashlib.sha256(t.encode()).hexdigest() for t in (
        "".join(f"{s},{length},{q}\n" for s, length, q in runs), " ".join(w for k, w in enumerate(words) if k not in gone))]
    return (doc_id, len(runs), *best, 1000 * best[1] // best[2] if runs else None, *sha)


def test_runs_of_random_sequences():
    rng, total = random.Random(5), 0
    for _ in range(400):
        k = rng.choice([1, 2, 2, 3, 5])
        c = [rng.randrange(k) for _ in range(rng.randint(0, 150))]
        for _ in range(rng.randint(0, 3)):
            block = [rng.randrange(k) for _ in range(rng.randint(1, 50))]
            a = rng.randint(0, len(c))
            c = c[:a] + block * rng.randint(1, 5) + block[:rng.randint(0, len(block))] + c[a:]
        c = (c * rng.randint(1, 3))[:500]
        want = [Run(*r) for r in brute_runs(c)]
        assert period_runs.find_runs(np.array(c, np.int64)) == want
        total += len(want)
    assert total > 200


def test_hot_grams_stay_cheap():
    assert period_runs.find_runs(np.zeros(200_000, np.int64)) == [Run(0, 200_000, 1)]
    assert period_runs.find_runs(np.arange(200_000) % 50_000) == [Run(0, 200_000, 50_000)]
    # One gram of 20 words at 5,000 places between words that occur once: no run, and no pair for each two places.
    seq = np.concatenate([np.r_[np.arange(20), 100 + k] for k in range(5000)])
    assert period_runs.find_runs(seq) == []


def test_long_document_with_copies_of_a_passage():
    rng = random.Random(2)
    words = [rng.randrange(10**6) for _ in range(3000)]
    seq = words + words[:900] * 4 + words[100:2000] + [7] * 40 + words[:500] * 2
    assert period_runs.find_runs(np.array(seq, np.int64)) == [Run(*r) for r in brute_runs(seq)]


def test_query_equals_brute_force(spark, small_documents):
    got = {tuple(r) for r in op12_period_runs(spark, SMALL).collect()}
    assert got == {brute_row(*r) for r in small_documents}
    assert sum(r[1] > 0 for r in got) > 10


def test_runs_of_messy_rows(spark, messy, messy_rows, empty):
    got = sorted(((r.doc_id, [tuple(x) for x in r.runs], r.collapsed) for r in period_runs.scan(messy).collect()), key=repr)
    want = []
    for i, text, _ in messy_rows:
        words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
        runs = brute_runs(words) if len(words) < 1000 else [tuple(r) for r in period_runs.find_runs(period_runs.codes_of([w.encode() for w in words]))]
        gone = {k for s, length, q in runs for k in range(s + q, s + length)}
        want.append((i, runs, " ".join(w for k, w in enumerate(words) if k not in gone)))
    assert got == sorted(want, key=repr)
    assert period_runs.scan(empty).collect() == []


def brute_whitened(rows, components=8):
    x = np.floor(np.array([v for _, v in rows], np.float64) * 1024) + 100_000
    n, sums = len(x), x.sum(axis=0)
    centred = x - sums / n
    e, v = np.linalg.eigh(centred.T @ centred / n)
    e, v = e[::-1][:components], v[:, ::-1][:, :components]
    return ((n * x - sums) ** 2).sum(axis=1), centred @ v / np.sqrt(e), e / np.trace(centred.T @ centred / n)


def held_against(rows, got, components=8):
    deviation, whitened, explained = brute_whitened(rows, components)
    assert len(got) == len(rows) * components
    by = {(r.vec_id, r.component): r for r in got}
    mine = np.array([[by[i, c + 1].whitened for c in range(components)] for i, _ in rows])
    sign = np.sign((mine * whitened).sum(axis=0))
    assert np.abs(mine * sign - whitened).max() < 1e-9
    assert [by[i, 1].deviation for i, _ in rows] == [int(d) for d in deviation]
    assert all(math.isclose(by[rows[0][0], c + 1].explained, explained[c], rel_tol=1e-9) for c in range(components))
    assert {r.n for r in got} == {len(rows)}
    assert max(r.identity_error for r in got) < 1e-9


def test_whitening_query(spark):
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{SMALL}/embeddings.parquet").collect()]
    held_against(rows, op13_whitening(spark, SMALL).collect())


@pytest.mark.parametrize("block", [3, 1024])
def test_whitening_of_hard_rows(spark, monkeypatch, block):
    monkeypatch.setattr(whitening, "BLOCK", block)
    rng = np.random.default_rng(1)
    fine = [(k, [float(c) for c in rng.normal(0, [5, 1, 0.1, 3])]) for k in range(60)]
    fine += [(k, fine[0][1]) for k in range(60, 90)]
    bad = [(900, None), (901, [1.0, None, 2.0, 3.0]), (902, [float("nan"), 0.0, 0.0, 0.0]), (903, [0.0, float("inf"), 0.0, 0.0]), (904, [1.0]), (905, [])]
    schema = "vec_id long, embedding array<double>, x string, ids string, component string"
    df = spark.createDataFrame([(*r, "a", "b", None) for r in fine + bad], schema)
    held_against(fine, whitening.whiten(df, components=4).collect(), 4)
    repeated = whitening.whiten(df.withColumn("vec_id", df.vec_id * 0), components=1).collect()
    assert len(repeated) == 90 and {r.vec_id for r in repeated} == {0}
    nameless = whitening.whiten(df.selectExpr("cast(null as string) AS vec_id", "embedding"), components=1).collect()
    assert len(nameless) == 90 and {r.vec_id for r in nameless} == {None}


def test_whitening_without_variance(spark):
    schema = "vec_id long, embedding array<float>"
    for rows in ([], [(1, [1.0, 2.0])], [(1, [1.0, 2.0])] * 5, [(1, [])], [(1, None)]):
        df = spark.createDataFrame(rows, schema)
        out = whitening.whiten(df)
        assert out.collect() == [] and out.columns[:2] == ["vec_id", "component"]


def test_repeated_eigenvalues_and_flat_directions(spark):
    """Variances 4, 4, 4, 1, 0: the three equal ones are all found, and the last direction is none."""
    axes = np.eye(5) * np.array([2, 2, 2, 1, 0])
    rows = [(k, [float(c) for c in v / 32]) for k, v in enumerate(np.concatenate([axes[:4], -axes[:4]]) * 32)]
    got = whitening.whiten(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect()
    assert {r.component for r in got} == {1, 2, 3, 4}
    explained = {r.component: r.explained for r in got}
    assert [round(explained[c] * 13, 9) for c in (1, 2, 3, 4)] == [4, 4, 4, 1]
    assert max(r.identity_error for r in got) < 1e-9


def test_great_entries(spark):
    """Sums and deviations beyond a long: exact sums, null deviations."""
    rows = [(k, [float(k) * 1e14, 1.0 + k]) for k in range(40)]
    got = whitening.whiten(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), components=1).collect()
    assert len(got) == 40 and all(r.deviation is None for r in got if abs(r.whitened) > 0.1)
    assert max(r.identity_error for r in got) < 1e-6
    whitening.whiten(spark.createDataFrame([(1, [1e300]), (2, [-1e300])], "vec_id long, embedding array<double>")).collect()
