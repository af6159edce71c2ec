import hashlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from listinglab.llm import components, exact_dedup, simhash_dedup
from tests.llm.conftest import brute_components, lower


def brute_groups(rows, largest):
    groups = {}
    for i, t in rows:
        groups.setdefault(lower(t), []).append(i)
    out = Counter()
    for i, t in rows:
        ids = [x for x in groups[lower(t)] if x is not None]
        keep = (max(ids) if largest else min(ids)) if ids else None
        out[i, keep, len(groups[lower(t)]), i == keep, hashlib.sha256(lower(t).encode()).hexdigest()] += 1
    return out


@pytest.mark.parametrize("keep", ["smallest", "largest"])
def test_exact_groups_of_hard_cases(messy, messy_rows, keep):
    got = Counter(map(tuple, exact_dedup.exact_groups(messy, keep=keep).collect()))
    assert got == brute_groups([(i, t) for i, t, _ in messy_rows], keep == "largest")


def test_exact_groups_survive_hash_collisions(messy, messy_rows):
    weak = exact_dedup.exact_groups(messy, content_hash=lambda n: (F.length(n) % 2).cast("string").cast("binary"))
    assert Counter(map(tuple, weak.collect())) == brute_groups([(i, t) for i, t, _ in messy_rows], False)


def test_exact_plan_has_no_python(messy):
    plan = exact_dedup.exact_groups(messy)._jdf.queryExecution().executedPlan().toString()
    assert not any(x in plan for x in ("Python", "Pandas", "Arrow"))


def test_drop_copies_keeps_all_columns_and_one_row_of_each(messy, messy_rows):
    out = exact_dedup.drop_copies(messy)
    assert out.columns == messy.columns
    rows = out.collect()
    assert len(rows) == len({lower(t) for _, t, _ in messy_rows})


def test_empty_tables(empty):
    assert exact_dedup.exact_groups(empty).count() == 0
    assert exact_dedup.drop_copies(empty).count() == 0
    assert simhash_dedup.near_duplicates(empty).count() == 0
    assert simhash_dedup.drop_near_copies(empty).count() == 0


def test_simhash_of_hard_cases(messy, messy_rows):
    want = Counter(brute_components([(i, t) for i, t, _ in messy_rows]))
    got = Counter((r.doc_id, r.fp % 2**64, r.component_id) for r in simhash_dedup.near_duplicates(messy).collect())
    assert got == want


def test_simhash_against_brute_force(spark, sf, small_documents):
    from listinglab.llm.registry import QUERIES

    got = Counter((r.doc_id, int(r.fingerprint, 16), r.component_id) for r in QUERIES["op7_simhash_dedup"](spark, sf).collect())
    assert got == Counter(brute_components(small_documents))


def test_one_document_of_each_component_stays(messy, messy_rows):
    out = simhash_dedup.drop_near_copies(messy)
    assert out.columns == messy.columns
    found = brute_components([(i, t) for i, t, _ in messy_rows])
    assert sorted(r.doc_id for r in out.collect() if r.doc_id is not None) == sorted({i for i, _, c in found if i is not None and i == c})


@pytest.mark.parametrize("tile,band", [(8, 4), (64, 16)])
def test_links_of_dense_and_sparse_fingerprints(spark, monkeypatch, tile, band):
    monkeypatch.setattr(simhash_dedup, "TILE", tile)
    monkeypatch.setattr(simhash_dedup, "BAND", band)
    rng = np.random.default_rng(1)
    seeds = rng.integers(0, 2**63, 30, dtype=np.uint64)
    near = [int(s) ^ sum(1 << int(b) for b in rng.choice(64, 3, replace=False)) for s in seeds for _ in range(8)]
    fps = np.unique(np.array([*seeds.tolist(), *near, 0, 2**64 - 1], np.uint64))
    table = spark.createDataFrame([(int(x),) for x in fps.view(np.int64)], "fp long")
    stars = {r.u: r.v for r in components.components(simhash_dedup.links(table)).collect()}
    want = {}
    for i, _, c in brute_pairs(fps):
        want[i] = c
    assert {int(x): stars.get(int(x), int(x)) for x in fps.view(np.int64)} == want


def brute_pairs(fps):
    from tests.llm.conftest import Sets

    sets = Sets()
    names = fps.view(np.int64).tolist()
    for a, x in zip(names, fps, strict=True):
        sets.find(a)
        for j in np.flatnonzero(np.bitwise_count(fps ^ x) <= 4).tolist():
            sets.join(a, names[j])
    return [(a, None, sets.find(a)) for a in names]


def test_a_group_of_near_copies_gives_few_links():
    base = np.uint64(0x0F0F0F0F0F0F0F0F)
    group = np.array([base ^ np.uint64(1 << a) ^ np.uint64(1 << b) for a in range(64) for b in range(a)], np.uint64)
    found = simhash_dedup.spanning_links(simhash_dedup._sorted(group), None, 4)
    assert len(found) == len(group) - 1


def test_components_of_a_long_chain(spark):
    links = spark.range(60).select(F.col("id").alias("u"), (F.col("id") + 1).alias("v"))
    assert {r.u: r.v for r in components.components(links).collect()} == dict.fromkeys(range(1, 61), 0)


def test_texts_of_one_id_or_of_none_are_all_kept(spark):
    words = [" ".join(f"{a}{k}" for k in range(30)) for a in "abcd"]
    docs = spark.createDataFrame([(5, words[0]), (5, words[1]), (5, words[1]), (None, words[2]), (None, words[3]), (7, words[0])], "doc_id long, text string")
    assert sorted(r.text for r in exact_dedup.drop_copies(docs).collect()) == sorted(words)
    assert sorted(r.text for r in simhash_dedup.drop_near_copies(docs).collect()) == sorted(words)
