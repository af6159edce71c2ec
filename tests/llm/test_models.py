"""Operators 1, 2, 3 and 6: models against brute force, held-out rows and hard cases."""

import math
import re
import zlib
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from listinglab.llm import chargrams, language_id, license_scan, lm_score, toxicity
from listinglab.llm.common import table, texts
from listinglab.llm.registry import QUERIES
from tests.llm.conftest import SMALL, lower

MIDDLE = "/root/testdata/sf0.01"


def crc(i):
    return zlib.crc32(("" if i is None else str(i)).encode())


# Operator 2

def brute_base(rows, part, fold):
    tokens = [[*re.findall(r"[^\x20\x09-\x0D]+", lower(t)), None] for _, t in rows]
    c = Counter(w for (i, _), own in zip(rows, tokens, strict=True) if crc(i) % part != fold for w in own)
    n, v = sum(c.values()), len(c)
    return [(i, crc(i) % part == fold, len(own), sum(c[w] > 0 for w in own), n, sum(math.log10((c[w] + 1) / (n + v + 1)) for w in own))
            for (i, _), own in zip(rows, tokens, strict=True)]


def same_base(got, want):
    key = lambda r: (r[0] is None, r[0] or 0, r[2], r[5])
    for g, w in zip(sorted((tuple(r)[:6] for r in got), key=key), sorted(want, key=key), strict=True):
        assert g[:5] == w[:5] and g[5] == pytest.approx(w[5], rel=1e-9)


@pytest.mark.parametrize("short,head", [(512, 1 << 17), (3, 10)])
def test_language_model_of_hard_cases(messy, messy_rows, short, head):
    got = lm_score.score(messy, lm_score.fold(), short=short, head=head).collect()
    same_base(got, brute_base([(i, t) for i, t, _ in messy_rows], 7, 2))
    assert all(r.score <= 0 and math.isfinite(r.score) for r in got)


def test_language_model_beats_the_base_on_held_out_texts(spark, sf, small_documents):
    got = QUERIES["op2_lm_score"](spark, sf).collect()
    same_base(got, brute_base(small_documents, 7, 2))
    assert sum(r.score for r in got if r.held_out) > 0.95 * sum(r.base_score for r in got if r.held_out)


def test_language_model_probabilities_add_up(messy):
    train = texts(messy).select("body")
    model, counted = lm_score.fit(train, short=5, head=10)
    each = 10 ** model.table()
    assert np.allclose(each.sum(axis=1), 1)
    counts = np.sort([r.c for r in counted.collect()])[::-1]
    rare = counts[model.short:]
    assert 10 ** model.in_rare(np.array([0]))[0] + (10 ** model.in_rare(rare)).sum() == pytest.approx(1)


def test_language_model_score_is_the_sum_of_its_tables(spark, messy, messy_rows):
    """Every token of every text, one at a time, from the model's own tables."""
    model, counted = lm_score.fit(texts(messy, "doc_id", "text", lm_score.fold().alias("o")).where("NOT o").select("body"), 5, 10)
    c = {bytes(r.word): r.c for r in counted.collect()}
    logs, first = model.table(), {w: k for k, w in enumerate(model.words[:model.short])}

    def one(text):
        total, last, after_rare, k = 0.0, model.short, False, model.short
        for w in [*lower(text).encode().split(), None]:
            cls = k + 1 if w is None else first.get(w, k)
            total += logs[last + (k + 1) * after_rare, cls]
            if cls == k:
                total += model.in_rare(np.array([c.get(w, 0)]))[0]
            last, after_rare = (cls, False) if cls < k else (last, True)
        return total

    got = Counter((r.doc_id, round(r.score, 5)) for r in lm_score.score(messy, lm_score.fold(), short=5, head=10).collect())
    assert got == Counter((i, round(one(t), 5)) for i, t, _ in messy_rows)


def test_noise_contrastive_estimation_finds_the_distribution():
    rng = np.random.default_rng(0)
    truth = rng.dirichlet(np.ones(6) * 0.5, 8)
    counts = np.round(truth * 50_000)
    contexts, classes, bias = lm_score.fit_nce(counts, dimensions=6, steps=800)
    scores = contexts @ classes.T + bias
    p = np.exp(scores) / np.exp(scores).sum(axis=1, keepdims=True)
    unigram = counts.sum(axis=0) / counts.sum()
    loss = -(counts * np.log(p)).sum() / counts.sum()
    assert loss < -(counts * np.log(unigram)).sum() / counts.sum() * 0.8
    assert loss < 1.05 * -(counts * np.log(np.maximum(truth, 1e-12))).sum() / counts.sum()


def test_language_model_of_words_with_one_count(spark):
    """More words tie at the highest count than the head takes: the shortlist is full all the same, and each word counts once."""
    rows = [(k, " ".join(f"w{j:02}" for j in range(30))) for k in range(8)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    model, _ = lm_score.fit(texts(docs).select("body"), short=5, head=10)
    assert model.words == [b"w00", b"w01", b"w02", b"w03", b"w04"] and model.short == 5
    same_base(lm_score.score(docs, lm_score.fold(), short=5, head=10).collect(), brute_base(rows, 7, 2))


def test_language_model_without_training_texts(messy, empty):
    got = lm_score.score(messy, F.lit(True)).collect()
    assert len(got) == messy.count() and {r.train_tokens for r in got} == {0} and all(math.isfinite(r.score) for r in got)
    assert lm_score.score(empty, lm_score.fold()).count() == 0


# Operator 6

def test_languages_of_held_out_texts(spark):
    lang = dict(duckdb.sql(f"SELECT doc_id, lang FROM '{MIDDLE}/documents.parquet'").fetchall())
    got = [r for r in QUERIES["op6_language_id"](spark, MIDDLE).collect() if r.held_out]
    assert got and all(r.held_out == (crc(r.doc_id) % 4 == 2) for r in got)
    assert sum(r.lang_pred == lang[r.doc_id] for r in got) > 0.98 * len(got)
    assert sum(r.accepted for r in got) > 0.9 * len(got)


def test_languages_of_hard_cases(messy, messy_rows, empty):
    got = language_id.identify(messy, language_id.fold()).collect()
    letters = Counter((i, any(map(str.isalpha, t or ""))) for i, t, _ in messy_rows)
    assert Counter((r.doc_id, r.lang_pred != "und") for r in got) == letters
    assert all(0 <= r.score <= 1 and r.lang_pred in ("en", "de", "fr", "und") for r in got)
    assert language_id.identify(empty, language_id.fold()).count() == 0
    assert {r.lang_pred for r in language_id.identify(messy, F.lit(True)).collect()} == {"und"}


def brute_model(texts_by_language):
    """p(language, history, character) by the definition: interpolated Kneser-Ney over the words, each between blanks."""
    top = language_id.ORDER
    words = {x: [f" {w} " for t in ts for token in t.lower().split() for w in chargrams.LETTERS.findall(token)] for x, ts in texts_by_language.items()}
    alphabet = len({c for ws in words.values() for w in ws for c in w}) + 1
    counts, levels = {}, {}
    for x, ws in words.items():
        raw = Counter()
        for w in ws:
            for k in range(1, len(w)):
                raw.update(w[k - m + 1:k + 1] for m in range(1, min(k + 1, top) + 1))
        kinds = Counter(g[1:] for g in raw if len(g) > 1)
        counts[x] = {g: n if len(g) == top or (len(g) > 1 and g[0] == " ") else kinds[g] for g, n in raw.items()}
        for m in range(1, top + 1):
            once, twice = (sum(len(g) == m and n == v for g, n in counts[x].items()) for v in (1, 2))
            levels[x, m] = min(0.9, max(0.1, once / max(once + 2 * twice, 1)))

    def p(x, gram):
        if not gram:
            return 1 / alphabet
        followers = [n for g, n in counts[x].items() if len(g) == len(gram) and g[:-1] == gram[:-1]]
        if not sum(followers):
            return p(x, gram[1:])
        d, total = levels[x, len(gram)], sum(followers)
        return max(counts[x].get(gram, 0) - d, 0) / total + d * sum(n > 0 for n in followers) / total * p(x, gram[1:])

    def bits(x, text):
        parts = [-math.log2(p(x, w[max(0, k - top + 1):k + 1])) for token in text.lower().split() for w in (f" {r} " for r in chargrams.LETTERS.findall(token))
                 for k in range(1, len(w))]
        return sum(parts) / len(parts) if parts else None

    return p, bits, sorted({c for ws in words.values() for w in ws for c in w})


TRAINED = {"en": ["the then that", "hat tent a the 2nd", "that theatre"], "de": ["der dann das", "Hut Zelt ein das, die", "über"], "x": ["zzz zz\u4e00 \u4e00z"]}


@pytest.mark.parametrize("block", [language_id.BLOCK, 40])
def test_languages_by_the_definition(spark, block):
    """Every text's cross-entropy, language and score against the plain definition; in one block, and in many."""
    asked = ["the tent", "das Zelt der", "zz \u4e00", "THE über-then 12", "unknown words", "", "12 34", "the tent", None]
    train = [(k, t, x, False) for k, (x, t) in enumerate((x, t) for x, ts in TRAINED.items() for t in ts)]
    rows = train + [(100 + k // 2, t, None, True) for k, t in enumerate(asked)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, held_out boolean")
    source = texts(df, "doc_id", "text", F.col("held_out"), F.col("lang"))
    fitted = language_id.fit(source.where("NOT held_out"), block)
    assert (fitted.blocks > 2) == (block == 40) and fitted.languages == ["de", "en", "x"]
    p, bits, alphabet = brute_model(TRAINED)
    for history in ("", " ", " t", "the", "zz"):
        assert all(sum(p(x, history + c) for c in alphabet) + p(x, history + "?") == pytest.approx(1) for x in TRAINED)
    got = language_id.identify(df, F.col("held_out"), block=block).where("held_out").collect()
    want = []
    for k, t in enumerate(asked):
        b = [bits(x, t or "") for x in fitted.languages]
        if b[0] is None:
            want.append((100 + k // 2, "und", 0.0, None))
            continue
        z = np.exp(-(np.array(b) - min(b)) * fitted.temperature)
        want.append((100 + k // 2, fitted.languages[int(np.argmin(b))], float(1 / z.sum()), min(b)))
    assert len(got) == len(want)
    for r, w in zip(sorted(got, key=lambda r: (r.doc_id, r.bits or 0)), sorted(want, key=lambda w: (w[0], w[3] or 0)), strict=True):
        assert (r.doc_id, r.lang_pred) == w[:2] and r.score == pytest.approx(w[2], abs=1e-9) and (r.bits is None) == (w[3] is None)
        assert w[3] is None or r.bits == pytest.approx(w[3], abs=1e-9)


def test_blocks_are_bounded_whatever_the_languages(spark):
    """Two hundred languages: no block holds much more than its bound, and a language's own texts are its."""
    rng = np.random.default_rng(3)
    rows = []
    for k in range(200):
        letters = list(rng.choice([chr(0x61 + j) for j in range(26)] + [chr(0x430 + j) for j in range(32)], 12, replace=False))
        rows += [(k, " ".join("".join(rng.choice(letters, 5)) for _ in range(12)).encode(), f"l{k:03}") for _ in range(2)]
    fitted = language_id.fit(spark.createDataFrame(rows, "doc_id long, body binary, lang string"), block=4000, calibration=40)
    assert len(fitted.languages) == 200 and fitted.blocks > 4
    sizes = [sum(len(e.lang) for e in fitted.model(k).grams[3:]) for k in range(fitted.blocks)]
    assert sum(sizes) == fitted.counted.where("m > 2").count() and max(sizes) < 2 * 4000


# Operator 1

@pytest.fixture(scope="module")
def chars(spark):
    return toxicity.CharModel(toxicity.char_counts(texts(table(spark, MIDDLE, "documents"))))


def test_character_counts(spark, chars):
    docs = spark.createDataFrame([("ab  cab",), ("É1a",), (None,), ("",)], "text string").select(F.lit(1).alias("doc_id"), "text")
    counts = toxicity.char_counts(texts(docs).coalesce(1)).reshape(28, 28, 28)
    assert counts[0, 0, 1] >= 1 and counts[0, 1, 2] == 1 and counts[0, 3, 1] == 1 and counts[3, 1, 2] == 1 and counts[0, 27, 0] == 1


@pytest.mark.parametrize("noisy,plain", [("1d10t", "idiot"), ("$tup1d", "stupid"), ("s.t.u.p.i.d", "stupid"), ("stuuuupid", "stupid"), ("m0r0n", "moron"),
                                         ("p@thet1c", "pathetic"), ("tr@sh", "trash"), ("id!ot", "idiot"), ("l0ser", "loser"), ("iiidiooot", "idiot")])
def test_restoring(chars, noisy, plain):
    assert toxicity.decode(toxicity.suspicious(noisy), chars) == [plain]
    assert "".join(toxicity.decode(plain, chars, spaced=True)) == plain


def test_masks_accents_and_symbols(chars):
    """Disguises that hold no digit: masked letters reach the lattice; accented and symbol words do where the plainer word weighs."""
    assert [toxicity.suspicious(t) for t in ("s**t", "d**k", "id**t", "id*ot!")] == ["s**t", "d**k", "id**t", "id*ot"]
    assert [toxicity.suspicious(t) for t in ("de***", "que&&&", "word", "12", "x%%%")] == [None] * 5
    assert [toxicity.decode(t, chars) for t in ("st*pid", "m*ron", "l*ser")] == [["stupid"], ["moron"], ["loser"]] and len(toxicity.decode("s**t", chars)[0]) == 4
    assert [toxicity.plainer(t) for t in ("stüpid", "@$$", "idiiot", "455", "word", "$$", "ñandú")] == ["stupid", "ass", "idiot", None, None, None, "nandu"]
    words = ["stupid", "idiot", "ass"]
    g = chargrams.Grams(words, toxicity.LONG)
    keys = np.unique(np.concatenate([g.hash[m][g.at(m)] + np.uint64(m) for m in range(toxicity.SHORT, toxicity.LONG + 1)]))
    reader = toxicity._Reader(chars, keys, np.ones(len(keys)))
    plain = [set(f.tolist()) for f in reader.features_of([w.encode() for w in words])]
    for body, k in (("you stüpid man", 0), ("ïdìôt", 1), ("what an @$$ he is", 2), ("stuupid!", 0)):
        assert plain[k] <= set(reader.features_of([body.encode()])[0].tolist()), body
    assert not len(reader.features_of(["für über 455 ñandú".encode()])[0])


def test_viterbi_finds_the_best_path(chars):
    """Against all paths of short tokens."""
    from itertools import groupby, product

    def cost(text):
        a = b = 0
        total = 0.0
        for s in [*map(toxicity.symbol, text), 0]:
            if not (s == b == 0):
                total += chars.list[a][b][s]
            a, b = (b if s else 0), s
        return total

    for token in ("1d10t", "a.b", "t00", "x!y", "aaa", "s-t"):
        options = [toxicity._alternatives(c, sum(1 for _ in run), False) for c, run in groupby(token)]
        best = min(product(*options), key=lambda path: cost("".join(s for s, _ in path)) + sum(c for _, c in path))
        assert toxicity.decode(token, chars) == "".join(s for s, _ in best).split()


def test_plain_tokens_are_not_decoded():
    assert [t for t in ("the", "l'eau", "end.", "(see", "1234", "...", "thon$$$", "&&&") if toxicity.suspicious(t)] == ["l'eau"]


def test_toxic_labels_of_held_out_texts(spark):
    truth = dict(duckdb.sql(f"SELECT doc_id, toxic FROM '{MIDDLE}/labels.parquet'").fetchall())
    got = QUERIES["op1_toxicity"](spark, MIDDLE).collect()
    assert all(r.held_out == (crc(r.doc_id) % 5 == 0) and 0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in got)
    held = [(r.predicted, truth[r.doc_id]) for r in got if r.held_out and r.doc_id in truth]
    assert sum(a == b for a, b in held) > 0.93 * len(held)
    assert sum(a for a, b in held if b) > 0.5 * sum(b for _, b in held)


def test_disguised_words_count(spark):
    docs, labels = table(spark, MIDDLE, "documents"), table(spark, MIDDLE, "labels")
    model = toxicity.fit(texts(docs), labels.select("doc_id", "toxic"))
    rows = [(1, "the idiot and the moron of this, stupid loser and scum"), (2, "the 1d10t and the m0r0n of this, $tup1d l0ser and scuuuum"),
            (3, "the thing and the other of this, and that for the in"), (4, "the i d i o t and m o r o n , s t u p i d"), (5, "")]
    got = {r.doc_id: r.score for r in toxicity.score(texts(spark.createDataFrame(rows, "doc_id long, text string")), model).collect()}
    assert got[1] > 0.5 and got[2] > 0.5 and got[4] > 0.5 and got[3] < 0.5 and got[5] < 0.5


def test_toxicity_of_hard_cases(spark, messy, messy_rows, empty):
    labels = spark.createDataFrame([(1, 1), (2, 0), (2, 1), (9, 0), (None, 1), (10, None), (11, 0), (77, 1)], "doc_id long, toxic int")
    got = toxicity.score_documents(messy, labels, toxicity.fold()).collect()
    assert Counter(r.doc_id for r in got) == Counter(i for i, _, _ in messy_rows)
    out = toxicity.drop_toxic(messy, labels, toxicity.fold())
    assert out.columns == messy.columns and out.count() == sum(r.score < 0.5 for r in got)
    assert all(r.predicted == 0 for r in toxicity.score_documents(messy, labels.limit(0), toxicity.fold()).collect())
    assert toxicity.score_documents(empty, labels, toxicity.fold()).count() == 0


# Operator 3

@pytest.fixture(scope="module")
def licences(spark):
    return license_scan.train(license_scan.background(table(spark, MIDDLE, "documents")))


# The licence lines that the documents hold.
KNOWN = {"Licensed under the Apache License, Version 2.0.": "apache-2.0", "Released under the MIT License.": "mit", "Licensed under CC BY-NC 4.0.": "cc-by-nc-4.0",
         "This work is licensed under the GNU General Public License, version 3.": "gpl-3.0", "All rights reserved.": "proprietary"}


def test_licence_lines_of_all_documents(spark, licences):
    want = Counter((i, line.strip(), KNOWN[line.strip()]) for i, t in duckdb.sql(f"SELECT doc_id, text FROM '{MIDDLE}/documents.parquet'").fetchall()
                   for line in (t or "").split("\n") if line.strip() in KNOWN)
    found = license_scan.scan(table(spark, MIDDLE, "documents"), licences).collect()
    assert want and Counter((r.doc_id, r.text.strip(), r.family) for r in found) == want


def test_licences_of_hard_cases(spark, licences, messy, empty):
    got = {(r.doc_id, r.n_lines, r.families) for r in license_scan.document_licences(messy, licences).collect()}
    assert got == {(19, 2, "mit,proprietary")}
    assert license_scan.scan(empty, licences).count() == 0
    assert license_scan.document_licences(empty).count() == 0
    rows = [(1, "Licensed under the Foo Bar License, version 7."), (2, "x\nThis program is distributed under GPLv3.\n"), (3, "Copyright 2019 ACME. All rights reserved."),
            (4, "of and to in"), (5, "You can use it under the terms of the Mozilla Public License 2.0"), (6, "in version 3")]
    found = {r.doc_id: r.family for r in license_scan.scan(spark.createDataFrame(rows, "doc_id long, text string"), licences).collect()}
    assert found == {1: "unknown", 2: "gpl-3.0", 3: "proprietary", 5: "mpl-2.0"}


def families(spark, model, lines):
    df = spark.createDataFrame(list(enumerate(lines)), "doc_id long, text string")
    out = {}
    for r in license_scan.scan(df, model).collect():
        out.setdefault(r.doc_id, set()).add(r.family)
    return [out.get(k, set()) for k in range(len(lines))]


def test_every_notice_gets_its_family(spark, licences):
    lines = [(lead + t, f) for f in license_scan.NOTICES for t in license_scan.notices(f) for lead in license_scan.LEADS]
    got = families(spark, licences, [t for t, _ in lines])
    assert [(t, f, g) for (t, f), g in zip(lines, got, strict=True) if g != {f}] == []


def test_reworded_and_wrapped_notices(spark, licences):
    """Wording that is no training row, in comments and over lines."""
    texts_ = {
        "mit": "// Permission is hereby granted, free of charge, to any person obtaining a copy\n// of this software and associated documentation files (the \"Software\"), to deal\n"
               "// in the Software without restriction",
        "apache-2.0": "# Licensed to us under one or more agreements under the Apache License, Version 2.0 (the\n# \"License\"); you may not use this file except in compliance\n# with the License.",
        "gpl-3.0": " * This library can be redistributed under the terms of the GNU General Public License as\n * published by the Free Software Foundation, either version 3 of the License.",
        "bsd": "Redistribution and use in source or binary form, with or without any modification, are\npermitted provided that the following conditions are met:",
        "mpl-2.0": "Everything here falls under the Mozilla Public License, version 2.0, as usual",
        "cc-by-4.0": "The pictures are under a Creative Commons Attribution 4.0 International License too",
    }
    assert dict(zip(texts_, families(spark, licences, list(texts_.values())), strict=True)) == {f: {f} for f in texts_}
    plain = ["We went to the public library, and the foundation of the house was free of damage.", "Version 3 of the plan was published by the city", "of the\nand the"]
    assert families(spark, licences, plain) == [set()] * 3


def brute_findings(model, text):
    """Paragraphs, grams, regression and templates in plain Python."""
    t = re.sub(r"(?m)^[ \t]*(?:[#;%*]+|//+|--+|/\*+)[ \t]*|\r$|[ \t]+$", "", text or "")
    t = re.sub(r"(?<=[^\W_])\n(?=[a-z0-9(\"'])|(?<=[,;)\"'])\n(?=[a-z0-9(\"'])", " ", t)
    t = re.sub(r"(?m)^([^\n]{50,120}(?:[^\W_]|[,)]))\n(?=[^\s])", r"\1 ", t)
    place, out = {g: k for k, g in enumerate(model.grams)}, []
    for line in t.split("\n"):
        grams = license_scan._plain_grams(line)
        own = [g for g in grams if g in place]
        if not any(" " not in g for g in own):
            continue
        z = model.bias + sum(model.weights[place[g]] for g in own)
        best = int(np.argmax(z))
        if model.classes[best] == "none":
            continue
        share = 0.0
        for notice in license_scan.notices(model.classes[best]):
            template = license_scan._template(notice)
            share = max(share, sum(g in grams for g in template) / min(len(template), max(1, sum(" " in g for g in grams))))
        sure = 1 / np.exp(z - z[best]).sum()
        out.append((line, model.classes[best] if sure >= model.threshold and share >= license_scan.SIMILAR else "unknown", round(float(sure), 6), round(share, 6)))
    return out


def test_scan_against_brute_force(spark, licences, small_documents, messy, messy_rows):
    made = [(-k, "x\nLicensed under " + " ".join(np.random.default_rng(k).permutation("the Apache MIT License Version 2.0 GNU General Public of".split()))) for k in range(1, 40)]
    rows = [*small_documents, *made, *[(i, t) for i, t, _ in messy_rows if i != 9]]
    found = license_scan.scan(spark.createDataFrame(rows, "doc_id long, text string"), licences).collect()
    want = Counter((i, *r) for i, t in rows for r in brute_findings(licences, t))
    assert Counter((r.doc_id, r.text, r.family, round(r.probability, 6), round(r.similarity, 6)) for r in found) == want and len(want) > 40


def test_native_grams_are_the_trainers(spark):
    for line in ("Licensed under CC BY-NC 4.0.", "a_b c-d  e", "", "É 2.0.1 x.y", "one"):
        got = spark.createDataFrame([(line,)], "t string").select(license_scan.grams_of(license_scan.words_of(F.col("t"))).alias("g")).first().g
        assert set(got) == license_scan._plain_grams(line)


def test_licence_plan_has_no_python(messy, licences):
    plan = license_scan.document_licences(messy, licences)._jdf.queryExecution().executedPlan().toString()
    assert not any(x in plan for x in ("Python", "Pandas", "Arrow"))


def test_language_thresholds_come_from_all_training_rows(spark):
    """One text in 6,000 is the worst of its language: only a fit that reads every row has it in the temperature's likelihood and the quantile."""
    import numpy as np
    from listinglab.llm import language_id as LI
    from pyspark.sql import functions as F

    n = 6000
    rows = spark.range(n).select(F.when(F.col("id") % 2 == 0, "a").otherwise("b").alias("lang"), F.col("id").cast("double").alias("x"))
    found = rows.select("lang", F.when(F.col("lang") == "a", F.array(F.col("x"), F.lit(9000.0))).otherwise(F.array(F.lit(9000.0), F.col("x"))).alias("bits"))
    got = LI._calibrated(LI.Fitted(["a", "b"], None, None, 1), found)
    want = [float(np.quantile(np.arange(k, n, 2), LI.ACCEPT)) * 1.05 for k in (0, 1)]
    assert list(got.thresholds) == pytest.approx(want) and 1 <= got.temperature <= 60
    none = LI._calibrated(LI.Fitted(["a", "b"], None, None, 1), found.where("false"))
    assert none.thresholds == (float("inf"),) * 2 and none.temperature == 30.0


def test_a_word_is_looked_up_once_for_a_token(monkeypatch):
    """A worker finds or places a token's word in one look-up, and forgets words when it holds too many, with the same sums."""
    looked: Counter = Counter()

    class Word(str):
        def __hash__(self):
            looked[str(self)] += 1
            return super().__hash__()

        __eq__ = str.__eq__

    rows = {"lang": np.zeros(2, np.int64), "m": np.ones(2, np.int64), "gram": np.array([97, 98], np.uint64), "c": np.array([3, 1]),
            **{k: np.zeros(2, np.uint64) for k in ("suffix", "context")}, "starts": np.zeros(2, bool)}
    none = [None] * 2 + [language_id._entries(np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0))] * 4
    model = language_id.kneser_ney(rows, ["x"])._replace(grams=none, contexts=none)
    plain = language_id._Reader(model).sums([b"ab ab 7 b", b"", b"b ab a-b"])
    assert plain[:, -1].tolist() == [3 + 3 + 2, 0, 2 + 3 + 4]
    split = language_id.tokens
    monkeypatch.setattr(language_id, "tokens", lambda body: [Word(t) for t in split(body)])
    reader = language_id._Reader(model)
    assert (reader.sums([b"ab ab 7 b", b"", b"b ab a-b"]) == plain).all()
    looked.clear()
    assert (reader.sums([b"ab ab 7 b", b"", b"b ab a-b"]) == plain).all() and looked == {"ab": 3, "7": 1, "b": 2, "a-b": 1}
    monkeypatch.setattr(language_id, "HELD_WORDS", 1)
    assert (reader.sums([b"b ab a-b"]) == plain[2:]).all() and len(reader.place) == 3
