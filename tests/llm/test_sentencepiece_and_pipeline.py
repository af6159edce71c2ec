import random
import subprocess
import sys
from collections import Counter
from pathlib import Path

import pytest
import sentencepiece

import corpus_pipeline
from listinglab.llm import line_dedup, sentencepiece_codec, toxicity
from listinglab.llm.common import save, table
from listinglab.llm.registry import QUERIES
from tests.llm.conftest import SMALL, brute_components, brute_hits
from tests.llm.test_lines_secrets_benchmark import brute_lines


@pytest.fixture(scope="module")
def data():
    return sentencepiece_codec._model_bytes(sentencepiece_codec.MODEL)


@pytest.fixture(scope="module")
def library(data):
    return sentencepiece.SentencePieceProcessor(model_proto=data)


def test_ids_are_the_librarys(spark, sf, small_documents, library):
    got = {r.doc_id: r for r in QUERIES["op9_sentencepiece"](spark, sf).collect()}
    for (i, t), ids in zip(small_documents, library.encode([t for _, t in small_documents]), strict=True):
        assert (got[i].token_ids, got[i].n_tokens, got[i].round_trip) == (ids, len(ids), True)


def test_random_texts(data, library):
    codec, rng = sentencepiece_codec.codec(data), random.Random(5)
    parts = ["a", "e", "the", "ing", " ", "  ", "    ", "▁", "-", "--", "=", "é", "日", "\U0001f600", "\t", "\n", "\r", "0", "1", "<s>", "\x00"]
    made = ["".join(rng.choices(parts, k=rng.randint(0, 40))) for _ in range(4000)]
    assert [x.tolist() for x in codec.encode(made)] == library.encode(made)
    for text, ids in zip(made, codec.encode(made), strict=True):
        assert codec.decode(ids.tolist()) == library.decode(ids.tolist()) == text.replace("▁", " ")


def test_long_texts_in_parts(data, library, monkeypatch):
    monkeypatch.setattr(sentencepiece_codec, "PART", 7)
    codec = sentencepiece_codec.codec(data)
    for text in ("several  words   in one " * 30, "x" * 100, " " * 50 + "a b", "a\n b\n\n c " * 9):
        assert codec.encode([text])[0].tolist() == library.encode(text)


def test_calls_are_bounded_by_characters(data, library, monkeypatch):
    """Many calls for one text, several texts in one call: the ids stay the library's."""
    monkeypatch.setattr(sentencepiece_codec, "PART", 40)
    monkeypatch.setattr(sentencepiece_codec, "CALL", 100)
    codec = sentencepiece_codec.codec(data)
    made = ["", "several words in one " * 40, "a", "", "x" * 300, "naïve 日本語 \U0001f600 " * 20, "b c"]
    assert [(x.tolist(), ok) for x, ok in codec.encoded(made)] == [(x, True) for x in library.encode(made)]


MEMORY = """
import resource, sys
from listinglab.llm import sentencepiece_codec as s
tool = s.codec(s._model_bytes(s.MODEL))
before = resource.getrusage(resource.RUSAGE_SELF).ru_maxrss
text = " ".join(f"word{k % 9973} some more of it, and {k}" for k in range(35000))
assert len(text) > 1_000_000
for _ in range(6):
    assert all(ok for _, ok in tool.encoded([text, text]))
print((resource.getrusage(resource.RUSAGE_SELF).ru_maxrss - before) // 1024)
"""


def test_texts_of_a_megabyte_stay_small_in_memory(spark):
    """Twelve texts of over a megabyte each: the worker grows by less than 150 MB."""
    done = subprocess.run([sys.executable, "-c", MEMORY], capture_output=True, text=True, cwd=Path(__file__).parents[2])
    assert done.returncode == 0, done.stderr
    assert int(done.stdout) < 150, done.stdout
    long = " ".join(f"word{k % 977} and {k}" for k in range(80_000))
    table_ = spark.createDataFrame([(k, long) for k in range(8)], "doc_id long, text string")
    assert {(r.n_tokens > 100_000, r.round_trip) for r in sentencepiece_codec.encode(table_).select("n_tokens", "round_trip").collect()} == {(True, True)}


def model_of(kind, pieces, fallback):
    """A model file put together by hand (nothing is trained)."""
    from sentencepiece import sentencepiece_model_pb2 as pb

    m = pb.ModelProto()
    m.trainer_spec.model_type, m.trainer_spec.byte_fallback = kind, fallback
    m.normalizer_spec.add_dummy_prefix, m.normalizer_spec.remove_extra_whitespaces = True, False
    m.normalizer_spec.name = "identity"
    every = [("<unk>", 0.0, 2), ("<s>", 0.0, 3), ("</s>", 0.0, 3), *[(f"<0x{b:02X}>", 0.0, 6) for b in range(256 if fallback else 0)], *[(p, s, 1) for p, s in pieces]]
    for piece, score, of in every:
        x = m.pieces.add()
        x.piece, x.score, x.type = piece, score, of
    m.trainer_spec.vocab_size = len(every)
    return m.SerializeToString()


@pytest.mark.parametrize("kind", [1, 2])
def test_unigram_and_bpe_models(kind, monkeypatch):
    pieces = [("▁", -3.0), ("▁a", -2.0), ("a", -4.0), ("b", -4.1), ("ab", -2.5), ("▁ab", -1.5), ("c", -5.0), ("abc", -3.2), ("bc", -3.3)]
    data = model_of(kind, pieces, True)
    codec, library = sentencepiece_codec.Codec(data), sentencepiece.SentencePieceProcessor(model_proto=data)
    for text in ("abc", "a b c", "aab", "cab", "", "abcabc ab", "xyz"):
        assert codec.encode([text])[0].tolist() == library.encode(text), text


def test_models_that_cannot_be_rebuilt_are_refused():
    from sentencepiece import sentencepiece_model_pb2 as pb

    m = pb.ModelProto()
    m.ParseFromString(model_of(2, [("▁", -1.0)], False))
    m.trainer_spec.model_type = 3
    with pytest.raises(ValueError):
        sentencepiece_codec.Model(m.SerializeToString())


def test_hard_cases(spark, messy, messy_rows, empty, library):
    got = sentencepiece_codec.encode(messy)
    want = Counter((i, str(library.encode(t or ""))) for i, t, _ in messy_rows)
    assert Counter((r.doc_id, str(r.token_ids)) for r in got.collect()) == want
    back = sentencepiece_codec.decode(got.where("doc_id IS NOT NULL"))
    assert {r.doc_id: r.text for r in back.collect()} == {i: (t or "").replace("▁", " ") for i, t, _ in messy_rows if i is not None}
    assert sentencepiece_codec.encode(empty).count() == 0


def test_pipeline_against_brute_force(spark, sf, small_documents, library):
    """Each stage on what its predecessor kept, recomputed without the operators' Spark code."""
    scores = toxicity.score_documents(table(spark, SMALL, "documents"), table(spark, SMALL, "labels"), toxicity.fold()).collect()
    clean = {r.doc_id for r in scores if r.score < 0.5}
    rows = [(i, t) for i, t in small_documents if i in clean]
    rows = sorted(brute_lines(rows).elements())
    rows = [(i, t) for (i, t), (_, _, least) in zip(rows, brute_components(rows), strict=True) if i == least]
    items = [(str(r.item_id), r.text) for r in table(spark, SMALL, "benchmark").collect()]
    hit = {i for i, t in rows if brute_hits(t, items)[1]}

    docs, kept = table(spark, SMALL, "documents"), []
    for name, stage in corpus_pipeline.STAGES:
        columns = docs.columns
        docs = save(stage(spark, docs, SMALL), "test-stage")
        if name != corpus_pipeline.STAGES[-1][0]:
            assert docs.columns == columns
            kept.append({r.doc_id: r for r in docs.collect()})
    assert set(kept[0]) == clean
    assert {i: kept[2][i].text for i in kept[2]} == dict(rows)
    assert {i: kept[3][i].text for i in kept[3] if i not in hit} == {i: t for i, t in rows if i not in hit}
    assert all(r.n_chars == len(r.text) and not brute_hits(r.text, items)[1] for r in kept[3].values())
    final = {r.doc_id: r.token_ids for r in docs.collect()}
    assert final == {i: library.encode(r.text) for i, r in kept[3].items()}
    assert {r.doc_id: r.token_ids for r in corpus_pipeline.run(spark, SMALL).collect()} == final


def test_pipeline_of_hard_cases(spark, messy, tmp_path):
    for name in ("labels", "benchmark"):
        table(spark, SMALL, name).write.parquet(str(tmp_path / f"{name}.parquet"))
    for docs in (messy, messy.limit(0)):
        for name, stage in corpus_pipeline.STAGES[:-1]:
            out = save(stage(spark, docs, str(tmp_path)), "test-hard")
            assert out.columns == docs.columns, name
            assert out.count() <= docs.count()
            docs = out
    assert line_dedup.drop_repeated_chunks(messy).count() == messy.count()
