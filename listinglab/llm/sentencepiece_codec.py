"""Operator 9: SentencePiece encoding and decoding on the tokenizers library.

A model file is read as what it is, a protobuf message: pieces with scores and
types, the trainer's and the normaliser's settings. From these the tokenizer
is rebuilt: the normaliser (a precompiled character map where the model has
one, removal of extra blanks), the metaspace marker and the dummy prefix, the
scores (a unigram lattice, or merges in the order of their pieces' scores for
a BPE model) and byte fallback. Each worker encodes a batch with several
threads. When a worker builds a tokenizer it verifies on ``PROBES`` that the
ids equal those of the sentencepiece library, and refuses the model if not.

Long texts are encoded in parts, cut before a blank that follows a
non-blank. No piece of a BPE model with whitespace splitting holds such a
place (checked when the model is read), so the parts' ids put together are the
text's; other models get whole texts.

Memory. What a worker holds is bounded by characters, not by rows: a call of
the tokenizer gets parts of ``CALL`` characters together (many short texts, or
a piece of a long one), its encodings are turned into ids, decoded, compared
and dropped before the next call, and rows leave in batches of ``OUT`` bytes of
text or one row. The tokenizer's own cache of words is off: parts hardly repeat.

The model's path is a parameter, read on the driver; its bytes (at most
``MODEL_BYTES``) are broadcast. Decoding turns pieces back to bytes, the
marker to a blank, and takes the dummy prefix away.

Edge cases. Null and empty texts have no tokens and decode to the empty text.
Bytes that are not UTF-8 count as U+FFFD. A text that holds the marker
character itself (U+2581) decodes with a blank in its place, as in the format.
Rows with null ids and repeated rows each get their row. Empty tables give
empty results. Other columns are not read.
"""

from __future__ import annotations

import os
import re
import struct
from collections.abc import Iterable, Iterator
from typing import Any

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from listinglab.llm.common import ship, slices, texts

#: Where the shared vocabulary files are; any other model file works too.
MODEL = "/opt/tokenizers/piece_bpe_32k.model"
MODEL_BYTES = 64 << 20
THREADS = 2
#: Characters in a part of a long text, and of the parts in one call.
PART, CALL = 8192, 1 << 18
#: Bytes of text in a batch of rows.
OUT = 2 << 20
MARK = "▁"

# Fixed values of the file format: piece types and model types.
NORMAL, UNKNOWN, CONTROL, USER_DEFINED, UNUSED, BYTE = 1, 2, 3, 4, 5, 6
UNIGRAM, BPE = 1, 2

PROBES = ("", " ", "a", "Hello world.", "  two  blanks  ", "line\nline\r\n\ttab", "naïve façade Über straße ñandú", "日本語テキスト",
          "emoji \U0001f600\U0001f680 end", "x" * 40, "-" * 33, " " * 37 + "deep", "0x3f 12,345.67 http://a.b/c?d=e&f",
          "<s> </s> <unk> <0x0A>", "▁marked▁", "a\x00b\x7f", "aaaa bbbbb.....!!!!")


def _fields(data: bytes) -> Iterator[tuple[int, Any]]:
    """(number, value) of the fields of a protobuf message: varints, fixed 32 and 64 bits, byte strings."""
    at = 0

    def varint() -> int:
        nonlocal at
        value = shift = 0
        while True:
            byte = data[at]
            at += 1
            value |= (byte & 0x7F) << shift
            if byte < 0x80:
                return value
            shift += 7

    while at < len(data):
        key = varint()
        kind = key & 7
        if kind == 0:
            value: Any = varint()
        elif kind == 2:
            size = varint()
            value, at = data[at:at + size], at + size
        else:
            size = {1: 8, 5: 4}[kind]
            value, at = data[at:at + size], at + size
        yield key >> 3, value


class Model:
    """What a model file says. Field numbers are those of the public message definition."""

    def __init__(self, data: bytes):
        self.pieces: list[str] = []
        self.scores: list[float] = []
        self.types: list[int] = []
        trainer = normaliser = b""
        for number, value in _fields(data):
            if number == 1:
                piece, score, kind = "", 0.0, NORMAL
                for n, v in _fields(value):
                    if n == 1:
                        piece = v.decode("utf-8")
                    elif n == 2:
                        score = struct.unpack("<f", v)[0]
                    elif n == 3:
                        kind = v
                self.pieces.append(piece)
                self.scores.append(score)
                self.types.append(kind)
            elif number == 2:
                trainer = value
            elif number == 3:
                normaliser = value
        spec, norm = dict(_fields(trainer)), dict(_fields(normaliser))
        self.kind = spec.get(3, UNIGRAM)
        self.by_whitespace = bool(spec.get(22, 1))
        self.suffix = bool(spec.get(24, 0))
        self.byte_fallback = bool(spec.get(35, 0))
        self.charsmap = norm.get(2, b"")
        self.dummy_prefix = bool(norm.get(3, 1))
        self.trim = bool(norm.get(4, 1))
        self.escape = bool(norm.get(5, 1))
        if self.kind not in (UNIGRAM, BPE) or self.suffix or not self.escape or USER_DEFINED in self.types:
            raise ValueError("only unigram and BPE models with a leading whitespace marker and no user-defined pieces are read")
        self.unknown = self.types.index(UNKNOWN)
        inner = any(MARK in p.lstrip(MARK) for p, t in zip(self.pieces, self.types, strict=True) if t == NORMAL)
        self.cuts = self.kind == BPE and not inner


class Codec:
    """The tokenizer of a model: ``encode`` and ``decode`` lists."""

    def __init__(self, data: bytes, threads: int = THREADS):
        os.environ["RAYON_NUM_THREADS"] = str(threads)
        os.environ["TOKENIZERS_PARALLELISM"] = "true"
        from tokenizers import Regex, Tokenizer, models, normalizers

        self.model = m = Model(data)
        ids = {p: k for k, p in enumerate(m.pieces)}
        if m.kind == UNIGRAM:
            core = models.Unigram(list(zip(m.pieces, m.scores, strict=True)), m.unknown, m.byte_fallback)
        else:
            core = models.BPE(ids, self._merges(), unk_token=m.pieces[m.unknown], fuse_unk=True, byte_fallback=m.byte_fallback, cache_capacity=0)
        self.tokenizer = Tokenizer(core)
        steps = [normalizers.Precompiled(m.charsmap)] if m.charsmap else []
        if m.trim:
            steps += [normalizers.Strip(), normalizers.Replace(Regex(" {2,}"), " ")]
        self.prepare = normalizers.Sequence(steps) if steps else None
        self.bytes = [bytes([int(p[3:5], 16)]) if t == BYTE else (b" \xe2\x81\x87 " if t == UNKNOWN else b"") if t in (UNKNOWN, CONTROL)
                      else p.replace(MARK, " ").encode() for p, t in zip(m.pieces, m.types, strict=True)]

    def _merges(self) -> list[tuple[str, str]]:
        """Pairs of pieces that make a piece, best score first; of equal ones the longer left part, as the leftmost goes first."""
        m = self.model
        known = {p: s for p, s, t in zip(m.pieces, m.scores, m.types, strict=True) if t == NORMAL}
        pairs = [(-s, -k, p[:k], p[k:]) for p, s in known.items() for k in range(1, len(p)) if p[:k] in known and p[k:] in known]
        pairs.sort(key=lambda x: x[:2])
        return [(a, b) for _, _, a, b in pairs]

    def normal(self, text: str) -> str:
        """The text as the model sees it: normalised, blanks marked, with the dummy prefix."""
        if self.prepare is not None:
            text = self.prepare.normalize_str(text)
        if not text:
            return ""
        return (MARK if self.model.dummy_prefix else "") + text.replace(" ", MARK)

    def encode(self, texts_: Iterable[str]) -> list[np.ndarray]:
        return [ids for ids, _ in self.encoded(texts_)]

    def encoded(self, texts_: Iterable[str]) -> list[tuple[np.ndarray, bool]]:
        """The ids of each text, and whether they decode to the normalised text."""
        ids: list[list[np.ndarray]] = []
        same: list[bool] = []
        parts: list[str] = []
        owner: list[int] = []

        def call() -> None:
            for k, part, e in zip(owner, parts, self.tokenizer.encode_batch_fast(parts, add_special_tokens=False), strict=True):
                own = e.ids
                ids[k].append(np.array(own, np.int32))
                same[k] = same[k] and b"".join(map(self.bytes.__getitem__, own)).decode("utf-8", "replace") == part.replace(MARK, " ")
            parts.clear()
            owner.clear()

        held = 0
        for k, text in enumerate(map(self.normal, texts_)):
            ids.append([])
            same.append(True)
            for part in self._parts(text):
                if held + len(part) > CALL and parts:
                    call()
                    held = 0
                parts.append(part)
                owner.append(k)
                held += len(part)
        if parts:
            call()
        return [(np.concatenate(x) if x else np.empty(0, np.int32), ok) for x, ok in zip(ids, same, strict=True)]

    def _parts(self, text: str) -> Iterator[str]:
        at = 0
        while self.model.cuts and len(text) - at > PART:
            if (cut := _CUT.search(text, at + PART - 1)) is None:
                break
            yield text[at:cut.end()]
            at = cut.end()
        if at < len(text):
            yield text[at:]

    def decode(self, ids: Iterable[int]) -> str:
        text = b"".join(map(self.bytes.__getitem__, ids)).decode("utf-8", "replace")
        return text[1:] if self.model.dummy_prefix and text.startswith(" ") else text


_CUT = re.compile(f"[^{MARK}](?={MARK})")
_READY: dict[tuple[bytes, int], Codec] = {}


def codec(data: bytes, threads: int = THREADS) -> Codec:
    """The worker's tokenizer of a model, built and verified against the sentencepiece library once."""
    key = (data, threads)
    if key not in _READY:
        import sentencepiece

        made = Codec(data, threads)
        own = sentencepiece.SentencePieceProcessor(model_proto=data).encode(list(PROBES), num_threads=1)
        got = [x.tolist() for x in made.encode(list(PROBES))]
        if got != own:
            wrong = [p for p, a, b in zip(PROBES, got, own, strict=True) if a != b]
            raise ValueError(f"the rebuilt tokenizer differs from the model on {wrong[:3]!r}")
        _READY.clear()
        _READY[key] = made
    return _READY[key]


def _model_bytes(path: str) -> bytes:
    with open(path, "rb") as f:
        data = f.read(MODEL_BYTES + 1)
    if len(data) > MODEL_BYTES:
        raise ValueError(f"{path}: a model of over {MODEL_BYTES} bytes is not broadcast")
    return data


def _sized(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Batches of ``OUT`` bytes of text, or of one row."""
    for batch in batches:
        ends = np.cumsum(pc.binary_length(batch.column("body")).to_numpy(zero_copy_only=False).astype(np.int64))
        at, before = 0, 0
        while at < batch.num_rows:
            stop = max(at + 1, int(np.searchsorted(ends, before + OUT, "right")))
            yield batch.slice(at, stop - at)
            at, before = stop, int(ends[stop - 1])


ENCODED = [T.StructField("n_tokens", T.LongType()), T.StructField("token_ids", T.ArrayType(T.IntegerType())),
           T.StructField("round_trip", T.BooleanType())]


def encode(docs: DataFrame, model_path: str = MODEL, id_col: str = "doc_id", text_col: str = "text", threads: int = THREADS) -> DataFrame:
    """Per row: doc_id, n_tokens, token_ids, round_trip (the ids decode to the normalised text)."""
    source = texts(docs, id_col, text_col)
    held = docs.sparkSession.sparkContext.broadcast(_model_bytes(model_path))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tool = codec(held.value, threads)
        for batch in _sized(slices(batches)):
            found = tool.encoded(b.as_py().decode("utf-8", "replace") for b in batch.column("body"))
            ids, same = [i for i, _ in found], [ok for _, ok in found]
            sizes = [len(i) for i in ids]
            offsets = pa.array(np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32))
            flat = pa.array(np.concatenate(ids) if ids else np.empty(0, np.int32))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(sizes, pa.int64()), pa.ListArray.from_arrays(offsets, flat), pa.array(same, pa.bool_())],
                names=["doc_id", *[f.name for f in ENCODED]])

    return source.mapInArrow(run, T.StructType([source.schema["doc_id"], *ENCODED]))


def decode(tokens: DataFrame, model_path: str = MODEL, id_col: str = "doc_id", ids_col: str = "token_ids") -> DataFrame:
    """Per row: doc_id, text. Null ids of a row decode to the empty text; an id outside the model is an error."""
    source = tokens.select(F.col(id_col).alias("doc_id"), F.col(ids_col).alias("ids"))
    ship(tokens.sparkSession)
    held = tokens.sparkSession.sparkContext.broadcast(_model_bytes(model_path))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tool = codec(held.value)
        for batch in slices(batches):
            out = [tool.decode(x or []) for x in batch.column("ids").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(out, pa.string())], names=["doc_id", "text"])

    return source.mapInArrow(run, T.StructType([source.schema["doc_id"], T.StructField("text", T.StringType())]))
