"""SentencePiece encoding and decoding with the tokenizers library.

The model file is a protobuf; it is parsed here, and its parts are rebuilt as a tokenizers
pipeline: the normaliser (character map, extra white space), the metaspace marker that stands
for a space and is put before a text, byte fallback for characters without a piece, and the
pieces with their scores.  A unigram model becomes a Unigram model with those scores.  A BPE
model becomes a BPE model whose merges are all splits of a piece into two pieces, ordered by
the score of the piece they make.

A text is cut before every run of markers.  If no piece of the model has a marker behind
another character, no piece can cross such a cut, so a text's ids are those of its cuts, one
after the other.  The distinct cuts of a batch are encoded in one multithreaded call of the backend and kept
for later batches (up to `remember` bytes).  Each of them is also decoded, and encoded by the
sentencepiece library.  The ids returned are the backend's; `parity` says that the library agrees on
every cut, and a cut on which they differ gets the library's ids, so that false parity tells how often
that was so.  `round_trip` says that decoding gave every cut back.  A model with pieces across cuts is
used on whole texts in the same way, and each text is decoded and compared on its own.  Texts are
encoded whole, whatever their length; repeated texts have equal rows; an empty table has none.

Null texts have null ids and no tokens, and count as equal; empty texts have none.  Text that looks like
a control piece ("<s>") is ordinary text.  Extra columns stay; clashing ones give way.
"""

from __future__ import annotations

import hashlib
import os
import re
import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

MARK = "▁"
_CUT = re.compile(f"{MARK}+[^{MARK}]*|[^{MARK}]+")
# Numbers of fields and kinds in the model's protobuf.
UNIGRAM, BPE = 1, 2
NORMAL, UNKNOWN, CONTROL, USER, UNUSED, BYTE = 1, 2, 3, 4, 5, 6


def _varint(data: bytes, at: int) -> tuple[int, int]:
    value = shift = 0
    while True:
        byte = data[at]
        at += 1
        value |= (byte & 127) << shift
        shift += 7
        if byte < 128:
            return value, at


def read_fields(data: bytes) -> Iterator[tuple[int, int | bytes]]:
    """(field number, value) of a protobuf message; lengths give bytes, fixed widths raw bytes."""
    at = 0
    while at < len(data):
        key, at = _varint(data, at)
        kind = key & 7
        if kind == 0:
            value, at = _varint(data, at)
        else:
            size = {1: 8, 5: 4}.get(kind)
            if size is None:
                size, at = _varint(data, at)
            value, at = data[at : at + size], at + size
        yield key >> 3, value


class Model:
    """What a model file says."""

    def __init__(self, data: bytes):
        self.pieces: list[tuple[str, float, int]] = []
        trainer: dict = {}
        norm: dict = {}
        for number, value in read_fields(data):
            if number == 1:
                piece = dict(read_fields(value))
                self.pieces.append((piece[1].decode(), struct.unpack("<f", piece.get(2, bytes(4)))[0], piece.get(3, NORMAL)))
            elif number == 2:
                trainer = dict(read_fields(value))
            elif number == 3:
                norm = dict(read_fields(value))
        self.kind = trainer.get(3, UNIGRAM)
        self.byte_fallback = bool(trainer.get(35, 0))
        self.unknown = next((i for i, p in enumerate(self.pieces) if p[2] == UNKNOWN), 0)
        self.suffix = bool(trainer.get(24, 0))
        self.char_map = norm.get(2, b"")
        self.prefix, self.squeeze, self.escape = bool(norm.get(3, 1)), bool(norm.get(4, 1)), bool(norm.get(5, 1))
        crossing = any(re.search(f"[^{MARK}]{MARK}", p) for p, _, kind in self.pieces if kind in (NORMAL, USER))
        self.by_cuts = self.prefix and self.escape and not (crossing or self.squeeze or self.suffix or self.char_map)
        if self.kind not in (UNIGRAM, BPE) or self.suffix or not self.escape:
            raise ValueError("unigram and BPE models with a leading marker are supported")


def _merges(model: Model) -> list[tuple[str, str]]:
    ids = {p: i for i, (p, _, kind) in enumerate(model.pieces) if kind in (NORMAL, USER)}
    found = []
    for piece, score, kind in model.pieces:
        if kind in (NORMAL, USER):
            for i in range(1, len(piece)):
                if piece[:i] in ids and piece[i:] in ids:
                    found.append((-score, ids[piece], i, piece))
    return [(p[:i], p[i:]) for _, _, i, p in sorted(found)]


class Codec:
    """Encoder and decoder of one model, with a memory of cuts."""

    def __init__(self, data: bytes, remember: int = 64 << 20):
        import sentencepiece
        from tokenizers import Regex, Tokenizer, decoders, models, normalizers

        self.model = model = Model(data)
        self.remember, self.held = remember, 0
        self.known: dict[str, bytes] = {}
        #: Cuts of which the two libraries make different ids, and cuts that don't come back.
        self.differ: set[str] = set()
        self.lost: set[str] = set()
        if model.kind == BPE:
            vocab = {p: i for i, (p, _, _) in enumerate(model.pieces)}
            inner = models.BPE(vocab=vocab, merges=_merges(model), unk_token=model.pieces[model.unknown][0], fuse_unk=True, byte_fallback=model.byte_fallback)
        else:
            inner = models.Unigram([(p, s) for p, s, _ in model.pieces], model.unknown, model.byte_fallback)
        self.backend = Tokenizer(inner)
        steps = [normalizers.Precompiled(model.char_map)] if model.char_map else []
        if model.squeeze:
            steps += [normalizers.Replace(Regex("^ +| +$"), ""), normalizers.Replace(Regex(" +"), " ")]
        steps += [normalizers.Prepend(MARK)] if model.prefix else []
        self.normal = normalizers.Sequence([*steps, normalizers.Replace(" ", MARK)])
        ends = [decoders.Replace(MARK, " "), decoders.ByteFallback(), decoders.Fuse()]
        self.backend.decoder = decoders.Sequence([*ends, decoders.Strip(" ", 1, 0)] if model.prefix else ends)
        self.other = sentencepiece.SentencePieceProcessor(model_proto=data)

    def cuts(self, text: str) -> list[str]:
        """Normalised parts that are encoded on their own."""
        if not text:
            return []
        if self.model.by_cuts:
            return _CUT.findall(MARK + text.replace(" ", MARK))
        return [self.normal.normalize_str(text)]

    def _learn(self, cuts: list[str], plain: list[str]) -> None:
        """Remember the backend's ids of new cuts; the library's only where the two differ, which `parity` then tells."""
        ids = [e.ids for e in self.backend.encode_batch_fast(cuts, add_special_tokens=False)]
        theirs = self.other.encode(plain, num_threads=1)
        if self.model.by_cuts and "" in plain:  # a marker that ends a text: the library only makes it behind something
            theirs[plain.index("")] = self.other.encode("a ")[len(self.other.encode("a")) :]
        for i, (cut, other) in enumerate(zip(cuts, theirs, strict=True)):
            if ids[i] != other:
                self.differ.add(cut)
                ids[i] = other
        for cut, text, each, again in zip(cuts, plain, ids, self.decode(ids), strict=True):
            packed = struct.pack(f"<{len(each)}i", *each)
            self.known[cut] = packed
            self.held += len(packed) + 4 * len(cut) + 150  # about what an entry takes
            if again != text:
                self.lost.add(cut)

    def encode(self, texts: list[str | None]) -> list[tuple[bytes, bool, bool]]:
        """For each text its ids (32-bit, packed), parity and round trip."""
        parts = [self.cuts(t or "") for t in texts]
        if self.held > self.remember:
            self.known, self.differ, self.lost, self.held = {}, set(), set(), 0
        new: dict[str, str] = {}
        for text, cuts in zip(texts, parts, strict=True):
            for cut in set(cuts).difference(self.known).difference(new):
                new[cut] = cut[1:].replace(MARK, " ") if self.model.by_cuts else text
        if new:
            self._learn(list(new), list(new.values()))
        out = []
        for text, cuts in zip(texts, parts, strict=True):
            ids = b"".join(map(self.known.__getitem__, cuts))
            if self.model.by_cuts:
                # A marker in the text comes back as a space.
                back = MARK not in (text or "") and self.lost.isdisjoint(cuts)
            else:
                back = text is None or self.decode([np.frombuffer(ids, "<i4").tolist()])[0] == text
            out.append((ids, self.differ.isdisjoint(cuts), back))
        return out

    def decode(self, ids: list[list[int]]) -> list[str]:
        return self.backend.decode_batch(ids, skip_special_tokens=False)


_CODECS: dict[bytes, Codec] = {}


def codec(data: bytes, threads: int = 2) -> Codec:
    """The codec of a model, built once per Python worker."""
    key = hashlib.sha256(data).digest()
    if key not in _CODECS:
        os.environ.setdefault("RAYON_NUM_THREADS", str(threads))
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "true")
        _CODECS[key] = Codec(data)
    return _CODECS[key]


def _chunks(texts: list[str | None], most: int = 2_000_000) -> Iterator[list[str | None]]:
    """Neighbouring texts of `most` characters in all, or one longer text."""
    chunk, size = [], 0
    for text in texts:
        if chunk and size + len(text or "") > most:
            yield chunk
            chunk, size = [], 0
        chunk.append(text)
        size += len(text or "")
    if chunk:
        yield chunk


_ENCODED = T.StructType(
    [T.StructField("ids", T.ArrayType(T.IntegerType())), T.StructField("parity", T.BooleanType()), T.StructField("round_trip", T.BooleanType())]
)


def encode(docs: DataFrame, model: bytes, threads: int = 2) -> DataFrame:
    """The documents with `ids`, `n_tokens`, `parity` and `round_trip`."""

    @F.arrow_udf(returnType=_ENCODED)
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        worker = codec(model, threads)
        for batch in batches:
            texts = batch.to_pylist()
            rows = [r for chunk in _chunks(texts) for r in worker.encode(chunk)]
            ends = np.concatenate([[0], np.cumsum([len(r[0]) // 4 for r in rows])]).astype(np.int32)
            values = pa.array(np.frombuffer(b"".join(r[0] for r in rows), "<i4"))
            lists = pa.ListArray.from_arrays(pa.array(ends), values, mask=pa.array([t is None for t in texts], pa.bool_()))
            yield pa.StructArray.from_arrays([lists, pa.array([r[1] for r in rows], pa.bool_()), pa.array([r[2] for r in rows], pa.bool_())], ["ids", "parity", "round_trip"])

    own = [c for c in docs.columns if c not in ("ids", "n_tokens", "parity", "round_trip", "_encoded")]
    made = docs.select(*own, run.asNondeterministic()(F.col("text")).alias("_encoded")).select(*own, "_encoded.*")
    return made.withColumn("n_tokens", F.coalesce(F.size("ids"), F.lit(0)).cast("long"))


def decode(rows: DataFrame, model: bytes, threads: int = 2) -> DataFrame:
    """Rows with `ids`, and `text` decoded from them (null for null ids)."""

    @F.arrow_udf(returnType=T.StringType())
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        worker = codec(model, threads)
        for batch in batches:
            ids = batch.to_pylist()
            texts = worker.decode([i or [] for i in ids])
            yield pa.array([None if i is None else t for i, t in zip(ids, texts, strict=True)], pa.string())

    return rows.withColumn("text", run.asNondeterministic()(F.col("ids")))


def read_model(path: str) -> bytes:
    """A model file of the driver; it travels to the workers with the function."""
    with open(path, "rb") as f:
        return f.read()
